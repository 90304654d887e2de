from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import policy as P
from ..sources.tables import Tables
from .views import sql

_NAMES = ("Reuters Institute Digital", "Reuters News", "AP News", "Aperture", "The Kyodo Times", "Stafford Post", "", None, "daily bloomberg wire", "Tass", "Quiet Journal")


def _pick(values, index):  # noqa: ANN001, ANN202
    return F.element_at(F.array(*(F.lit(v).cast("string") for v in values)), (index % len(values) + 1).cast("int"))


def _gate_rows(t: Tables):  # noqa: ANN202
    d = t.documents().select("doc_id", F.col("source").alias("sid"))
    p = t.source_policy().select(F.col("source_id").alias("sid"), "archive_policy", "cloud_policy", "llm_policy")
    x = d.join(p, "sid", "left")
    i = F.col("doc_id")
    return x.select(
        "doc_id",
        _pick((*P.STAGES, "mystery"), F.floor(i / 7)).alias("stage"),
        _pick((*P.ACTIONS, "nap"), i).alias("action"),
        F.when(F.col("archive_policy").isNotNull(), F.col("sid")).alias("source_id"),
        F.when(i % 97 == 5, "odd").otherwise(F.coalesce("archive_policy", F.lit("unknown"))).alias("archive"),
        F.when(i % 89 == 5, "unknown").otherwise(F.coalesce("cloud_policy", F.lit("unknown"))).alias("cloud"),
        F.when(i % 83 == 5, "allowed").otherwise(F.coalesce("llm_policy", F.lit("unknown"))).alias("llm"),
        _pick(_NAMES, F.floor(i / 3)).alias("source_name"),
    )


def _gate(s, d):  # noqa: ANN001, ANN202
    return P.gate(_gate_rows(Tables(s, d))).select("doc_id", "error", "triggers", "gate_mode", "decision")


def _rationale(s, d):  # noqa: ANN001, ANN202
    rows = _gate_rows(Tables(s, d))
    found = P.explained_risks(*(F.col(c) for c in ("source_id", "archive", "cloud", "llm", "action", "source_name")))
    return rows.select("doc_id", F.posexplode(found).alias("place", "x")).select("doc_id", F.col("place").cast("long").alias("place"), "x.trigger", "x.rationale")


def _wire(s, d):  # noqa: ANN001, ANN202
    x = _gate_rows(Tables(s, d))
    return x.groupBy("source_name", P.is_wire_service(F.col("source_name")).alias("wire")).agg(F.count(F.lit(1)).alias("n"))


def _severities(t: Tables):  # noqa: ANN202
    return t.intervention().withColumn("severity", P.severity(F.col("gate_mode"), F.col("importance"), F.col("linked")))


def _report(s, d):  # noqa: ANN001, ANN202
    items = _severities(Tables(s, d)).filter("status = 'pending_user_review'").withColumn("severity", F.when(F.col("intervention_id") % 50 == 3, "ODD").otherwise(F.col("severity")))
    return P.batch_report(items)


def _markdown(s, d):  # noqa: ANN001, ANN202
    return P.markdown(_severities(Tables(s, d)).filter("status = 'pending_user_review'").withColumn("importance", F.round("importance", 0)))


def _review(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    actions = t.base("events").filter("event_type in ('error', 'click')").select(F.col("event_id").alias("intervention_id"), _pick(("ignore", "manual_claim", "temp_text", "burn"), F.col("event_id")).alias("action"), F.col("ts").alias("at"))
    return P.review(actions, t.intervention().select("intervention_id", "importance", "status"))


def _claims(t: Tables):  # noqa: ANN202
    i, x = F.col("doc_id"), F.coalesce("text", F.lit(""))
    return t.documents().select(
        "doc_id",
        "source",
        F.when(i % 3 == 0, F.substring(x, 1, 50)).otherwise(F.when(i % 3 == 1, "")).alias("written"),
        F.when((i % 3 == 1) | (i % 30 == 0), F.substring(x, 1, 40)).alias("opinion"),
        F.when((i % 3 == 2) & (i % 10 != 8), F.substring(x, F.lit(1), (150 + i % 100).cast("int"))).alias("quote"),
        F.when(i % 23 == 0, "rumour").otherwise("browser").alias("via"),
        ((i * 37 % 110) / 100).alias("confidence"),
        F.when(i % 5 != 0, "critique").alias("reason"),
        F.when(i % 7 != 0, "https://a.example/x").otherwise("").alias("url"),
    )


def _kind(s, d):  # noqa: ANN001, ANN202
    return P.claim_kind(_claims(Tables(s, d))).select("doc_id", "error", "kind")


def _create_claims(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    ok = P.claim_kind(_claims(t)).filter("error is null")
    return ok.join(t.source_policy().select(F.col("source_id").alias("source")), "source", "left_semi").select(F.concat(F.lit("mcl_"), "doc_id").alias("claim_id"), F.col("source").alias("source_id"), "kind", "confidence")


def _llm_gate(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    rows = t.documents().select("doc_id", F.col("source").alias("source_id"))
    return P.lookup(rows, t.source_policy(), "llm_policy").select("doc_id", P.llm_verdict(F.col("llm_policy")).alias("verdict"))


def _lookup(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    return P.lookup(t.documents().select("doc_id", F.col("source").alias("source_id")), t.source_policy(), "archive_policy").select("doc_id", "archive_policy", "error")


def _create(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    return P.create_interventions(t.intervention(), t.source_policy())


def _enums(s, d):  # noqa: ANN001, ANN202
    x = _gate_rows(Tables(s, d))
    bad = F.array_compact(F.array(F.when(~F.col("archive").isin("unknown", *P.ARCHIVE), "archive"), F.when(~F.col("stage").isin(*P.STAGES), "stage"), F.when(~F.col("action").isin(*P.ACTIONS), "action")))
    return x.select("doc_id", F.explode(bad).alias("column_name"))


QUERIES = {
    "policy_lookup": _lookup,
    "llm_gate": _llm_gate,
    "policy_gate": _gate,
    "policy_gate_rationale": _rationale,
    "wire_service": _wire,
    "severity": lambda s, d: _severities(Tables(s, d)).select("intervention_id", "gate_mode", "severity"),
    "batch_report": _report,
    "batch_report_markdown": _markdown,
    "review_actions": _review,
    "manual_claim_kind": _kind,
    "manual_claim_create": _create_claims,
    "intervention_create": _create,
    "enum_violations": _enums,
}


def _list(values) -> str:  # noqa: ANN001
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


def _in(values) -> str:  # noqa: ANN001
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_ROWS = f"""g AS (SELECT d.doc_id, ({_list((*P.STAGES, "mystery"))})[(d.doc_id // 7) % 6 + 1] AS stage, ({_list((*P.ACTIONS, "nap"))})[d.doc_id % 12 + 1] AS action, p.source_id,
    CASE WHEN d.doc_id % 97 = 5 THEN 'odd' ELSE coalesce(p.archive_policy, 'unknown') END AS archive, CASE WHEN d.doc_id % 89 = 5 THEN 'unknown' ELSE coalesce(p.cloud_policy, 'unknown') END AS cloud,
    CASE WHEN d.doc_id % 83 = 5 THEN 'allowed' ELSE coalesce(p.llm_policy, 'unknown') END AS llm, ({_list(_NAMES)})[(d.doc_id // 3) % 11 + 1] AS source_name FROM documents d LEFT JOIN source_policy p ON p.source_id = d.source),
    w AS (SELECT *, coalesce(regexp_matches(lower(source_name), 'associated press|agence france-presse|bloomberg|yonhap|kyodo|xinhua|interfax|\\bap\\b|\\bafp\\b|\\btass\\b')
        OR (regexp_matches(lower(source_name), '\\breuters\\b') AND NOT regexp_matches(lower(source_name), '\\breuters\\s+institute')), false) AS wire FROM g)"""
_FIT = " OR ".join(f"(stage = '{s}' AND action IN {_in(a)})" for s, (_, a) in P.STAGES.items())
_MODE = " ".join(f"WHEN '{s}' THEN '{m}'" for s, (m, _) in P.STAGES.items())
_SEV = """sev AS (SELECT *, (['LOW','MEDIUM','HIGH','CRITICAL'])[least(4, (CASE gate_mode WHEN 'inline_block' THEN [3,3,4] WHEN 'inline_warn' THEN [1,2,3] ELSE [1,1,2] END)[CASE WHEN importance < 0.4 THEN 1 WHEN importance < 0.7 THEN 2 ELSE 3 END] + linked::INT)] AS severity FROM intervention)"""
_CLAIMS = """c AS (SELECT doc_id, source, CASE WHEN doc_id % 3 = 0 THEN substring(coalesce(text, ''), 1, 50) WHEN doc_id % 3 = 1 THEN '' END AS written, CASE WHEN doc_id % 3 = 1 OR doc_id % 30 = 0 THEN substring(coalesce(text, ''), 1, 40) END AS opinion,
    CASE WHEN doc_id % 3 = 2 AND doc_id % 10 <> 8 THEN substring(coalesce(text, ''), 1, CAST(150 + doc_id % 100 AS BIGINT)) END AS quote, CASE WHEN doc_id % 23 = 0 THEN 'rumour' ELSE 'browser' END AS via,
    (doc_id * 37 % 110) / 100 AS confidence, CASE WHEN doc_id % 5 <> 0 THEN 'critique' END AS reason, CASE WHEN doc_id % 7 <> 0 THEN 'https://a.example/x' ELSE '' END AS url FROM documents),
    h AS (SELECT *, coalesce(length(written) > 0, false) AS hw, coalesce(length(opinion) > 0, false) AS ho, coalesce(length(quote) > 0, false) AS hq FROM c),
    k AS (SELECT *, CASE WHEN hw::INT + ho::INT + hq::INT = 0 THEN 'no_text' WHEN hw::INT + ho::INT + hq::INT > 1 THEN 'several_texts' WHEN via NOT IN ('browser', 'print', 'broadcast', 'subscription') THEN 'invalid_via' WHEN confidence > 1 OR confidence < 0 THEN 'invalid_confidence'
    WHEN hq AND reason IS NULL THEN 'quote_reason_missing' WHEN hq AND url = '' THEN 'attribution_missing' WHEN hq AND length(quote) > 200 THEN 'quote_too_long' END AS error FROM h),
    kk AS (SELECT *, CASE WHEN error IS NULL THEN CASE WHEN hq THEN 'referenced_quote' WHEN hw THEN 'user_written_claim' ELSE 'user_opinion' END END AS kind FROM k)"""
SQL = {
    "policy_lookup": sql("SELECT d.doc_id, p.archive_policy, CASE WHEN p.source_id IS NULL THEN 'source_not_registered' END AS error FROM documents d LEFT JOIN source_policy p ON p.source_id = d.source"),
    "llm_gate": sql("SELECT d.doc_id, CASE WHEN p.source_id IS NULL THEN 'error_not_registered' WHEN llm_policy = 'allowed' THEN 'ok' ELSE 'error_' || llm_policy END AS verdict FROM documents d LEFT JOIN source_policy p ON p.source_id = d.source"),
    "policy_gate_rationale": sql(f"""WITH {_ROWS}, nf AS (SELECT *, action || ' needs archive_policy full_snapshot_allowed, not ' || archive AS need, archive <> 'full_snapshot_allowed' AS part, coalesce(trim(source_name), '') = '' AS nameless FROM w),
        r AS (SELECT doc_id, unnest([
            {{'n': 1, 't': 'external_llm_raw_text_unauthorized', 'w': action LIKE 'external_llm%' AND (source_id IS NULL OR llm <> 'allowed'), 'r': CASE WHEN source_id IS NULL THEN action || ' for a source that is not registered' ELSE action || ' needs llm_policy allowed, not ' || llm END}},
            {{'n': 2, 't': 'paywalled_source_fetch', 'w': action IN ('extract_full_text', 'chunk_create') AND archive IN ('metadata_only', 'excerpt_only'), 'r': action || ' of a source with archive_policy ' || archive}},
            {{'n': 3, 't': 'terms_violation', 'w': action NOT IN ('image_inclusion', 'publication_preflight') AND (source_id IS NULL OR archive = 'do_not_collect'), 'r': CASE WHEN source_id IS NULL THEN action || ': the terms of an unregistered source are not known' ELSE action || ': the terms forbid collection' END}},
            {{'n': 4, 't': 'wire_service_full_text', 'w': action IN ('extract_full_text', 'chunk_create') AND (CASE WHEN nameless THEN source_id IS NOT NULL ELSE wire END), 'r': CASE WHEN nameless THEN action || ': source ' || source_id || ' has no name, and may be a wire service' ELSE action || ' of a wire service: ' || source_name END}},
            {{'n': 5, 't': 'article_raw_quote_or_cache', 'w': action IN ('quote_storage', 'raw_cache') AND part, 'r': need}},
            {{'n': 6, 't': 'image_inclusion_without_license', 'w': action = 'image_inclusion', 'r': 'no licences of images are kept'}},
            {{'n': 7, 't': 'raw_embedding', 'w': action = 'embed' AND part, 'r': need}},
            {{'n': 8, 't': 'raw_cloud_upload', 'w': action = 'r2_upload' AND NOT (archive = 'full_snapshot_allowed' AND cloud = 'allowed_public_data_only'), 'r': need || ', and cloud_policy allowed_public_data_only, not ' || cloud}}]) AS x FROM nf)
        SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY x.n) - 1 AS place, x.t AS trigger, x.r AS rationale FROM r WHERE x.w"""),
    "policy_gate": sql(f"""WITH {_ROWS}, e AS (SELECT *, CASE WHEN stage NOT IN {_in(P.STAGES)} THEN 'invalid_stage' WHEN action NOT IN {_in(P.ACTIONS)} THEN 'invalid_action' WHEN archive NOT IN {_in(("unknown", *P.ARCHIVE))} THEN 'invalid_archive'
        WHEN source_id IS NOT NULL AND archive = 'unknown' THEN 'registered_unknown_archive' WHEN source_id IS NOT NULL AND cloud = 'unknown' THEN 'registered_unknown_cloud' WHEN source_id IS NOT NULL AND llm = 'unknown' THEN 'registered_unknown_llm'
        WHEN source_id IS NULL AND archive <> 'unknown' THEN 'unregistered_known_archive' WHEN source_id IS NULL AND cloud <> 'unknown' THEN 'unregistered_known_cloud' WHEN source_id IS NULL AND llm <> 'unknown' THEN 'unregistered_known_llm' END AS ie,
        concat_ws(',', CASE WHEN action LIKE 'external_llm%' AND (source_id IS NULL OR llm <> 'allowed') THEN 'external_llm_raw_text_unauthorized' END,
        CASE WHEN action IN ('extract_full_text', 'chunk_create') AND archive IN ('metadata_only', 'excerpt_only') THEN 'paywalled_source_fetch' END,
        CASE WHEN action NOT IN ('image_inclusion', 'publication_preflight') AND (source_id IS NULL OR archive = 'do_not_collect') THEN 'terms_violation' END,
        CASE WHEN action IN ('extract_full_text', 'chunk_create') AND (CASE WHEN coalesce(trim(source_name), '') = '' THEN source_id IS NOT NULL ELSE wire END) THEN 'wire_service_full_text' END,
        CASE WHEN action IN ('quote_storage', 'raw_cache') AND archive <> 'full_snapshot_allowed' THEN 'article_raw_quote_or_cache' END, CASE WHEN action = 'image_inclusion' THEN 'image_inclusion_without_license' END,
        CASE WHEN action = 'embed' AND archive <> 'full_snapshot_allowed' THEN 'raw_embedding' END,
        CASE WHEN action = 'r2_upload' AND NOT (archive = 'full_snapshot_allowed' AND cloud = 'allowed_public_data_only') THEN 'raw_cloud_upload' END) AS tr FROM w),
        v AS (SELECT *, coalesce(ie, CASE WHEN tr = '' AND NOT ({_FIT}) THEN 'incompatible_stage_action' END) AS error FROM e),
        m AS (SELECT *, CASE WHEN error IS NULL THEN CASE WHEN tr <> '' THEN 'inline_block' ELSE CASE stage {_MODE} END END END AS gate_mode FROM v)
        SELECT doc_id, error, CASE WHEN ie IS NULL THEN tr ELSE '' END AS triggers, gate_mode, CASE gate_mode WHEN 'inline_block' THEN 'block' WHEN 'inline_warn' THEN 'warn' WHEN 'batch_report' THEN 'allow' END AS decision FROM m"""),
    "wire_service": sql(f"WITH {_ROWS} SELECT source_name, wire, count(*) AS n FROM w GROUP BY 1, 2"),
    "severity": sql(f"WITH {_SEV} SELECT intervention_id, gate_mode, severity FROM sev"),
    "batch_report": sql(f"""WITH {_SEV}, x AS (SELECT session_id, CASE WHEN intervention_id % 50 = 3 THEN 'HIGH' ELSE severity END AS severity FROM sev WHERE status = 'pending_user_review')
        SELECT session_id, severity, count(*) AS n, CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END::INT AS position, severity IN ('CRITICAL', 'HIGH') AS blocks FROM x GROUP BY 1, 2"""),
    "batch_report_markdown": sql(f"""WITH {_SEV}, p AS (SELECT session_id, severity, CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END AS r, count(*) AS n,
        string_agg('- ' || intervention_id || ' ' || source_id || ' ' || printf('%.2f', round(importance)), chr(10) ORDER BY created_at, intervention_id) AS body FROM sev WHERE status = 'pending_user_review' GROUP BY 1, 2)
        SELECT session_id, '# Access report' || chr(10) || chr(10) || string_agg('## ' || severity || ' (' || n || ')' || chr(10) || body, chr(10) || chr(10) ORDER BY r) AS markdown FROM p GROUP BY 1"""),
    "review_actions": sql("""WITH a AS (SELECT event_id AS intervention_id, (['ignore','manual_claim','temp_text','burn'])[event_id % 4 + 1] AS action, ts FROM events WHERE event_type IN ('error', 'click')),
        j AS (SELECT a.*, i.status AS st, i.importance AS imp, CASE WHEN i.status IS NULL THEN 'not_found' WHEN i.status <> 'pending_user_review' THEN 'not_pending' WHEN action = 'burn' THEN 'unknown_action' END AS error FROM a LEFT JOIN intervention i USING (intervention_id))
        SELECT intervention_id, action, error, CASE WHEN error IS NULL THEN 'resolved_' || action ELSE st END AS status, CASE WHEN error IS NULL AND action = 'ignore' THEN greatest(imp - 0.2::DOUBLE, 0.0::DOUBLE) ELSE imp END AS importance,
        CASE WHEN error IS NULL AND action = 'temp_text' THEN strftime(ts + INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') END AS expires_at FROM j"""),
    "manual_claim_kind": f"WITH {_CLAIMS} SELECT doc_id, error, kind FROM kk",
    "manual_claim_create": sql(f"WITH {_CLAIMS} SELECT 'mcl_' || doc_id AS claim_id, source AS source_id, kind, confidence FROM kk WHERE error IS NULL AND source IN (SELECT source_id FROM source_policy)"),
    "intervention_create": sql("SELECT i.intervention_id, i.source_id, greatest(0.0::DOUBLE, least(1.0::DOUBLE, importance)) AS importance, CASE WHEN p.source_id IS NULL THEN 'source_missing' END AS error FROM intervention i LEFT JOIN source_policy p USING (source_id)"),
    "enum_violations": sql(f"WITH {_ROWS} SELECT doc_id, 'archive' AS column_name FROM g WHERE archive = 'odd' UNION ALL SELECT doc_id, 'stage' FROM g WHERE stage = 'mystery' UNION ALL SELECT doc_id, 'action' FROM g WHERE action = 'nap'"),
}
