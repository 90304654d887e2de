from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit as A
from ..scratch import Scratch
from ..sources.tables import Tables
from .views import sql


def _parts(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    return t.keyed_snapshot(), t.upload_audit(), t.doc_source_edge(), t.source_policy()


def _hashed_once(s, d):  # noqa: ANN001, ANN202
    """The parts over written hashes: a scan reads them on several axes, and the texts once."""
    t = Tables(s, d)
    t.hold_hashes(Scratch(s, "audit"))
    return t.keyed_snapshot(), t.upload_audit(), t.doc_source_edge(), t.source_policy()


def _scan(s, d):  # noqa: ANN001, ANN202
    return A.scan(*_hashed_once(s, d))


def _counts(s, d):  # noqa: ANN001, ANN202
    k, a, e, p = _hashed_once(s, d)
    return A.counts(k, a, p, A.scan(k, a, e, p))


def _axis3(s, d):  # noqa: ANN001, ANN202
    k, _, e, p = _parts(s, d)
    return A.restricted_keys(k, e, p).select("snap_id", "object_key", F.array_join("restricted", ",").alias("restricted"), "has_unregistered")


def _axis1(s, d):  # noqa: ANN001, ANN202
    k, a, e, _ = _parts(s, d)
    return A.key_without_audit(k, a, e).select("snap_id", "object_key", F.array_join("sources", ",").alias("sources"))


def _pairing(s, d):  # noqa: ANN001, ANN202
    a = Tables(s, d).upload_audit()
    events = a.filter("snap_id is not null").select("attempt_id", F.lit("attempted").alias("decision")).unionByName(a.filter("rationale <> 'no id here'").select("attempt_id", "decision")).unionByName(a.filter("decision = 'skipped_toctou'").select("attempt_id", "decision"))
    return A.pairing(events)


def _outcome(s, d):  # noqa: ANN001, ANN202
    f = Tables(s, d).snapshot_allowed()
    return A.upload_outcome(f.select("snap_id", (F.col("allowed") | (F.col("first_doc") % 3 == 0)).alias("allowed_before"), (F.col("allowed") | (F.col("first_doc") % 2 == 0)).alias("allowed_after"), (F.col("first_doc") % 5 != 0).alias("set_ok")))


def _rationale(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    return (
        t.doc_source_edge()
        .join(t.source_policy(), "source_id")
        .select("doc_id", A.rationale(F.col("snap_id"), F.col("archive_policy"), F.col("cloud_policy"), F.when(F.col("doc_id") % 2 == 0, F.lit("retry")).otherwise(F.lit(""))).alias("rationale"))
    )


def _keys(s, d):  # noqa: ANN001, ANN202
    head = F.element_at(F.array(*map(F.lit, (*A.KEY_PREFIXES, "private/", "Backups/neo4j/"))), (F.col("doc_id") % 11 + 1).cast("int"))
    rows = Tables(s, d).documents().select("doc_id", F.concat(head, "doc_id").alias("object_key"))
    return rows.select("doc_id", A.matched_prefix(F.col("object_key")).alias("prefix"), A.matched_prefix(F.col("object_key")).isNotNull().alias("permitted"))


def _surrogate(s, d):  # noqa: ANN001, ANN202
    e = Tables(s, d).base("events")
    return e.select("event_id", A.surrogate_id("pdec_", F.col("ts"), F.col("event_id")).alias("decision_id"))


QUERIES = {
    "snapshot_allowed_forall": lambda s, d: Tables(s, d).snapshot_allowed(),
    "audit_axis_1": _axis1,
    "audit_axis_2": lambda s, d: A.audit_without_key(*_parts(s, d)[:2]),
    "audit_axis_3": _axis3,
    "audit_axis_4": lambda s, d: A.orphan_objects(_parts(s, d)[1], "set_r2_key_failed_neo4j"),
    "audit_axis_4b": lambda s, d: A.orphan_objects(_parts(s, d)[1], "skipped_toctou"),
    "audit_axis_5": lambda s, d: A.malformed(_parts(s, d)[1]),
    "audit_axis_6": lambda s, d: A.drifted(_parts(s, d)[1]),
    "audit_scan": _scan,
    "audit_counts": _counts,
    "audit_pairing": _pairing,
    "upload_outcome": _outcome,
    "audit_rationale": _rationale,
    "key_prefix_check": _keys,
    "violations_json": lambda s, d: A.as_json_lines(_scan(s, d)),
    "surrogate_id": _surrogate,
}

_RESOLVED = """r AS (SELECT *, CASE WHEN regexp_matches(snap_id, '^snap_[A-Za-z0-9_-]+$') THEN snap_id END AS column_id,
    nullif(regexp_extract(rationale, '^snap_id=(snap_[A-Za-z0-9_-]+)(;|$)', 1), '') AS rationale_id FROM upload_audit),
    resolved AS (SELECT *, coalesce(column_id, rationale_id) AS snap FROM r)"""
_LINKS = "links AS (SELECT DISTINCT snap_id, source_id FROM doc_source_edge)"
_A1 = f"""{_LINKS}, a1 AS (SELECT k.snap_id, k.object_key, coalesce(string_agg(l.source_id, ',' ORDER BY l.source_id), '') AS sources FROM keyed_snapshot k LEFT JOIN links l USING (snap_id)
    WHERE k.snap_id NOT IN (SELECT snap FROM resolved WHERE decision = 'uploaded' AND snap IS NOT NULL) GROUP BY 1, 2)"""
_A2 = "a2 AS (SELECT snap, attempt_id, decision_id FROM resolved WHERE decision = 'uploaded' AND snap IS NOT NULL AND snap NOT IN (SELECT snap_id FROM keyed_snapshot))"
_A3 = """x3 AS (SELECT k.snap_id, k.object_key, l.source_id || '|' || coalesce(p.archive_policy, '<unregistered>') || '|' || coalesce(p.cloud_policy, '<unregistered>') AS x, p.source_id IS NULL AS unreg
    FROM keyed_snapshot k JOIN links l USING (snap_id) LEFT JOIN source_policy p USING (source_id) WHERE p.source_id IS NULL OR p.archive_policy <> 'full_snapshot_allowed' OR p.cloud_policy <> 'allowed_public_data_only'),
    a3 AS (SELECT snap_id, object_key, string_agg(x, ',' ORDER BY x) AS restricted, bool_or(unreg) AS has_unregistered FROM x3 GROUP BY 1, 2)"""
_A4 = "SELECT snap, attempt_id, decision_id, 'permitted_artifact/snapshot/' || snap AS expected_key FROM resolved WHERE decision = '{}' AND snap IS NOT NULL"
_A5 = "SELECT decision, attempt_id, decision_id, substring(coalesce(rationale, ''), 1, 120) AS rationale_prefix FROM resolved WHERE snap IS NULL"
_A6 = "SELECT column_id, rationale_id, decision, attempt_id, decision_id FROM resolved WHERE column_id <> rationale_id"
_ALL = f"""{_RESOLVED}, {_A1}, {_A2}, {_A3}, v AS (
    SELECT 'r2_key_without_audit' AS type, snap_id, object_key || '|' || sources AS detail FROM a1
    UNION ALL SELECT 'audit_uploaded_without_r2_key', snap, attempt_id || '|' || decision_id FROM a2
    UNION ALL SELECT 'r2_key_with_restricted_source', snap_id, restricted || '|' || has_unregistered FROM a3
    UNION ALL SELECT 'r2_object_without_graph_key_set_failed', snap, attempt_id || '|' || decision_id || '|' || expected_key FROM ({_A4.format("set_r2_key_failed_neo4j")})
    UNION ALL SELECT 'r2_object_without_graph_key_policy_recheck_skipped', snap, attempt_id || '|' || decision_id || '|' || expected_key FROM ({_A4.format("skipped_toctou")})
    UNION ALL SELECT 'malformed_r2_upload_audit_row', '<unparseable>', decision || '|' || attempt_id || '|' || decision_id || '|' || rationale_prefix FROM ({_A5})
    UNION ALL SELECT 'r2_audit_column_rationale_drift', column_id, decision || '|' || attempt_id || '|' || decision_id || '|' || column_id || '|' || rationale_id FROM ({_A6}))"""
SQL = {
    "snapshot_allowed_forall": sql("SELECT * FROM snapshot_allowed"),
    "audit_axis_1": sql(f"WITH {_RESOLVED}, {_A1} SELECT * FROM a1"),
    "audit_axis_2": sql(f"WITH {_RESOLVED}, {_A2} SELECT * FROM a2"),
    "audit_axis_3": sql(f"WITH {_LINKS}, {_A3} SELECT * FROM a3"),
    "audit_axis_4": sql(f"WITH {_RESOLVED} {_A4.format('set_r2_key_failed_neo4j')}"),
    "audit_axis_4b": sql(f"WITH {_RESOLVED} {_A4.format('skipped_toctou')}"),
    "audit_axis_5": sql(f"WITH {_RESOLVED} {_A5}"),
    "audit_axis_6": sql(f"WITH {_RESOLVED} {_A6}"),
    "audit_scan": sql(f"WITH {_ALL} SELECT * FROM v"),
    "violations_json": sql(f"WITH {_ALL} SELECT to_json({{'detail': detail, 'snap_id': snap_id, 'type': type}})::VARCHAR AS value FROM v"),
    "audit_counts": sql(f"""WITH {_ALL} SELECT (SELECT count(*) FROM resolved WHERE decision = 'uploaded' AND snap IS NOT NULL) AS uploaded_rows, (SELECT count(*) FROM resolved WHERE decision = 'set_r2_key_failed_neo4j' AND snap IS NOT NULL) AS set_failed_rows,
        (SELECT count(*) FROM resolved WHERE decision = 'skipped_toctou' AND snap IS NOT NULL) AS skipped_rows, (SELECT count(*) FROM resolved WHERE snap IS NULL) AS malformed_rows, (SELECT count(*) FROM keyed_snapshot) AS keyed_snapshots,
        (SELECT count(*) FROM source_policy) AS policy_rows, (SELECT count(*) FROM v) AS violations, (SELECT count(*) FROM v) = 0 AS aligned"""),
    "audit_pairing": sql("""WITH e AS (SELECT attempt_id, 'attempted' AS decision FROM upload_audit WHERE snap_id IS NOT NULL UNION ALL SELECT attempt_id, decision FROM upload_audit WHERE rationale <> 'no id here' UNION ALL SELECT attempt_id, decision FROM upload_audit WHERE decision = 'skipped_toctou'),
        g AS (SELECT attempt_id, count(*) FILTER (decision = 'attempted') AS attempts, count(*) FILTER (decision <> 'attempted') AS outcomes FROM e GROUP BY 1)
        SELECT *, CASE WHEN attempts = 0 THEN 'outcome_only' WHEN outcomes = 0 THEN 'in_flight' WHEN attempts = 1 AND outcomes = 1 THEN 'paired' ELSE 'ambiguous' END AS state FROM g"""),
    "upload_outcome": sql("""WITH f AS (SELECT snap_id, allowed OR first_doc % 3 = 0 AS allowed_before, allowed OR first_doc % 2 = 0 AS allowed_after, first_doc % 5 <> 0 AS set_ok FROM snapshot_allowed)
        SELECT *, CASE WHEN NOT allowed_before THEN 'not_attempted' WHEN NOT allowed_after THEN 'skipped_toctou' WHEN NOT set_ok THEN 'set_r2_key_failed_neo4j' ELSE 'uploaded' END AS decision, 'r2_upload' AS trigger_type, 'batch_report' AS gate_mode, 'r2_upload' AS action FROM f"""),
    "audit_rationale": sql("SELECT e.doc_id, 'snap_id=' || e.snap_id || '; archive_policy=' || p.archive_policy || '; raw_cloud_policy=' || p.cloud_policy || CASE WHEN e.doc_id % 2 = 0 THEN '; retry' ELSE '' END AS rationale FROM doc_source_edge e JOIN source_policy p USING (source_id)"),
    "key_prefix_check": """WITH p AS (SELECT doc_id, (['backups/neo4j/', 'backups/sqlite/', 'audit/jsonl/', 'tmp/multipart/', 'permitted_artifact/dataset/', 'permitted_artifact/snapshot/', 'permitted_artifact/derived/dossier/', 'permitted_artifact/derived/publication/', 'permitted_artifact/evidence-pack/', 'private/', 'Backups/neo4j/'])[doc_id % 11 + 1] AS h FROM documents)
        SELECT doc_id, CASE WHEN h NOT IN ('private/', 'Backups/neo4j/') THEN h END AS prefix, h NOT IN ('private/', 'Backups/neo4j/') AS permitted FROM p""",
}
