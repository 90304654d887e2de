"""Source policies: the gate, its risks and its verdict, and the severity of interventions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Enums, the stage matrix and the names of wire services.
ARCHIVE = ("full_snapshot_allowed", "excerpt_only", "metadata_only", "do_not_collect")
CLOUD = ("allowed_public_data_only", "always_prohibited")
LLM = ("allowed", "manual_review_required", "prohibited")
ACTIONS = (
    "discovery_fetch", "extract_full_text", "raw_cache", "chunk_create", "embed", "r2_upload", "external_llm_call_with_raw_text",
    "external_llm_call_with_excerpt", "quote_storage", "image_inclusion", "publication_preflight",
)
STAGES = {
    "discovery": ("inline_warn", ("discovery_fetch",)),
    "extract_cache_embed_cloud_upload": ("inline_block", ("extract_full_text", "raw_cache", "chunk_create", "embed", "r2_upload", "external_llm_call_with_raw_text", "external_llm_call_with_excerpt")),
    "interactive_exploration": ("batch_report", ("discovery_fetch", "extract_full_text", "external_llm_call_with_raw_text", "external_llm_call_with_excerpt")),
    "content_production": ("batch_report", ("discovery_fetch", "extract_full_text", "external_llm_call_with_raw_text", "external_llm_call_with_excerpt", "quote_storage", "image_inclusion")),
    "publication_preflight": ("inline_block", ("publication_preflight", "quote_storage", "image_inclusion")),
}
WIRE_NAMES = ("associated press", "agence france-presse", "bloomberg", "yonhap", "kyodo", "xinhua", "interfax")
WIRE_WORDS = ("ap", "afp", "tass")
WIRE_EXCEPT = r"(?i)\breuters\b(?!\s+institute)"
MODE_DECISION = {"inline_block": "block", "inline_warn": "warn", "batch_report": "allow"}


def is_wire_service(name: Column) -> Column:
    low = F.lower(name)
    parts = [low.contains(x) for x in WIRE_NAMES] + [name.rlike(rf"(?i)\b{x}\b") for x in WIRE_WORDS] + [name.rlike(WIRE_EXCEPT)]
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return F.coalesce(out, F.lit(False))


def _says(*parts: str | Column) -> Column:
    """Text put together from columns, null ones as a dash."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("-")) for p in parts))


def _detectors(source_id: Column, archive: Column, cloud: Column, llm: Column, action: Column, name: Column) -> tuple[tuple[str, Column, Column], ...]:
    """Name, condition and reason of each risk, in their fixed order."""
    calls = action.isin("external_llm_call_with_raw_text", "external_llm_call_with_excerpt")
    whole = action.isin("extract_full_text", "chunk_create")
    unregistered, nameless = source_id.isNull(), F.coalesce(F.trim(name) == "", F.lit(True))
    full = archive == "full_snapshot_allowed"
    needs_full = _says(action, " needs archive_policy full_snapshot_allowed, not ", archive)
    return (
        ("external_llm_raw_text_unauthorized", calls & (unregistered | (llm != "allowed")), F.when(unregistered, _says(action, " for a source that is not registered")).otherwise(_says(action, " needs llm_policy allowed, not ", llm))),
        ("paywalled_source_fetch", whole & archive.isin("metadata_only", "excerpt_only"), _says(action, " of a source with archive_policy ", archive)),
        ("terms_violation", ~action.isin("image_inclusion", "publication_preflight") & (unregistered | (archive == "do_not_collect")), F.when(unregistered, _says(action, ": the terms of an unregistered source are not known")).otherwise(_says(action, ": the terms forbid collection"))),
        ("wire_service_full_text", whole & F.when(nameless, ~unregistered).otherwise(is_wire_service(name)), F.when(nameless, _says(action, ": source ", source_id, " has no name, and may be a wire service")).otherwise(_says(action, " of a wire service: ", name))),
        ("article_raw_quote_or_cache", action.isin("quote_storage", "raw_cache") & ~full, needs_full),
        ("image_inclusion_without_license", action == "image_inclusion", _says("no licences of images are kept")),
        ("raw_embedding", (action == "embed") & ~full, needs_full),
        ("raw_cloud_upload", (action == "r2_upload") & ~(full & (cloud == "allowed_public_data_only")), _says(action, " needs archive_policy full_snapshot_allowed, not ", archive, ", and cloud_policy allowed_public_data_only, not ", cloud)),
    )


def risks(source_id: Column, archive: Column, cloud: Column, llm: Column, action: Column, name: Column) -> Column:
    """Names of all risks that an action bears, in their fixed order."""
    return F.array_compact(F.array(*(F.when(rule, F.lit(label)) for label, rule, _ in _detectors(source_id, archive, cloud, llm, action, name))))


def explained_risks(source_id: Column, archive: Column, cloud: Column, llm: Column, action: Column, name: Column) -> Column:
    """The risks of :func:`risks` as structs of ``trigger`` and ``rationale``: what the decision was made on."""
    found = _detectors(source_id, archive, cloud, llm, action, name)
    return F.array_compact(F.array(*(F.when(rule, F.struct(F.lit(label).alias("trigger"), why.alias("rationale"))) for label, rule, why in found)))


def gate(rows: DataFrame) -> DataFrame:
    """Adds ``error``, ``triggers``, ``gate_mode`` and ``decision`` to ``stage, action, source_id, archive, cloud, llm, source_name``.

    Input errors come first, then risks (which block), then an action that the
    stage does not know, then the stage's own mode.
    """
    c = {n: F.col(n) for n in ("stage", "action", "source_id", "archive", "cloud", "llm", "source_name")}
    policies = ("archive", "cloud", "llm")
    known = {"archive": ARCHIVE, "cloud": CLOUD, "llm": LLM}
    error = F.when(~F.coalesce(c["stage"].isin(*STAGES), F.lit(False)), "invalid_stage").when(~F.coalesce(c["action"].isin(*ACTIONS), F.lit(False)), "invalid_action")
    for p in policies:
        error = error.when(~F.coalesce(c[p].isin("unknown", *known[p]), F.lit(False)), f"invalid_{p}")
    for p in policies:
        error = error.when(c["source_id"].isNotNull() & (c[p] == "unknown"), f"registered_unknown_{p}")
    for p in policies:
        error = error.when(c["source_id"].isNull() & (c[p] != "unknown"), f"unregistered_known_{p}")
    found = risks(c["source_id"], c["archive"], c["cloud"], c["llm"], c["action"], c["source_name"])
    out = rows.withColumns({"input_error": error, "triggers": found})
    risky = F.size("triggers") > 0
    fits = F.lit(False)
    mode = F.lit(None).cast("string")
    for stage, (stage_mode, actions) in STAGES.items():
        fits = fits | ((c["stage"] == stage) & c["action"].isin(*actions))
        mode = F.when(c["stage"] == stage, F.lit(stage_mode)).otherwise(mode)
    error = F.coalesce("input_error", F.when(~risky & ~fits, "incompatible_stage_action"))
    out = out.withColumn("error", error).withColumn("gate_mode", F.when(F.col("error").isNull(), F.when(risky, "inline_block").otherwise(mode)))
    decision = F.when(risky, F.lit("block"))
    for m, d in MODE_DECISION.items():
        decision = decision.when(F.col("gate_mode") == m, d)
    return out.withColumn("decision", F.when(F.col("error").isNull(), decision)).withColumn("triggers", F.when(F.col("input_error").isNull(), F.array_join("triggers", ",")).otherwise("")).drop("input_error")


def lookup(rows: DataFrame, policies: DataFrame, value: str) -> DataFrame:
    """The policy of each row's source; a missing one is an error, not a default."""
    out = rows.join(policies.select("source_id", value), "source_id", "left")
    return out.withColumn("error", F.when(F.col(value).isNull(), "source_not_registered"))


def llm_verdict(policy: Column) -> Column:
    return F.when(policy.isNull(), "error_not_registered").when(policy == "allowed", "ok").when(policy.isin("manual_review_required", "prohibited"), F.concat(F.lit("error_"), policy)).otherwise("error_unknown")


# ---- severity ---------------------------------------------------------------

SEVERITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
SEVERITY_RANK = {"inline_block": (3, 3, 4), "inline_warn": (1, 2, 3), "batch_report": (1, 1, 2)}


def severity(mode: Column, score: Column, linked: Column) -> Column:
    """By mode and importance below 0.4, 0.7 or above; an assumption raises it a step; no finite score counts as lowest."""
    finite = score.isNotNull() & ~F.isnan(score) & (F.abs(score) < float("inf"))
    s = F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))
    bucket = F.when(~finite | (s < 0.4), 1).when(s < 0.7, 2).otherwise(3)
    rank = F.lit(None).cast("int")
    for m, ranks in SEVERITY_RANK.items():
        rank = F.when(mode == m, F.element_at(F.array(*map(F.lit, ranks)), bucket)).otherwise(rank)
    rank = F.least(rank + F.when(linked, 1).otherwise(0), F.lit(4))
    return F.element_at(F.array(*map(F.lit, SEVERITIES)), rank)


def batch_report(items: DataFrame) -> DataFrame:
    """By severity (anything unknown counts as HIGH): how many, and whether any blocks."""
    known = F.when(F.col("severity").isin(*SEVERITIES), F.col("severity")).otherwise("HIGH")
    g = items.withColumn("severity", known).groupBy("session_id", "severity").agg(F.count(F.lit(1)).alias("n"))
    rank = F.array_position(F.array(*map(F.lit, SEVERITIES)), F.col("severity")).cast("int")
    return g.withColumns({"position": 5 - rank, "blocks": F.col("severity").isin("CRITICAL", "HIGH")})


def markdown(items: DataFrame) -> DataFrame:
    """One report a session: sections from CRITICAL to LOW, items by time."""
    known = F.when(F.col("severity").isin(*SEVERITIES), F.col("severity")).otherwise("HIGH")
    rank = 5 - F.array_position(F.array(*map(F.lit, SEVERITIES)), known)
    line = F.format_string("- %s %s %.2f", F.col("intervention_id").cast("string"), F.col("source_id"), F.col("importance"))
    parts = items.withColumns({"severity": known, "rank": rank, "line": line}).groupBy("session_id", "severity", "rank").agg(F.array_sort(F.collect_list(F.struct("created_at", "intervention_id", "line"))).alias("lines"))
    section = F.concat(F.lit("## "), F.col("severity"), F.lit(" ("), F.size("lines").cast("string"), F.lit(")\n"), F.array_join("lines.line", "\n"))
    whole = parts.select("session_id", F.struct("rank", section.alias("text")).alias("section")).groupBy("session_id").agg(F.array_sort(F.collect_list("section")).alias("s"))
    return whole.select("session_id", F.concat(F.lit("# Access report\n\n"), F.array_join("s.text", "\n\n")).alias("markdown"))


def review(actions: DataFrame, pending: DataFrame, days: int = 7) -> DataFrame:
    """Actions ``(intervention_id, action, at)`` on interventions; only pending ones change.

    Ignoring lowers the score by 0.2, not below 0; temporary text expires after ``days``.
    """
    j = actions.join(pending, "intervention_id", "left")
    error = F.when(F.col("status").isNull(), "not_found").when(F.col("status") != "pending_user_review", "not_pending").when(~F.col("action").isin("ignore", "manual_claim", "temp_text"), "unknown_action")
    j = j.withColumn("error", error)
    ok = F.col("error").isNull()
    return j.select(
        "intervention_id",
        "action",
        "error",
        F.when(ok, F.concat(F.lit("resolved_"), "action")).otherwise(F.col("status")).alias("status"),
        F.when(ok & (F.col("action") == "ignore"), F.greatest(F.col("importance") - 0.2, F.lit(0.0))).otherwise(F.col("importance")).alias("importance"),
        F.when(ok & (F.col("action") == "temp_text"), F.date_format(F.col("at") + F.make_dt_interval(F.lit(days)), "yyyy-MM-dd HH:mm:ss")).alias("expires_at"),
    )


def create_interventions(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Clamps the score and links to the source; a row without its source is an error."""
    known = sources.select("source_id", F.lit(True).alias("known"))
    out = rows.join(known, "source_id", "left")
    return out.select("intervention_id", "source_id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "importance")).alias("importance"), F.when(F.col("known").isNull(), "source_missing").alias("error"))


# ---- manual claims ----------------------------------------------------------

QUOTE_REASONS = ("analysis", "critique", "fact_check")
ACCESSED_VIA = ("browser", "print", "broadcast", "subscription")


def claim_kind(rows: DataFrame) -> DataFrame:
    """``error`` or ``kind`` of ``written, opinion, quote, via, confidence, reason, url``: exactly one text, and rules for quotes."""
    have = lambda c: F.coalesce(F.length(c) > 0, F.lit(False))
    n = sum((have(c).cast("int") for c in ("written", "opinion", "quote")), F.lit(0))
    confident = F.coalesce((F.col("confidence") >= 0) & (F.col("confidence") <= 1) & ~F.isnan("confidence"), F.lit(False))
    error = (
        F.when(n == 0, "no_text")
        .when(n > 1, "several_texts")
        .when(~F.coalesce(F.col("via").isin(*ACCESSED_VIA), F.lit(False)), "invalid_via")
        .when(~confident, "invalid_confidence")
        .when(have("quote") & ~F.coalesce(F.col("reason").isin(*QUOTE_REASONS), F.lit(False)), "quote_reason_missing")
        .when(have("quote") & ~have("url"), "attribution_missing")
        .when(have("quote") & (F.length("quote") > 200), "quote_too_long")
    )
    kind = F.when(have("quote"), "referenced_quote").when(have("written"), "user_written_claim").otherwise("user_opinion")
    return rows.withColumn("error", error).withColumn("kind", F.when(F.col("error").isNull(), kind))
