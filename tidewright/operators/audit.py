"""Reconciliation of stored objects, graph keys and the upload audit.

All comparisons are anti, semi or left joins on ids; each axis is one tagged
relation and the scan is their union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Forms and names that stored rows already carry.
SNAP_ID = r"^snap_[A-Za-z0-9_-]+$"
RATIONALE_SNAP_ID = r"^snap_id=(snap_[A-Za-z0-9_-]+)(?=;|$)"
SNAPSHOT_PREFIX = "permitted_artifact/snapshot/"
KEY_PREFIXES = (
    "backups/neo4j/", "backups/sqlite/", "audit/jsonl/", "tmp/multipart/", "permitted_artifact/dataset/", SNAPSHOT_PREFIX,
    "permitted_artifact/derived/dossier/", "permitted_artifact/derived/publication/", "permitted_artifact/evidence-pack/",
)


def valid_snap_id(value: Column) -> Column:
    return F.when(value.rlike(SNAP_ID), value)


def snap_id_of_rationale(rationale: Column) -> Column:
    return F.nullif(F.regexp_extract(rationale, RATIONALE_SNAP_ID, 1), F.lit(""))


def rationale(snap_id: Column, archive: Column, cloud: Column, more: Column) -> Column:
    return F.concat_ws("; ", F.concat(F.lit("snap_id="), snap_id), F.concat(F.lit("archive_policy="), archive), F.concat(F.lit("raw_cloud_policy="), cloud), F.nullif(more, F.lit("")))


def matched_prefix(key: Column) -> Column:
    """The first permitted prefix of a key, or null."""
    return F.try_element_at(F.filter(F.array(*map(F.lit, KEY_PREFIXES)), lambda p: F.startswith(key, p)), F.lit(1))


def resolved(audits: DataFrame) -> DataFrame:
    """Adds ``column_id``, ``rationale_id`` and ``snap``: the column where it is valid, else the rationale's."""
    out = audits.withColumns({"column_id": valid_snap_id(F.col("snap_id")), "rationale_id": snap_id_of_rationale(F.col("rationale"))})
    return out.withColumn("snap", F.coalesce("column_id", "rationale_id"))


def linked_sources(keyed: DataFrame, edges: DataFrame) -> DataFrame:
    """Each keyed snapshot with the sorted distinct ids of its sources, none being an empty array."""
    return keyed.join(edges.select("snap_id", "source_id").distinct(), "snap_id", "left").groupBy("snap_id", "object_key").agg(F.array_sort(F.collect_set("source_id")).alias("sources"))


def key_without_audit(keyed: DataFrame, audits: DataFrame, edges: DataFrame) -> DataFrame:
    done = resolved(audits).filter("decision = 'uploaded' and snap is not null").select(F.col("snap").alias("snap_id"))
    return linked_sources(keyed.join(done, "snap_id", "left_anti"), edges)


def audit_without_key(keyed: DataFrame, audits: DataFrame) -> DataFrame:
    """One row for each audit row."""
    return resolved(audits).filter("decision = 'uploaded' and snap is not null").join(keyed.select(F.col("snap_id").alias("snap")), "snap", "left_anti").select("snap", "attempt_id", "decision_id")


def restricted_keys(keyed: DataFrame, edges: DataFrame, policies: DataFrame) -> DataFrame:
    """Keyed snapshots with a source that does not permit the upload now, or is not registered."""
    rows = keyed.join(edges.select("snap_id", "source_id").distinct(), "snap_id").join(policies.select("source_id", "archive_policy", "cloud_policy"), "source_id", "left")
    rows = rows.filter("archive_policy is null or archive_policy <> 'full_snapshot_allowed' or cloud_policy <> 'allowed_public_data_only'")
    name = F.lit("<unregistered>")
    return rows.groupBy("snap_id", "object_key").agg(
        F.array_sort(F.collect_list(F.concat_ws("|", "source_id", F.coalesce("archive_policy", name), F.coalesce("cloud_policy", name)))).alias("restricted"),
        F.bool_or(F.col("archive_policy").isNull()).alias("has_unregistered"),
    )


def orphan_objects(audits: DataFrame, decision: str) -> DataFrame:
    return resolved(audits).filter((F.col("decision") == decision) & F.col("snap").isNotNull()).select("snap", "attempt_id", "decision_id", F.concat(F.lit(SNAPSHOT_PREFIX), "snap").alias("expected_key"))


def malformed(audits: DataFrame) -> DataFrame:
    return resolved(audits).filter("snap is null").select("decision", "attempt_id", "decision_id", F.substring(F.coalesce("rationale", F.lit("")), 1, 120).alias("rationale_prefix"))


def drifted(audits: DataFrame) -> DataFrame:
    return resolved(audits).filter("column_id <> rationale_id").select("column_id", "rationale_id", "decision", "attempt_id", "decision_id")


def scan(keyed: DataFrame, audits: DataFrame, edges: DataFrame, policies: DataFrame) -> DataFrame:
    """``type, snap_id, detail`` of every violation on all axes."""

    def tag(df: DataFrame, kind: str, snap: Column, detail: Column) -> DataFrame:
        return df.select(F.lit(kind).alias("type"), snap.alias("snap_id"), detail.alias("detail"))

    attempt = F.concat_ws("|", "attempt_id", "decision_id")
    parts = [
        tag(key_without_audit(keyed, audits, edges), "r2_key_without_audit", F.col("snap_id"), F.concat_ws("|", F.col("object_key"), F.array_join("sources", ","))),
        tag(audit_without_key(keyed, audits), "audit_uploaded_without_r2_key", F.col("snap"), attempt),
        tag(restricted_keys(keyed, edges, policies), "r2_key_with_restricted_source", F.col("snap_id"), F.concat_ws("|", F.array_join("restricted", ","), F.col("has_unregistered").cast("string"))),
        tag(orphan_objects(audits, "set_r2_key_failed_neo4j"), "r2_object_without_graph_key_set_failed", F.col("snap"), F.concat_ws("|", "attempt_id", "decision_id", "expected_key")),
        tag(orphan_objects(audits, "skipped_toctou"), "r2_object_without_graph_key_policy_recheck_skipped", F.col("snap"), F.concat_ws("|", "attempt_id", "decision_id", "expected_key")),
        tag(malformed(audits), "malformed_r2_upload_audit_row", F.lit("<unparseable>"), F.concat_ws("|", "decision", "attempt_id", "decision_id", "rationale_prefix")),
        tag(drifted(audits), "r2_audit_column_rationale_drift", F.col("column_id"), F.concat_ws("|", "decision", "attempt_id", "decision_id", "column_id", "rationale_id")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def counts(keyed: DataFrame, audits: DataFrame, policies: DataFrame, violations: DataFrame) -> DataFrame:
    """One row of counters, and whether nothing was found."""
    a = resolved(audits).agg(
        *(F.count_if((F.col("decision") == d) & F.col("snap").isNotNull()).alias(n) for d, n in (("uploaded", "uploaded_rows"), ("set_r2_key_failed_neo4j", "set_failed_rows"), ("skipped_toctou", "skipped_rows"))),
        F.count_if(F.col("snap").isNull()).alias("malformed_rows"),
    )
    k = keyed.agg(F.count(F.lit(1)).alias("keyed_snapshots"))
    p = policies.agg(F.count(F.lit(1)).alias("policy_rows"))
    v = violations.agg(F.count(F.lit(1)).alias("violations"))
    return a.crossJoin(F.broadcast(k)).crossJoin(F.broadcast(p)).crossJoin(F.broadcast(v)).withColumn("aligned", F.col("violations") == 0)  # one row each


def pairing(events: DataFrame) -> DataFrame:
    """Attempts against outcomes ``(attempt_id, decision)``: each attempt has one ``attempted`` row and one outcome."""
    g = events.groupBy("attempt_id").agg(F.count_if(F.col("decision") == "attempted").alias("attempts"), F.count_if(F.col("decision") != "attempted").alias("outcomes"))
    state = F.when(F.col("attempts") == 0, "outcome_only").when(F.col("outcomes") == 0, "in_flight").when((F.col("attempts") == 1) & (F.col("outcomes") == 1), "paired").otherwise("ambiguous")
    return g.withColumn("state", state)


def upload_outcome(attempts: DataFrame) -> DataFrame:
    """From ``allowed_before, allowed_after, set_ok`` what the audit gets as the outcome."""
    outcome = F.when(~F.col("allowed_before"), "not_attempted").when(~F.col("allowed_after"), "skipped_toctou").when(~F.col("set_ok"), "set_r2_key_failed_neo4j").otherwise("uploaded")
    return attempts.withColumn("decision", outcome).withColumns({"trigger_type": F.lit("r2_upload"), "gate_mode": F.lit("batch_report"), "action": F.lit("r2_upload")})


def as_json_lines(violations: DataFrame) -> DataFrame:
    return violations.select(F.to_json(F.struct(*sorted(violations.columns))).alias("value"))


def surrogate_id(prefix: str, at: Column, *key: Column) -> Column:
    """Ordered by time, the same for the same key: prefix, hex of milliseconds, hash of the key."""
    millis = F.unix_millis(at.cast("timestamp"))
    return F.concat(F.lit(prefix), F.lpad(F.lower(F.hex(millis)), 12, "0"), F.lpad(F.lower(F.hex(F.xxhash64(*key))), 16, "0"))


def survivors(rows: DataFrame, key: str, id_col: str) -> DataFrame:
    """Each row with the smallest id of its key, to which edges are redirected; an aggregate and a join, so that a key with very many rows is no window partition."""
    least = rows.groupBy(F.col(key).alias("__key")).agg(F.min(id_col).alias("survivor"))
    return rows.join(least, F.col(key).eqNullSafe(F.col("__key"))).drop("__key")
