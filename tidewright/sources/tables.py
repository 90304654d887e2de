"""Domain tables derived from the base tables, as lazy DataFrames.

Every view is a projection or an aggregate of one or two scans; nothing is
collected. ``plans/views.py`` states the same views in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import Scratch


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._hashed: DataFrame | None = None

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def documents(self) -> DataFrame:
        return self.base("documents").withColumn("n", F.expr("try_cast(substring(source, 4) as int)"))

    def source_policy(self) -> DataFrame:
        """One row for each registered source; ``src19`` is the unregistered case."""
        n = F.col("n")
        archive = F.element_at(F.array(*map(F.lit, ("full_snapshot_allowed", "excerpt_only", "metadata_only", "do_not_collect"))), n % 4 + 1)
        llm = F.element_at(F.array(*map(F.lit, ("allowed", "manual_review_required", "prohibited"))), n % 3 + 1)
        cloud = F.when(F.floor(n / 4) % 2 == 0, "allowed_public_data_only").otherwise("always_prohibited")
        return (
            self.documents()
            .select(F.col("source").alias("source_id"), "n")
            .distinct()
            .filter("source_id <> 'src19'")
            .select("source_id", "n", archive.alias("archive_policy"), cloud.alias("cloud_policy"), llm.alias("llm_policy"))
        )

    def hashed(self) -> DataFrame:
        return self._hashed or self.documents().withColumn("content_hash", F.sha2(F.coalesce("text", F.lit("")), 256))

    def hold_hashes(self, scratch: Scratch) -> None:
        """Writes the content hashes once (without the texts), for a plan that has many branches over them."""
        self._hashed = scratch.save(self.hashed().select("doc_id", "source", "n", "content_hash"), "hashed")

    def snapshot(self) -> DataFrame:
        """Distinct contents; ``snap_id`` is named after the first document."""
        return self.hashed().groupBy("content_hash").agg(F.min("doc_id").alias("first_doc")).withColumn("snap_id", F.concat(F.lit("snap_"), "first_doc"))

    def doc_source_edge(self) -> DataFrame:
        return self.hashed().select("doc_id", F.col("source").alias("source_id"), "content_hash").join(self.snapshot(), "content_hash").select("source_id", "doc_id", "snap_id", "first_doc")

    def snapshot_allowed(self) -> DataFrame:
        """A snapshot may be uploaded when it has sources, all registered and permitting; no source at all means no."""
        policy = self.source_policy().select("source_id", ((F.col("archive_policy") == "full_snapshot_allowed") & (F.col("cloud_policy") == "allowed_public_data_only")).alias("ok"))
        return self.doc_source_edge().join(policy, "source_id", "left").groupBy("snap_id", "first_doc").agg(F.coalesce(F.bool_and(F.coalesce("ok", F.lit(False))), F.lit(False)).alias("allowed"))

    def keyed_snapshot(self) -> DataFrame:
        return self.snapshot_allowed().filter("allowed or first_doc % 11 = 0").select("snap_id", "first_doc", F.concat(F.lit("permitted_artifact/snapshot/"), "snap_id").alias("object_key"))

    def upload_audit(self) -> DataFrame:
        m = F.col("first_doc") % 7
        decision = F.when(m <= 3, "uploaded").when(m == 4, "set_r2_key_failed_neo4j").when(m == 5, "skipped_toctou")
        named = F.when(F.col("first_doc") % 17 == 0, F.concat(F.lit("snap_x"), "first_doc")).otherwise(F.col("snap_id"))
        good = F.concat(F.lit("snap_id="), named, F.lit("; archive_policy=full_snapshot_allowed; raw_cloud_policy=allowed_public_data_only"))
        return (
            self.snapshot()
            .filter(m < 6)
            .select(
                F.concat(F.lit("pdec_"), "first_doc").alias("decision_id"),
                decision.alias("decision"),
                F.when(F.col("first_doc") % 5 != 0, F.col("snap_id")).alias("snap_id"),
                F.when(F.col("first_doc") % 13 == 0, "no id here").otherwise(good).alias("rationale"),
                F.concat(F.lit("att_"), "first_doc").alias("attempt_id"),
                F.col("first_doc"),
            )
        )

    def run_ledger(self) -> DataFrame:
        e = self.base("events")
        status = F.when(F.col("event_type") == "view", "running").when(F.col("event_type") == "error", "failed").otherwise("completed")
        cost = F.when((F.col("event_type") == "view") | ((F.col("event_type") == "error") & (F.col("event_id") % 2 == 1)), None).otherwise(F.round(F.col("value") * 100).cast("long"))
        return e.select(
            F.col("event_id").alias("run_id"),
            F.col("ts").alias("completed_at"),
            F.concat(F.lit("vendor"), F.col("user_id") % 3).alias("vendor"),
            (F.get_json_object("props", "$.k").cast("int") % 4).alias("tier"),
            F.col("event_type").alias("stage"),
            status.alias("status"),
            cost.alias("cost_e4"),
            F.col("user_id").alias("session_id"),
            (F.col("event_id") * 37 % 5000).alias("input_tokens"),
            (F.col("event_id") * 13 % 3000).alias("cached_tokens"),
            (F.col("event_id") * 7 % 900).alias("output_tokens"),
            (F.col("event_id") * 3 % 400).alias("creation_tokens"),
        )

    def crawl_log(self) -> DataFrame:
        outcome = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "view", "not_modified").otherwise("ok")
        etag = F.when(F.col("event_type") == "purchase", F.concat(F.lit("W/"), F.col("event_id").cast("string")))
        return self.base("events").select(F.concat(F.lit("u"), F.col("user_id")).alias("source_id"), "ts", "event_id", outcome.alias("outcome"), etag.alias("etag"))

    def queue(self) -> DataFrame:
        """Pages joined with the event of the same number, which gives the time of discovery."""
        status = F.element_at(F.array(*map(F.lit, ("pending", "processing", "done", "error"))), (F.col("page_id") % 4 + 1).cast("int"))
        pages = self.base("pages").select(F.col("page_id").alias("queue_id"), F.concat(F.lit("src"), F.col("page_id") % 20).alias("source_id"), "url", "html", status.alias("status"))
        seen = self.base("events").select(F.col("event_id").alias("queue_id"), F.col("ts").alias("discovered_at"))
        return pages.join(seen, "queue_id", "left")

    def intervention(self) -> DataFrame:
        mode = F.element_at(F.array(*map(F.lit, ("inline_block", "inline_warn", "batch_report"))), (F.col("user_id") % 3 + 1).cast("int"))
        return (
            self.base("events")
            .filter("event_type = 'error'")
            .select(
                F.col("event_id").alias("intervention_id"),
                F.concat(F.lit("sess_"), F.col("user_id") % 10).alias("session_id"),
                F.concat(F.lit("src"), F.col("user_id") % 20).alias("source_id"),
                mode.alias("gate_mode"),
                (F.col("value") / 200).alias("importance"),
                (F.col("event_id") % 2 == 1).alias("linked"),
                F.col("ts").alias("created_at"),
                F.when(F.col("event_id") % 5 == 0, "resolved_ignore").otherwise("pending_user_review").alias("status"),
            )
        )

    def claim_quote(self) -> DataFrame:
        """A claim for each document, with a quote of its text; every twentieth is corrupted."""
        quote = F.substring(F.coalesce("text", F.lit("")), (F.col("doc_id") % 50 + 1).cast("int"), F.lit(80))
        role = F.element_at(F.array(*map(F.lit, ("supporting", "opposing", "monitoring", "context"))), (F.col("doc_id") % 4 + 1).cast("int"))
        return self.documents().select(
            F.concat(F.lit("clm_"), "doc_id").alias("claim_id"),
            "doc_id",
            "source",
            "n",
            "text",
            F.when(F.col("doc_id") % 20 == 0, F.concat(quote, F.lit("~~"))).otherwise(quote).alias("quote"),
            (F.col("doc_id") * 37 % 101).alias("confidence_pct"),
            role.alias("role"),
            F.concat(F.lit("ths_"), F.floor(F.col("doc_id") / 10).cast("long")).alias("thesis_id"),
        )
