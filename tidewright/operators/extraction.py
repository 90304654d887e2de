"""Extractors by source type, and the article pipeline with its ledger rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import html_to_text, parsed_claims, wrap_untrusted
from .policy import llm_verdict

Extractor = Callable[[DataFrame], DataFrame]
#: A model turns a prompt column into a reply column; the default needs no network and always answers alike.
Client = Callable[[Column], Column]
#: What a call cost, in US dollars, from its prompt and its reply; null where the client did not say.
Meter = Callable[[Column, Column], Column]


def stub_client(prompt: Column) -> Column:
    body = F.substring(prompt, 13, 60)
    return F.to_json(F.struct(body.alias("title"), F.lit("stub").alias("summary"), F.array(F.struct(F.substring(prompt, 13, 20).alias("claim"), F.substring(prompt, 13, 20).alias("evidence_quote"))).alias("key_claims")))


class Registry:
    """One extractor for each source type."""

    def __init__(self) -> None:
        self._of: dict[str, Extractor] = {}

    def register(self, source_type: str, extractor: Extractor) -> None:
        if source_type in self._of:
            raise ValueError(f"{source_type} has an extractor")
        self._of[source_type] = extractor

    def get(self, source_type: str) -> Extractor:
        if source_type not in self._of:
            raise KeyError(f"no extractor for {source_type}")
        return self._of[source_type]

    def route(self, rows: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
        """Sends each registered type of ``rows(id, source_type, …)`` through its extractor, which must keep both.

        Rows of other types come back as errors; a key that an extractor changed fails the query.
        """
        out = None
        for kind, extractor in sorted(self._of.items()):
            got = extractor(rows.filter(F.col("source_type") == kind))
            bad = F.col("source_type").isNull() | (F.col("source_type") != kind) | F.col("id").isNull()
            got = got.select(F.when(bad, F.raise_error(F.lit(f"the extractor of {kind} changed a key"))).otherwise(F.col("id")).alias("id"), F.lit(kind).alias("source_type"), F.col("result"), F.lit(None).cast("string").alias("error"))
            out = got if out is None else out.unionByName(got)
        rest = rows.filter(~F.coalesce(F.col("source_type").isin(*self._of), F.lit(False))).select("id", "source_type", F.lit(None).cast("string").alias("result"), F.lit("unknown_source_type").alias("error"))
        return rest if out is None else out.unionByName(rest)


def free(prompt: Column, reply: Column) -> Column:
    """The stub costs nothing; a call without a reply has no cost."""
    return F.when(reply.isNotNull(), F.lit(0.0))


def articles(pages: DataFrame, policies: DataFrame, client: Client = stub_client, meter: Meter = free, tier: int = 1) -> DataFrame:
    """Gate, clean, wrap, ask, price and parse ``pages(id, source_id, html)``; every path leaves a ledger status.

    A reply without a cost is an error before it is parsed.
    """
    j = pages.join(policies.select("source_id", "llm_policy"), "source_id", "left").withColumn("gate", llm_verdict(F.col("llm_policy")))
    open_ = F.col("gate") == "ok"
    j = j.withColumn("text", F.when(open_, html_to_text(F.col("html"))))
    j = j.withColumn("prompt", F.when(open_, wrap_untrusted(F.col("text"), F.lit(tier))))
    j = j.withColumn("reply", F.when(open_, client(F.col("prompt"))))
    j = j.withColumn("cost_usd", F.when(open_, meter(F.col("prompt"), F.col("reply")))).withColumn("parsed", parsed_claims(F.col("reply")))
    error = F.when(~open_, F.col("gate")).when(F.col("cost_usd").isNull(), "cost_missing").when(F.col("parsed").isNull(), "schema")
    out = j.withColumn("error", error)
    status = F.when(F.col("gate") != "ok", "not_started").when(F.col("error").isNotNull(), "failed").otherwise("completed")
    return out.select("id", "source_id", status.alias("run_status"), "error", "cost_usd", F.when(F.col("error").isNull(), F.col("parsed.title")).alias("title"), F.when(F.col("error").isNull(), F.size("parsed.key_claims")).alias("n_claims"))
