"""Exact token counts for every context limit, from a histogram of lengths.

A document's length is its number of token ids with the end id. Documents are
aggregated by length at once, so that everything after has one row for each
distinct length; sums over the longer ones then answer, for any limit, how many
documents fit, how many tokens remain when each document is truncated, and any
quantile. Defined cases: null and empty texts have length 1 (the end id); every
row counts, whatever its id; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch
from .tokens import document_ids, vocabulary

#: Lengths of one range are summed together before the few ranges are.
RANGE = 1024


def with_lengths(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """One column ``length`` for each row."""
    path = tokenizer or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(document_ids(t.as_py(), path)) for t in batch.column(0)], pa.int64())], ["length"])

    return docs.select(text_col).mapInArrow(run, "length long")


def histogram(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """``length, n_docs``: one row for each distinct length, written once, because what follows reads it several times."""
    counted = with_lengths(docs, text_col, tokenizer).groupBy("length").agg(F.count(F.lit(1)).alias("n_docs"))
    return Scratch(docs.sparkSession, "token-counts").save(counted, "histogram")


def context_table(lengths: DataFrame) -> DataFrame:
    """From ``length, n_docs`` one row for each length taken as a context limit.

    ``docs_within`` and ``tokens_within`` count what fits whole, ``docs_over`` and
    ``tokens_over`` the rest, ``truncated_total`` sums ``min(length, limit)`` over all
    documents, ``quantile`` is the share of documents within the limit.
    """
    hist = lengths.select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("tokens"), F.floor(F.col("length") / RANGE).alias("range"))
    ranges = hist.groupBy("range").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    above = Window.orderBy(F.col("range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("range", F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"), F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"))
    totals = hist.agg(F.sum("n_docs").alias("n_total"), F.sum("tokens").alias("t_total"))
    longer = Window.partitionBy("range").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    out = (
        hist.withColumns({"d": F.coalesce(F.sum("n_docs").over(longer), F.lit(0)), "t": F.coalesce(F.sum("tokens").over(longer), F.lit(0))})
        .join(ranges, "range")
        .crossJoin(F.broadcast(totals))  # one row
        .withColumns({"docs_over": F.col("d") + F.col("d_above"), "tokens_over": F.col("t") + F.col("t_above")})
    )
    return out.select(
        F.col("length").alias("context_limit"),
        "n_docs",
        (F.col("n_total") - F.col("docs_over")).alias("docs_within"),
        (F.col("t_total") - F.col("tokens_over")).alias("tokens_within"),
        "docs_over",
        "tokens_over",
        (F.col("t_total") - F.col("tokens_over") + F.col("length") * F.col("docs_over")).alias("truncated_total"),
        ((F.col("n_total") - F.col("docs_over")) / F.col("n_total")).alias("quantile"),
    )


def truncated_total(table: DataFrame, limit: int) -> int:
    """Tokens that remain when each document is cut at ``limit``; any limit, not only those of the table."""
    row = table.select("context_limit", "n_docs").agg(F.sum(F.least("context_limit", F.lit(limit)) * F.col("n_docs")).alias("t")).first()
    return int(row["t"] or 0)


def quantile(table: DataFrame, p: float) -> int | None:
    """The smallest length that a share ``p`` of the documents does not exceed."""
    row = table.filter(F.col("quantile") >= p).agg(F.min("context_limit").alias("x")).first()
    return row["x"]
