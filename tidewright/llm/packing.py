"""Best-fit packing planned over a histogram of lengths.

1. Every document is tokenised once; documents longer than a sequence are cut
   into full pieces from their end, so that only the first may be shorter.
2. Pieces are counted by length: at most ``size`` numbers, whatever the corpus.
   Best-fit decreasing runs over those counts on the driver: a class of open
   sequences with equal room takes as many pieces of a length as fit at a time.
3. The plan says which sequence and offset the k-th piece of a length takes.
   Pieces get their rank within their length from counts for each length and
   slice of ids, so that no length, however common, is ranked in one task, and
   are joined with the plan on (length, rank).

The plan has at most a few runs for each length and room, both at most ``size``.
Defined cases: null and empty texts are the end id alone; rows that repeat an
id are packed each; null ids are packed; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch
from .tokens import document_ids, vocabulary


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document of ``n`` ids."""
    first = n % size or min(n, size)
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


def plan(counts: np.ndarray, size: int) -> np.ndarray:
    """Best-fit decreasing over ``counts[length]``.

    Rows ``(length, rank, sequence, each, offset)``: from that rank on, up to the
    next row's, pieces of the length go to successive sequences from ``sequence``,
    ``each`` of them in one, the first at ``offset``.
    """
    rows: list[tuple[int, int, int, int, int]] = []
    room: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]  # by room left: ranges (first sequence, how many)
    made = 0
    for length in range(size, 0, -1):
        left, rank = int(counts[length]), 0
        for r in range(length, size + 1):
            if not left:
                break
            each, ranges = r // length, room[r]
            while left and (ranges or r == size):
                if ranges:
                    first, n = ranges.pop()
                else:
                    first, n = made, -(-left // each)
                    made += n
                full = min(n, left // each)
                if full:
                    rows.append((length, rank, first, each, size - r))
                    room[r - each * length].append((first, full))
                    rank, left = rank + full * each, left - full * each
                if full < n and left:  # the last sequence takes fewer than it could
                    rows.append((length, rank, first + full, each, size - r))
                    room[r - left * length].append((first + full, 1))
                    rank, left, full = rank + left, 0, full + 1
                if full < n:
                    ranges.append((first + full, n - full))
    return np.array(rows, np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """``doc, piece, start, length, ids_crc32`` and, if asked for, the piece's ``ids``."""
    path = tokenizer or vocabulary()
    names = ["doc", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[Any]] = [[] for _ in names]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = document_ids(text.as_py(), path).astype("<u4")
                for k, (start, n) in enumerate(cut(len(ids), size)):
                    part = ids[start : start + n]
                    row = [doc, k, start, n, zlib.crc32(part.tobytes())] + [part] * with_ids
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    ddl = "doc long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, ddl)


def pack(docs: DataFrame, size: int = 2048, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row for each piece: ``doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    cut_up = pieces(docs, size, id_col, text_col, tokenizer, with_ids).withColumn("slice", F.pmod(F.xxhash64("doc", "piece", "ids_crc32"), F.lit(_slices(spark))).cast("int"))
    cut_up = scratch.save(cut_up, "pieces")
    by_slice = scratch.save(cut_up.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n")), "counts")
    counts = np.zeros(size + 1, np.int64)
    for row in by_slice.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `size` rows
        counts[row["length"]] = row["n"]
    runs = plan(counts, size)
    shared = spark.sparkContext.broadcast(runs)

    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_slice.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "slice").orderBy("doc", "piece", "ids_crc32")
    ranked = cut_up.withColumn("within", F.row_number().over(order) - 1).join(starts, ["length", "slice"]).withColumn("rank", F.col("before") + F.col("within"))

    @F.pandas_udf("sequence_id long, offset long")  # type: ignore[call-overload]
    def slot(length, rank):  # noqa: ANN001, ANN202
        import pandas as pd

        r, n, k = shared.value, length.to_numpy(np.int64), rank.to_numpy(np.int64)
        span = np.int64(1) << np.int64(44)
        at = np.searchsorted((size - r[:, 0]) * span + r[:, 1], (size - n) * span + k, "right") - 1
        step = k - r[at, 1]
        return pd.DataFrame({"sequence_id": r[at, 2] + step // r[at, 3], "offset": r[at, 4] + step % r[at, 3] * n})

    out = ranked.withColumn("slot", slot("length", "rank"))
    return out.select(F.col("doc").alias(id_col), "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []), "slot.sequence_id", "slot.offset")


def _slices(spark: Any) -> int:
    return max(32, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
