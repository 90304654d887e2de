"""Codes of integer vectors: a small codebook for each part of a vector, fitted on distinct parts.

1. Components become integers, ``floor(scale * x)``; a vector is cut into equal parts. A
   block of vectors (one Arrow batch or a piece of it) keeps a dictionary of its
   distinct parts by position, with their numbers of occurrences.
2. Dictionaries are added up to weighted distinct parts. Lloyd's rounds run over
   those: every task assigns its distinct parts and returns integer sums for each
   entry, which the cluster adds; the driver divides them. Nothing depends on
   the order of rows or on how they are split.
3. Distinct parts get their codes and errors, which are joined to the entries of
   the blocks' dictionaries and so back to the vectors (:mod:`.block_lookup`). A part that a
   third of all vectors hold is one row a block.

The driver holds codebooks only: ``entries`` vectors.

Defined cases: vectors that are null, or hold a null, NaN or infinity, give no row, nor
do those without components, those that can't be cut into equal parts, and those of
another length than the vector with the smallest id; rows that repeat an id are coded
each, and the codebook starts from the smaller vectors of them; null ids come last
there and are coded; with fewer vectors than entries the codebook is as small;
equal entries and equal distances go to the lower place; null labels are one label;
an empty table gives no rows; extra columns are not read. Squared distances are
64-bit integers: components so large that they might not fit fail the query.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import Scratch
from .block_lookup import entries as block_entries
from .block_lookup import look_up, numbers

#: Components of a block, at most; a longer vector is a block of its own.
BLOCK_COMPONENTS = 1 << 20

Books = list[list[list[int]]]  # by part, entry, component


def usable(vector: Column, parts: int) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & (F.size(vector) % parts == 0) & finite, F.lit(False))


def integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``; raises where squared distances of such vectors might not fit."""
    scaled = np.floor(vectors.astype(np.float64) * scale)
    most = np.sqrt(2.0**62 / max(1, vectors.shape[-1])) / 2
    if len(scaled) and np.abs(scaled).max() > most:
        raise ValueError(f"components beyond {most / scale:.4g}: squared distances would not fit 64 bits")
    return scaled.astype(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the nearest entry, ties to the lower, and the squared distance."""
    place, least = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
    for i in range(0, len(points), 8192):
        some = points[i : i + 8192]
        distance = np.zeros((len(some), len(book)), np.int64)
        for k in range(points.shape[1]):
            distance += (some[:, k, None] - book[None, :, k]) ** 2
        place[i : i + 8192] = distance.argmin(1)
        least[i : i + 8192] = distance.min(1)
    return place, least


def _points(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each position in a batch of distinct parts: the rows there and their components."""
    at = batch.column("position").to_numpy()
    raw = np.frombuffer(b"".join(batch.column("part").to_pylist()), np.int64).reshape(len(at), width)
    for position in np.unique(at):
        rows = np.flatnonzero(at == position)
        yield int(position), rows, raw[rows]


def _first(kept: DataFrame, n: int, size: int | None = None) -> list[list[float]]:
    some = kept if size is None else kept.filter(F.size("vector") == size)
    return [r.vector for r in some.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(n).collect()]


def _better(distinct: DataFrame, books: Books, width: int) -> Books:
    """One round: every entry becomes the floor of the mean of the parts nearest to it."""
    arrays = [np.array(b, np.int64) for b in books]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, total = np.zeros((len(arrays), len(arrays[0])), np.int64), np.zeros((len(arrays), len(arrays[0]), width), np.int64)
        for batch in batches:
            weights = batch.column("weight").to_numpy()
            for position, rows, points in _points(batch, width):
                place, _ = nearest(points, arrays[position])
                np.add.at(weight[position], place, weights[rows])
                np.add.at(total[position], place, points * weights[rows][:, None])
        at = np.argwhere(weight > 0)
        x = [at[:, 0], at[:, 1], weight[weight > 0]]
        yield pa.RecordBatch.from_arrays([*map(pa.array, x), pa.array(list(total[weight > 0]), pa.list_(pa.int64()))], ["position", "entry", "weight", "total"])

    sums = distinct.mapInArrow(add, "position long, entry long, weight long, total array<long>")
    totals = [F.sum(F.col("total")[k]).alias(f"t{k}") for k in range(width)]
    out = [[list(e) for e in b] for b in books]
    for r in sums.groupBy("position", "entry").agg(F.sum("weight").alias("weight"), *totals).collect():  # as many as entries
        out[r.position][r.entry] = [r[f"t{k}"] // r.weight for k in range(width)]
    return out


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256
) -> tuple[DataFrame, Books]:
    """``id``, ``label``, ``codes`` (array of long, by part) and ``error`` of each usable vector, and the codebooks."""
    spark, id_type, label_type = vectors.sparkSession, vectors.schema[id_col].dataType, vectors.schema[label_col].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("label", label_type), T.StructField("codes", T.ArrayType(T.LongType())), T.StructField("error", T.LongType())])
    kept = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector")).filter(usable(F.col("vector"), parts))
    start = _first(kept, entries)
    if not start:
        return spark.createDataFrame([], schema), [[] for _ in range(parts)]
    size = len(start[0])
    if any(len(v) != size for v in start):
        start = _first(kept, entries, size)
    width = size // parts
    first = integers(np.array(start, np.float64), scale).reshape(len(start), parts, width)
    books: Books = first.transpose(1, 0, 2).tolist()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers()
        for batch in batches:
            step = max(1, BLOCK_COMPONENTS // size)
            for i in range(0, batch.num_rows, step):
                some = batch.slice(i, step)
                cells = integers(_matrix(some.column(2)), scale).reshape(some.num_rows, parts, width)
                places, at, raw, weights = np.zeros((some.num_rows, parts), np.int32), [], [], []
                for p in range(parts):
                    bytes_of = np.ascontiguousarray(cells[:, p]).view(f"V{8 * width}").ravel()
                    distinct, inverse, times = np.unique(bytes_of, return_inverse=True, return_counts=True)
                    places[:, p] = inverse + len(raw)
                    at += [p] * len(distinct)
                    raw += [x.tobytes() for x in distinct]
                    weights += times.tolist()
                none = [None] * (some.num_rows - 1)
                lists = [pa.array([v, *none], pa.list_(t)) for v, t in ((at, pa.int32()), (raw, pa.binary()), (weights, pa.int64()))]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(some.num_rows, next(number))), some.column(0), some.column(1), pa.array([x.tobytes() for x in places], pa.binary()), *lists], blocks_schema.names)

    dictionary = [T.StructField("position", T.ArrayType(T.IntegerType())), T.StructField("part", T.ArrayType(T.BinaryType())), T.StructField("weight", T.ArrayType(T.LongType()))]
    blocks_schema = T.StructType([T.StructField("block", T.LongType()), schema["id"], schema["label"], T.StructField("places", T.BinaryType()), *dictionary])
    scratch = Scratch(spark, "code_compression")
    blocks = scratch.save(kept.filter(F.size("vector") == size).mapInArrow(cut, blocks_schema), "blocks")
    found = block_entries(blocks, "position", "part", "weight")
    distinct = scratch.save(found.groupBy("position", "part").agg(F.sum("weight").alias("weight")), "distinct")
    for _ in range(rounds):
        books = _better(distinct, books, width)
    arrays = [np.array(b, np.int64) for b in books]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, error = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for position, rows, points in _points(batch, width):
                code[rows], error[rows] = nearest(points, arrays[position])
            yield pa.RecordBatch.from_arrays([batch.column("position"), batch.column("part"), pa.array(code), pa.array(error)], ["position", "part", "code", "error"])

    coded = distinct.mapInArrow(assign, "position int, part binary, code long, error long")
    looked_up = found.select("block", "place", "position", "part").join(coded, ["position", "part"]).select("block", "place", "code", "error")

    def join(rows: pa.Table, values: pa.Table) -> pa.Table:
        code, error = (values.column(c).to_numpy() for c in ("code", "error"))
        places = np.frombuffer(b"".join(rows.column("places").to_pylist()), np.int32).reshape(rows.num_rows, parts)
        codes = pa.ListArray.from_arrays(pa.array(np.arange(rows.num_rows + 1) * parts, pa.int32()), pa.array(code[places].ravel()))
        return pa.Table.from_arrays([rows.column("id"), rows.column("label"), codes, pa.array(error[places].sum(1))], schema.names)

    return look_up(blocks.select("block", "id", "label", "places"), looked_up, join, schema), books


def decoded(coded: DataFrame, books: Books, scale: int = 256) -> DataFrame:
    """The vectors that the codes stand for, beside ``coded``'s columns."""
    spark = coded.sparkSession
    flat = spark.createDataFrame([(books,)], "books array<array<array<long>>>")  # one row
    entry = lambda book, code: F.transform(book[code.cast("int")], lambda c: c / F.lit(float(scale)))
    return coded.crossJoin(F.broadcast(flat)).withColumn("vector", F.flatten(F.zip_with("books", "codes", entry))).drop("books")


def books_sha256(books: Books) -> str:
    """Of all components in decimal, by part, entry and place, with commas between."""
    return hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error``: the error summed over equal labels, nulls together. Sums are joined back, so that a label of a third of all rows is split like any join's."""
    saved = Scratch(coded.sparkSession, "code_compression").save(coded, "coded")
    sums = saved.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    return saved.join(sums, F.col("label").eqNullSafe(F.col("__label")), "left").drop("__label")
