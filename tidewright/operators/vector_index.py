"""Approximate neighbours by cosine: inverted lists of product-quantised residuals, and exact products at the end.

1. On a bounded sample (:data:`SAMPLE_VALUES` numbers, vectors with the smallest hashes of
   their ids) k-means finds cells, and a codebook for each part of what a vector has
   beyond its cell's centre.
2. Every vector of the table gets its cell and its codes, written in the order of cells.
3. A query looks into its nearest cells. There its product with a vector is that with the
   centre plus one entry of a table for each part. Tasks keep a query's best, and the
   best of all tasks are compared again by their vectors, in double precision.

Vectors are those of the commonest length; others are compared with all of their length
by :func:`.design.knn`, which is exact. Null and zero vectors, and those that hold a null
or no number, are nobody's neighbour.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch
from .design import knn

#: Numbers in the sample that cells and codebooks are fitted on.
SAMPLE_VALUES = 1 << 22
#: Queries that are sent out at a time, and candidates of each that are compared exactly.
QUERIES, CANDIDATES = 1024, 128
_ROUNDS = 8
_ENTRIES = 256


@dataclass(frozen=True)
class Codec:
    centres: np.ndarray  # cells x size
    books: np.ndarray  # parts x entries x size of a part

    @property
    def size(self) -> int:
        return self.centres.shape[1]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = _closest(x, self.centres)
        rest = (x - self.centres[cell]).reshape(len(x), len(self.books), -1)
        return cell, np.stack([_closest(rest[:, p], book) for p, book in enumerate(self.books)], 1).astype(np.uint8)


def _closest(x: np.ndarray, centres: np.ndarray, rows: int = 4096) -> np.ndarray:
    half = (centres * centres).sum(1) / 2
    return np.concatenate([(half - x[i : i + rows] @ centres.T).argmin(1) for i in range(0, len(x), rows)]) if len(x) else np.zeros(0, np.int64)


def _means(x: np.ndarray, n: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(n, len(x)), replace=False)].copy()
    for _ in range(_ROUNDS):
        own = _closest(x, centres)
        times = np.bincount(own, minlength=len(centres))
        order = np.argsort(own, kind="stable")
        sums = np.add.reduceat(x[order], np.concatenate(([0], np.cumsum(times)[:-1]))[times > 0], axis=0)
        centres[times > 0] = sums / times[times > 0, None]
    return centres


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: x.cast("double")).alias("v"))
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return rows.filter(F.col("id").isNotNull() & F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False)))


def _unit(column: pa.Array) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float32)
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), np.float32(1e-30))


class VectorIndex:
    """An index of ``vectors(id, vector)``, written when it is made."""

    def __init__(self, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cells: int | None = None, parts: int = 16) -> None:
        self.id_col, self.vector_col, self.vectors = id_col, vector_col, vectors
        usable = _usable(vectors, id_col, vector_col)
        common = usable.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
        self.rows = usable.filter(F.size("v") == (common["size"] if common else 0))
        self.codec: Codec | None = None
        if common is None:
            return
        size, n = common["size"], common["n"]
        most = max(1, SAMPLE_VALUES // size)
        sample = self.rows.orderBy(F.xxhash64("id"), "id").limit(most).select("v").toArrow()  # a bounded sample
        x = _unit(sample.column("v").combine_chunks())
        cut = max(p for p in range(1, parts + 1) if size % p == 0)
        centres = _means(x, cells or max(1, min(round(n**0.5), len(x) // 8, 1 << 14)), 1)
        rest = (x - centres[_closest(x, centres)]).reshape(len(x), cut, -1)
        entries = [_means(rest[:, p], _ENTRIES, 2 + p) for p in range(cut)]
        self.codec = Codec(centres, np.stack(entries))
        shared = vectors.sparkSession.sparkContext.broadcast(self.codec)

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cell, codes = shared.value.encode(_unit(batch.column("v")))
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), batch.column("id"), pa.array([c.tobytes() for c in codes], pa.binary())], ["cell", "id", "codes"])

        coded = self.rows.select("id", "v").mapInArrow(encode, "cell int, id long, codes binary")
        self.lists = Scratch(vectors.sparkSession, "vectors").save(coded.repartitionByRange("cell", "id").sortWithinPartitions("cell", "id"), "lists")

    def tune(self, queries: DataFrame, k: int, least: float = 0.95, sample: int = 64) -> int:
        """How many cells hold the share ``least`` of the exact neighbours of some queries, those with the smallest hashes."""
        if self.codec is None:
            return 1
        asked = _usable(queries, self.id_col, self.vector_col).filter(F.size("v") == self.codec.size)
        some = asked.orderBy(F.xxhash64("id"), "id").limit(sample).toArrow()
        if not some.num_rows:
            return 1
        chosen = self.vectors.sparkSession.createDataFrame(some)
        exact = knn(self.rows, chosen, k, "id", "v").select("query_id", F.col("other_id").alias("id"))
        found = self.lists.select("id", "cell").join(F.broadcast(exact), "id").select("query_id", "cell").collect()  # k for each of the sample
        place = np.argsort(self._order(_unit(some.column("v").combine_chunks())), axis=1)
        row = {q: i for i, q in enumerate(some.column("id").to_pylist())}
        needed = sorted(int(place[row[r.query_id], r.cell]) for r in found)
        return needed[-(-round(least * len(needed) * 1000) // 1000) - 1] + 1 if needed else 1

    def _order(self, unit: np.ndarray) -> np.ndarray:
        """The cells of each vector, the nearest first."""
        centres = self.codec.centres  # type: ignore[union-attr]
        return np.argsort((centres * centres).sum(1) / 2 - unit @ centres.T, axis=1, kind="stable")

    def search(self, queries: DataFrame, k: int, probes: int | None = None, candidates: int = CANDIDATES) -> DataFrame:
        """``query_id, other_id, cosine, rank``: the ``k`` nearest that the nearest ``probes`` cells of each query hold (by :meth:`tune`, if not said)."""
        probes = probes or self.tune(queries, k)
        spark, asked = self.vectors.sparkSession, _usable(queries, self.id_col, self.vector_col)
        size = self.codec.size if self.codec else 0
        other = lambda df: df.filter(F.coalesce(F.size(self.vector_col) != size, F.lit(False)))
        found = knn(other(self.vectors), other(queries), k, self.id_col, self.vector_col).select("query_id", "other_id", "cosine")
        mine = asked.filter(F.size("v") == size)
        blocks = -(-mine.count() // QUERIES)
        for block in range(blocks):
            some = mine.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toArrow()  # about QUERIES rows
            if some.num_rows:
                found = found.unionByName(self._block(spark, some, probes, max(k, candidates)))
        w = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "other_id")
        return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)

    def _block(self, spark, some: pa.Table, probes: int, keep: int) -> DataFrame:  # noqa: ANN001
        codec = self.codec
        assert codec is not None
        ids, exact = some.column("id").to_numpy(), some.column("v").combine_chunks().flatten().to_numpy().reshape(some.num_rows, -1)
        unit = _unit(some.column("v").combine_chunks())
        to_centre = unit @ codec.centres.T
        near = self._order(unit)[:, :probes]
        by_cell: dict[int, np.ndarray] = {int(c): np.flatnonzero((near == c).any(1)) for c in np.unique(near)}
        tables = np.einsum("qpd,ped->qpe", unit.reshape(len(unit), len(codec.books), -1), codec.books)
        shared = spark.sparkContext.broadcast((ids, exact, to_centre, tables, by_cell))

        def best(row: np.ndarray, other: np.ndarray, score: np.ndarray) -> np.ndarray:
            order = np.lexsort((other, -score, row))
            place = np.arange(len(order)) - np.searchsorted(row[order], row[order], "left")
            return order[place < keep]

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, _, to_centre, tables, by_cell = shared.value
            held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)]
            for batch in batches:
                cells, others = batch.column("cell").to_numpy(), batch.column("id").to_numpy()
                codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(len(cells), -1)
                for cell in np.unique(cells):
                    rows = np.flatnonzero(cells == cell)
                    for i in range(0, len(rows), 2048):
                        at = rows[i : i + 2048]
                        q = by_cell[int(cell)]
                        score = to_centre[q, cell][:, None].astype(np.float32).repeat(len(at), 1)
                        for p in range(codes.shape[1]):
                            score += tables[q, p][:, codes[at, p]]
                        score[ids[q][:, None] == others[at][None, :]] = -np.inf
                        take = np.argpartition(-score, keep - 1, axis=1)[:, :keep] if len(at) > keep else np.tile(np.arange(len(at)), (len(q), 1))
                        new = [np.repeat(q, take.shape[1]), others[at][take].ravel(), np.take_along_axis(score, take, 1).ravel()]
                        good = np.isfinite(new[2])
                        held = [np.concatenate((h, n[good])) for h, n in zip(held, new, strict=True)]
                        if len(held[0]) > 4 * keep * len(ids):
                            chosen = best(*held)
                            held = [h[chosen] for h in held]
            chosen = best(*held)
            for i in range(0, len(chosen), 1 << 16):
                c = chosen[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(held[0][c]), pa.array(held[1][c]), pa.array(held[2][c])], ["query", "id", "score"])

        wanted = self.lists.filter(F.col("cell").isin([int(c) for c in by_cell])).mapInArrow(look, "query long, id long, score float")
        order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
        # About QUERIES times the candidates of each: a bound by both parameters.
        chosen = wanted.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= keep).select("query", "id")
        rows = self.rows.join(F.broadcast(chosen), "id")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, exact = shared.value[:2]
            for batch in batches:
                x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                q = exact[batch.column("query").to_numpy()]
                size = [np.sqrt(np.cumsum(m * m, axis=1)[:, -1]) for m in (q, x)]
                cosine = np.cumsum(q * x, axis=1)[:, -1] / (size[0] * size[1])
                yield pa.RecordBatch.from_arrays([pa.array(ids[batch.column("query").to_numpy()]), batch.column("id"), pa.array(cosine)], ["query_id", "other_id", "cosine"])

        return rows.select("query", "id", "v").mapInArrow(compare, "query_id long, other_id long, cosine double")
