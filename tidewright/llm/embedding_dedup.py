"""Embedding near-dedup: spherical k-means cells, blocked cosine products inside them.

1. Equal vectors of a label are one row with a count. Vectors that are null, zero
   or hold null or non-finite components link with nothing, nor do null labels.
2. Spherical k-means on a bounded sample (at most ``SAMPLE`` vectors, those with the
   smallest hashes) gives unit centres, whose number follows that of the vectors. A vector lives in the cell of its nearest centre
   and is shown in every cell whose dividing plane is within half the chord of
   the threshold: of two vectors that link across a plane, one is that near to
   it. So no link is lost to the cells, for any centres.
3. A label's cell is cut into blocks of bounded size; each pair of blocks is one
   task's double-precision product. Each pair of vectors counts in one cell only:
   the lower of both homes if the other is shown there, else the higher.
4. Blocks return counts of links and, for connectivity, each vector's smallest
   mate inside the block's own components, never pairs.

One row is returned for each row of the table: rows that repeat an id share its
class and count on their own; a null id is never the smallest while there is
another. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from ..scratch import Scratch

#: Vectors of a label that a cell should hold.
CELL = 2048
#: Vectors that centres are fitted on: some for each cell, ``SAMPLE`` at most, and so cells.
PER_CELL, SAMPLE = 16, 65_536
#: Rows of a block; a task compares two.
BLOCK = 2048


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _nearest(x: np.ndarray, at: np.ndarray, rows: int = 4096) -> np.ndarray:
    return np.concatenate([(x[i : i + rows] @ at.T).argmax(1) for i in range(0, len(x), rows)])


def centres(sample: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Unit centres by spherical k-means from an even choice of the sample."""
    k = max(1, min(k, len(sample)))
    at = sample[np.linspace(0, len(sample) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = _nearest(sample, at)
        order = np.argsort(near, kind="stable")
        begins = np.flatnonzero(np.diff(near[order], prepend=-1))
        total = np.zeros_like(at)
        total[near[order][begins]] = np.add.reduceat(sample[order], begins, axis=0)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        at = np.where(size > 1e-9, total / np.maximum(size, 1e-9), at)
    return np.unique(at, axis=0)


def cells_of(x: np.ndarray, at: np.ndarray, threshold: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each unit vector's home, and the cells that it is shown in."""
    homes, shown = [], []
    rows = max(1, (1 << 20) // len(at))
    for i in range(0, len(x), rows):
        near = x[i : i + rows] @ at.T
        home = near.argmax(1)
        apart = np.sqrt(np.maximum(2 - 2 * at[home] @ at.T, 0))
        margin = (near[np.arange(len(near)), home][:, None] - near) / np.maximum(apart, 1e-12)
        inside = margin <= np.sqrt(2 - 2 * threshold) / 2 + 1e-9
        inside[np.arange(len(near)), home] = True
        homes.append(home)
        shown += [np.flatnonzero(row) for row in inside]
    return np.concatenate(homes), shown


def _owned(cell: int, home: np.ndarray, shown: list, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Which of the links ``u, v`` this cell counts: both at home here, or one, and the other's home is higher or does not show the one."""
    hu, hv = home[u], home[v]
    mine = (hu == cell) & (hv == cell)
    size = np.fromiter(map(len, shown), np.int64, len(shown))
    cells = np.concatenate(shown).astype(np.int64)
    span = max(int(cells.max()), int(home.max())) + 1
    codes = np.sort(np.repeat(np.arange(len(shown)), size) * span + cells)
    for resident, guest, other in ((u, hv, (hu == cell) & (hv != cell)), (v, hu, (hv == cell) & (hu != cell))):
        at = np.flatnonzero(other)
        want = resident[at] * span + guest[at]
        found = codes[np.minimum(np.searchsorted(codes, want), len(codes) - 1)] == want
        mine[at[(guest[at] > cell) | ~found]] = True
    return mine


def compare(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links within one pair of blocks: for each vector the copies it links with and its mate."""
    low = (pdf["part"] == pdf["low"]).to_numpy()
    alone = pdf["low"].iloc[0] == pdf["high"].iloc[0]
    x = np.stack(pdf["embedding"].to_numpy()).astype(float, copy=False)
    norm = np.linalg.norm(x, axis=1)
    y = x / norm[:, None]
    left = np.flatnonzero(low)
    right = left if alone else np.flatnonzero(~low)
    cosine = y[left] @ y[right].T
    u, v = np.nonzero(cosine >= threshold - 1e-12)
    value = cosine[u, v]
    if alone:
        u, v, value = u[u < v], v[u < v], value[u < v]
    u, v = left[u], right[v]
    close = np.flatnonzero(np.abs(value - threshold) < 1e-12)
    value[close] = np.einsum("ij,ij->i", x[u[close]], x[v[close]]) / (norm[u[close]] * norm[v[close]])
    keep = np.flatnonzero(value >= threshold)
    u, v = u[keep], v[keep]
    if len(u):
        keep = _owned(int(pdf["cell"].iloc[0]), pdf["home"].to_numpy(), pdf["shown"].to_list(), u, v)
        u, v = u[keep], v[keep]
    number, n = np.arange(len(pdf)), len(pdf)
    while True:  # the smallest number that links reach inside this product
        least = number.copy()
        np.minimum.at(least, u, number[v])
        np.minimum.at(least, v, number[u])
        least = least[least]
        if (least == number).all():
            break
        number = least
    weight = pdf["copies"].to_numpy()
    links = np.bincount(u, weight[v], n) + np.bincount(v, weight[u], n)
    got = np.flatnonzero(links > 0)
    key = pdf["key"].to_numpy()
    return pd.DataFrame({"key": key[got], "links": links[got].astype(np.int64), "mate": key[number[got]]})


def classes(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``id, n_links, class_id`` for each row."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is above 0 and at most 1")
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embeddings")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.transform(vector_col, lambda x: x.cast("double")).alias("embedding"))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    sound = F.col("label").isNotNull() & F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)) & (norm > 0) & (norm < float("inf"))
    key = F.unhex(F.md5(F.concat(F.col("label"), F.lit("\0"), F.array_join(F.transform("embedding", lambda x: x.cast("string")), ",")).cast("binary")))
    rows = scratch.save(rows.select("id", F.when(F.coalesce(sound, F.lit(False)), key).alias("key"), "label", "embedding"), "rows")
    good = rows.filter("key is not null")
    unique = scratch.save(good.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("id"), F.first("label").alias("label"), F.first("embedding").alias("embedding")), "unique")

    per_label = unique.groupBy("label", F.size("embedding").alias("dim")).count().agg(F.max("count").alias("most")).first()["most"] or 0
    k = min(SAMPLE // 4, -(-per_label // CELL))
    picked = unique.select("key", "embedding").orderBy("key").limit(min(SAMPLE, max(1024, PER_CELL * k))).select("embedding").toArrow().column(0)
    by_dim: dict[int, list[np.ndarray]] = {}
    for vector in picked:
        by_dim.setdefault(len(vector), []).append(vector.values.to_numpy())
    shared = spark.sparkContext.broadcast({d: centres(unit(np.array(x)), k) for d, x in by_dim.items()})

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = batch.column(0).to_pylist()
            home, shown = [0] * len(vecs), [np.zeros(1, int)] * len(vecs)
            for d in {len(v) for v in vecs}:
                at = [i for i, v in enumerate(vecs) if len(v) == d]
                if d in shared.value:
                    h, s = cells_of(unit(np.array([vecs[i] for i in at])), shared.value[d], threshold)
                    for i, a, b in zip(at, h, s, strict=True):
                        home[i], shown[i] = int(a), b
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home, pa.int32()), pa.array(shown, pa.list_(pa.int32()))], [*batch.schema.names, "home", "shown"])

    placed = unique.select("embedding", "key", "copies", "label").mapInArrow(assign, "embedding array<double>, key binary, copies long, label string, home int, shown array<int>")
    placed = scratch.save(placed.withColumn("cell", F.explode("shown")).withColumn("dim", F.size("embedding")), "placed")
    group = ["label", "dim", "cell"]
    sizes = placed.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    parted = placed.join(sizes, group).withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    pairs = parted.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)"))).withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
    found = pairs.select(*group, "low", "high", "part", "key", "copies", "home", "shown", "embedding").groupBy(*group, "low", "high").applyInPandas(lambda pdf: compare(pdf, threshold), "key binary, links long, mate binary")
    found = scratch.save(found, "found")
    grouped = components(found.filter("key <> mate").select(F.col("key").alias("a"), F.col("mate").alias("b")), scratch)
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    nodes = unique.select("key", "copies", "id").join(links, "key", "left").join(grouped.select(F.col("node").alias("key"), "root"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    nodes = scratch.save(nodes, "nodes")
    heads = nodes.groupBy("root").agg(F.min("id").alias("class_id"))
    nodes = nodes.join(heads, "root").select("key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "class_id")
    return rows.select("id", "key").join(nodes, "key", "left").select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("class_id", "id").alias("class_id"))
