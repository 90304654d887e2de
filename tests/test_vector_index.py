"""Approximate neighbours against exact ones."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidewright.operators.design import knn
from tidewright.operators.vector_index import VectorIndex


def recall(exact, found):
    near = {}
    for r in exact.collect():
        near.setdefault(r.query_id, set()).add(r.other_id)
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, set()).add(r.other_id)
    return sum(len(v & got.get(q, set())) for q, v in near.items()) / sum(map(len, near.values()))


def test_recall_on_the_table(spark):
    v = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    queries = v.filter("vec_id % 50 = 0")
    index = VectorIndex(v)
    found = index.search(queries, 5)
    assert index.tune(queries, 5) < len(index.codec.centres)
    assert recall(knn(v, queries, 5), found) >= 0.9
    assert found.filter("query_id = other_id").isEmpty()


def test_hot_cells_odd_vectors_and_all_cells(spark):
    """With all cells and candidates enough the result is the exact one, cosines and ties included."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(120)]  # a third of all rows
    rows += [(500, None), (501, [0.0] * 12), (502, [float("nan")] * 12), (503, [None] * 12), (504, []), (505, [1.0, 2.0]), (506, [2.0, 1.0]), (None, rows[1][1])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    queries = v.filter("vec_id % 7 = 0 or vec_id >= 500")
    index = VectorIndex(v, cells=9)
    key = lambda df: sorted((r.query_id, r.other_id, r.rank, r.cosine) for r in df.collect())
    assert key(index.search(queries, 4, probes=9, candidates=500)) == key(knn(v, queries, 4))
    assert recall(knn(v, queries, 4), index.search(queries, 4, probes=3)) > 0.4
    assert VectorIndex(v.limit(0)).search(queries.limit(0), 4).count() == 0
    assert VectorIndex(v.filter(F.col("embedding").isNull())).search(queries, 4).count() == 0
