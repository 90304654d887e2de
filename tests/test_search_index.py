"""The kept index against plain BM25, over segments and with blocks left out."""

from __future__ import annotations

import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewright.operators import search_index as S

WORDS = [f"w{k}" for k in range(40)]


def words(text):
    return F.filter(F.split(F.coalesce(text, F.lit("")), " "), lambda w: w != "")


def plain(nodes, query, limit, score):
    out = []
    for kind in {k for k, *_ in nodes}:
        terms = {i: Counter(w for t in texts if t for w in t.split()) for k, i, *texts in nodes if k == kind}
        mean = sum(sum(c.values()) for c in terms.values()) / len(terms)
        df = {q: sum(q in c for c in terms.values()) for q in set(query.split())}
        scored = []
        for i, c in terms.items():
            x = 0.0
            for q in df:
                if c[q]:
                    idf = math.log(1 + (len(terms) - df[q] + 0.5) / (df[q] + 0.5))
                    x += idf * c[q] * 2.2 / (c[q] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) if score == "bm25" else c[q]
            if any(c[q] for q in df):
                scored.append((-round(x, 6), i))
        out += [(kind, i, -x, k) for k, (x, i) in enumerate(sorted(scored)[:limit], 1)]
    return sorted(out)


@pytest.mark.parametrize("score", ["bm25", "count"])
def test_search(spark, tmp_path, score, monkeypatch):
    rng = random.Random(4)
    pick = lambda: min(int(rng.expovariate(0.15)), 39)
    nodes = [(rng.choice(["a", "a", "b"]), f"n{i:04}", rng.choice([None, "", f"w{pick()}"]), " ".join(WORDS[pick()] for _ in range(rng.choice([0, 3, 10, 60])))) for i in range(900)]
    df = spark.createDataFrame(nodes, "kind string, id string, name string, text string").repartition(3)
    edges = spark.createDataFrame([("n0001", "n0002", "X"), ("n0002", "n0001", "X"), ("n0001", "n0003", "Y"), ("n0001", None, "X")], "src string, dst string, kind string")
    monkeypatch.setattr(S, "PRUNE_FROM", 16)
    whole = S.SearchIndex(spark, f"{tmp_path}/one", words, score).add(df, ["name", "text"], edges, block=8)
    parts = S.SearchIndex(spark, f"{tmp_path}/two", words, score).add(df.filter("id < 'n0600'"), ["name", "text"], block=8).add(df.filter("id >= 'n0600'"), ["name", "text"], edges, block=8)
    again = S.SearchIndex(spark, f"{tmp_path}/two", words, score).open()
    for query in ("w0", "w0 w1 w5", "w0 w30 w38", "none", "", "w2 w2 none w39"):
        want = plain(nodes, query, 5, score)
        for index in (whole, parts, again):
            assert sorted((r.kind, r.id, pytest.approx(r.score, abs=2e-6), r.place) for r in index.search(query, 5).collect()) == want, query
    for query, share in (("w0", 0.5), ("w1", 0.6)):
        everything = whole.postings.filter(F.col("term").isin(*query.split())).count()
        assert 0 < whole.blocks(query, 5)[0].count() < everything * share
    near = {r.id: r.neighbours for r in parts.one_hop("w0 w1 w2 w3 w4 w5 w6 w7 w8 w9", 900, ["X"]).collect()}
    assert near.get("n0001", "n0002") == "n0002" and near.get("n0003", "") == ""
    with pytest.raises(ValueError, match="segment 1"):
        whole.add(df, ["text"], segment=1)


def test_terms_are_counted_in_runs():
    """Of a batch of long texts, Python holds the terms of a run at a time."""
    terms = [["a", "b", "a"] * 4000 if i % 2 else None for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(["d"] * 40), pa.array([str(i) for i in range(40)]), pa.array(terms, pa.list_(pa.string()))], ["kind", "id", "terms"])
    parts = list(S._counted(iter([batch])))
    assert len(parts) > 3 and max(sum(p.column("size").to_pylist()) for p in parts) <= 1 << 16
    rows = [r for p in parts for r in p.to_pylist()]
    assert [r["id"] for r in rows] == [str(i) for i in range(40)]
    assert rows[0]["terms"] == [] and rows[1] == {"kind": "d", "id": "1", "terms": ["a", "b"], "often": [8000, 4000], "size": 12000}
