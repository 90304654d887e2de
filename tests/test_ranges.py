"""Scans and ranks over ranges against windows, with one key that holds nearly every row."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewright.operators import crawl, documents, ledger
from tidewright.operators import ranges as R


def table(spark, seed, keys):
    rng = random.Random(seed)
    rows = [(rng.choice(keys), rng.randint(0, 30), i, rng.choice([True, False, False, None]), rng.choice(["x", "y", "z", None, None])) for i in range(2500)]
    return spark.createDataFrame(rows, "k string, t int, id long, f boolean, v string").repartition(5)


@pytest.mark.parametrize(("keys", "n"), [(["hot"] * 20 + ["a", "b", None], 9), (["hot"], 7), ([str(i) for i in range(400)], 5), (["a"], 1)])
def test_scan_equals_windows(spark, keys, n):
    rows = table(spark, n, keys)
    f = F.coalesce("f", F.lit(False))
    specs = {"since": R.Since(~f, f), "last": R.Last(F.col("v")), "before": R.Last(F.col("v"), before=True), "next": R.Next(F.col("v"))}
    got = R.scan(rows, ["k"], ["t", "id"], specs, n)
    w = Window.partitionBy("k").orderBy("t", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = rows.withColumn("i", F.sum((~f).cast("int")).over(upto))
    want = want.withColumn("since", F.sum(f.cast("long")).over(Window.partitionBy("k", "i").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0))).drop("i")
    want = want.withColumn("last", F.last("v", True).over(upto)).withColumn("before", F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("next", F.lead("v").over(w))
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert R.scan(rows.limit(0), ["k"], ["t", "id"], specs, n).count() == 0


def test_a_hot_key_is_in_every_range(spark):
    rows = table(spark, 3, ["hot"])
    sizes = [r["count"] for r in R.ranged(rows, ["k"], ["t", "id"], 8).groupBy("__range").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 2500 / 3


@pytest.mark.parametrize("n", [1, 6])
def test_crawl_state_of_one_source(spark, n):
    rng = random.Random(n)
    log = spark.createDataFrame([("s", rng.randint(0, 500), i, rng.choice(["ok", "error", "error", "error", "timeout", "not_modified"]), rng.choice([None, f"W/{i}"])) for i in range(1500)], "source_id string, m int, event_id long, outcome string, etag string")
    log = log.withColumn("ts", F.timestamp_seconds(F.col("m") * 60))
    failures, etag, want = 0, None, {}
    for r in sorted(log.collect(), key=lambda r: (r.ts, r.event_id)):
        failures = failures + 1 if r.outcome in ("error", "timeout") else 0
        etag = r.etag or etag
        want[r.event_id] = (failures, etag, failures >= 5)
    got = {r.event_id: (r.failures, r.last_etag, r.next_eligible_at is not None) for r in crawl.failure_state(log, n).collect()}
    assert got == want
    ids = spark.createDataFrame([("p", x) for x in [*range(0, 900, 2), 5, 5, 4000]], "prefix string, number long")
    found = {(r.number, r.times, r.gap) for r in documents.gaps(ids, ranges=n).collect()}
    present = sorted({*range(0, 900, 2), 5, 4000})
    assert found == {(a, 2 if a == 5 else 1, b - a - 1) for a, b in zip(present, [*present[1:], None], strict=True) if b and (b - a > 1 or a == 5)} | ({(5, 2, 0)} if 6 in present else set())


@pytest.mark.parametrize("n", [1, 5, 40])
def test_ranks(spark, n):
    rng = random.Random(n)
    rows = [("hot", float(rng.choice([rng.randint(0, 10_000), 7, 7]))) for _ in range(2000)] + [("one", 3.0), (None, 1.0), (None, 2.0), ("none", None), ("hot", None), ("nan", float("nan")), ("nan", 1.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    shares = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r.g: [getattr(r, s) for s in shares] for r in R.ranked(df, "g", "v", shares, n).collect()}
    for g in {x for x, _ in rows}:
        v = sorted((x for k, x in rows if k == g and x is not None), key=lambda x: (math.isnan(x), x))
        want = [v[max(1, math.ceil(len(v) * p)) - 1] if v else None for p in shares.values()]
        assert repr(got[g]) == repr(want), g
    assert ledger.nearest_rank(df.limit(0), "g", "v", shares).count() == 0
