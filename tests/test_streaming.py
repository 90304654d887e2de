"""State with timers: replays, restarts, reclaims, and the batch twins."""

from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tidewright.operators import crawl as C
from tidewright.streaming import queue as Q

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def run(spark, f, schema, batches, tmp_path, restart=False):
    """One batch after another through the stream, which ends and is started again for each if asked."""
    Q.settings(spark)
    (tmp_path / "in").mkdir()
    name = f"t{abs(hash(str(tmp_path)))}"
    query = None
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"b{k}"))
        if query is None or restart:
            stream = f(spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in")))
            query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).queryName(f"{name}{k}").option("checkpointLocation", str(tmp_path / "c")).outputMode("append")
            query = query.trigger(availableNow=True).start() if restart else query.start()
        if restart:
            assert query.awaitTermination(90)
        else:
            query.processAllAvailable()
    query.stop()
    return spark.read.parquet(str(tmp_path / "out"))


def event(i, minutes, event_id, kind, worker=None, code=None, known=False):
    return (i, f"src{i}", at(minutes), event_id, kind, worker, code, known)


EVENTS = [
    # 1: claimed, kept by a heartbeat, done by its owner; what another worker says is skipped
    event(1, 0, 1, "discovered"), event(1, 10, 2, "claimed", "a"), event(1, 20, 3, "claimed", "b"), event(1, 65, 4, "heartbeat", "a"), event(1, 66, 5, "heartbeat", "b"), event(1, 120, 6, "fetched", "a"), event(1, 130, 7, "fetched", "a"),
    # 2: the owner is silent for over an hour; its result comes too late, another worker's counts
    event(2, 0, 8, "discovered"), event(2, 10, 9, "claimed", "a"), event(2, 90, 10, "fetched", "a"), event(2, 95, 11, "claimed", "b"), event(2, 100, 12, "fetched", "b", None, True),
    # 3: an error, 4: never claimed, 5: claimed and never heard of again, 6: exactly an hour is not too late
    event(3, 1, 13, "discovered"), event(3, 2, 14, "claimed", "a"), event(3, 3, 15, "fetched", "a", "http_status"), event(4, 5, 16, "discovered"), event(5, 6, 17, "discovered"), event(5, 7, 18, "claimed", "c"),
    event(6, 0, 19, "discovered"), event(6, 5, 20, "claimed", "a"), event(6, 65, 21, "fetched", "a"),
    event(7, 400, 22, "discovered"),
]
WANT = {1: ("done", "processed", None, 1, 0, 3), 2: ("done", "deduplicated", None, 2, 1, 1), 3: ("error", "error", "http_status", 1, 0, 0), 4: ("pending", "pending", None, 0, 0, 0), 5: ("pending", "reclaimed", None, 1, 1, 0), 6: ("done", "processed", None, 1, 0, 0), 7: ("pending", "pending", None, 0, 0, 0)}


@pytest.mark.parametrize(("cuts", "restart"), [((), False), ((70, 92), False), ((15, 97), True)])
def test_queue_replay(spark, tmp_path, cuts, restart):
    """The same end however the log is cut into batches, and over restarts from the checkpoint."""
    edges = [-1, *cuts, 10_000]
    batches = [[e for e in EVENTS if at(a) < e[2] <= at(b)] for a, b in zip(edges, edges[1:], strict=False)]
    out = run(spark, Q.queue_states, Q.LOG, batches, tmp_path, restart)
    got = {r.queue_id: (r.status, r.outcome, r.error_code, r.claims, r.reclaims, r.skipped) for r in Q.latest(out).collect()}
    assert got == WANT
    reclaimed = {r.queue_id: r["at"] for r in out.filter("outcome = 'reclaimed'").collect()}
    assert reclaimed == {2: at(70) + dt.timedelta(milliseconds=1), 5: at(67) + dt.timedelta(milliseconds=1)}


def test_queue_in_the_clusters_time(spark, tmp_path):
    """Such a query has a batch at each trigger, for its timers, and does not end by itself."""
    Q.settings(spark)
    spark.createDataFrame(EVENTS[:6], Q.LOG).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = Q.queue_states(spark.readStream.schema(Q.LOG).parquet(str(tmp_path / "in")), "ProcessingTime")
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(processingTime="1 second").start()
    end = time.time() + 60
    while time.time() < end and not (query.lastProgress and query.lastProgress.batchId >= 1):
        time.sleep(0.5)
    query.stop()
    assert {r.outcome for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"pending", "claimed", "heartbeat", "skipped", "processed"}


def test_error_codes(spark):
    rows = [(None, None, 200, 5, False), ("do_not_collect", None, 200, 5, False), ("ok", "refused", None, None, False), ("ok", None, 404, 5, False), ("ok", None, 204, 0, False), ("ok", None, 200, 0, False), ("ok", None, 200, 5, True), ("ok", None, 200, 5, None)]
    df = spark.createDataFrame(rows, "p string, f string, s int, n long, x boolean")
    got = [r[0] for r in df.select(Q.error_code(*(F.col(c) for c in "pfsnx"))).collect()]
    assert got == ["source_not_found_in_graph", "policy_do_not_collect", "runtime_error", "http_status", "empty_body", "empty_body", "dedup_prohibited_source", None]


def test_back_off_equals_the_batch_and_wakes_sources(spark, small, tmp_path):
    from tidewright.sources.tables import Tables

    log = Tables(spark, small).crawl_log().withColumn("ts", F.col("ts").cast("timestamp")).select("source_id", "ts", "event_id", "outcome", "etag")
    resting = [("sick", T0 + dt.timedelta(hours=k), 10**6 + k, "timeout", None) for k in range(6)]
    whole = log.unionByName(spark.createDataFrame(resting, log.schema))
    days = [F.col("ts") < "2024-01-10", (F.col("ts") >= "2024-01-10")]
    out = run(spark, Q.back_off, log.schema, [whole.filter(d).collect() for d in days], tmp_path)
    columns = ("source_id", "event_id", "failures", "last_etag", "next_eligible_at")
    got = sorted(tuple(r) for r in out.filter("kind = 'fetch'").select(*columns).collect())
    assert got == sorted(tuple(r) for r in C.failure_state(whole).select(*columns).collect())
    woken = [r["at"] for r in out.filter("kind = 'eligible' and source_id = 'sick'").collect()]
    assert woken == [T0 + dt.timedelta(hours=29)]
