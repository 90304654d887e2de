"""The discovery queue and the sources' back-off as state with timers.

:func:`queue_states` turns a log of what happened to queue rows into transitions:

* ``discovered``: the row becomes pending;
* ``claimed``: a pending row is processing, and belongs to the worker;
* ``heartbeat``: the owner keeps it for another hour;
* ``fetched``: the owner's result makes it done or an error;
* an hour without a word from the owner makes it pending again (a timer, or the next
  event of the row if that comes first in the log).

What comes from a worker that does not own the row, and what comes after the end, is
skipped. :func:`back_off` counts failures in a row for each source, and says when
a source that rests may be polled again (a timer after a day).

Time is event time, which a watermark moves (replays give the same rows however the log
is cut into batches), or the cluster's own (``ProcessingTime``). A key's events must come
in order between batches; within one they are sorted. A finished row is remembered
for a week, so that what comes late is skipped, and its state is then dropped.
Needs the RocksDB provider: see :func:`settings`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.crawl import FAILURES
from ..scratch import Scratch

HOUR = 3_600_000
RECLAIM_MS, FORGET_MS, REST_MS = HOUR, 7 * 24 * HOUR, 24 * HOUR
#: What can be wrong with a row, in the order in which it is asked.
ERROR_CODES = ("source_not_found_in_graph", "policy_do_not_collect", "runtime_error", "http_status", "empty_body", "dedup_prohibited_source")
NO_BODY = (204, 205)

LOG = "queue_id long, source_id string, at timestamp, event_id long, kind string, worker string, error_code string, known boolean"
_STATE = "source_id string, status string, worker string, deadline long"
_TRANSITION = "queue_id long, source_id string, at timestamp, event_id long, kind string, outcome string, status string, worker string, error_code string, claims long"
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.UTC)


def settings(spark: SparkSession) -> None:
    """State with several variables and timers needs this provider."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def error_code(archive_policy: Column, failure: Column, http_status: Column, body_length: Column, prohibited: Column) -> Column:
    """What is wrong with a fetched row, or null. A null policy is a source that the graph does not know."""
    good = http_status.between(200, 299)
    empty = F.coalesce(body_length, F.lit(0)) == 0
    wrong = (
        archive_policy.isNull(), archive_policy == "do_not_collect", failure.isNotNull() | http_status.isNull(),
        ~good | (http_status.isin(*NO_BODY) & ~empty), empty, F.coalesce(prohibited, F.lit(False)),
    )
    out = F.lit(None).cast("string")
    for code, when in reversed(tuple(zip(ERROR_CODES, wrong, strict=True))):
        out = F.when(when, code).otherwise(out)
    return out


def _ms(at: dt.datetime) -> int:
    return round((at - _EPOCH).total_seconds() * 1000)


class _Timed(StatefulProcessor):
    """What both processors share: the time that a key's next timer is measured from."""

    def __init__(self, time_mode: str) -> None:
        self.event_time = time_mode.lower() == "eventtime"

    def _now(self, at: dt.datetime, timers: Any) -> int:
        return _ms(at) if self.event_time else timers.getCurrentProcessingTimeInMs()

    def _rearm(self, handle: StatefulProcessorHandle, old: int | None, new: int | None) -> None:
        if old != new:
            if old is not None:
                handle.deleteTimer(old)
            if new is not None:
                handle.registerTimer(new)

    def close(self) -> None:
        pass


class QueueProcessor(_Timed):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.row = handle.getValueState("row", _STATE)
        # Claims of the row by worker; forgotten by themselves where time is the cluster's own.
        self.claims = handle.getMapState("claims", "worker string", "n long", None if self.event_time else FORGET_MS)

    def _total(self) -> int:
        return sum(n[0] for n in self.claims.values())

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        kept = self.row.get() if self.row.exists() else (None, None, None, None)
        source, status, worker, deadline = kept
        armed = deadline
        for e in sorted(rows, key=lambda r: (r.at, r.event_id)):
            now = self._now(e.at, timerValues)
            if status == "processing" and now > deadline:
                yield self._reclaimed(key, source, deadline)
                status, worker, deadline = "pending", None, None
            outcome, code = "skipped", None
            if e.kind == "discovered" and status is None:
                source, status, outcome = e.source_id, "pending", "pending"
            elif e.kind == "claimed" and status == "pending" and e.worker is not None:
                status, worker, deadline, outcome = "processing", e.worker, now + RECLAIM_MS, "claimed"
                before = self.claims.getValue((worker,))[0] if self.claims.containsKey((worker,)) else 0
                self.claims.updateValue((worker,), (before + 1,))
            elif status == "processing" and e.worker == worker and e.kind == "heartbeat":
                deadline, outcome = now + RECLAIM_MS, "heartbeat"
            elif status == "processing" and e.worker == worker and e.kind == "fetched":
                code = e.error_code
                outcome = "error" if code is not None else "deduplicated" if e.known else "processed"
                status, deadline = "error" if code is not None else "done", now + FORGET_MS
            yield Row(queue_id=key[0], source_id=source or e.source_id, at=e.at, event_id=e.event_id, kind=e.kind, outcome=outcome, status=status, worker=e.worker, error_code=code, claims=self._total())
        if status is not None:
            self.row.update((source, status, worker, deadline))
        self._rearm(self.handle, None if armed is None else armed + 1, None if deadline is None else deadline + 1)

    def _reclaimed(self, key: Any, source: str, deadline: int) -> Row:
        at = _EPOCH + dt.timedelta(milliseconds=deadline + 1)
        return Row(queue_id=key[0], source_id=source, at=at, event_id=None, kind="timer", outcome="reclaimed", status="pending", worker=None, error_code=None, claims=self._total())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        source, status, _, deadline = self.row.get() if self.row.exists() else (None, None, None, None)
        if deadline is None or expiredTimerInfo.getExpiryTimeInMs() != deadline + 1:
            return
        if status == "processing":
            self.row.update((source, "pending", None, None))
            yield self._reclaimed(key, source, deadline)
        else:
            self.row.clear()
            self.claims.clear()


def queue_states(log: DataFrame, time_mode: str = "EventTime", late: str = "0 seconds") -> DataFrame:
    """Transitions of the stream ``log`` (:data:`LOG`, its ``error_code`` from :func:`error_code`)."""
    stamped = log.withWatermark("at", late) if time_mode.lower() == "eventtime" else log
    return stamped.groupBy("queue_id").transformWithState(QueueProcessor(time_mode), _TRANSITION, "Append", time_mode)


def latest(transitions: DataFrame) -> DataFrame:
    """Each row as its last transition left it; what was skipped changes nothing."""
    order = F.struct("at", F.col("event_id").isNotNull(), "event_id")
    last = F.max_by(F.struct("source_id", "status", "outcome", "error_code", "claims"), order)
    counts = [F.count_if(F.col("outcome") == o).alias(n) for o, n in (("reclaimed", "reclaims"), ("skipped", "skipped"))]
    moved = F.max_by(F.when(F.col("outcome") != "skipped", F.struct("source_id", "status", "outcome", "error_code", "claims")), F.when(F.col("outcome") != "skipped", order))
    return transitions.groupBy("queue_id").agg(F.coalesce(moved, last).alias("x"), *counts).select("queue_id", "x.*", "reclaims", "skipped")


def replay(log: DataFrame) -> DataFrame:
    """Transitions of a log that is all there: written, and run through the stream as one batch until its timers are done."""
    spark, scratch = log.sparkSession, Scratch(log.sparkSession, "queue")
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    saved = scratch.save(log.select(*(c.split(" ")[0] for c in LOG.split(", "))), "log")
    settings(spark)
    try:
        stream = queue_states(spark.readStream.schema(LOG).parquet(saved.scratch_path))  # type: ignore[attr-defined]
        path = scratch.path("transitions")
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", scratch.path("checkpoint")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(_TRANSITION).parquet(path)


_FETCH = "source_id string, at timestamp, event_id long, kind string, failures long, last_etag string, next_eligible_at timestamp"


class BackOffProcessor(_Timed):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.source = handle.getValueState("source", "failures long, last_etag string, until long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        failures, etag, until = self.source.get() if self.source.exists() else (0, None, None)
        armed = until
        for e in sorted(rows, key=lambda r: (r.ts, r.event_id)):
            failed = e.outcome in ("error", "timeout")
            failures = failures + 1 if failed else 0
            etag = e.etag if e.etag is not None else etag
            rests = failed and failures >= FAILURES
            until = self._now(e.ts, timerValues) + REST_MS if rests else None
            yield Row(source_id=key[0], at=e.ts, event_id=e.event_id, kind="fetch", failures=failures, last_etag=etag, next_eligible_at=e.ts + dt.timedelta(milliseconds=REST_MS) if rests else None)
        self.source.update((failures, etag, until))
        self._rearm(self.handle, armed, until)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        failures, etag, until = self.source.get() if self.source.exists() else (0, None, None)
        if until is not None and expiredTimerInfo.getExpiryTimeInMs() == until:
            self.source.update((failures, etag, None))
            yield Row(source_id=key[0], at=_EPOCH + dt.timedelta(milliseconds=until), event_id=None, kind="eligible", failures=failures, last_etag=etag, next_eligible_at=None)


def back_off(log: DataFrame, time_mode: str = "EventTime", late: str = "0 seconds") -> DataFrame:
    """``log(source_id, ts timestamp, event_id, outcome, etag)`` as a stream: each fetch with the state after it, and an ``eligible`` row when a rest ends without another fetch."""
    stamped = log.withWatermark("ts", late) if time_mode.lower() == "eventtime" else log
    return stamped.groupBy("source_id").transformWithState(BackOffProcessor(time_mode), _FETCH, "Append", time_mode)
