"""The streaming twin of ``operators.crawl.failure_state``: one state for each source.

Rows of a source must come in order of their time within a batch and between
batches; the rest period is measured from the row's own time.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.crawl import FAILURES

OUT = "source_id string, event_id long, failures long, last_etag string, next_eligible_at timestamp"
STATE = "failures long, last_etag string"


def _step(key: tuple[str], frames: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
    failures, etag = state.get if state.exists else (0, None)
    rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
    out = []
    for row in rows.itertuples():
        failed = row.outcome in ("error", "timeout")
        failures = failures + 1 if failed else 0
        etag = row.etag if isinstance(row.etag, str) else etag
        rest = row.ts + pd.Timedelta(hours=24) if failed and failures >= FAILURES else pd.NaT
        out.append((key[0], row.event_id, failures, etag, rest))
    state.update((failures, etag))
    frame = pd.DataFrame(out, columns=["source_id", "event_id", "failures", "last_etag", "next_eligible_at"])
    frame["next_eligible_at"] = pd.to_datetime(frame["next_eligible_at"])
    yield frame


def failure_stream(log: DataFrame) -> DataFrame:
    """``log(source_id, ts timestamp, event_id, outcome, etag)`` as a stream, each fetch with its state after it."""
    return log.groupBy("source_id").applyInPandasWithState(_step, OUT, STATE, "append", "NoTimeout")


def active_only(items: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Items of ``(source_id, url, discovered_at)`` once each within the watermark: what a unique index on active rows does."""
    return items.withWatermark("discovered_at", delay).dropDuplicatesWithinWatermark(["source_id", "url"])


def windowed_counts(events: DataFrame, size: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
