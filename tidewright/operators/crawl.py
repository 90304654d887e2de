"""Crawl state, the discovery queue and its outcomes. ``now`` is always a parameter."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranges import Last, Since, scan

#: Consecutive failures after which a source rests, and for how long.
FAILURES = 5
REST = "INTERVAL 24 HOURS"


def failure_state(log: DataFrame, ranges: int | None = None) -> DataFrame:
    """Each fetch with the count of failures in a row, the last validator seen, and when the source is eligible again.

    A source of any size is scanned range by range, see :mod:`.ranges`.
    """
    failed = F.col("outcome").isin("error", "timeout")
    out = scan(log, ["source_id"], ["ts", "event_id"], {"failures": Since(~failed, failed), "last_etag": Last(F.col("etag"))}, ranges)
    rest = F.when(failed & (F.col("failures") >= FAILURES), F.col("ts") + F.expr(REST))
    return out.withColumn("next_eligible_at", rest)


def latest_state(log: DataFrame) -> DataFrame:
    """The state after the last fetch of each source."""
    s = failure_state(log)
    return s.groupBy("source_id").agg(F.max_by(F.struct("ts", "outcome", "failures", "last_etag", "next_eligible_at"), F.struct("ts", "event_id")).alias("s")).select("source_id", F.col("s.ts").alias("last_polled_at"), F.col("s.outcome").alias("last_status"), "s.failures", "s.last_etag", "s.next_eligible_at")


def upsert_state(old: DataFrame, new: DataFrame) -> DataFrame:
    """New rows over old ones; a validator that did not come again stays."""
    o = old.select("source_id", F.col("last_polled_at").alias("op"), F.col("last_etag").alias("oe"))
    n = new.select("source_id", F.col("last_polled_at").alias("np"), F.col("last_etag").alias("ne"))
    return o.join(n, "source_id", "full").select("source_id", F.coalesce("np", "op").alias("last_polled_at"), F.coalesce("ne", "oe").alias("last_etag"), F.col("op").isNull().alias("is_new"))


def eligible(ids: DataFrame, state: DataFrame, now: Column) -> DataFrame:
    """Registered sources that may be polled, those without state first, with the order they are polled in."""
    j = ids.select("source_id").distinct().join(state.withColumn("__have", F.lit(True)), "source_id", "left")
    j = j.filter(F.col("next_eligible_at").isNull() | (F.col("next_eligible_at") <= now))
    j = j.select("source_id", F.col("__have").isNull().alias("is_new"), "last_polled_at", F.coalesce("failures", F.lit(0)).cast("long").alias("failures"))
    return j.orderBy(F.col("is_new").desc(), F.col("last_polled_at").asc_nulls_first(), "source_id")


def keep_last(rows: DataFrame, key: str, position: str) -> DataFrame:
    """The last row of each key in input order; an aggregate, so that a hot key is combined before it is shuffled."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(position)).alias("r")).select(key, "r.*")


def enqueue(items: DataFrame, active: DataFrame, cap: int) -> DataFrame:
    """Items that are new for their source, once each, the first ``cap`` of each run in feed order."""
    fresh = items.join(active.select("source_id", "url").distinct(), ["source_id", "url"], "left_anti")
    first = fresh.groupBy("run", "source_id", "url").agg(F.min("position").alias("position"))
    w = Window.partitionBy("run").orderBy("position", "source_id", "url")
    return first.withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= cap)


def claim(queue: DataFrame, size: int) -> DataFrame:
    """The oldest pending rows: a bounded top, kept per partition and merged."""
    return queue.filter("status = 'pending'").orderBy("discovered_at", "queue_id").limit(size)


def pending_by_source(queue: DataFrame, now: Column, stale_after: str = "INTERVAL 1 HOUR") -> DataFrame:
    stale = (F.col("status") == "processing") & (F.col("discovered_at") < now - F.expr(stale_after))
    g = queue.groupBy("source_id").agg(F.count_if(F.col("status") == "pending").alias("pending"), F.count_if(stale).alias("stale"), F.count(F.lit(1)).alias("total"))
    return g.orderBy(F.desc("pending"), "source_id")


def process(queue: DataFrame, policies: DataFrame, known: DataFrame, now: Column) -> DataFrame:
    """What a pass makes of each row: stuck rows return to pending first, then rules in their order.

    ``known`` has the content hashes that are stored already.
    """
    reclaimed = (F.col("status") == "processing") & (F.col("discovered_at") < now - F.expr("INTERVAL 1 HOUR"))
    due = queue.withColumn("work", (F.col("status") == "pending") | reclaimed).join(policies.select("source_id", "archive_policy"), "source_id", "left")
    due = due.join(known.select("content_hash").distinct().withColumn("__seen", F.lit(True)), "content_hash", "left")
    error = (
        F.when(F.col("archive_policy").isNull(), "source_not_registered")
        .when(F.col("archive_policy") == "do_not_collect", "policy_do_not_collect")
        .when((F.col("http_status") < 200) | (F.col("http_status") > 299), "fetch_failed")
        .when(F.coalesce(F.length("body"), F.lit(0)) == 0, "empty_body")
    )
    outcome = F.when(~F.col("work"), "skipped").when(error.isNotNull(), "error").when(F.col("__seen"), "deduplicated").otherwise("processed")
    return due.select("queue_id", "source_id", outcome.alias("outcome"), F.when(F.col("work"), error).alias("error_code"))


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """Skipped rows are not counted."""
    return outcomes.agg(*(F.count_if(F.col("outcome") == o).alias(o) for o in ("processed", "deduplicated", "error")))


def revisit(seen: DataFrame, ranges: int | None = None) -> DataFrame:
    """When a page is due again: by content type, sooner after a change, later after each two unchanged visits."""
    keys, order = ["source_id", "url"], ["at", "id"]
    visits = seen.withColumn("__one", F.struct("hash"))  # of a visit before, also if its hash is null
    changed = F.coalesce(F.col("hash") != F.col("__before.hash"), F.lit(True))
    out = scan(visits, keys, order, {"__before": Last(F.col("__one"), before=True)}, ranges).withColumn("changed", changed).drop("__one", "__before")
    out = scan(out, keys, order, {"streak": Since(F.col("changed"), F.lit(True))}, ranges).withColumn("streak", F.col("streak") - 1)
    hours = F.when(F.col("kind") == "news", F.when(F.col("streak") < 2, 72).otherwise(168)).when(F.col("kind") == "data", F.when(F.col("streak") < 2, 168).otherwise(720)).otherwise(F.when(F.col("streak") < 2, 720).otherwise(2160))
    return out.withColumn("revisit_hours", hours.cast("long"))


def fetch_counters(seen: DataFrame, ranges: int | None = None) -> DataFrame:
    """Changes, unchanged visits and failures of each page."""
    ok = ~F.col("failed")
    s = scan(seen, ["source_id", "url"], ["at", "id"], {"__last": Last(F.when(ok, F.col("hash")), before=True)}, ranges)
    return s.groupBy("source_id", "url").agg(
        F.count_if(ok & F.col("__last").isNotNull() & (F.col("hash") != F.col("__last"))).alias("changes"),
        F.count_if(ok & (F.col("hash") == F.col("__last"))).alias("unchanged"),
        F.count_if(F.col("failed")).alias("failures"),
    )


def raw_cache_expiry(items: DataFrame, now: Column) -> DataFrame:
    """A requested time to live is kept between a day and a week; what is older goes."""
    ttl = F.least(F.greatest(F.col("ttl_hours"), F.lit(24)), F.lit(168))
    out = items.withColumn("ttl_hours", ttl.cast("long"))
    return out.withColumn("expired", F.timestamp_diff("HOUR", F.col("fetched_at"), now) >= F.col("ttl_hours"))


def raw_cache_eviction(items: DataFrame, reads: DataFrame, now: Column) -> DataFrame:
    """Why an item of the raw cache goes: its age, or as long without being read (least recently used), if it does.

    ``items(item, fetched_at, ttl_hours)``: the time to live is kept between a day and a
    week, a null one is a week; ``reads(item, at)``: the last one up to ``now`` counts,
    else the fetch.
    """
    last = reads.filter(F.col("at") <= now).groupBy("item").agg(F.max("at").alias("read_at"))
    ttl = F.least(F.greatest(F.coalesce("ttl_hours", F.lit(168)), F.lit(24)), F.lit(168))
    limit = now - F.make_dt_interval(hours=ttl)
    out = items.join(last, "item", "left").withColumn("last_accessed_at", F.greatest("fetched_at", F.coalesce("read_at", "fetched_at")))
    why = F.when(F.col("fetched_at") < limit, "age").when(F.col("last_accessed_at") < limit, "idle")
    return out.select("item", ttl.cast("long").alias("ttl_hours"), "last_accessed_at", why.alias("evicted"))


# ---- fetching, over recorded responses and requests -------------------------

#: Redirects followed, and how often a body may be larger than what was sent.
MOST_HOPS, MOST_RATIO = 3, 100
REDIRECTS = (301, 302, 303, 307, 308)


def _step(urls: DataFrame, responses: DataFrame, hops: int, most_bytes: int, hosts: tuple[str, ...] | None) -> DataFrame:
    """What a fetch of each ``(id, at, blocked)`` gives: a verdict, or the next place."""
    r = responses.select(F.col("url").alias("at"), *(c for c in responses.columns if c != "url"))
    j = urls.join(r, "at", "left")
    scheme, status = F.try_parse_url("at", F.lit("PROTOCOL")), F.col("status")
    redirect = F.coalesce(status.isin(*REDIRECTS), F.lit(False))
    target = F.when(F.col("location").rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.col("location"))
    target = target.when(F.col("location").startswith("//"), F.concat(scheme, F.lit(":"), "location"))
    target = target.when(F.col("location").startswith("/"), F.concat(scheme, F.lit("://"), F.try_parse_url("at", F.lit("AUTHORITY")), "location"))
    target = target.otherwise(F.concat(F.regexp_replace(F.regexp_replace("at", r"[?#].*$", ""), r"(?<=[^/])/[^/]*$", ""), F.lit("/"), "location"))
    known = F.col("bytes").cast("double")
    too_large = (status != 304) & F.coalesce(F.col("content_length") > most_bytes, F.lit(False)) | F.coalesce(known > most_bytes, F.lit(False))
    bomb = F.coalesce(F.col("encoded") & (F.col("content_length") > 0) & (known / F.col("content_length") > MOST_RATIO), F.lit(False))
    host = F.try_parse_url("at", F.lit("HOST"))
    outside = ~F.coalesce(host.isin(*hosts), F.lit(False)) if hosts is not None else F.lit(False)
    verdict = (
        F.when(F.col("blocked").isNotNull(), F.col("blocked"))
        .when(host.isNull(), "invalid_url")
        .when(~F.coalesce(scheme == "https", F.lit(False)) & (hops == 0), "blocked_scheme")
        .when(outside, "host_not_allowed")
        .when(F.coalesce(F.col("private_address"), F.lit(False)), "private_address")
        .when(F.coalesce(F.col("disallowed"), F.lit(False)), "robots")
        .when(status.isNull(), "no_response")
        .when(redirect & F.lit(hops >= MOST_HOPS), "too_many_redirects")
        .when(redirect & F.col("location").isNull(), "no_location")
        .when(redirect & F.coalesce((scheme == "https") & F.lower(target).startswith("http:"), F.lit(False)), "scheme_downgrade")
        .when(redirect & ~F.coalesce(F.lower(target).startswith("https:"), F.lit(False)), "blocked_scheme")
        .when(redirect, F.lit(None))
        .when(too_large, "body_too_large")
        .when(bomb, "decompression_ratio")
        .when(F.coalesce(F.col("kind") == "executable", F.lit(False)), "executable")
        .when(F.coalesce((F.col("declared") != "unknown") & (F.col("kind") != "unknown") & (F.col("declared") != F.col("kind")), F.lit(False)), "content_type_mismatch")
        .otherwise("ok")
    )
    return j.select("id", "at", verdict.alias("verdict"), target.alias("next"), status.alias("status"))


def fetched(requests: DataFrame, responses: DataFrame, most_bytes: int, hosts: tuple[str, ...] | None = None) -> DataFrame:
    """What the safe fetcher makes of recorded responses: ``id, final_url, status, hops, verdict``.

    ``requests(id, url)``; ``responses`` has one row a URL: ``url, status, location,
    content_length, encoded, bytes, declared, kind, private_address, disallowed``.
    Checks come in the order of the fetcher, and again at each redirect: address,
    scheme, host list, private address, robots, at most :data:`MOST_HOPS` redirects
    and none to a plainer scheme, size declared and read, how much it grew when
    unpacked, what it is and was said to be.
    """
    open_ = requests.select("id", F.col("url").alias("at"), F.lit(None).cast("string").alias("blocked"))
    out = None
    for hops in range(MOST_HOPS + 1):
        step = _step(open_, responses, hops, most_bytes, hosts)
        done = step.filter("verdict is not null").select("id", F.col("at").alias("final_url"), "status", F.lit(hops).cast("long").alias("hops"), "verdict")
        out = done if out is None else out.unionByName(done)
        open_ = step.filter("verdict is null").select("id", F.col("next").alias("at"), F.lit(None).cast("string").alias("blocked"))
    return out


def robots_cache(requests: DataFrame, size: int = 1000, ttl_seconds: int = 24 * 3600, ttl_failed_seconds: int = 300) -> DataFrame:
    """``worker, seq, key, hit`` for ``requests(worker, seq, at, key, failed)``: whether the site's rules were in the worker's cache.

    Entries go first in, first out beyond ``size`` and are stale after their time to
    live, which is short where the file could not be had. What a cache holds depends on
    each earlier request in turn, so that a worker's requests are folded in order, in
    Arrow batches; the caches of different workers are independent, and the state of
    one has ``size`` entries.
    """
    import pandas as pd

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        owner, cache = object(), OrderedDict[str, int]()
        for part in parts:
            hits = []
            for worker, name, at, failed in zip(part["worker"], part["key"], part["micros"], part["failed"], strict=True):
                if worker != owner:  # sorted: its rows come together
                    owner = worker
                    cache.clear()
                hits.append(cache.get(name, at) > at)
                if not hits[-1]:
                    if len(cache) >= size:
                        cache.popitem(last=False)
                    cache[name] = at + 1_000_000 * (ttl_failed_seconds if failed else ttl_seconds)
            yield part[["worker", "seq", "key"]].assign(hit=hits)

    dealt = requests.select("worker", "seq", F.unix_micros(F.col("at").cast("timestamp")).alias("micros"), "key", "failed").repartition("worker").sortWithinPartitions("worker", "seq")
    return dealt.mapInPandas(run, "worker long, seq long, key string, hit boolean")


def slots_in_use(log: DataFrame, per_host: int = 1, overall: int = 8) -> DataFrame:
    """Adds to ``log(pool, id, host, began, ended)`` how many fetches of the host and of the pool ran when each began, itself included, and whether that kept the limits.

    A running sum over beginnings and ends, ends first; a null end has not ended.
    """
    edge = lambda at, step: log.select("pool", "host", "id", F.col(at).alias("at"), F.lit(step).alias("step"))
    edges = edge("began", 1).unionByName(edge("ended", -1).filter("at is not null"))
    running = lambda *by: F.sum("step").over(Window.partitionBy(*by).orderBy("at", "step", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = edges.withColumns({"of_host": running("pool", "host"), "of_pool": running("pool")}).filter("step = 1")
    return out.select("pool", "id", "host", "of_host", "of_pool", ((F.col("of_host") <= per_host) & (F.col("of_pool") <= overall)).alias("within"))


def poll_results(fetches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two phases: what all fetches ``(source_id, http_status, failure)`` came to, and of these the outcomes to record at once.

    304 is ``not_modified``; another status from 300 on is an error, a failure a timeout
    or an error. ``ok`` is not recorded here: its content has to be read first, and an
    error found then must meet the failures counted so far.
    """
    status = (
        F.when(F.col("failure") == "timeout", "timeout")
        .when(F.col("failure").isNotNull() | F.col("http_status").isNull(), "error")
        .when(F.col("http_status") == 304, "not_modified")
        .when(F.col("http_status") >= 300, "error")
        .otherwise("ok")
    )
    results = fetches.withColumn("outcome", status)
    return results, results.filter("outcome <> 'ok'")


def known_candidates(candidates: DataFrame, documents: DataFrame) -> DataFrame:
    return candidates.join(documents.select("url").distinct().withColumn("__k", F.lit(True)), "url", "left").withColumn("already_known", F.col("__k").isNotNull()).drop("__k")
