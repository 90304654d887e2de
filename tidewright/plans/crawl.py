from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import crawl as C
from ..sources.tables import Tables
from ..streaming import queue as Q
from .views import sql

_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _at(text: str):  # noqa: ANN202
    return F.lit(dt.datetime.fromisoformat(text)).cast("timestamp_ntz")


def _failures(s, d):  # noqa: ANN001, ANN202
    x = C.failure_state(Tables(s, d).crawl_log())
    return x.select("source_id", "event_id", F.col("failures").cast("long").alias("failures"), "last_etag", F.date_format("next_eligible_at", _FMT).alias("next_eligible_at"))


def _registered(t: Tables):  # noqa: ANN202
    return t.crawl_log().select("source_id").distinct().unionByName(t.source_policy().select("source_id"))


def _eligible(s, d):  # noqa: ANN001, ANN202
    t = Tables(s, d)
    return C.eligible(_registered(t), C.latest_state(t.crawl_log().filter(F.col("ts") < _at("2024-01-20"))), _at("2024-01-20")).withColumn("last_polled_at", F.date_format("last_polled_at", _FMT))


def _upsert(s, d):  # noqa: ANN001, ANN202
    log = Tables(s, d).crawl_log()
    old, new = C.latest_state(log.filter(F.col("ts") < _at("2024-01-10"))), C.latest_state(log.filter(F.col("ts") >= _at("2024-01-28")))
    return C.upsert_state(old, new).withColumn("last_polled_at", F.date_format("last_polled_at", _FMT))


def _keep_last(s, d):  # noqa: ANN001, ANN202
    return C.keep_last(Tables(s, d).crawl_log().select("source_id", "event_id", "outcome"), "source_id", "event_id")


def _enqueue(s, d):  # noqa: ANN001, ANN202
    q = Tables(s, d).queue()
    items = q.select((F.col("queue_id") % 3).alias("run"), "source_id", F.regexp_replace("url", r"[?#].*", "").alias("url"), F.col("queue_id").alias("position"))
    active = q.filter("status in ('pending', 'processing')").select("source_id", F.regexp_replace("url", r"[?#].*", "").alias("url"))
    return C.enqueue(items, active, 20).select("run", "source_id", "url", "position", F.col("nth").cast("long").alias("nth"))


def _claim(s, d):  # noqa: ANN001, ANN202
    return C.claim(Tables(s, d).queue(), 100).select("queue_id", "source_id", "url")


def _outcomes(t: Tables):  # noqa: ANN202
    i = F.col("queue_id")
    q = t.queue().withColumns({"content_hash": F.sha2(F.coalesce("html", F.lit("")), 256), "http_status": F.when(i % 9 == 4, 404).otherwise(200), "body": F.when(i % 16 == 8, "").otherwise(F.col("html"))})
    known = q.filter("url like '%?%'").select("content_hash")
    return C.process(q, t.source_policy(), known, _at("2024-01-01T12:00:00"))


def _replayed(s, d):  # noqa: ANN001, ANN202
    """A log in which workers claim, keep, lose and finish rows, through the stream."""
    t, i = Tables(s, d), F.col("queue_id")
    q = t.queue().join(t.source_policy().select("source_id", "archive_policy"), "source_id", "left")
    status, failure = F.when(i % 9 == 4, 404).otherwise(200), F.when(i % 23 == 5, "refused")
    size = F.when(i % 16 == 8, 0).otherwise(F.length("html"))
    code = Q.error_code(F.col("archive_policy"), failure, status, size, i % 19 == 2)

    def event(k, kind, minutes, worker=None, when=None):  # noqa: ANN001, ANN202
        e = F.struct(F.lit(k).alias("k"), F.lit(kind).alias("kind"), F.lit(minutes).cast("int").alias("m") if isinstance(minutes, int) else minutes.alias("m"), F.lit(worker).cast("string").alias("worker"))
        return e if when is None else F.when(when, e)

    events = F.array(
        event(0, "discovered", 0), event(1, "claimed", 10, "a", i % 7 != 0), event(2, "heartbeat", 50, "a", i % 3 == 0), event(3, "fetched", F.when(i % 5 < 3, 30).otherwise(100), "a"),
        event(4, "claimed", 115, "b", i % 2 == 0), event(5, "fetched", 120, "b", i % 2 == 0),
    )
    start = F.coalesce(F.col("discovered_at").cast("timestamp"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp"))
    rows = q.select("queue_id", "source_id", start.alias("t0"), code.alias("error_code"), (i % 6 == 1).alias("known"), F.explode(F.array_compact(events)).alias("e"))
    log = rows.select("queue_id", "source_id", (F.col("t0") + F.make_dt_interval(mins=F.col("e.m"))).alias("at"), (i * 10 + F.col("e.k")).alias("event_id"), "e.kind", "e.worker", F.when(F.col("e.kind") == "fetched", F.col("error_code")).alias("error_code"), "known")
    return Q.latest(Q.replay(log)).select("queue_id", "source_id", "status", "outcome", "error_code", "claims", "reclaims", "skipped")


def _visits(t: Tables):  # noqa: ANN202
    e = t.base("events")
    kind = F.element_at(F.array(*map(F.lit, ("news", "data", "other"))), (F.col("user_id") % 3 + 1).cast("int"))
    return e.select(F.concat(F.lit("src"), F.col("user_id") % 20).alias("source_id"), F.concat(F.lit("/p"), F.col("user_id")).alias("url"), F.col("ts").alias("at"), F.col("event_id").alias("id"), F.when(F.col("value") < 20, "h1").otherwise("h2").alias("hash"), kind.alias("kind"), (F.col("event_type") == "error").alias("failed"))


def _cache(s, d):  # noqa: ANN001, ANN202
    items = Tables(s, d).base("events").select("event_id", F.col("ts").alias("fetched_at"), (F.col("user_id") % 300).alias("ttl_hours"))
    return C.raw_cache_expiry(items, _at("2024-01-15")).select("event_id", "ttl_hours", "expired")


def _known(s, d):  # noqa: ANN001, ANN202
    q = Tables(s, d).queue()
    return C.known_candidates(q.select("queue_id", F.regexp_replace("url", "^https?://(m[.]|blog[.])?", "").alias("url")), q.filter("status = 'done'").select(F.regexp_replace("url", "^https?://", "").alias("url"))).select("queue_id", "already_known")


def _lru(s, d):  # noqa: ANN001, ANN202
    e = Tables(s, d).base("events")
    items = e.groupBy(F.concat(F.lit("rcache_"), "user_id").alias("item"), (F.col("user_id") * 3 % 300).alias("ttl")).agg(F.min("ts").alias("fetched_at")).select("item", "fetched_at", F.when(F.col("ttl") > 20, F.col("ttl")).alias("ttl_hours"))
    reads = e.filter("event_type = 'purchase'").select(F.concat(F.lit("rcache_"), "user_id").alias("item"), F.col("ts").alias("at"))
    return C.raw_cache_eviction(items, reads, _at("2024-01-06")).withColumn("last_accessed_at", F.date_format("last_accessed_at", _FMT))


def _fetches(s, d):  # noqa: ANN001, ANN202
    i = F.col("page_id")
    at = lambda k: F.concat(F.when(k % 29 == 3, "http://h").otherwise("https://h"), (k % 40).cast("string"), F.lit(".example/p"), k.cast("string"))
    p = Tables(s, d).base("pages")
    size = F.octet_length(F.coalesce("html", F.lit(""))).cast("long")
    kind = F.element_at(F.array(*map(F.lit, ("html", "html", "unknown", "json", "executable"))), (i % 5 + 1).cast("int"))
    responses = p.select(
        at(i).alias("url"),
        F.when(i % 3 == 1, 301).when(i % 31 == 0, None).when(i % 31 == 6, 304).otherwise(200).alias("status"),
        F.when(i % 43 == 1, None).when(i % 2 == 0, at(i + 1)).when(i % 4 == 1, at(i + 3)).otherwise(F.concat(F.lit("/p"), (i + 40).cast("string"))).alias("location"),
        F.when(i % 4 == 0, size).when(i % 4 == 1, F.floor(size / 200) + 1).alias("content_length"),
        (i % 4 == 1).alias("encoded"),
        size.alias("bytes"),
        F.when(i % 7 == 0, "json").otherwise("html").alias("declared"),
        kind.alias("kind"),
        (i % 37 == 5).alias("private_address"),
        (i % 41 == 8).alias("disallowed"),
    )
    return C.fetched(p.select(i.alias("id"), F.when(i % 47 == 9, "not a url").otherwise(at(i)).alias("url")), responses, 20_000)


def _robots_cache(s, d):  # noqa: ANN001, ANN202
    e = Tables(s, d).base("events")
    return C.robots_cache(e.select((F.col("user_id") % 4).alias("worker"), F.col("event_id").alias("seq"), F.col("ts").alias("at"), F.concat(F.lit("https://h"), F.col("user_id"), F.lit(".example::bot")).alias("key"), (F.col("event_type") == "error").alias("failed")))


def _slots(s, d):  # noqa: ANN001, ANN202
    e = Tables(s, d).base("events")
    log = e.select((F.col("user_id") % 10).alias("pool"), F.col("event_id").alias("id"), F.concat(F.lit("h"), F.col("user_id")).alias("host"), F.col("ts").alias("began"), F.when(F.col("event_type") != "error", F.col("ts") + F.make_dt_interval(hours=F.floor("value").cast("int") % 40 + 1)).otherwise(F.col("ts") + F.expr("INTERVAL 90 HOURS")).alias("ended"))
    return C.slots_in_use(log, 2, 8)


def _polls(s, d):  # noqa: ANN001, ANN202
    i = F.col("event_id")
    fetches = Tables(s, d).base("events").select(i.alias("source_id"), F.when(i % 7 == 0, 304).when(i % 7 == 1, 503).when(i % 7 == 2, 300).when(i % 7 == 3, None).otherwise(200).alias("http_status"), F.when(F.col("event_type") == "error", F.when(F.col("value") > 20, "timeout").otherwise("refused")).alias("failure"))
    results, recorded = C.poll_results(fetches)
    return results.select("source_id", "outcome").join(recorded.select("source_id", F.lit(True).alias("r")), "source_id", "left").select("source_id", "outcome", F.coalesce("r", F.lit(False)).alias("recorded"))


QUERIES = {
    "raw_cache_lru": _lru,
    "fetch_verdicts": _fetches,
    "robots_cache": _robots_cache,
    "pool_slots": _slots,
    "poll_results": _polls,
    "crawl_failures_backoff": _failures,
    "eligible_sources": _eligible,
    "crawl_state_upsert": _upsert,
    "keep_last_source": _keep_last,
    "enqueue_dedup_capped": _enqueue,
    "claim_batch": _claim,
    "pending_by_source": lambda s, d: C.pending_by_source(Tables(s, d).queue(), _at("2024-01-01T12:00:00")),
    "queue_replay": _replayed,
    "queue_outcomes": lambda s, d: _outcomes(Tables(s, d)),
    "queue_outcome_counts": lambda s, d: C.outcome_counts(_outcomes(Tables(s, d))),
    "revisit_schedule": lambda s, d: C.revisit(_visits(Tables(s, d))).select("id", "changed", F.col("streak").cast("long").alias("streak"), "revisit_hours"),
    "fetch_state_counters": lambda s, d: C.fetch_counters(_visits(Tables(s, d))),
    "raw_cache_expiry": _cache,
    "known_candidates": _known,
}

_STATE = """isl AS (SELECT *, outcome = 'error' AS failed, sum((outcome <> 'error')::INT) OVER (PARTITION BY source_id ORDER BY ts, event_id) AS k FROM log),
    st AS (SELECT *, sum(failed::INT) OVER (PARTITION BY source_id, k ORDER BY ts, event_id)::BIGINT AS failures, last_value(etag IGNORE NULLS) OVER (PARTITION BY source_id ORDER BY ts, event_id) AS last_etag FROM isl),
    sx AS (SELECT *, CASE WHEN failed AND failures >= 5 THEN ts + INTERVAL 24 HOUR END AS next_eligible_at, row_number() OVER (PARTITION BY source_id ORDER BY ts DESC, event_id DESC) AS r FROM st)"""
_VISITS = """v AS (SELECT 'src' || (user_id % 20) AS source_id, '/p' || user_id AS url, ts AS seen_at, event_id AS id, CASE WHEN value < 20 THEN 'h1' ELSE 'h2' END AS hash, (['news', 'data', 'other'])[user_id % 3 + 1] AS kind, event_type = 'error' AS failed FROM events)"""
_TS = "'%Y-%m-%d %H:%M:%S.%f'"
_OUT = """q AS (SELECT *, sha256(coalesce(html, '')) AS content_hash, CASE WHEN queue_id % 9 = 4 THEN 404 ELSE 200 END AS http, CASE WHEN queue_id % 16 = 8 THEN '' ELSE html END AS body, status = 'pending' OR (status = 'processing' AND coalesce(discovered_at < TIMESTAMP '2024-01-01 11:00:00', false)) AS work FROM queue),
    e AS (SELECT q.*, CASE WHEN p.source_id IS NULL THEN 'source_not_registered' WHEN p.archive_policy = 'do_not_collect' THEN 'policy_do_not_collect' WHEN http <> 200 THEN 'fetch_failed' WHEN coalesce(length(body), 0) = 0 THEN 'empty_body' END AS err,
    content_hash IN (SELECT content_hash FROM q WHERE url LIKE '%?%') AS seen FROM q LEFT JOIN source_policy p USING (source_id)),
    oc AS (SELECT queue_id, source_id, CASE WHEN NOT work THEN 'skipped' WHEN err IS NOT NULL THEN 'error' WHEN seen THEN 'deduplicated' ELSE 'processed' END AS outcome, CASE WHEN work THEN err END AS error_code FROM e)"""
_AT = "(CASE WHEN ({0}) % 29 = 3 THEN 'http://h' ELSE 'https://h' END || (({0}) % 40) || '.example/p' || ({0}))"
SQL = {
    "raw_cache_lru": f"""WITH i AS (SELECT 'rcache_' || user_id AS item, min(ts) AS f, CASE WHEN user_id * 3 % 300 > 20 THEN user_id * 3 % 300 END AS ttl FROM events GROUP BY user_id),
        r AS (SELECT 'rcache_' || user_id AS item, max(ts) AS a FROM events WHERE event_type = 'purchase' AND ts <= TIMESTAMP '2024-01-06' GROUP BY user_id),
        j AS (SELECT item, f, greatest(f, coalesce(a, f)) AS l, least(greatest(coalesce(ttl, 168), 24), 168)::BIGINT AS ttl_hours FROM i LEFT JOIN r USING (item))
        SELECT item, ttl_hours, strftime(l, {_TS}) AS last_accessed_at, CASE WHEN f < TIMESTAMP '2024-01-06' - to_hours(ttl_hours) THEN 'age' WHEN l < TIMESTAMP '2024-01-06' - to_hours(ttl_hours) THEN 'idle' END AS evicted FROM j""",
    "fetch_verdicts": f"""WITH RECURSIVE r AS (SELECT {_AT.format("page_id")} AS url, CASE WHEN page_id % 3 = 1 THEN 301 WHEN page_id % 31 = 0 THEN NULL WHEN page_id % 31 = 6 THEN 304 ELSE 200 END AS status,
            CASE WHEN page_id % 43 = 1 THEN NULL WHEN page_id % 2 = 0 THEN {_AT.format("page_id + 1")} WHEN page_id % 4 = 1 THEN {_AT.format("page_id + 3")} ELSE regexp_extract({_AT.format("page_id")}, '^[^/]*//[^/]*') || '/p' || (page_id + 40) END AS goal,
            CASE page_id % 4 WHEN 0 THEN strlen(coalesce(html, '')) WHEN 1 THEN strlen(coalesce(html, '')) // 200 + 1 END AS declared_size, strlen(coalesce(html, '')) AS size, page_id % 4 = 1 AS enc, CASE WHEN page_id % 7 = 0 THEN 'json' ELSE 'html' END AS decl, (['html', 'html', 'unknown', 'json', 'executable'])[page_id % 5 + 1] AS kind,
            page_id % 37 = 5 AS priv, page_id % 41 = 8 AS dis FROM pages),
        w(id, place, hops) AS (SELECT page_id, CASE WHEN page_id % 47 = 9 THEN 'not a url' ELSE {_AT.format("page_id")} END, 0 FROM pages
            UNION ALL SELECT id, r.goal, hops + 1 FROM w JOIN r ON r.url = w.place WHERE hops < 3 AND (hops > 0 OR place LIKE 'https:%') AND NOT priv AND NOT dis AND status = 301 AND goal LIKE 'https:%'),
        v AS (SELECT id, place, r.status, hops, row_number() OVER (PARTITION BY id ORDER BY hops DESC) AS last, CASE WHEN place = 'not a url' THEN 'invalid_url' WHEN hops = 0 AND place NOT LIKE 'https:%' THEN 'blocked_scheme' WHEN priv THEN 'private_address' WHEN dis THEN 'robots' WHEN status IS NULL THEN 'no_response'
            WHEN status = 301 AND hops = 3 THEN 'too_many_redirects' WHEN status = 301 AND goal IS NULL THEN 'no_location' WHEN status = 301 AND place LIKE 'https:%' AND goal LIKE 'http:%' THEN 'scheme_downgrade'
            WHEN (status <> 304 AND declared_size > 20000) OR size > 20000 THEN 'body_too_large' WHEN enc AND declared_size > 0 AND size / declared_size > 100 THEN 'decompression_ratio' WHEN kind = 'executable' THEN 'executable' WHEN kind <> 'unknown' AND kind <> decl THEN 'content_type_mismatch' ELSE 'ok' END AS verdict
            FROM w LEFT JOIN r ON r.url = w.place)
        SELECT id, place AS final_url, status, hops::BIGINT AS hops, verdict FROM v WHERE last = 1""",
    "pool_slots": """WITH l AS (SELECT user_id % 10 AS pool, event_id AS id, 'h' || user_id AS host, ts AS began, ts + to_hours(CASE WHEN event_type <> 'error' THEN floor(value)::INT % 40 + 1 ELSE 90 END) AS ended FROM events),
        c AS (SELECT a.pool, a.id, a.host, count(*) FILTER (b.host = a.host) AS of_host, count(*) AS of_pool FROM l a JOIN l b ON a.pool = b.pool AND (b.began, b.id) <= (a.began, a.id) AND b.ended > a.began GROUP BY 1, 2, 3) SELECT *, of_host <= 2 AND of_pool <= 8 AS within FROM c""",
    "poll_results": """WITH p AS (SELECT event_id AS source_id, CASE WHEN event_type = 'error' AND value > 20 THEN 'timeout' WHEN event_type = 'error' OR event_id % 7 = 3 THEN 'error' WHEN event_id % 7 = 0 THEN 'not_modified' WHEN event_id % 7 IN (1, 2) THEN 'error' ELSE 'ok' END AS outcome FROM events) SELECT *, outcome <> 'ok' AS recorded FROM p""",
    "crawl_failures_backoff": sql(f"WITH log AS (SELECT * FROM crawl_log), {_STATE} SELECT source_id, event_id, failures, last_etag, strftime(next_eligible_at, {_TS}) AS next_eligible_at FROM sx"),
    "eligible_sources": sql(f"""WITH log AS (SELECT * FROM crawl_log WHERE ts < TIMESTAMP '2024-01-20'), {_STATE}, ids AS (SELECT source_id FROM crawl_log UNION SELECT source_id FROM source_policy)
        SELECT i.source_id, s.source_id IS NULL AS is_new, strftime(s.ts, {_TS}) AS last_polled_at, coalesce(s.failures, 0)::BIGINT AS failures FROM ids i LEFT JOIN (SELECT * FROM sx WHERE r = 1) s USING (source_id) WHERE next_eligible_at IS NULL OR next_eligible_at <= TIMESTAMP '2024-01-20'"""),
    "crawl_state_upsert": sql(f"""WITH o AS (SELECT source_id, max(ts) AS p, max_by(etag, (ts, event_id)) FILTER (etag IS NOT NULL) AS e FROM crawl_log WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1), n AS (SELECT source_id, max(ts) AS p, max_by(etag, (ts, event_id)) FILTER (etag IS NOT NULL) AS e FROM crawl_log WHERE ts >= TIMESTAMP '2024-01-28' GROUP BY 1)
        SELECT source_id, strftime(coalesce(n.p, o.p), {_TS}) AS last_polled_at, coalesce(n.e, o.e) AS last_etag, o.p IS NULL AS is_new FROM o FULL JOIN n USING (source_id)"""),
    "keep_last_source": sql("SELECT source_id, max(event_id) AS event_id, max_by(outcome, event_id) AS outcome FROM crawl_log GROUP BY 1"),
    "enqueue_dedup_capped": sql("""WITH a AS (SELECT DISTINCT source_id, regexp_replace(url, '[?#].*', '') AS url FROM queue WHERE status IN ('pending', 'processing')),
        f AS (SELECT queue_id % 3 AS run, source_id, regexp_replace(url, '[?#].*', '') AS url, min(queue_id) AS position FROM queue q WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.source_id = q.source_id AND a.url = regexp_replace(q.url, '[?#].*', '')) GROUP BY 1, 2, 3),
        n AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY position, source_id, url) AS nth FROM f) SELECT * FROM n WHERE nth <= 20"""),
    "claim_batch": sql("SELECT queue_id, source_id, url FROM queue WHERE status = 'pending' ORDER BY discovered_at NULLS FIRST, queue_id LIMIT 100"),
    "pending_by_source": sql("SELECT source_id, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'processing' AND discovered_at < TIMESTAMP '2024-01-01 11:00:00') AS stale, count(*) AS total FROM queue GROUP BY 1"),
    "queue_replay": sql("""WITH e AS (SELECT q.queue_id, q.source_id, queue_id % 7 <> 0 AS c, queue_id % 5 < 3 AS f30, queue_id % 3 = 0 AS hb, queue_id % 2 = 0 AS ev,
            CASE WHEN p.source_id IS NULL THEN 'source_not_found_in_graph' WHEN p.archive_policy = 'do_not_collect' THEN 'policy_do_not_collect' WHEN queue_id % 23 = 5 THEN 'runtime_error' WHEN queue_id % 9 = 4 THEN 'http_status'
                WHEN queue_id % 16 = 8 OR coalesce(length(html), 0) = 0 THEN 'empty_body' WHEN queue_id % 19 = 2 THEN 'dedup_prohibited_source' END AS err FROM queue q LEFT JOIN source_policy p USING (source_id)),
        f AS (SELECT *, c AND NOT f30 AND NOT hb AS lost, (c AND (f30 OR hb)) AS by_a FROM e), g AS (SELECT *, NOT by_a AND ev AS by_b FROM f)
        SELECT queue_id, source_id, CASE WHEN NOT by_a AND NOT by_b THEN 'pending' WHEN err IS NOT NULL THEN 'error' ELSE 'done' END AS status,
            CASE WHEN NOT by_a AND NOT by_b THEN CASE WHEN lost THEN 'reclaimed' ELSE 'pending' END WHEN err IS NOT NULL THEN 'error' WHEN queue_id % 6 = 1 THEN 'deduplicated' ELSE 'processed' END AS outcome,
            CASE WHEN by_a OR by_b THEN err END AS error_code, c::BIGINT + by_b::BIGINT AS claims, lost::BIGINT AS reclaims,
            CASE WHEN by_a THEN (hb AND f30)::BIGINT + 2 * ev::BIGINT ELSE 1 + (hb AND NOT c)::BIGINT END AS skipped FROM g"""),
    "queue_outcomes": sql(f"WITH {_OUT} SELECT * FROM oc"),
    "queue_outcome_counts": sql(f"WITH {_OUT} SELECT count(*) FILTER (outcome = 'processed') AS processed, count(*) FILTER (outcome = 'deduplicated') AS deduplicated, count(*) FILTER (outcome = 'error') AS error FROM oc"),
    "revisit_schedule": f"""WITH {_VISITS}, c AS (SELECT *, coalesce(hash <> lag(hash) OVER (PARTITION BY source_id, url ORDER BY seen_at, id), true) AS changed FROM v), i AS (SELECT *, sum(changed::INT) OVER (PARTITION BY source_id, url ORDER BY seen_at, id) AS k FROM c),
        s AS (SELECT *, row_number() OVER (PARTITION BY source_id, url, k ORDER BY seen_at, id) - 1 AS streak FROM i) SELECT id, changed, streak, CASE kind WHEN 'news' THEN CASE WHEN streak < 2 THEN 72 ELSE 168 END WHEN 'data' THEN CASE WHEN streak < 2 THEN 168 ELSE 720 END ELSE CASE WHEN streak < 2 THEN 720 ELSE 2160 END END::BIGINT AS revisit_hours FROM s""",
    "fetch_state_counters": f"""WITH {_VISITS}, l AS (SELECT *, last_value(CASE WHEN NOT failed THEN hash END IGNORE NULLS) OVER (PARTITION BY source_id, url ORDER BY seen_at, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM v)
        SELECT source_id, url, count(*) FILTER (NOT failed AND hash <> last) AS changes, count(*) FILTER (NOT failed AND hash = last) AS unchanged, count(*) FILTER (failed) AS failures FROM l GROUP BY 1, 2""",
    "raw_cache_expiry": "SELECT event_id, least(greatest(user_id % 300, 24), 168) AS ttl_hours, date_sub('microsecond', ts, TIMESTAMP '2024-01-15') >= least(greatest(user_id % 300, 24), 168) * 3600000000 AS expired FROM events",
    "known_candidates": sql("SELECT queue_id, regexp_replace(url, '^https?://(m[.]|blog[.])?', '') IN (SELECT regexp_replace(url, '^https?://', '') FROM queue WHERE status = 'done') AS already_known FROM queue"),
}
