from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import ledger as L
from ..sources.tables import Tables
from .views import sql

_PRICES = {"alpha": {"input": 1.25, "output": 10.0, "cached": 0.125}, "alpha-mini": {"input": 0.25, "output": 2.0, "cached": 0.025}, "alpha-mini-fast": {"input": 0.5, "output": 4.0}, "beta": {"input": 3.0, "output": 15.0, "cached": 0.3}}
_PRICE_SQL = "prices(alias, input, output, cached) AS (VALUES ('alpha', 1.25, 10.0, 0.125), ('alpha-mini', 0.25, 2.0, 0.025), ('alpha-mini-fast', 0.5, 4.0, NULL), ('beta', 3.0, 15.0, 0.3))"


def _models(t: Tables):  # noqa: ANN202
    names = F.array(*map(F.lit, ("alpha", "alpha-mini-2025-08-07", "alpha-mini-fast-2025", "beta-2026", "alphabet")))
    return t.run_ledger().withColumn("model", F.element_at(names, (F.col("run_id") % 5 + 1).cast("int")))


def llm_cost_variants(spark, sf_dir):  # noqa: ANN001, ANN201
    t = Tables(spark, sf_dir)
    runs = L.priced(_models(t), L.price_table(spark, _PRICES))
    return runs.select("run_id", "model", F.col("alias").alias("price_key"), L.cost_subtracting_cached().alias("cost_shared"), L.cost_separate_buckets().alias("cost_separate"))


def _calls(t: Tables):  # noqa: ANN202
    """Calls of the run ledger, many of them wrong in one way or another."""
    e, i = t.base("events"), F.col("event_id")
    kind = F.element_at(F.array(*map(F.lit, ("start", "complete", "fail"))), F.when(F.col("event_type").isin("view", "signup"), 1).when(F.col("event_type") == "error", 3).otherwise(2))
    pick = lambda values, n: F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))
    number = lambda n, odd: F.when(i % odd == 3, -1.0).when(i % odd == 5, 1.5).when(i % odd == 6, None).otherwise((n % 1000).cast("double"))
    return e.select(
        F.col("user_id").alias("run"), F.struct("ts", "event_id").alias("seq"), "event_id", kind.alias("kind"), (i % 11 - 1).alias("tier"), pick((*L.RUN_STAGES, "nap"), F.floor(i / 3)).alias("stage"),
        pick(("openai", "anthropic", "openai", "google", "openai", "acme"), F.floor(i / 2)).alias("vendor"), F.when(i % 13 == 2, " ").when(i % 13 == 4, None).otherwise(F.concat(F.lit("m"), i % 5)).alias("model_id"),
        F.when(i % 3 > 0, "why").alias("override_reason"), F.when(i % 7 == 1, "run_1").when(i % 7 < 4, F.concat(F.lit(" sess_"), i)).alias("session_id"),
        F.when(i % 17 == 3, F.lit("NaN").cast("double")).when(i % 17 == 4, F.lit("Infinity").cast("double")).when(i % 17 == 5, -0.5).when(i % 17 == 6, None).otherwise(F.round(F.col("value"), 2)).alias("cost"),
        number(i * 37, 19).alias("input_tokens"), number(i * 13, 23).alias("output_tokens"), number(i * 7, 29).alias("cached_tokens"),
    )


def _lifecycle(t: Tables):  # noqa: ANN202
    e = t.base("events")
    kind = F.element_at(F.array(*map(F.lit, ("start", "complete", "fail"))), F.when(F.col("event_type").isin("view", "signup"), 1).when(F.col("event_type") == "error", 3).otherwise(2))
    return e.select(F.col("user_id").alias("run"), F.struct("ts", "event_id").alias("seq"), "event_id", kind.alias("kind"), F.when(F.col("event_id") % 9 != 0, F.round(F.col("value") - 1, 2)).alias("cost"))


def run_terminal_violations(spark, sf_dir):  # noqa: ANN001, ANN201
    return L.transitions(_lifecycle(Tables(spark, sf_dir))).groupBy("kind", F.coalesce("error", F.lit("accepted")).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


def _quota(spark, sf_dir):  # noqa: ANN001, ANN202
    return L.weekly_quota(Tables(spark, sf_dir).run_ledger(), 700_000, 900_000, 5_000_000, 60)


def policy_learning_pattern1(spark, sf_dir):  # noqa: ANN001, ANN201
    i = Tables(spark, sf_dir).intervention().filter("status = 'resolved_ignore'").select("source_id", F.col("created_at").alias("at"), F.col("intervention_id").alias("id"))
    return L.rule_candidates(i, "source_id", 3).select("source_id", "times", F.date_format("reached_at", "yyyy-MM-dd HH:mm:ss").alias("reached_at"))


def policy_learning_pattern2(spark, sf_dir):  # noqa: ANN001, ANN201
    """Pages that were blocked, by domain; every third domain has an archive policy of its own."""
    i = F.col("queue_id")
    pick = lambda n: F.element_at(F.array(*map(F.lit, L.STRICTER)), (n % 4 + 1).cast("int"))
    q = Tables(spark, sf_dir).queue().withColumn("at", F.coalesce("discovered_at", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")))
    cases = q.filter(i % 3 > 0).select(i.alias("id"), "url", "at", pick(F.floor(i / 3)).alias("wanted"))
    domain = F.regexp_extract(F.lower(F.try_parse_url("url", F.lit("HOST"))), r"([^.]+\.[^.]+)$", 1)
    current = q.select(domain.alias("domain")).distinct().filter(F.length("domain") % 3 == 0).select("domain", pick(F.length("domain")).alias("policy"))
    return L.domain_rules(cases, current, 3).withColumn("reached_at", F.date_format("reached_at", "yyyy-MM-dd HH:mm:ss"))


def polarity_trailing_50(spark, sf_dir):  # noqa: ANN001, ANN201
    e = Tables(spark, sf_dir).base("events").filter("event_type in ('click', 'purchase', 'error')")
    e = e.select("event_id", "ts", F.when(F.col("event_type") == "error", "negative").when(F.col("value") > 30, "positive").otherwise("neutral").alias("direction"), (F.col("user_id") % 7).alias("stream"))
    return L.trailing_share(e, ("ts", "event_id"), 50, 0.4).select("event_id", "stream", "seen", F.round("share", 9).alias("share"), "skewed")


def _backfill(spark, sf_dir):  # noqa: ANN001, ANN202
    return L.backfill_bucket(Tables(spark, sf_dir).run_ledger().withColumn("bucket", F.when(F.col("stage") == "click", "backfill")), 1_500_000)


QUERIES = {
    "backfill_quota": _backfill,
    "daily_cost_total": lambda s, d: L.daily_total(Tables(s, d).run_ledger(), "2024-01-10"),
    "daily_cost_total_vendor": lambda s, d: L.daily_total(Tables(s, d).run_ledger(), "2024-01-10", "vendor1"),
    "daily_cost_breakdown": lambda s, d: L.daily_breakdown(Tables(s, d).run_ledger()),
    "weekly_quota_status": _quota,
    "run_terminal_violations": run_terminal_violations,
    "run_validation": lambda s, d: L.run_problems(_calls(Tables(s, d))).select("event_id", "kind", "problem"),
    "run_states": lambda s, d: L.run_states(_calls(Tables(s, d))),
    "llm_cost_variants": llm_cost_variants,
    "cache_hit_and_cost_kpis": lambda s, d: L.kpis(Tables(s, d).run_ledger(), Tables(s, d).claim_quote()),
    "metrics_daily": lambda s, d: L.metrics_daily(Tables(s, d).run_ledger()),
    "metric_alerts": lambda s, d: L.alerts(L.metrics_daily(Tables(s, d).run_ledger()), [("error", 0.5), ("click", 0.49), ("purchase", 0.55)]),
    "value_percentiles": lambda s, d: L.nearest_rank(Tables(s, d).base("events"), "event_type", "value", {"p50": 0.5, "p95": 0.95}),
    "policy_learning_pattern1": policy_learning_pattern1,
    "policy_learning_pattern2": policy_learning_pattern2,
    "polarity_trailing_50": polarity_trailing_50,
}

_DAILY = "strftime(completed_at, '%Y-%m-%d')"
_TOKEN = lambda n, odd: f"CASE event_id % {odd} WHEN 3 THEN -1.0 WHEN 5 THEN 1.5 WHEN 6 THEN NULL ELSE (event_id * {n} % 1000)::DOUBLE END::DOUBLE"
_CALLS = f"""c AS (SELECT user_id AS run, ts, event_id, CASE WHEN event_type IN ('view', 'signup') THEN 'start' WHEN event_type = 'error' THEN 'fail' ELSE 'complete' END AS kind, event_id % 11 - 1 AS tier,
        (['discover','extract','dossier','scenario','thesis','cite_check','publication','nap'])[event_id // 3 % 8 + 1] AS stage, (['openai','anthropic','openai','google','openai','acme'])[event_id // 2 % 6 + 1] AS vendor,
        CASE event_id % 13 WHEN 2 THEN ' ' WHEN 4 THEN NULL ELSE 'm' || (event_id % 5) END AS model_id, event_id % 3 > 0 AS why, CASE WHEN event_id % 7 = 1 THEN 'run_1' WHEN event_id % 7 < 4 THEN ' sess_' || event_id END AS session_id,
        CASE event_id % 17 WHEN 3 THEN 'NaN'::DOUBLE WHEN 4 THEN 'Infinity'::DOUBLE WHEN 5 THEN -0.5 WHEN 6 THEN NULL ELSE round(value, 2) END::DOUBLE AS cost,
        {_TOKEN(37, 19)} AS input_tokens, {_TOKEN(13, 23)} AS output_tokens, {_TOKEN(7, 29)} AS cached_tokens FROM events),
    p AS (SELECT *, CASE WHEN kind = 'start' THEN CASE WHEN tier NOT BETWEEN 0 AND 3 THEN 'invalid_tier' WHEN stage = 'nap' THEN 'invalid_stage' WHEN vendor = 'acme' THEN 'invalid_vendor' WHEN coalesce(trim(model_id), '') = '' THEN 'model_missing'
        WHEN vendor <> 'openai' AND NOT why THEN 'override_reason_missing' WHEN session_id = 'run_1' THEN 'invalid_session' END
        ELSE CASE WHEN kind = 'complete' AND cost IS NULL THEN 'cost_missing' WHEN NOT isfinite(cost) OR cost < 0 THEN 'invalid_cost' WHEN event_id % 19 IN (3, 5) THEN 'invalid_input_tokens' WHEN event_id % 23 IN (3, 5) THEN 'invalid_output_tokens'
        WHEN event_id % 29 IN (3, 5) THEN 'invalid_cached_tokens' WHEN trim(model_id) = '' THEN 'model_missing' END END AS problem FROM c)"""
SQL = {
    "run_validation": f"WITH {_CALLS} SELECT event_id, kind, problem FROM p",
    "run_states": f"""WITH {_CALLS}, s AS (SELECT * FROM p WHERE problem IS NULL AND kind = 'start' QUALIFY row_number() OVER (PARTITION BY run ORDER BY ts, event_id) = 1),
        e AS (SELECT p.* FROM p JOIN s ON s.run = p.run AND (p.ts, p.event_id) > (s.ts, s.event_id) WHERE p.problem IS NULL AND p.kind <> 'start' QUALIFY row_number() OVER (PARTITION BY p.run ORDER BY p.ts, p.event_id) = 1)
        SELECT s.run, CASE WHEN e.kind IS NULL THEN 'running' WHEN e.kind = 'complete' THEN 'completed' ELSE 'failed' END AS status, s.vendor, coalesce(e.model_id, s.model_id) AS model_id, e.cost,
        e.input_tokens::BIGINT AS input_tokens, e.output_tokens::BIGINT AS output_tokens, e.cached_tokens::BIGINT AS cached_tokens FROM s LEFT JOIN e USING (run)""",
    "backfill_quota": sql("""WITH g AS (SELECT CAST(completed_at AS DATE) AS d, coalesce(sum(cost_e4) FILTER (stage <> 'click'), 0)::BIGINT AS s, coalesce(sum(cost_e4) FILTER (stage = 'click'), 0)::BIGINT AS b FROM run_ledger WHERE cost_e4 IS NOT NULL GROUP BY 1), u AS (SELECT *, sum(b) OVER (ORDER BY d)::BIGINT AS used FROM g)
        SELECT strftime(d, '%Y-%m-%d') AS day, s / 10000 AS spent_usd, b / 10000 AS backfill_usd, greatest(1500000 - used, 0) / 10000 AS backfill_left_usd, used >= 1500000 AS backfill_stop FROM u"""),
    "daily_cost_total": sql("SELECT coalesce(sum(cost_e4), 0)::BIGINT / 10000.0::DOUBLE AS total_cost_usd FROM run_ledger WHERE completed_at >= TIMESTAMP '2024-01-10' AND completed_at < TIMESTAMP '2024-01-11'"),
    "daily_cost_total_vendor": sql("SELECT coalesce(sum(cost_e4), 0)::BIGINT / 10000.0::DOUBLE AS total_cost_usd FROM run_ledger WHERE CAST(completed_at AS DATE) = DATE '2024-01-10' AND vendor = 'vendor1'"),
    "daily_cost_breakdown": sql(f"SELECT {_DAILY} AS day, vendor, sum(cost_e4)::BIGINT / 10000.0::DOUBLE AS total_cost_usd, count(*) AS run_count FROM run_ledger WHERE cost_e4 IS NOT NULL GROUP BY 1, 2"),
    "weekly_quota_status": sql("""WITH days AS (SELECT CAST(completed_at AS DATE) AS d, sum(cost_e4)::BIGINT AS spent, count(*) FILTER (tier = 0) AS tier0_calls FROM run_ledger WHERE cost_e4 IS NOT NULL GROUP BY 1),
        w AS (SELECT *, sum(spent) OVER (ORDER BY d RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)::BIGINT AS week FROM days)
        SELECT strftime(d, '%Y-%m-%d') AS day, spent / 10000.0::DOUBLE AS spent_usd, week / 10000.0::DOUBLE AS week_usd, tier0_calls, tier0_calls > 60 AS tier0_over,
        CASE WHEN spent >= 900000 THEN 'hard_stop' WHEN week >= 5000000 THEN 'weekly_stop' WHEN spent >= 700000 THEN 'soft_warn' ELSE 'ok' END AS status FROM w"""),
    "run_terminal_violations": """WITH e AS (SELECT user_id AS run, ts, event_id, CASE WHEN event_type IN ('view', 'signup') THEN 'start' WHEN event_type = 'error' THEN 'fail' ELSE 'complete' END AS kind,
        CASE WHEN event_id % 9 <> 0 THEN round(value - 1, 2) END AS cost FROM events),
        w AS (SELECT *, coalesce(bool_or(kind <> 'start') OVER p, false) AS ended, coalesce(bool_or(kind = 'start') OVER p, false) AS started FROM e WINDOW p AS (PARTITION BY run ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT kind, CASE WHEN ended THEN 'terminal_row_changed' WHEN kind = 'start' AND started THEN 'started_twice' WHEN kind <> 'start' AND NOT started THEN 'not_started'
        WHEN kind = 'complete' AND cost IS NULL THEN 'cost_missing' WHEN cost < 0 THEN 'cost_negative' ELSE 'accepted' END AS verdict, count(*) AS n FROM w GROUP BY 1, 2""",
    "llm_cost_variants": sql(f"""WITH {_PRICE_SQL}, m AS (SELECT *, (['alpha','alpha-mini-2025-08-07','alpha-mini-fast-2025','beta-2026','alphabet'])[run_id % 5 + 1] AS model FROM run_ledger),
        k AS (SELECT m.*, p.alias, p.input::DOUBLE AS pi, p.output::DOUBLE AS po, p.cached::DOUBLE AS pc, row_number() OVER (PARTITION BY run_id ORDER BY length(p.alias) DESC NULLS LAST) AS r
        FROM m LEFT JOIN prices p ON model = p.alias OR starts_with(model, p.alias || '-'))
        SELECT run_id, model, alias AS price_key, greatest(input_tokens - cached_tokens, 0) / 1e6 * pi + cached_tokens / 1e6 * coalesce(pc, pi) + output_tokens / 1e6 * po AS cost_shared,
        input_tokens / 1e6 * pi + cached_tokens / 1e6 * coalesce(pc, pi) + creation_tokens / 1e6 * (pi * 1.25) + output_tokens / 1e6 * po AS cost_separate FROM k WHERE r = 1"""),
    "cache_hit_and_cost_kpis": sql("""SELECT l.cached / l.input AS cache_hit_rate, l.cost / 10000.0::DOUBLE / nullif(c.promoted, 0) AS cost_per_promoted, c.faithfulness
        FROM (SELECT sum(cached_tokens)::BIGINT AS cached, sum(input_tokens)::BIGINT AS input, sum(cost_e4)::BIGINT AS cost FROM run_ledger WHERE status <> 'running') l,
        (SELECT count(*) FILTER (confidence_pct >= 85 AND n % 4 = 0) AS promoted, avg(CASE WHEN contains(coalesce(text, ''), quote) THEN 1.0 ELSE 0.0 END) AS faithfulness FROM claim_quote) c"""),
    "metrics_daily": sql(f"SELECT {_DAILY} AS day, stage AS metric, sum(cost_e4)::BIGINT / count(*) / 10000.0::DOUBLE AS value, count(*) AS sample_count FROM run_ledger WHERE cost_e4 IS NOT NULL GROUP BY 1, 2"),
    "metric_alerts": sql(f"""WITH m AS (SELECT {_DAILY} AS day, stage AS metric, sum(cost_e4)::BIGINT / count(*) / 10000.0::DOUBLE AS value FROM run_ledger WHERE cost_e4 IS NOT NULL GROUP BY 1, 2),
        t(metric, threshold) AS (VALUES ('error', 0.5::DOUBLE), ('click', 0.49::DOUBLE), ('purchase', 0.55::DOUBLE)) SELECT day, metric, value, threshold FROM m JOIN t USING (metric) WHERE value > threshold"""),
    "value_percentiles": "SELECT event_type, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95 FROM events GROUP BY 1",
    "policy_learning_pattern2": sql("""WITH q AS (SELECT queue_id, lower(regexp_extract(url, '^https?://(?:[^/?#]*[.])?([^./?#:]+[.][^./?#:]+)', 1)) AS domain, coalesce(discovered_at, TIMESTAMP '2024-01-01') AS at_ FROM queue),
        c AS (SELECT domain, at_, queue_id, queue_id // 3 % 4 + 1 AS level FROM q WHERE queue_id % 3 > 0 AND domain <> ''), n AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY at_, queue_id) AS nth, count(*) OVER (PARTITION BY domain) AS times, max(level) OVER (PARTITION BY domain) AS top FROM c)
        SELECT domain, '*.' || domain AS rule, times, strftime(at_, '%Y-%m-%d %H:%M:%S') AS reached_at, (['full_snapshot_allowed','excerpt_only','metadata_only','do_not_collect'])[top] AS proposed FROM n
        WHERE nth = 3 AND top > CASE WHEN length(domain) % 3 = 0 THEN length(domain) % 4 + 1 ELSE 1 END"""),
    "policy_learning_pattern1": sql("""WITH i AS (SELECT source_id, created_at, row_number() OVER (PARTITION BY source_id ORDER BY created_at, intervention_id) AS nth, count(*) OVER (PARTITION BY source_id) AS times FROM intervention WHERE status = 'resolved_ignore')
        SELECT source_id, times, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS reached_at FROM i WHERE nth = 3"""),
    "polarity_trailing_50": """WITH e AS (SELECT event_id, ts, user_id % 7 AS stream, CASE WHEN event_type = 'error' THEN 'negative' WHEN value > 30 THEN 'positive' ELSE 'neutral' END AS direction FROM events WHERE event_type IN ('click', 'purchase', 'error')),
        w AS (SELECT event_id, stream, count(*) OVER p AS seen, greatest(count(*) FILTER (direction = 'positive') OVER p, count(*) FILTER (direction = 'negative') OVER p) AS top FROM e
        WINDOW p AS (PARTITION BY stream ORDER BY ts, event_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))
        SELECT event_id, stream, seen, round(top / seen, 9) AS share, seen = 50 AND top / seen >= 0.4 AS skewed FROM w""",
}
