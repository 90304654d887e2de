"""Run ledger: costs, quotas, lifecycles and key figures.

Money is summed as integers of 1e-4 and shown as doubles, so that a sum does not
depend on the order of its rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .ranges import Since, ranked, scan


def usd(units: Column) -> Column:
    return units.cast("double") / 10_000.0


def day_of(ts: str = "completed_at") -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def billable(ledger: DataFrame, day: str, vendor: str | None = None) -> DataFrame:
    """Runs of a UTC day with a cost, failed ones too; the half-open range reaches the scan."""
    start = dt.date.fromisoformat(day)
    end = start + dt.timedelta(days=1)
    out = ledger.filter((F.col("completed_at") >= F.lit(dt.datetime.combine(start, dt.time())).cast("timestamp_ntz")) & (F.col("completed_at") < F.lit(dt.datetime.combine(end, dt.time())).cast("timestamp_ntz")) & F.col("cost_e4").isNotNull())
    return out if vendor is None else out.filter(F.col("vendor") == vendor)


def daily_total(ledger: DataFrame, day: str, vendor: str | None = None) -> DataFrame:
    """One row; 0 on a day without costs."""
    return billable(ledger, day, vendor).agg(usd(F.coalesce(F.sum("cost_e4"), F.lit(0))).alias("total_cost_usd"))


def daily_breakdown(ledger: DataFrame) -> DataFrame:
    return ledger.filter("cost_e4 is not null").groupBy(day_of().alias("day"), "vendor").agg(usd(F.sum("cost_e4")).alias("total_cost_usd"), F.count(F.lit(1)).alias("run_count"))


def weekly_quota(ledger: DataFrame, soft: int, hard: int, weekly: int, top_calls: int) -> DataFrame:
    """Spend by day against a soft, a hard and a trailing seven-day ceiling (in 1e-4), and calls of tier 0 a day."""
    days = ledger.filter("cost_e4 is not null").groupBy(F.to_date("completed_at").alias("d")).agg(F.sum("cost_e4").alias("spent"), F.count_if(F.col("tier") == 0).alias("tier0_calls"))
    number = F.datediff("d", F.lit("1970-01-01"))
    # One row a day: the single partition of this window is bounded by the calendar.
    week = Window.orderBy("number").rangeBetween(-6, 0)
    days = days.withColumn("number", number).withColumn("week", F.sum("spent").over(week))
    status = F.when(F.col("spent") >= hard, "hard_stop").when(F.col("week") >= weekly, "weekly_stop").when(F.col("spent") >= soft, "soft_warn").otherwise("ok")
    return days.select(F.date_format("d", "yyyy-MM-dd").alias("day"), usd(F.col("spent")).alias("spent_usd"), usd(F.col("week")).alias("week_usd"), "tier0_calls", (F.col("tier0_calls") > top_calls).alias("tier0_over"), status.alias("status"))


def backfill_bucket(ledger: DataFrame, cap: int) -> DataFrame:
    """Spend (in 1e-4) by day in the usual budget and in the bucket of its own that backfill runs have, with what the bucket has left.

    ``ledger(completed_at, bucket, cost_e4)``; the cap holds for all days together.
    """
    own = F.coalesce(F.col("bucket") == "backfill", F.lit(False))
    days = ledger.filter("cost_e4 is not null").groupBy(F.to_date("completed_at").alias("d")).agg(F.coalesce(F.sum(F.when(~own, F.col("cost_e4"))), F.lit(0)).alias("spent"), F.coalesce(F.sum(F.when(own, F.col("cost_e4"))), F.lit(0)).alias("backfill"))
    # One row a day: the single partition of this window is bounded by the calendar.
    used = F.sum("backfill").over(Window.orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    days = days.withColumn("used", used)
    return days.select(F.date_format("d", "yyyy-MM-dd").alias("day"), usd(F.col("spent")).alias("spent_usd"), usd(F.col("backfill")).alias("backfill_usd"), usd(F.greatest(F.lit(cap) - F.col("used"), F.lit(0))).alias("backfill_left_usd"), (F.col("used") >= cap).alias("backfill_stop"))


def transitions(events: DataFrame) -> DataFrame:
    """Lifecycle events ``(run, seq, kind, cost)`` folded to the rule each one breaks, if any.

    A run starts once; only a running one completes (with a cost) or fails; what has
    ended stays as it is.
    """
    order = Window.partitionBy("run").orderBy("seq")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ended = F.coalesce(F.max(F.col("kind").isin("complete", "fail").cast("int")).over(before), F.lit(0)) == 1
    started = F.coalesce(F.max((F.col("kind") == "start").cast("int")).over(before), F.lit(0)) == 1
    error = (
        F.when(ended, "terminal_row_changed")
        .when((F.col("kind") == "start") & started, "started_twice")
        .when((F.col("kind") != "start") & ~started, "not_started")
        .when((F.col("kind") == "complete") & F.col("cost").isNull(), "cost_missing")
        .when(F.col("cost") < 0, "cost_negative")
    )
    return events.withColumn("error", error)


# What a run can say of itself.
RUN_STAGES = ("discover", "extract", "dossier", "scenario", "thesis", "cite_check", "publication")
RUN_VENDORS = ("openai", "anthropic", "google")
TOKENS = ("input_tokens", "output_tokens", "cached_tokens")


def run_problems(calls: DataFrame) -> DataFrame:
    """Adds ``problem``: the first rule that a call of the run ledger breaks by itself, or null.

    ``calls(kind, tier, stage, vendor, model_id, override_reason, session_id, cost double, input_tokens double,
    output_tokens double, cached_tokens double)``. A start is judged by what it names; a completion must, a failure may, say a finite
    cost, whole numbers of tokens and a model.
    """
    start = F.col("kind") == "start"
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    said = lambda c: F.col(c).isNotNull()
    endless = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
    problem = (
        F.when(start & ~F.coalesce(F.col("tier").between(0, 3), F.lit(False)), "invalid_tier")
        .when(start & ~F.coalesce(F.col("stage").isin(*RUN_STAGES), F.lit(False)), "invalid_stage")
        .when(start & ~F.coalesce(F.col("vendor").isin(*RUN_VENDORS), F.lit(False)), "invalid_vendor")
        .when(start & blank("model_id"), "model_missing")
        .when(start & (F.col("vendor") != RUN_VENDORS[0]) & blank("override_reason"), "override_reason_missing")
        .when(start & said("session_id") & ~F.startswith(F.trim("session_id"), F.lit("sess_")), "invalid_session")
        .when((F.col("kind") == "complete") & ~said("cost"), "cost_missing")
        .when(~start & said("cost") & (endless("cost") | (F.col("cost") < 0)), "invalid_cost")
    )
    for c in TOKENS:
        problem = problem.when(~start & said(c) & (endless(c) | (F.col(c) < 0) | (F.col(c) != F.floor(c))), f"invalid_{c}")
    return calls.withColumn("problem", problem.when(~start & said("model_id") & blank("model_id"), "model_missing"))


def run_states(calls: DataFrame) -> DataFrame:
    """Each run after its sound calls ``(run, seq, …)``: its first start, then the first end after that; the end's model replaces the start's."""
    sound = run_problems(calls).filter("problem is null")
    rest = ("vendor", "model_id", "cost", *TOKENS)
    started = sound.filter("kind = 'start'").groupBy("run").agg(F.min_by(F.struct("seq", *rest), "seq").alias("s"))
    ended = sound.filter("kind <> 'start'").join(started.select("run", F.col("s.seq").alias("__from")), "run").filter(F.col("seq") > F.col("__from"))
    end = ended.groupBy("run").agg(F.min_by(F.struct("kind", *rest), "seq").alias("e"))
    status = F.when(F.col("e").isNull(), "running").when(F.col("e.kind") == "complete", "completed").otherwise("failed")
    return started.join(end, "run", "left").select("run", status.alias("status"), "s.vendor", F.coalesce("e.model_id", "s.model_id").alias("model_id"), "e.cost", *(F.col(f"e.{c}").cast("long").alias(c) for c in TOKENS))


def price_table(spark: SparkSession, prices: Mapping[str, Mapping[str, float | None]]) -> DataFrame:
    """``alias, input, output, cached, creation`` in USD per million tokens."""
    number = lambda x: None if x is None else float(x)
    rows = [(a, *(number(p.get(k)) for k in ("input", "output", "cached", "creation"))) for a, p in prices.items()]
    return spark.createDataFrame(rows, "alias string, input double, output double, cached double, creation double")


def priced(runs: DataFrame, prices: DataFrame, model_col: str = "model") -> DataFrame:
    """The longest alias that is the model or is followed by a dash in it; unknown models get nulls."""
    parts = F.split(model_col, "-")
    starts = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "-"))
    models = runs.select(model_col).distinct().select(model_col, F.explode(starts).alias("alias"))
    hit = models.join(prices, "alias")
    best = hit.groupBy(model_col).agg(F.max_by(F.struct("alias", "input", "output", "cached", "creation"), F.length("alias")).alias("p"))
    return runs.join(best.select(model_col, "p.*"), model_col, "left")


def cost_subtracting_cached(input_tokens: str = "input_tokens", cached: str = "cached_tokens", output: str = "output_tokens") -> Column:
    """Cached tokens are part of the input, at their own rate."""
    fresh = F.greatest(F.col(input_tokens) - F.col(cached), F.lit(0))
    return fresh / 1e6 * F.col("input") + F.col(cached) / 1e6 * F.coalesce("cached", "input") + F.col(output) / 1e6 * F.col("output")


def cost_separate_buckets(input_tokens: str = "input_tokens", cached: str = "cached_tokens", creation: str = "creation_tokens", output: str = "output_tokens") -> Column:
    """Cached and newly cached tokens come on top of the input."""
    return F.col(input_tokens) / 1e6 * F.col("input") + F.col(cached) / 1e6 * F.coalesce("cached", "input") + F.col(creation) / 1e6 * F.coalesce(F.col("creation"), F.col("input") * 1.25) + F.col(output) / 1e6 * F.col("output")


def kpis(ledger: DataFrame, claims: DataFrame) -> DataFrame:
    """Cache hit rate, cost per promoted claim, share of quotes that their documents contain; nulls where nothing is counted."""
    spend = ledger.filter("status <> 'running'").agg(F.sum("cached_tokens").alias("cached"), F.sum("input_tokens").alias("input"), F.sum("cost_e4").alias("cost"))
    faithful = claims.agg(F.count_if((F.col("confidence_pct") >= 85) & (F.col("n") % 4 == 0)).alias("promoted"), F.avg(F.coalesce(F.col("text"), F.lit("")).contains(F.col("quote")).cast("double")).alias("faithfulness"))
    return spend.crossJoin(F.broadcast(faithful)).select((F.col("cached") / F.col("input")).alias("cache_hit_rate"), F.try_divide(usd(F.col("cost")), F.col("promoted")).alias("cost_per_promoted"), "faithfulness")  # one row each


def metrics_daily(ledger: DataFrame) -> DataFrame:
    """Per-run values rolled up by day and stage: mean and sample count."""
    return ledger.filter("cost_e4 is not null").groupBy(day_of().alias("day"), F.col("stage").alias("metric")).agg((F.sum("cost_e4") / F.count(F.lit(1)) / 10_000.0).alias("value"), F.count(F.lit(1)).alias("sample_count"))


def alerts(metrics: DataFrame, thresholds: Sequence[tuple[str, float]]) -> DataFrame:
    limits = metrics.sparkSession.createDataFrame(list(thresholds), "metric string, threshold double")
    return metrics.join(limits, "metric").filter("value > threshold").select("day", "metric", "value", "threshold")


def nearest_rank(values: DataFrame, group: str, value: str, shares: Mapping[str, float]) -> DataFrame:
    """Percentiles at index ``ceil(n * p) - 1`` of the sorted values; no task holds a group, see :func:`.ranges.ranked`."""
    return ranked(values, group, value, shares)


def rule_candidates(ignored: DataFrame, key: str, least: int) -> DataFrame:
    """Keys that were ignored ``least`` times or more, and when they first reached it."""
    order = Window.partitionBy(key).orderBy("at", "id")
    nth = ignored.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") == least).select(key, F.col("at").alias("reached_at"))
    return ignored.groupBy(key).agg(F.count(F.lit(1)).alias("times")).filter(F.col("times") >= least).join(nth, key)


#: Archive policies from the loosest to the strictest. Rules are only proposed towards the strict end.
STRICTER = ("full_snapshot_allowed", "excerpt_only", "metadata_only", "do_not_collect")


def domain_rules(cases: DataFrame, current: DataFrame, least: int) -> DataFrame:
    """Rules for whole domains, where ``cases(id, url, at, wanted)`` asked for a policy ``least`` times or more.

    ``domain, rule, times, reached_at, proposed``: the strictest policy that was wanted, if it is stricter than the domain's
    ``current(domain, policy)``; a domain without one has the loosest. A user confirms a rule; none is relaxed. A
    domain of any size is counted range by range.
    """
    host = F.lower(F.try_parse_url("url", F.lit("HOST")))
    rows = cases.select(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"), "at", "id", F.array_position(F.array(*map(F.lit, STRICTER)), F.col("wanted")).alias("level"))
    rows = rows.filter("domain <> '' and level > 0")
    nth = scan(rows, ["domain"], ["at", "id"], {"nth": Since(F.lit(False), F.lit(True))}).filter(F.col("nth") == least).select("domain", F.col("at").alias("reached_at"))
    found = rows.groupBy("domain").agg(F.count(F.lit(1)).alias("times"), F.max("level").alias("level")).join(nth, "domain")
    now = current.select("domain", F.array_position(F.array(*map(F.lit, STRICTER)), F.col("policy")).alias("now"))
    out = found.join(now, "domain", "left").filter(F.col("level") > F.greatest(F.coalesce("now", F.lit(1)), F.lit(1)))
    return out.select("domain", F.concat(F.lit("*."), "domain").alias("rule"), "times", "reached_at", F.element_at(F.array(*map(F.lit, STRICTER)), F.col("level").cast("int")).alias("proposed"))


def trailing_share(rows: DataFrame, order: Sequence[str], size: int, most: float) -> DataFrame:
    """Rows of ``direction`` in order with the share of the commoner of ``positive``, ``negative`` among the last ``size`` of each stream."""
    w = Window.partitionBy("stream").orderBy(*order).rowsBetween(-(size - 1), 0)
    up, down, n = F.count_if(F.col("direction") == "positive").over(w), F.count_if(F.col("direction") == "negative").over(w), F.count(F.lit(1)).over(w)
    return rows.withColumn("seen", n).withColumn("share", F.greatest(up, down) / n).withColumn("skewed", (F.col("seen") == size) & (F.col("share") >= most))
