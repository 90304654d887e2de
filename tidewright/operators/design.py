"""Claims, dossiers, scenarios, reviews and retrieval, as the designs state them."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def stale_claims(claims: DataFrame, snapshots: DataFrame, contradicted: DataFrame, now: Column, default_days: int = 30) -> DataFrame:
    """A claim is stale when it is too old, its source has changed since, or something contradicts it.

    ``claims(claim_id, url, hash, at, stale_after)``, ``snapshots(url, hash, at)``, ``contradicted(claim_id)``.
    """
    newest = snapshots.groupBy("url").agg(F.max_by("hash", F.struct("at", "hash")).alias("newest"))
    c = claims.join(newest, "url", "left").join(contradicted.select("claim_id").distinct().withColumn("__c", F.lit(True)), "claim_id", "left")
    old = F.timestamp_diff("DAY", F.col("at"), now) > F.coalesce(F.col("stale_after"), F.lit(default_days))
    why = F.array_compact(F.array(F.when(old, "age"), F.when(F.col("newest") != F.col("hash"), "newer_snapshot"), F.when(F.col("__c"), "contradicted")))
    return c.select("claim_id", F.array_join(why, ",").alias("why"), (F.size(why) > 0).alias("stale"))


def auto_confirm(claims: DataFrame, least: int = 85) -> DataFrame:
    """Of reliable sources (tier 0) and confident claims; all others go to the queue."""
    return claims.withColumn("route", F.when((F.col("tier") == 0) & (F.col("confidence_pct") >= least), "auto_confirm").otherwise("review_queue"))


def confirm_error_rate(routed: DataFrame, labels: DataFrame) -> DataFrame:
    """Share of labelled auto-confirmed rows that were wrong; null where none is labelled."""
    j = routed.filter("route = 'auto_confirm'").join(labels, "doc_id")
    return j.agg(F.count(F.lit(1)).alias("reviewed"), F.count_if(F.col("quality") == 0).alias("wrong")).withColumn("false_positive_rate", F.try_divide("wrong", "reviewed"))


def scenario_checks(scenarios: DataFrame) -> DataFrame:
    """``branches: array<struct<weight, falsifiers, signals>>, counterclaims``: the names of the checks that fail."""
    b = F.col("branches")
    failed = F.array_compact(
        F.array(
            F.when(~F.forall(b, lambda x: x["weight"].isNotNull()), "weights"),
            F.when(F.size(b) < 2, "branches"),
            F.when(F.exists(b, lambda x: F.size(x["falsifiers"]) < 1), "falsifiers"),
            F.when(F.exists(b, lambda x: F.size(x["signals"]) < 1), "signals"),
            F.when(F.size("counterclaims") < 1, "counterclaims"),
        )
    )
    return scenarios.select("scenario_id", F.array_join(failed, ",").alias("failed"), (F.size(failed) == 0).alias("valid"))


def cite_check(cites: DataFrame, claims: DataFrame, blocked_sources: DataFrame) -> DataFrame:
    """Drafts with the checks that stop them: one row a draft, from booleans of each cited claim."""
    flags = ("stale", "retracted", "horizon", "unit", "overclaim")
    j = cites.join(claims, "claim_id", "left").join(blocked_sources.select("source").distinct().withColumn("blocked", F.lit(True)), "source", "left")
    g = j.groupBy("draft_id").agg(*(F.bool_or(F.coalesce(f, F.lit(False))).alias(f) for f in (*flags, "blocked")), F.bool_or(F.col("source").isNull()).alias("unknown_claim"))
    names = F.array_compact(F.array(*(F.when(F.col(f), f) for f in (*flags, "blocked", "unknown_claim"))))
    return g.select("draft_id", F.array_join(names, ",").alias("blocks"), (F.size(names) == 0).alias("passes"))


SECTIONS = ("supporting", "opposing", "monitoring", "context")


def evidence_pack(claims: DataFrame) -> DataFrame:
    """Claims of a thesis by role, each section in order of ids."""
    return claims.groupBy("thesis_id").agg(*(F.array_join(F.array_sort(F.collect_list(F.when(F.col("role") == r, F.col("claim_id")))), ",").alias(r) for r in SECTIONS))


def coverage(claims: DataFrame, least: Mapping[str, int]) -> DataFrame:
    g = claims.groupBy("thesis_id").agg(*(F.count_if(F.col("role") == r).alias(f"n_{r}") for r in least))
    ok = F.lit(True)
    for r, n in least.items():
        ok = ok & (F.col(f"n_{r}") >= n)
    return g.withColumn("covered", ok)


def recall_at_k(cases: DataFrame, k: int) -> DataFrame:
    """Share of expected ids among the first ``k`` retrieved; nothing expected counts as 1."""
    hit = F.size(F.array_intersect(F.slice("retrieved", 1, k), F.array_distinct("expected")))
    share = F.when(F.size("expected") == 0, 1.0).otherwise(hit / F.size(F.array_distinct("expected")))
    return cases.select("case_id", share.alias("recall"), (share >= 0.8).alias("passed"))


def evaluation_run(recalls: DataFrame, packs: DataFrame) -> DataFrame:
    """One row a run: cases, pass rate, mean recall and mean diversity.

    ``recalls(run, case_id, recall, passed)``; ``packs(case_id, source)`` has the source
    of each claim retrieved. A case's diversity is its distinct sources by its claims,
    0 where it retrieved nothing.
    """
    diversity = packs.groupBy("case_id").agg((F.count_distinct("source") / F.count(F.lit(1))).alias("diversity"))
    j = recalls.join(diversity, "case_id", "left")
    return j.groupBy("run").agg(F.count(F.lit(1)).alias("total_cases"), F.avg(F.col("passed").cast("int")).alias("pass_rate"), F.avg("recall").alias("mean_recall"), F.avg(F.coalesce("diversity", F.lit(0.0))).alias("mean_diversity"))


#: Queries that are sent to all tasks at a time, and vectors that they are multiplied by at a time.
QUERY_BLOCK, VECTOR_RUN = 4096, 2048


def knn(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Exact nearest neighbours by cosine of a stated set of queries against every vector: ``query_id, other_id, cosine, rank``.

    Queries go out in blocks of about ``QUERY_BLOCK``, so that what is sent is bounded
    however many there are. A task multiplies ``VECTOR_RUN`` vectors at a time by the
    block, computes the best (with all that could tie) again term by term in double
    precision, so that equal vectors have equal cosines, and holds each query's ``k``
    best of all its rows. Null and zero vectors, and those of another length, are
    nobody's neighbour.
    """
    spark = vectors.sparkSession
    asked = queries.select(F.col(id_col).alias("id"), F.transform(vector_col, lambda x: x.cast("double")).alias("v")).filter("id is not null and v is not null")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    rows = vectors.select(F.col(id_col).alias("id"), F.transform(vector_col, lambda x: x.cast("double")).alias("v"))
    found = None
    for block in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toArrow()  # about QUERY_BLOCK rows
        shared = spark.sparkContext.broadcast(_by_length(mine.column("id").to_numpy(), mine.column("v").combine_chunks()))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            held: dict[int, _Held] = {}
            for batch in batches:
                for i in range(0, batch.num_rows, VECTOR_RUN):
                    part = batch.slice(i, VECTOR_RUN)
                    for size, (ids, x) in _by_length(part.column(0).to_numpy(zero_copy_only=False), part.column(1)).items():
                        if size in shared.value:
                            held[size] = _nearest(*shared.value[size], ids, x, k, held.get(size))
            for size, (row, other, cosine) in held.items():
                for i in range(0, len(row), 1 << 16):
                    at = slice(i, i + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array(shared.value[size][0][row[at]]), pa.array(other[at]), pa.array(cosine[at])], ["query_id", "other_id", "cosine"])

        part = rows.filter("id is not null and v is not null").mapInArrow(run, "query_id long, other_id long, cosine double")
        found = part if found is None else found.unionByName(part)
    w = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "other_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _by_length(ids: np.ndarray, vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and matrix of the vectors of each length, without zero vectors and those that hold a null or no number."""
    out = {}
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == size)
        x = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, int(size))
        good = np.isfinite(x).all(1) & (x != 0).any(1)
        out[int(size)] = (ids[at[good]].astype(np.int64), x[good])
    return out


#: Place of the query in its block, id of the other vector, cosine; at most ``k`` of each query, in the order of queries.
_Held = tuple[np.ndarray, np.ndarray, np.ndarray]


def _best(row: np.ndarray, other: np.ndarray, cosine: np.ndarray, k: int) -> _Held:
    """Each query's first ``k`` by cosine, then id; no number is the largest, as Spark has it."""
    order = np.lexsort((other, -np.nan_to_num(cosine, nan=np.inf), row))
    place = np.arange(len(order)) - np.searchsorted(row[order], row[order], "left")
    chosen = order[place < k]
    return row[chosen], other[chosen], cosine[chosen]


def _nearest(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, held: _Held | None = None, rows: int = 512) -> _Held:
    """Each query's ``k`` best of what was ``held`` and of some vectors; those that tie with the last within rounding are all looked at."""
    held = held or (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    if not len(q) or not len(x):
        return held
    bound = np.full(len(q), -np.inf)
    first = np.searchsorted(held[0], np.arange(len(q)))
    full = np.flatnonzero(np.append(first[1:], len(held[0])) - first == k)
    bound[full] = held[2][first[full] + k - 1]
    qn, xn = (np.sqrt(np.cumsum(m * m, axis=1)[:, -1]) for m in (q, x))
    unit = (x / xn[:, None]).T
    step = max(1, (1 << 20) // x.shape[1])
    for i in range(0, len(q), rows):
        near = (q[i : i + rows] / qn[i : i + rows, None]) @ unit
        near[(query_ids[i : i + rows, None] == ids[None, :]) | ~np.isfinite(near)] = -np.inf
        least = np.partition(near, -k, axis=1)[:, -k] if near.shape[1] > k else near.min(1)
        a, b = np.nonzero((near >= np.fmax(least, bound[i : i + rows])[:, None] - 1e-9) & np.isfinite(near))
        a += i
        cosine = np.empty(len(a))
        for j in range(0, len(a), step):
            u, v = a[j : j + step], b[j : j + step]
            cosine[j : j + step] = np.cumsum(q[u] * x[v], axis=1)[:, -1] / (qn[u] * xn[v])
        held = tuple(np.concatenate((h, n)) for h, n in zip(held, _best(a, ids[b], cosine, k), strict=True))
    return _best(*held, k)


def pagerank(edges: DataFrame, rounds: int = 5, damping: float = 0.85) -> DataFrame:
    """Ranks after a fixed number of rounds; what dangling nodes hold is lost, as in the plain formula."""
    nodes = edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).distinct()
    out_degree = edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    ranks = nodes.withColumn("rank", F.lit(1.0))
    for _ in range(rounds):
        sent = edges.join(out_degree, "src").join(ranks, F.col("src") == F.col("node")).groupBy("dst").agg(F.sum(F.col("rank") / F.col("degree")).alias("got"))
        ranks = nodes.join(sent, F.col("node") == F.col("dst"), "left").select("node", (F.lit(1 - damping) + damping * F.coalesce("got", F.lit(0.0))).alias("rank"))
    return ranks


OPPOSITE = {"positive": "negative", "negative": "positive"}


def one_sided(theses: DataFrame) -> DataFrame:
    """``thesis_id, direction``: whether all claims of a thesis point one way, and the way a counterclaim would point."""
    g = theses.groupBy("thesis_id").agg(F.count_if(F.col("direction") == "positive").alias("up"), F.count_if(F.col("direction") == "negative").alias("down"), F.count(F.lit(1)).alias("n"))
    main = F.when(F.col("up") >= F.col("down"), "positive").otherwise("negative")
    opposite = F.create_map(*(F.lit(x) for pair in OPPOSITE.items() for x in pair))
    return g.select("thesis_id", (F.greatest("up", "down") / F.col("n")).alias("share"), ((F.least("up", "down") == 0) & (F.greatest("up", "down") > 0)).alias("one_sided"), F.element_at(opposite, main).alias("wanted_direction"))


def presence_rates(publications: DataFrame) -> DataFrame:
    """``publication_id, direction`` of cited claims: shares of publications with a claim that points up, with one that points down, and with one way only."""
    g = publications.groupBy("publication_id").agg(F.coalesce(F.bool_or(F.col("direction") == "positive"), F.lit(False)).alias("up"), F.coalesce(F.bool_or(F.col("direction") == "negative"), F.lit(False)).alias("down"))
    share = lambda cond: F.try_divide(F.count_if(cond), F.count(F.lit(1)))
    return g.agg(
        F.count(F.lit(1)).alias("publications"),
        share(F.col("up")).alias("upside_claim_presence_rate"),
        share(F.col("down")).alias("downside_claim_presence_rate"),
        share(F.col("up") != F.col("down")).alias("one_sided_warning_rate"),
    )


def review_coverage(runs: DataFrame, reviews: DataFrame) -> DataFrame:
    """Share of top-tier runs that another vendor reviewed."""
    j = runs.filter("tier = 0").join(reviews.select("run_id", F.col("vendor").alias("reviewer")).distinct(), "run_id", "left")
    g = j.groupBy("run_id", "vendor").agg(F.bool_or(F.coalesce(F.col("reviewer") != F.col("vendor"), F.lit(False))).alias("ok"))
    return g.agg(F.count(F.lit(1)).alias("runs"), F.count_if("ok").alias("reviewed")).withColumn("coverage", F.try_divide("reviewed", "runs")).withColumn("met", F.coalesce(F.col("coverage") >= 0.95, F.lit(False)))


def session_stop(rounds: DataFrame, confident: float, most: int) -> DataFrame:
    """The first round at which a session stops, and why: confidence, then unchanged twice, then the number of rounds."""
    w = Window.partitionBy("session").orderBy("round")
    same = (F.col("answer") == F.lag("answer", 1).over(w)) & (F.col("answer") == F.lag("answer", 2).over(w))
    why = F.when(F.col("confidence") >= confident, "confident").when(same, "unchanged").when(F.col("round") >= most, "rounds")
    stopped = rounds.withColumn("why", why).filter("why is not null")
    return stopped.groupBy("session").agg(F.min_by(F.struct("round", "why"), "round").alias("s")).select("session", "s.round", "s.why")


def tier_rules(rows: DataFrame) -> DataFrame:
    """Source tier A-D from four collectability dimensions; no tier depends on reliability."""
    c = F.col("collectability")
    good = sum((F.col(f"collectability.{k}") == "yes").cast("int") for k in ("access", "stability", "terms", "structure"))
    tier = F.when(c["terms"] == "no", "D").when(good == 4, "A").when(good == 3, "B").otherwise("C")
    return rows.withColumn("tier", tier)


def superseded(snapshots: DataFrame, cited: DataFrame) -> DataFrame:
    """Snapshots that a later one of their page replaces and nothing cites: what retention may collapse."""
    w = Window.partitionBy("url").orderBy(F.desc("at"), F.desc("snap_id"))
    return snapshots.withColumn("r", F.row_number().over(w)).filter("r > 1").drop("r").join(cited.select("snap_id").distinct(), "snap_id", "left_anti")


# ---- datasets ---------------------------------------------------------------


def year_over_year(series: DataFrame, order: str, value: str, periods: int = 12, by: Sequence[str] = ()) -> DataFrame:
    """Change against ``periods`` rows before, within each of ``by`` (none: one short series)."""
    before = F.lag(value, periods).over(Window.partitionBy(*by).orderBy(order))
    return series.withColumn("yoy", F.try_divide(F.col(value) - before, before))


def rolling(series: DataFrame, order: str, value: str, size: int, by: Sequence[str] = ()) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-(size - 1), 0)
    return series.withColumn("rolling_sum", F.sum(value).over(w)).withColumn("rolling_n", F.count(value).over(w))


def zscores(rows: DataFrame, value: str, by: str, limit: float = 3.0) -> DataFrame:
    """Deviation from the group's mean in population deviations, from joined aggregates rather than a window over a hot group."""
    g = rows.groupBy(by).agg(F.avg(value).alias("__m"), F.stddev_pop(value).alias("__s"))
    z = F.try_divide(F.col(value) - F.col("__m"), F.col("__s"))
    return rows.join(g, by).withColumn("z", z).withColumn("anomaly", F.coalesce(F.abs("z") >= limit, F.lit(False))).drop("__m", "__s")


def cohorts(rows: DataFrame, entity: str, period: str) -> DataFrame:
    """Entities by the period they first appear in and the periods in which they are seen again."""
    first = rows.groupBy(entity).agg(F.min(period).alias("cohort"))
    return rows.join(first, entity).groupBy("cohort", (F.col(period) - F.col("cohort")).alias("age")).agg(F.count_distinct(entity).alias("entities"))


def payload_guard(rows: DataFrame, text_col: str, most_rows: int = 1000, most_bytes: int = 50_000) -> DataFrame:
    g = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("bytes"))
    return g.withColumn("must_reduce", (F.col("rows") >= most_rows) | (F.col("bytes") >= most_bytes))


def repeated_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def communities(edges: DataFrame, rounds: int = 5) -> DataFrame:
    """Label propagation: each node takes the label most of its neighbours have, the smallest on a tie."""
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    labels = both.select(F.col("src").alias("node")).distinct().withColumn("label", F.col("node"))
    for _ in range(rounds):
        seen = both.join(labels, F.col("dst") == F.col("node")).groupBy("src", "label").agg(F.count(F.lit(1)).alias("n"))
        best = seen.groupBy("src").agg(F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("label"))
        labels = best.select(F.col("src").alias("node"), "label")
    return labels
