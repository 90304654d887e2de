"""Source registry: loading, preflight, resolving and upserts."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .policy import ARCHIVE, CLOUD, LLM

REQUIRED = ("slug", "name", "publisher", "url")
ACCESS = ("rss", "api", "html", "manual")
SCHEMA = "slug string, name string, publisher string, url string, rss_url string, access_method string, reliability_tier int, perspective string, category string, active_v0 boolean, archive_policy string, raw_cloud_policy string, external_llm_policy string, subtopic_tags array<string>"


class RegistryError(ValueError):
    """A registry that is not loaded at all, with everything that is wrong with it."""


def problems(rows: Iterable[Any]) -> list[str]:
    out, seen = [], set()
    for i, row in enumerate(rows):
        if not isinstance(row, Mapping):
            out.append(f"row {i}: no mapping")
            continue
        out += [f"row {i}: {k} is missing" for k in REQUIRED if not isinstance(row.get(k), str) or not row[k].strip()]
        slug = row.get("slug")
        if slug in seen:
            out.append(f"row {i}: slug {slug!r} again")
        seen.add(slug)
        for k, allowed in (("access_method", ACCESS), ("archive_policy", ARCHIVE), ("raw_cloud_policy", CLOUD), ("external_llm_policy", LLM)):
            if row.get(k) not in allowed:
                out.append(f"row {i}: {k} is {row.get(k)!r}")
        for k in ("url", "rss_url"):
            if row.get(k) is not None and not str(row[k]).startswith(("http://", "https://")):
                out.append(f"row {i}: {k} is no web address")
    return out


def load(spark: SparkSession, path: str | os.PathLike[str]) -> DataFrame:
    """A YAML registry (``sources`` or a list) as rows; the whole load fails on any problem."""
    import yaml

    text = "\n".join(r["value"] for r in spark.read.text(str(path), wholetext=True).collect())  # one small file
    root = yaml.safe_load(text)
    rows = root.get("sources") if isinstance(root, Mapping) else root
    if not isinstance(rows, list):
        raise RegistryError("the registry is no list of sources")
    if found := problems(rows):
        raise RegistryError("; ".join(found))
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], SCHEMA)


def pollable(registry: DataFrame, slug_map: DataFrame, slug: str | None = None) -> DataFrame:
    """Active RSS sources of tier 0 with their ids; one without an id fails the query."""
    out = registry.filter("coalesce(active_v0, true) and access_method = 'rss' and reliability_tier = 0 and rss_url rlike '^https?://'")
    if slug is not None:
        out = out.filter(F.col("slug") == slug)
    out = out.join(slug_map, "slug", "left")
    checked = F.when(F.col("source_id").isNull(), F.raise_error(F.concat(F.lit("no source id for slug "), "slug"))).otherwise(F.col("source_id"))
    return out.select(checked.alias("source_id"), F.col("rss_url").alias("feed_url"))


def preflight(slug_map: DataFrame, graph: DataFrame, policies: DataFrame) -> DataFrame:
    """Differences of the three sets of ids, both ways, as ``difference, source_id``."""
    ids = {"slug_map": slug_map, "graph": graph, "policy": policies}
    pairs = (("slug_map", "graph"), ("graph", "slug_map"), ("policy", "slug_map"), ("slug_map", "policy"))
    out = None
    for a, b in pairs:
        part = ids[a].select("source_id").filter("source_id is not null").distinct().join(ids[b].select("source_id"), "source_id", "left_anti").select(F.lit(f"{a}_minus_{b}").alias("difference"), "source_id")
        out = part if out is None else out.unionByName(part)
    return out


def id_counts(graph: DataFrame) -> DataFrame:
    """Ids that occur more than once, and how many rows have none."""
    twice = graph.filter("source_id is not null").groupBy("source_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    none = graph.agg((F.count(F.lit(1)) - F.count("source_id")).alias("n")).select(F.lit(None).cast("string").alias("source_id"), "n")
    return twice.unionByName(none)


def resolve(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Names from the registry by slug; a slug that it does not know is its own name."""
    return rows.join(registry.select("slug", "name", "url"), "slug", "left").select("slug", F.coalesce("name", "slug").alias("name"), "url")


def upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """A slug keeps the id that it first got; its other values are the new ones."""
    o = old.select("slug", F.col("source_id").alias("oid"), F.col("policy").alias("op"))
    n = new.select("slug", F.col("source_id").alias("nid"), F.col("policy").alias("np"))
    change = F.when(F.col("oid").isNull(), "inserted").when(F.col("nid").isNull(), "kept").otherwise("updated")
    return o.join(n, "slug", "full").select("slug", F.coalesce("oid", "nid").alias("source_id"), F.coalesce("np", "op").alias("policy"), change.alias("change"))


def shares(rows: DataFrame, column: str, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """The percentage of each value, and whether it lies within its bounds."""
    total = Window.partitionBy()
    g = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))  # one row a value
    g = g.withColumn("percent", F.col("n") * 100 / F.sum("n").over(total))
    low, high = F.lit(0.0), F.lit(100.0)
    for value, (a, b) in bounds.items():
        low, high = F.when(F.col("value") == value, a).otherwise(low), F.when(F.col("value") == value, b).otherwise(high)
    return g.withColumn("within", (F.col("percent") >= low) & (F.col("percent") <= high))


def latest_version(versions: DataFrame) -> DataFrame:
    """By number: v10 is later than v9."""
    return versions.groupBy().agg(F.max_by("version", F.expr("try_cast(substring(version, 2) as int)")).alias("version"))
