"""Derived metrics from specifications: a small language of steps, compiled to one DataFrame plan and named by its hash.

A specification is a mapping (or its JSON) of the keys ``id``, ``group`` (columns), ``value``
(an expression over the table's columns), ``function`` (:data:`FUNCTIONS`) and, optionally,
``filter``, ``order`` (a column of ``group``), ``window`` (rows of the order, the last one
included) or ``change`` (rows back, as a share of the value there), and ``decimals``. Values
are exact where the expression is: sums of integers do not depend on their order.

A metric is reproducible by three things: the vintage of its data, the hash of its
specification, and the versions it was computed with. Specifications that say the same have
the same hash, whatever the order of their keys or the blanks of their JSON.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FUNCTIONS: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum, "count": F.count, "mean": F.avg, "min": F.min, "max": F.max, "distinct": F.count_distinct,
}
_KEYS = {"id": str, "group": list, "value": str, "function": str, "filter": str, "order": str, "window": int, "change": int, "decimals": int}
_NEEDED = ("id", "group", "value", "function")


def parsed(spec: str | Mapping[str, Any]) -> dict[str, Any]:
    """The specification, or a ValueError that says what is wrong with it."""
    try:
        out = dict(json.loads(spec)) if isinstance(spec, str) else dict(spec)
    except (TypeError, ValueError) as e:
        raise ValueError(f"no specification: {e}") from e
    for key, value in out.items():
        if key not in _KEYS:
            raise ValueError(f"unknown key {key}")
        if not isinstance(value, _KEYS[key]) or isinstance(value, bool):
            raise ValueError(f"{key} is no {_KEYS[key].__name__}")
    missing = [k for k in _NEEDED if k not in out]
    if missing:
        raise ValueError(f"{', '.join(missing)} missing")
    if out["function"] not in FUNCTIONS:
        raise ValueError(f"unknown function {out['function']}")
    if not all(isinstance(c, str) for c in out["group"]):
        raise ValueError("group is a list of columns")
    if ("window" in out or "change" in out) and out.get("order") not in out["group"]:
        raise ValueError("window and change need an order among the columns of group")
    if "window" in out and "change" in out:
        raise ValueError("either window or change")
    if any(out.get(k, 1) < 1 for k in ("window", "change")):
        raise ValueError("window and change count rows")
    return out


def spec_sha256(spec: str | Mapping[str, Any]) -> str:
    return hashlib.sha256(json.dumps(parsed(spec), sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def compiled(table: DataFrame, spec: str | Mapping[str, Any]) -> DataFrame:
    """The groups of one specification with their ``value``.

    Rows are combined by group before the shuffle; a window runs over groups, of
    which there is one for each value of the order. An expression that the table
    does not have fails when it is compiled, not when it runs.
    """
    s = parsed(spec)
    rows = table.filter(s["filter"]) if "filter" in s else table
    groups = [F.col(c) for c in s["group"]]
    out = rows.withColumn("__value", F.expr(s["value"])).groupBy(*groups).agg(FUNCTIONS[s["function"]](F.col("__value")).alias("value"))
    if "order" in s and ("window" in s or "change" in s):
        w = Window.partitionBy(*(c for c in s["group"] if c != s["order"])).orderBy(s["order"])
        if "window" in s:
            out = out.withColumn("value", F.sum("value").over(w.rowsBetween(1 - s["window"], 0)))
        else:
            before = F.lag("value", s["change"]).over(w)
            out = out.withColumn("value", F.try_divide((F.col("value") - before).cast("double"), before.cast("double")))
    value = F.col("value").cast("double")
    return out.select(*groups, (F.round(value, s["decimals"]) if "decimals" in s else value).alias("value"))


def derived(tables: Mapping[str, DataFrame], specs: Sequence[tuple[str, str | Mapping[str, Any]]], vintage: str, versions: Mapping[str, str]) -> DataFrame:
    """All metrics of specifications over named tables: ``metric, vintage, spec_sha256, lock_sha256, dimensions, value``.

    ``dimensions`` is JSON of the group. Equal specifications are computed once.
    """
    lock = hashlib.sha256(json.dumps(dict(versions), sort_keys=True).encode()).hexdigest()
    out, seen = None, set()
    for name, spec in specs:
        s, key = parsed(spec), spec_sha256(spec)
        if (name, key) in seen:
            continue
        seen.add((name, key))
        rows = compiled(tables[name], s)
        dimensions = F.to_json(F.struct(*s["group"]), {"ignoreNullFields": "false"}) if s["group"] else F.lit("{}")
        rows = rows.select(F.lit(s["id"]).alias("metric"), F.lit(vintage).alias("vintage"), F.lit(key).alias("spec_sha256"), F.lit(lock).alias("lock_sha256"), dimensions.alias("dimensions"), "value")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no specification")
    return out
