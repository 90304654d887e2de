"""Windows over keys that may hold most of the rows: prefix scans over ranges.

Rows are sorted into ranges by key and order, so that a key of any size spreads over
as many ranges as its share of the table. Each range computes what it can alone. What
a range tells the next ones is a summary that can be put together with others (a count
since the last reset, a last value, a first value); a window over the summaries, at
most one row for each key and range, carries it on. Only the first key of a range goes on
from an earlier one, and only the last into a later one, so that the carried table has
no more rows than there are ranges, and is broadcast.

The same ranges serve as a histogram for ranks: see :func:`ranked`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch


@dataclass(frozen=True)
class Since:
    """How many rows have ``count`` since the last one with ``reset``, this row included (a row that resets counts too)."""

    reset: Column
    count: Column


@dataclass(frozen=True)
class Last:
    """The last value that is not null, up to this row, or up to the row before."""

    value: Column
    before: bool = False


@dataclass(frozen=True)
class Next:
    """The value of the next row."""

    value: Column


def ranged(rows: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Adds ``__range``: rows of a key go to successive ranges by their order. The shuffle deals them by sampled bounds."""
    n = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(n, *keys, *order).withColumn("__range", F.spark_partition_id())


def _same(columns: Sequence[str], left: str = "", right: str = "o_") -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{left}{c}").eqNullSafe(F.col(f"{right}{c}"))
    return out


def scan(rows: DataFrame, keys: Sequence[str], order: Sequence[str], specs: Mapping[str, Since | Last | Next], ranges: int | None = None) -> DataFrame:
    """``rows`` with a column for each spec, as a window over ``keys`` by ``order`` would give; order columns must tell rows of a key apart."""
    keys, order, place = list(keys), list(order), [*keys, "__range"]
    w = Window.partitionBy(*place).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local, kept, carry = ranged(rows, keys, order, ranges), list(rows.columns), []
    for name, spec in specs.items():
        if isinstance(spec, Since):
            # Rows before a range's first reset go on counting.
            local = local.withColumn(f"__i_{name}", F.sum(spec.reset.cast("int")).over(upto))
            own = Window.partitionBy(*place, f"__i_{name}").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
            local = local.withColumn(f"__v_{name}", F.sum(spec.count.cast("long")).over(own))
            kept += [f"__i_{name}", f"__v_{name}"]
        elif isinstance(spec, Last):
            # The range's own last value is kept beside the row's, for what follows the range.
            local = local.withColumn(f"__i_{name}", spec.value).withColumn(f"__v_{name}", F.last(spec.value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1) if spec.before else upto))
            kept += [f"__i_{name}", f"__v_{name}"]
        else:
            local = local.withColumn(f"__i_{name}", spec.value).withColumn(f"__v_{name}", F.lead(spec.value).over(w)).withColumn(f"__e_{name}", F.lead(F.lit(True), 1).over(w).isNull())
            kept += [f"__i_{name}", f"__v_{name}", f"__e_{name}"]
    saved = Scratch(rows.sparkSession, "ranges").save(local.select(*kept, "__range"), "local")

    at, totals = F.struct(*order), []
    for name, spec in specs.items():
        if isinstance(spec, Since):
            totals += [F.max(f"__i_{name}").alias(f"r_{name}"), F.max_by(f"__v_{name}", at).alias(f"s_{name}")]
        elif isinstance(spec, Last):
            totals.append(F.max_by(f"__i_{name}", F.when(F.col(f"__i_{name}").isNotNull(), at)).alias(f"s_{name}"))
        else:
            totals.append(F.min_by(F.struct(f"__i_{name}"), at).alias(f"s_{name}"))
    summary = saved.groupBy(*place).agg(*totals)
    over = Window.partitionBy(*keys).orderBy("__range")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    for name, spec in specs.items():
        if isinstance(spec, Since):
            summary = summary.withColumn(f"k_{name}", F.sum((F.col(f"r_{name}") > 0).cast("int")).over(over.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            # The range with the last reset starts the count; those after it add all they have.
            own = Window.partitionBy(*keys, f"k_{name}").orderBy("__range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            summary = summary.withColumn(f"t_{name}", F.sum(f"s_{name}").over(own))
            carry.append(F.lag(f"t_{name}").over(over).alias(f"c_{name}"))
        elif isinstance(spec, Last):
            carry.append(F.last(f"s_{name}", ignorenulls=True).over(before).alias(f"c_{name}"))
        else:
            carry.append(F.lead(f"s_{name}").over(over).alias(f"c_{name}"))
    carried = summary.select(*(F.col(c).alias(f"o_{c}") for c in place), *carry)
    some = F.lit(False)
    for name in specs:
        some = some | F.col(f"c_{name}").isNotNull()
    out = saved.join(F.broadcast(carried.filter(some)), _same(place), "left")  # a row at most for each range and direction
    for name, spec in specs.items():
        value, c = F.col(f"__v_{name}"), F.col(f"c_{name}")
        if isinstance(spec, Since):
            value = value + F.when(F.col(f"__i_{name}") == 0, F.coalesce(c, F.lit(0))).otherwise(F.lit(0))
        elif isinstance(spec, Last):
            value = F.coalesce(value, c)
        else:
            value = F.when(F.col(f"__e_{name}"), c[f"__i_{name}"]).otherwise(value)
        out = out.withColumn(name, value)
    return out.select(*rows.columns, *specs)


def ranked(values: DataFrame, group: str, value: str, shares: Mapping[str, float], ranges: int | None = None) -> DataFrame:
    """Of each group the value at rank ``ceil(n * share)`` among those that are not null, ties included; null without values.

    Equal values are counted first. Counts of ranges tell which range holds a rank, and
    only the rows of such ranges are looked at again.
    """
    counted = values.groupBy(F.col(group).alias("g"), F.col(value).alias("v")).agg(F.count(value).alias("n"))
    saved = Scratch(values.sparkSession, "ranges").save(ranged(counted, ["g"], ["v"], ranges), "counted")
    over = Window.partitionBy("g").orderBy("__range")  # a row for each range
    sums = saved.groupBy("g", "__range").agg(F.sum("n").alias("n"))
    sums = sums.withColumn("upto", F.sum("n").over(over)).withColumn("total", F.sum("n").over(Window.partitionBy("g")))
    wanted = F.array(*(F.struct(F.lit(name).alias("name"), F.greatest(F.lit(1), F.ceil(F.col("total") * F.lit(p))).alias("rank")) for name, p in shares.items()))
    sought = sums.select(F.col("g").alias("o_g"), F.col("__range").alias("o___range"), "n", "upto", F.explode(wanted).alias("w"))
    sought = sought.filter((F.col("w.rank") <= F.col("upto")) & (F.col("w.rank") > F.col("upto") - F.col("n"))).select("o_g", "o___range", "w.name", (F.col("w.rank") - (F.col("upto") - F.col("n"))).alias("rank"))
    inside = saved.filter("v is not null").withColumn("cum", F.sum("n").over(Window.partitionBy("g", "__range").orderBy("v")))
    found = inside.join(sought, _same(["g", "__range"])).filter("cum >= rank").groupBy("g", "name").agg(F.min("v").alias("v"))
    by_group = found.groupBy("g").agg(*(F.max(F.when(F.col("name") == name, F.col("v"))).alias(name) for name in shares))
    groups = sums.groupBy(F.col("g").alias("o_g")).agg(F.lit(1).alias("__one"))
    return groups.join(by_group, _same(["g"]), "left").select(F.col("o_g").alias(group), *shares)
