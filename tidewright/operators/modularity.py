"""Communities by modularity, to the end: pairs that gain most from each other merge, until none gains.

1. Every node begins as its own community. Of each link between communities the gain
   of merging is an exact integer, ``2 m w - k_a k_b``.
2. Every community names the neighbour it gains most with; ties go to the pair with the
   smaller ids, so that all agree on an order of pairs. Two that name each other merge. Such pairs are
   disjoint, so that modularity grows by the sum of their gains, and the best pair of
   all is always among them: rounds end by themselves, and give the same result each time.
3. Merged communities become one node with the links of both. Each round is written.

The graph is taken without directions, repeated links and loops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch

_EXACT = "decimal(38,0)"


def _links(edges: DataFrame) -> DataFrame:
    ends = edges.filter("src is not null and dst is not null and src <> dst")
    return ends.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()


def modularity(edges: DataFrame, labels: DataFrame) -> float:
    """Of ``labels(node, label)``: the share of links within communities beyond what the nodes' degrees make likely."""
    links = _links(edges)
    of = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias(f"l{end}"))
    named = links.join(of("a"), "a").join(of("b"), "b")
    halves = named.select(F.explode(F.array("la", "lb")).alias("label"), (F.col("la") == F.col("lb")).cast("long").alias("inside"))
    sums = halves.groupBy("label").agg(F.count(F.lit(1)).alias("k"), F.sum("inside").alias("twice"))
    r = sums.agg(F.sum("k").alias("all"), F.sum("twice").alias("inside"), F.sum(F.col("k").cast("double") * F.col("k")).alias("squares")).first()
    return r["inside"] / r["all"] - r["squares"] / r["all"] ** 2 if r["all"] else 0.0


def modular_communities(edges: DataFrame) -> DataFrame:
    """``node, label``: the label is the smallest node of the community. Nodes without a link to another are alone."""
    scratch = Scratch(edges.sparkSession, "modularity")
    links = scratch.save(_links(edges).withColumn("w", F.lit(1).cast("long")), "links")
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("node")).filter("node is not null").distinct()
    member = scratch.save(nodes.withColumn("label", F.col("node")), "member")
    m = links.count()
    strength = scratch.save(links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("k")), "strength")
    while m:
        k = lambda end: strength.select(F.col("node").alias(end), F.col("k").cast(_EXACT).alias(f"k{end}"))
        gain = F.col("w").cast(_EXACT) * F.lit(2 * m) - F.col("ka") * F.col("kb")
        good = links.join(k("a"), "a").join(k("b"), "b").select("a", "b", gain.cast(_EXACT).alias("gain")).filter("gain > 0")
        order = F.struct(-F.col("gain"), F.col("a"), F.col("b"))
        sides = good.select(F.inline(F.array(F.struct(F.col("a").alias("node"), order.alias("o")), F.struct(F.col("b").alias("node"), order.alias("o")))))
        best = sides.groupBy("node").agg(F.min("o").alias("o"))
        # A pair that both its ends name.
        pairs = best.groupBy(F.col("o.a").alias("a"), F.col("o.b").alias("b")).agg(F.count(F.lit(1)).alias("n")).filter("n = 2").select(F.col("b").alias("node"), F.col("a").alias("into"))
        merged = scratch.save(pairs, "merged")
        if merged.isEmpty():
            break

        def moved(rows: DataFrame, column: str, merged: DataFrame = merged) -> DataFrame:
            to = merged.select(F.col("node").alias(column), "into")
            return rows.join(to, column, "left").withColumn(column, F.coalesce("into", column)).drop("into")

        both = moved(moved(links, "a"), "b").filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "w")
        old = (links, member, strength, merged)
        links = scratch.save(both.groupBy("a", "b").agg(F.sum("w").alias("w")), "links")
        member = scratch.save(moved(member, "label").select("node", "label"), "member")
        strength = scratch.save(moved(strength, "node").groupBy("node").agg(F.sum("k").alias("k")), "strength")
        scratch.drop(*old)
    return member
