"""Connected components as a sequence of contractions, all in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, root)`` for every node that occurs in ``links(a, b)``.

    Each round every node points to its smallest neighbour (or itself), and the
    links are rewritten to those parents. Node ids should be in random order
    (hashes), so that a round removes a fixed share of the nodes. Null ends are
    ignored; repeated links and loops do no harm; no links give no rows. A node
    with a third of all links costs no more than the others: the minimum is
    combined before the shuffle, and joins on a hot end are split by AQE.
    """
    edges = scratch.save(links.filter("a is not null and b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    levels: list[DataFrame] = []
    while True:
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        parent = scratch.save(ends.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("root")), "parents")
        levels.append(parent)
        rest = (
            edges.filter("a <> b")
            .join(parent.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
            .join(parent.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
            .filter("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct()
        )
        rest = scratch.save(rest, "links")
        scratch.drop(edges)
        edges = rest
        if edges.isEmpty():
            break
    scratch.drop(edges)
    found = levels[0]
    for level in levels[1:]:
        step = level.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    out = scratch.save(found, "components")
    scratch.drop(*levels)
    return out
