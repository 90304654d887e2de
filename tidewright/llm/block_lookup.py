"""Rows that look up values of many shared keys, block by block.

A block is a bounded run of rows that one task has seen together. Its rows name
keys by their places in the block's dictionary, and only the dictionaries, one
entry for each distinct key of a block, are shuffled and joined with what is
known of a key: a key that all rows hold costs one entry a block.

A table of blocks has the columns ``block`` and, in the first row of a block,
the arrays of its dictionary (null in the others).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Join = Callable[[pa.Table, pa.Table], pa.Table]


def numbers() -> Iterator[int]:
    """Numbers of blocks that no other task of the stage gives."""
    from pyspark import TaskContext

    context = TaskContext.get()
    return count((context.partitionId() if context else 0) << 33)


def entries(blocks: DataFrame, *arrays: str) -> DataFrame:
    """``block``, ``place`` and the entry of each array there."""
    zipped = F.arrays_zip(*arrays)
    rows = blocks.filter(F.col(arrays[0]).isNotNull()).select("block", F.posexplode(zipped).alias("place", "__entry"))
    return rows.select("block", "place", *(F.col("__entry")[a].alias(a) for a in arrays))


def look_up(blocks: DataFrame, found: DataFrame, join: Join, schema: T.StructType) -> DataFrame:
    """``join`` on the rows of each block and its entries, which come ordered by their places."""

    def ordered(rows: pa.Table, values: pa.Table) -> pa.Table:
        return join(rows, values.sort_by("place"))

    apart = found.withColumnRenamed("block", "__block")  # both may come from one table
    return blocks.groupBy("block").cogroup(apart.groupBy("__block")).applyInArrow(ordered, schema)
