"""Set operations on whole rows, nulls equal to nulls.

Both sides are tagged, put together and grouped once. Copies of a row are merged
inside each input partition, so a row repeated very often is shuffled once per
partition, and no join is needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _copies_per_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row per distinct row, with its number of copies on each side."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    lefts = left.withColumns({"_left": one, "_right": none})
    rights = right.toDF(*left.columns).withColumns({"_left": none, "_right": one})
    return (
        lefts.union(rights)
        .groupBy(*left.columns)
        .agg(F.sum("_left").alias("_left"), F.sum("_right").alias("_right"))
    )


def intersect_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows found on both sides."""
    both = _copies_per_side(left, right).filter((F.col("_left") > 0) & (F.col("_right") > 0))
    return both.drop("_left", "_right")


def difference_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left rows not found on the right, with all their copies."""
    kept = _copies_per_side(left, right).filter((F.col("_left") > 0) & (F.col("_right") == 0))
    return repeat_rows(kept.drop("_right"), "_left")


def repeat_rows(df: DataFrame, times: str, block: int = 65_536) -> DataFrame:
    """Each row ``times`` times.

    A row first becomes one row per started block of copies; the blocks are
    spread over all partitions and only then laid out, so the copies of a single
    very frequent row are produced by many tasks.
    """
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / block))
    # Adaptive execution merges small partitions; splitting needs no count, because
    # the hint makes partitions of the advisory size.
    spread = df.withColumn("_block", F.explode(blocks)).hint("rebalance")
    here = F.least(F.lit(block).cast("long"), F.col(times) - F.col("_block") * block)
    copies = F.explode(F.sequence(F.lit(1).cast("long"), here))
    return spread.withColumn("_copy", copies).drop("_block", "_copy", times)


def union_many(tables: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union of several tables by column name."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), tables
    )
