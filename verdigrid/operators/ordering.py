"""Row numbers, positional zip and exact-size samples without a global sort task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from verdigrid.operators.layout import task_count
from verdigrid.shared import written

_POSITION_BITS = 33
#: Hexadecimal digits that a share of all draws is rounded to.
_DIGITS = 12
#: Rows that one task merges from the heaps of all tasks.
HEAP_ROWS = 10_000_000


def index_rows(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str = "index",
    partitions: int | None = None,
) -> DataFrame:
    """Number all rows 0, 1, 2, ... in the order of ``order_by``.

    ``order_by`` may name columns or say direction and place of nulls; it must
    order the rows uniquely. Rows are range-partitioned and
    sorted, numbered inside their partition, and written once; the numbers of
    rows in the partitions before (one row per partition) are then added. The
    written table keeps the numbers fixed when a task is run again.
    """
    ranges = partitions or task_count(df)
    placed = (
        df.repartitionByRange(ranges, *order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_part", F.spark_partition_id().cast("long"))
        # The id begins at the partition's number times 2 ** 33; the difference is the
        # position also in a partition of more rows than that.
        .withColumn(
            "_place",
            F.monotonically_increasing_id() - F.shiftleft("_part", _POSITION_BITS),
        )
    )
    placed = written(placed, "indexed")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    # one row per range partition, so a single ordered window is bounded
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place"))
        .drop("_part", "_place", "_offset")
    )


def zip_rows(
    left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str]
) -> DataFrame:
    """Pair the n-th row of each side; the run fails if one side is longer."""
    lefts = index_rows(left, left_order, "_index").withColumn("_left", F.lit(True))
    rights = index_rows(right, right_order, "_index").withColumn("_right", F.lit(True))
    unequal = F.raise_error("zip_rows: the sides have different lengths").cast("boolean")
    paired = F.when(F.col("_left") & F.col("_right"), F.lit(True)).otherwise(unequal)
    return lefts.join(rights, "_index", "full").filter(paired).drop("_index", "_left", "_right")


def _draw(seed: int, *columns: str) -> Column:
    """A uniform hexadecimal key that any engine with MD5 can reproduce."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))


def _quantile(share: float) -> str:
    """A key that about ``share`` of all draws lie below."""
    if share >= 1:
        return "g"  # beyond every hexadecimal digit
    return format(int(max(share, 0.0) * 16**_DIGITS), f"0{_DIGITS}x")


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 7) -> DataFrame:
    """Exactly ``n`` random rows without replacement, the same for any layout.

    ``key`` must identify a row. The rows with the ``n`` smallest draws are taken. Where
    the ``n`` best rows of all tasks together are at most ``HEAP_ROWS``, one pass keeps
    them in a heap per task. Otherwise: draws are uniform, so the n-th of N lies close to n / N: a count of the rows gives a band
    around it, some six standard deviations wide, and one aggregate counts the draws
    below the band and in it. Rows below are filtered, and only the band is sorted; it
    has a few times the square root of ``n`` rows. Should the n-th draw lie outside, the
    band is widened. All rows are returned if there are fewer.
    """
    drawn = df.withColumn("_draw", _draw(seed, *key))
    if n * task_count(df) <= HEAP_ROWS:
        return drawn.orderBy("_draw", *key).limit(n).drop("_draw")
    total = df.count()
    if n >= total:
        return df
    slack = 6 * n**0.5 + 30
    while True:
        low, high = _quantile((n - slack) / total), _quantile((n + slack) / total)
        below, within = drawn.agg(
            F.count_if(F.col("_draw") < low), F.count_if(F.col("_draw") < high)
        ).first()
        if below <= n <= within:
            break
        slack *= 4
    sure = drawn.filter(F.col("_draw") < low)
    band = drawn.filter((F.col("_draw") >= low) & (F.col("_draw") < high))
    rest = band.orderBy("_draw", *key).limit(n - below)
    return sure.unionByName(rest).drop("_draw")


def sample_rows_with_replacement(
    df: DataFrame, n: int, key: Sequence[str], seed: int = 7
) -> DataFrame:
    """Exactly ``n`` random rows, each drawn from all of them; none of an empty table.

    Draw i takes the row at the position that the first 15 hexadecimal digits of its MD5
    give, modulo the number of rows, in the order of ``key``, which must identify a row.
    """
    indexed = index_rows(df, key, "_index")
    total = indexed.count()
    if total == 0:
        return df
    drawn = F.conv(F.substring(_draw(seed, "id"), 1, 15), 16, 10).cast("long")
    draws = df.sparkSession.range(n).select((drawn % total).alias("_index"))
    return draws.join(indexed, "_index").drop("_index")
