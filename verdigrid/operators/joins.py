"""Equi-joins that hold up when one side is too big or one key too frequent."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdigrid.shared import written

MAX_BROADCAST_BYTES = 32 * 1024 * 1024
MAX_LITERAL_VALUES = 1_000
#: Rows of one key that a task takes, and the most keys that can be called hot.
TASK_ROWS = 1_000_000
MAX_HOT_KEYS = 100_000

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _width(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, _FIXED_WIDTH):
        return F.lit(16)
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + 16


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows as they would travel, from one distributed aggregate."""
    width = F.lit(0)
    for field in df.schema.fields:
        width = width + _width(field)
    return df.agg(F.sum(width.cast("long")).alias("bytes")).first()["bytes"] or 0


def small_side_join(
    big: DataFrame,
    small: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Broadcast ``small`` only if its measured size is within ``max_bytes``.

    Beyond the bound the join carries no hint: it shuffles, and adaptive
    execution splits skewed partitions.
    """
    if measured_bytes(small) <= max_bytes:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


def hot_keys(df: DataFrame, keys: Sequence[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """Keys with more rows than one task should take, and ``_salts``: tasks they need.

    Grouped counts are written once. Where more than ``MAX_HOT_KEYS`` keys could pass
    the target, it is raised to that part of all rows, so the result stays small
    whatever the table; tasks then take up to the raised target. Keys with a null are left out: they match nothing.
    """
    counts = written(df.groupBy(*keys).agg(F.count("*").alias("_rows")), "key-counts")
    total = counts.agg(F.sum("_rows").alias("_total")).first()["_total"] or 0
    target = max(task_rows, -(-total // MAX_HOT_KEYS))
    hot = counts.filter(F.col("_rows") > target).dropna("any", subset=list(keys))
    return hot.select(*keys, F.ceil(F.col("_rows") / target).cast("int").alias("_salts"))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    task_rows: int = TASK_ROWS,
    strategy: str | None = None,
) -> DataFrame:
    """Equi-join that deals the rows of each hot key out to tasks of ``task_rows`` rows.

    ``spread_by`` names columns of ``big`` that tell rows of one key apart. A key of n
    rows has ceil(n / ``task_rows``) salts; only its rows of ``small`` are repeated, once
    per salt (more rows a salt in tables beyond ``MAX_HOT_KEYS`` times that, see
    ``hot_keys``). Rows without a key match nothing and are spread freely. ``strategy`` may
    ask for a join hint such as ``merge``. ``small`` must not be the preserved side of an
    outer join, because its repeated rows would show up as unmatched copies.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join cannot preserve the repeated side: {how}")
    on = list(on)
    hot = hot_keys(big, on, task_rows)
    if measured_bytes(hot) <= MAX_BROADCAST_BYTES:
        hot = F.broadcast(hot)
    drawn = F.xxhash64(*spread_by)
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    salts = F.when(no_key, F.lit(MAX_HOT_KEYS)).otherwise(F.coalesce("_salts", F.lit(1)))
    big_salted = big.join(hot, on, "left").withColumn("_salt", F.pmod(drawn, salts).cast("int"))
    last = F.coalesce("_salts", F.lit(1)) - 1
    small_salted = (
        small.join(hot, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
        .drop("_salts")
    )
    if strategy:
        small_salted = small_salted.hint(strategy)
    return big_salted.drop("_salts").join(small_salted, [*on, "_salt"], how).drop("_salt")


def copartitioned_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], partitions: int, how: str = "inner"
) -> DataFrame:
    """Lay both sides out by the join key first, so the join adds no shuffle.

    Meant for sides with at most one row per key (aggregate before calling): an
    explicit layout is not split by adaptive execution, so a frequent key would
    stay in one partition. Use ``salted_join`` where keys repeat.
    """
    on = list(on)
    placed = right.repartition(partitions, *on).hint("merge")
    return left.repartition(partitions, *on).join(placed, on, how)


def with_each(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    """Every row once per value: the product with a literal list.

    A short list is written into the plan, so the product needs neither a join nor a
    shuffle. A longer one is a table of lists of ``MAX_LITERAL_VALUES`` values: every row
    meets each list by its number, in an equi-join, and is then repeated per value.
    """
    if len(values) <= MAX_LITERAL_VALUES:
        return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    starts = range(0, len(values), MAX_LITERAL_VALUES)
    lists = [(k, list(values[a : a + MAX_LITERAL_VALUES])) for k, a in enumerate(starts)]
    table = written(df.sparkSession.createDataFrame(lists, ["_list", "_values"]), "literal-lists")
    numbers = F.sequence(F.lit(0), F.lit(len(lists) - 1)).cast("array<long>")
    return (
        df.withColumn("_list", F.explode(numbers))
        .join(table, "_list")
        .withColumn(name, F.explode("_values"))
        .drop("_list", "_values")
    )
