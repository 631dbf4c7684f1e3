"""Operators on key/value tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pandas.core.groupby import DataFrameGroupBy
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdigrid.shared import written


def _with_chunk(
    df: DataFrame, keys: Sequence[str], value: str, spread_by: Sequence[str], chunk_rows: int
) -> DataFrame:
    """Add ``chunk``: the row's place among its key's rows, divided by ``chunk_rows``.

    One rule for all keys, rows without a key counting as one key. Rows are
    range-partitioned by key, value and ``spread_by``, so a frequent key lies in
    several partitions; they are numbered there and written once. What a key has in
    the partitions before (one row per partition and key) is then added.
    """
    return _chunked(_placed(df, keys, value, spread_by), keys, chunk_rows)


def _placed(df: DataFrame, keys: Sequence[str], value: str, spread_by: Sequence[str]) -> DataFrame:
    order = [*keys, value, *(c for c in spread_by if c not in (*keys, value))]
    return written(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id()),
        "placed",
    )


def _chunked(placed: DataFrame, keys: Sequence[str], chunk_rows: int) -> DataFrame:
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*keys, "_part")
        .agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
        .select(
            *[F.col(k).alias(f"_{k}") for k in keys],
            F.col("_part").alias("_in"),
            (F.col("_first") - F.coalesce(F.sum("_rows").over(before), F.lit(0))).alias("_start"),
        )
    )
    same_key = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys],
        F.col("_part") == F.col("_in"),
    )
    chunk = F.floor((F.col("_place") - F.col("_start")) / chunk_rows).cast("long")
    return placed.join(starts, same_key).withColumn("chunk", chunk)


def _sorted_values(df: DataFrame, value: str, present: Column) -> Column:
    """The values of a group in order, missing ones first.

    ``present`` is null for rows that belong to the other side. A collected list
    leaves missing values out, so they are counted and put back.
    """
    missing = F.lit(None).cast(df.schema[value].dataType)
    absent = (F.count(present) - F.count(value)).cast("int")
    return F.concat(F.array_repeat(missing, absent), F.sort_array(F.collect_list(value)))


def group_values(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    spread_by: Sequence[str],
    chunk_rows: int = 100_000,
) -> DataFrame:
    """All values of each key as sorted lists of at most ``chunk_rows`` values.

    Result: keys, ``chunk``, ``values``. A key of n rows has exactly
    ceil(n / chunk_rows) lists, all but the last full; chunk 0 holds its smallest
    values, missing ones first. ``spread_by`` names columns that tell rows of equal
    key and value apart; they only help to deal out such rows.
    """
    chunked = _with_chunk(df, keys, value, spread_by, chunk_rows)
    values = _sorted_values(chunked, value, F.lit(1))
    return chunked.groupBy(*keys, "chunk").agg(values.alias("values"))


def cogroup_values(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_value: str,
    right_value: str,
    left_spread: Sequence[str],
    right_spread: Sequence[str],
    chunk_rows: int = 100_000,
) -> DataFrame:
    """Both sides' values per key, a side without the key giving an empty list.

    Result: keys, ``chunk``, ``left_values``, ``right_values``; chunks as in
    ``group_values``. Both sides are put together and grouped once.
    """

    def side(df: DataFrame, value: str, spread_by: Sequence[str], name: str) -> DataFrame:
        chunked = _with_chunk(df, keys, value, spread_by, chunk_rows)
        return chunked.select(*keys, "chunk", F.col(value).alias(name), F.lit(1).alias(f"{name}_row"))

    both = side(left, left_value, left_spread, "_left").unionByName(
        side(right, right_value, right_spread, "_right"), allowMissingColumns=True
    )
    return both.groupBy(*keys, "chunk").agg(
        _sorted_values(both, "_left", F.col("_left_row")).alias("left_values"),
        _sorted_values(both, "_right", F.col("_right_row")).alias("right_values"),
    )


def cogroup_map(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_value: str,
    right_value: str,
    left_spread: Sequence[str],
    right_spread: Sequence[str],
    function: Callable[[pa.Table, pa.Table], pa.Table],
    schema: T.StructType | str,
    chunk_rows: int = 100_000,
    bundle_rows: int | None = None,
) -> DataFrame:
    """Both sides of each key through a function of Arrow tables, a bounded chunk at a time.

    Each side is cut as in ``group_values``: chunk i holds a key's i-th ``chunk_rows``
    rows in the order of the value (missing values first), so both tables of a call hold
    the same places. They have the keys, ``chunk``, ``place`` (of the row among its key's
    rows, from 0) and the value, in that order of places; a side without rows there is an
    empty table. Rows without a key are one key. The function's tables must fit
    ``schema``; what needs a key's chunks together is a grouping of the result.

    A call costs a group of its own in Spark, which many short chunks make dear. With
    ``bundle_rows`` a call gets all chunks of a bundle: whole chunks of any keys, dealt out
    by a hash, some ``bundle_rows`` rows of both sides together, in no order. The number
    of calls then grows with the rows, not with the chunks.
    """
    placed = [
        _placed(left, keys, left_value, left_spread),
        _placed(right, keys, right_value, right_spread),
    ]
    place = (F.col("_place") - F.col("_start")).alias("place")
    sides = [
        _chunked(p, keys, chunk_rows).select(*keys, "chunk", place, value)
        for p, value in zip(placed, (left_value, right_value))
    ]
    if bundle_rows is None:

        def both(first: pa.Table, second: pa.Table) -> pa.Table:
            return function(first.sort_by("place"), second.sort_by("place"))

        first, second = (c.groupBy(*keys, "chunk") for c in sides)
        return first.cogroup(second).applyInArrow(both, schema)

    bundles = max(1, -(-sum(p.count() for p in placed) // bundle_rows))
    bundle = F.pmod(F.xxhash64(*keys, "chunk"), F.lit(bundles)).alias("_bundle")

    def bundled(first: pa.Table, second: pa.Table) -> pa.Table:
        return function(first.drop_columns("_bundle"), second.drop_columns("_bundle"))

    first, second = (c.select("*", bundle).groupBy("_bundle") for c in sides)
    return first.cogroup(second).applyInArrow(bundled, schema)


def combine_by_key(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    create: Callable[[DataFrameGroupBy], pd.DataFrame],
    merge: Callable[[DataFrameGroupBy], pd.DataFrame],
    finish: Callable[[pd.DataFrame], pd.Series],
    state: T.StructType,
    result: T.StructField,
    salts: int = 32,
    max_open_keys: int = 50_000,
) -> DataFrame:
    """A custom aggregate with its own state type, combined in three steps.

    All three functions work on many keys at once: ``create`` turns ``columns``
    grouped by key into one state per key, ``merge`` does the same for states,
    ``finish`` turns states into results.

    1. Inside each input partition states are merged batch by batch; no rows are
       shuffled, only states. About ``max_open_keys`` states are held at once.
    2. States meet per (key, salt), so a hot key is merged by ``salts`` tasks.
    3. The last merge sees at most ``salts`` states of a key.

    Steps 2 and 3 pass over sorted states and hold one batch at a time.
    """
    names = [f.name for f in state.fields]
    # as text, a key with nulls keeps its exact value on the way through pandas
    key_text = T.StructField(key, T.StringType())
    states_schema = T.StructType([key_text, T.StructField("_salt", T.IntegerType()), *state.fields])

    def per_key(frame: pd.DataFrame, function) -> pd.DataFrame:
        grouped = frame.groupby(key, dropna=False, sort=False)
        states = function(grouped).reset_index()[[key, *names]]
        # plain objects: Arrow-backed strings come back from pandas in chunks
        return states.astype({key: object})

    def partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId() % salts
        held = None
        for batch in batches:
            if batch.empty:
                continue
            new = per_key(batch, create)
            held = new if held is None else per_key(pd.concat([held, new]), merge)
            if len(held) > max_open_keys:
                yield held.assign(_salt=salt)
                held = None
        if held is not None:
            yield held.assign(_salt=salt)

    def merge_sorted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None  # the newest key may go on in the next batch
        for batch in batches:
            if batch.empty:
                continue
            merged = per_key(batch if last is None else pd.concat([last, batch]), merge)
            yield merged.iloc[:-1]
            last = merged.iloc[-1:]
        if last is not None:
            yield last

    def merge_salts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for merged in merge_sorted(batches):
            yield merged.assign(_salt=0)

    def finish_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for merged in merge_sorted(batches):
            yield pd.DataFrame({key: merged[key], result.name: finish(merged)})

    combined = (
        df.select(F.col(key).cast("string").alias(key), *columns)
        .mapInPandas(partials, states_schema)
        .repartition(key, "_salt")
        .sortWithinPartitions(key)
        .mapInPandas(merge_salts, states_schema)
        .repartition(key)
        .sortWithinPartitions(key)
        .mapInPandas(finish_keys, T.StructType([key_text, result]))
    )
    return combined.withColumn(key, F.col(key).cast(df.schema[key].dataType))
