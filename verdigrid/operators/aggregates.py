"""Numeric summaries in a single grouped pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, min and max as numbers, one row per column."""
    measures = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("stddev"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            )
            for c in columns
        ]
    )
    return df.agg(measures.alias("m")).select(F.inline("m"))


def population_stats(column: str) -> list[Column]:
    """count, sum, min, max, mean and the population deviation and variance."""
    return [
        F.count(column).alias("count"),
        F.sum(column).alias("sum"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
        F.avg(column).alias("mean"),
        F.stddev_pop(column).alias("stdev"),
        F.var_pop(column).alias("variance"),
    ]


def fold_sum(column: str | Column) -> Column:
    """Sum with neutral element 0, also for empty input."""
    return F.coalesce(F.sum(column), F.lit(0))


def fold_product(column: str | Column) -> Column:
    """Product with neutral element 1, also for empty input."""
    return F.coalesce(F.product(column), F.lit(1.0))


def exact_sum(value: Column) -> Column:
    """The sum of doubles that are decimals of at most six places, without rounding on the way.

    Added as doubles, cents are lost once a total has some twelve digits. Where any value
    has more places or is no number, all are added as doubles.
    """
    places = value.try_cast("decimal(28,6)")
    exact = F.when(places.cast("double") == value, places)
    return F.when(F.count(exact) == F.count(value), F.sum(exact).cast("double")).otherwise(F.sum(value))
