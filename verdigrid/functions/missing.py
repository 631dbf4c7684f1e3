"""Null and NaN, which Spark keeps apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_missing(column: Column) -> Column:
    """Null or NaN."""
    return column.isNull() | F.isnan(column)


def clean_number(column: Column, default: float = 0.0) -> Column:
    """``default`` in place of null and NaN."""
    return F.when(column.isNull(), F.lit(default)).when(F.isnan(column), F.lit(default)).otherwise(column)


def number_status(column: Column) -> Column:
    """One of missing, not a number, negative, ok."""
    return (
        F.when(column.isNull(), "missing")
        .when(F.isnan(column), "not a number")
        .when(column < 0, "negative")
        .otherwise("ok")
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Number of nulls per column, one row, one pass."""
    return df.select(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])


def clean_table(df: DataFrame, fills: dict, number: str, required: str) -> DataFrame:
    """Drop rows without any value, fill gaps, clean one number, require one column."""
    return (
        df.na.drop("all")
        .na.fill(fills)
        .withColumn(number, clean_number(F.col(number)))
        .na.drop(subset=[required])
    )
