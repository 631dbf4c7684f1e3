"""Words and lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def words(df: DataFrame, column: str, min_length: int = 3) -> DataFrame:
    """Lower-cased words split at blanks, one row each; short ones are left out."""
    parts = F.split(F.lower(F.col(column)), r"\s+")
    return df.select(F.explode(parts).alias("word")).filter(F.length("word") >= min_length)


def word_counts(df: DataFrame, column: str, min_length: int = 3) -> DataFrame:
    """Occurrences per word; counted inside each partition before the shuffle."""
    return words(df, column, min_length).groupBy("word").agg(F.count("*").alias("n"))
