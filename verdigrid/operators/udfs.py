"""Arrow-batched user functions, for logic that built-in functions lack."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdigrid.sources.readers import inline_table

MAX_MAPPING = 10_000


def lookup_udf(mapping: Mapping[str, str], default: str):
    """A vectorised scalar function: the mapped value, or ``default``."""
    if len(mapping) > MAX_MAPPING:
        raise ValueError("a mapping this long belongs in a table: use a join")
    fixed = dict(mapping)

    @F.pandas_udf(T.StringType())
    def look_up(codes: pd.Series) -> pd.Series:
        return codes.map(fixed).fillna(default)

    return look_up


def look_up_column(
    df: DataFrame, column: str, mapping: Mapping[str, str], default: str, name: str
) -> DataFrame:
    """Add ``name``: what ``column`` maps to, or ``default`` (also for null).

    A mapping of up to ``MAX_MAPPING`` entries travels with a vectorised function; a
    longer one becomes a table and a left join.
    """
    if len(mapping) <= MAX_MAPPING:
        return df.withColumn(name, lookup_udf(mapping, default)(column))
    table = inline_table(df.sparkSession, list(mapping.items()), f"`{column}` string, `{name}` string")
    return df.join(table, column, "left").withColumn(name, F.coalesce(name, F.lit(default)))


def percent_of(df: DataFrame, value: str, whole: float, name: str) -> DataFrame:
    """``value`` in percent of ``whole``: set up once per partition, then batch by batch."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])

    def scaled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        factor = 100.0 / whole  # the one set-up of this partition
        for batch in batches:
            yield batch.assign(**{name: batch[value] * factor})

    return df.mapInPandas(scaled, schema)
