"""Wide to long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack_columns(
    df: DataFrame, keep: Sequence[str], columns: Sequence[str], name: str, value: str
) -> DataFrame:
    """One row per (row, column) with a value; empty cells are dropped."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    kept = [f"`{c}`" for c in keep]
    long = df.selectExpr(*kept, f"stack({len(columns)}, {pairs}) as (`{name}`, `{value}`)")
    return long.filter(F.col(value).isNotNull())
