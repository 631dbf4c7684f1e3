"""Flattening of nested columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_structs(df: DataFrame) -> DataFrame:
    """One column per leaf, named ``parent_child``; arrays and maps stay as they are.

    The schema is walked once and the result is a single projection. Field names
    may contain dots. Two leaves with the same flat name are an error.
    """
    leaves: list[tuple[str, str]] = []

    def walk(fields, path: list[str], names: list[str]) -> None:
        for field in fields:
            here = [*path, f"`{field.name}`"]
            flat = [*names, field.name]
            if isinstance(field.dataType, T.StructType):
                walk(field.dataType.fields, here, flat)
            else:
                leaves.append((".".join(here), "_".join(flat)))

    walk(df.schema.fields, [], [])
    names = [name for _, name in leaves]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"flat names used twice: {clashes}")
    return df.select(*[F.col(path).alias(name) for path, name in leaves])
