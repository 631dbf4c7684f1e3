"""Conditional columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def banded(column: str, floors: Sequence[tuple[float, str]], lowest: str) -> Column:
    """The label of the first floor the value exceeds, else ``lowest``.

    Floors are tried in the given order, so list them from high to low.
    """
    (floor, label), *others = floors
    branches = F.when(F.col(column) > floor, label)
    for floor, label in others:
        branches = branches.when(F.col(column) > floor, label)
    return branches.otherwise(lowest)


def literal_lookup(column: Column, mapping: Mapping[str, str], default: str) -> Column:
    """A short mapping written into the plan; unknown codes give ``default``."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(pairs, column), F.lit(default))
