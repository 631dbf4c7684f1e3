"""Connected components of a link table, by alternating stars.

Each round hangs every node's larger neighbours on its smallest neighbour (large
star), then every node and its smaller neighbours on the smallest of them (small
star). Rounds grow with the logarithm of the longest chain. Minima are combined
before the shuffle, so a hub costs one row per task. They are written before they are
joined: both sides are then plain shuffles, and adaptive execution splits a hub's links
over many tasks or broadcasts few minima. Every step is a written table, so a lost
executor repeats one step at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigrid.shared import written


def _mark(edges: DataFrame) -> tuple:
    """Number and an order-free digest of the edges; both count as equal if unchanged."""
    row = edges.select(
        F.count("*"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")),
    ).first()
    return tuple(row)


def _hung(pairs: DataFrame) -> DataFrame:
    """Every (u, v) of ``pairs`` with the smallest of u and all of u's v as ``m``."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return pairs.join(written(least, "least"), "u")


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v; long, in any direction) to (u, root), root the smallest node.

    Roots themselves are left out. An empty table gives an empty one; a link of a
    node to itself, repeated links and links with a null end change nothing.
    """
    edges = written(
        links.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    before = _mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _hung(both)
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = written(large, "large-star")
        small = _hung(large)
        edges = written(
            small.where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v")))
            .distinct(),
            "small-star",
        )
        now = _mark(edges)
        if now == before:
            break
        before = now
    return edges.select("u", F.col("v").alias("root"))
