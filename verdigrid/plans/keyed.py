"""Key/value operators."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from verdigrid.operators.keyed import cogroup_map, cogroup_values, group_values
from verdigrid.plans.registry import Tables, query

_CHUNK = 1_000
# Short enough that customers of any table have several lists.
_LISTED = 4
# Rows of many customers that one call compares.
_BUNDLED = 20_000


def pairs(t: Tables):
    """Key: priority (five values, each frequent). Value: price."""
    return t.orders.select(
        F.col("o_orderpriority").alias("k"), F.col("o_totalprice").alias("v"), F.col("o_orderkey").alias("id")
    )


_PAIRS = "SELECT o_orderpriority AS k, o_totalprice AS v FROM orders"


@query("kv_map_values", "SELECT o_orderpriority AS k, o_totalprice * 1.1::DOUBLE AS v FROM orders")
def map_values(t: Tables):
    return pairs(t).withColumn("v", F.col("v") * 1.1).select("k", "v")


@query(
    "kv_flat_map_values",
    "SELECT o_orderpriority AS k, unnest([o_totalprice, o_totalprice * 2]) AS v FROM orders",
)
def flat_map_values(t: Tables):
    return pairs(t).select("k", F.explode(F.array("v", F.col("v") * 2)).alias("v"))


@query(
    "kv_keys_values",
    """SELECT 'key' AS part, o_orderpriority AS content FROM orders
       UNION ALL SELECT 'value', o_orderstatus FROM orders""",
)
def keys_values(t: Tables):
    kv = t.orders.select(F.col("o_orderpriority").alias("k"), F.col("o_orderstatus").alias("v"))
    keys = kv.select(F.lit("key").alias("part"), F.col("k").alias("content"))
    return keys.union(kv.select(F.lit("value"), "v"))


@query(
    "kv_group_values",
    f"""WITH placed AS (SELECT k, v, (row_number() OVER (PARTITION BY k ORDER BY v) - 1)
              // {_CHUNK} AS chunk FROM ({_PAIRS}))
        SELECT k, chunk, count(*) AS n, round(sum(v), 2) AS total, min(v) AS lowest,
               max(v) AS highest, true AS in_order FROM placed GROUP BY 1, 2""",
)
def group_values_(t: Tables):
    """All values of a key as lists of bounded length, each list summed up."""
    lists = group_values(pairs(t), ["k"], "v", spread_by=["id"], chunk_rows=_CHUNK)
    summed = F.aggregate("values", F.lit(0.0), lambda a, b: a + b)
    return lists.select(
        "k",
        "chunk",
        F.size("values").cast("long").alias("n"),
        F.round(summed, 2).alias("total"),
        F.array_min("values").alias("lowest"),
        F.array_max("values").alias("highest"),
        (F.sort_array("values") == F.col("values")).alias("in_order"),
    )


@query("kv_reduce", f"SELECT k, round(sum(v), 2) AS total, max(v) AS highest FROM ({_PAIRS}) GROUP BY k")
def reduce_(t: Tables):
    return pairs(t).groupBy("k").agg(F.round(F.sum("v"), 2).alias("total"), F.max("v").alias("highest"))


@query(
    "kv_sum_count_avg",
    f"""SELECT k, round(sum(v), 2) AS total, count(*) AS n, round(sum(v) / count(*), 6) AS mean
        FROM ({_PAIRS}) GROUP BY k ORDER BY k""",
)
def sum_count_avg(t: Tables):
    return (
        pairs(t)
        .groupBy("k")
        .agg(F.sum("v").alias("s"), F.count("*").alias("n"))
        .select("k", F.round("s", 2).alias("total"), "n", F.round(F.col("s") / F.col("n"), 6).alias("mean"))
        .orderBy("k")
    )


@query(
    "kv_frequency",
    """SELECT 'value' AS counted, event_type AS item, count(*) AS n FROM events GROUP BY 2
       UNION ALL SELECT 'key', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY 2""",
)
def frequency(t: Tables):
    def counted(label: str, column: str):
        counts = t.events.groupBy(F.col(column).cast("string").alias("item")).count()
        return counts.select(F.lit(label).alias("counted"), "item", F.col("count").alias("n"))

    return counted("value", "event_type").unionByName(counted("key", "user_id"))


# The sides' keys overlap in part: customers' nations start at 3, suppliers' at 0.
_SIDES = """a AS (SELECT c_nationkey + 3 AS k, count(*) AS v FROM customer GROUP BY 1),
            b AS (SELECT s_nationkey AS k, count(*) AS w FROM supplier GROUP BY 1)"""


@query(
    "kv_joins",
    f"""WITH {_SIDES}
        SELECT 'inner' AS how, k, v, w FROM a JOIN b USING (k)
        UNION ALL SELECT 'left', k, v, w FROM a LEFT JOIN b USING (k)
        UNION ALL SELECT 'right', k, v, w FROM a RIGHT JOIN b USING (k)
        UNION ALL SELECT 'full', k, v, w FROM a FULL JOIN b USING (k)""",
)
def joins(t: Tables):
    a = t.customer.groupBy((F.col("c_nationkey") + 3).alias("k")).agg(F.count("*").alias("v"))
    b = t.supplier.groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("w"))
    # One full join, read once: each kind is the rows with the sides it keeps.
    both = a.join(b, "k", "full")
    left, right = F.col("v").isNotNull(), F.col("w").isNotNull()
    kinds = F.filter(
        F.array(
            F.when(left & right, "inner"),
            F.when(left, "left"),
            F.when(right, "right"),
            F.lit("full"),
        ),
        lambda how: how.isNotNull(),
    )
    return both.select(F.explode(kinds).alias("how"), "k", "v", "w")


def _dearer(closed: pa.Table, others: pa.Table) -> pa.Table:
    """Places of each customer of a bundle at which the closed order is the dearer one."""
    sides = []
    for rows, side, other in ((closed, "closed", "others"), (others, "others", "closed")):
        price = rows.column("o_totalprice")
        sides.append(
            rows.select(["k", "place"])
            .append_column(side, price)
            .append_column(other, pa.nulls(len(rows), price.type))
            .append_column("sides", pa.array([1] * len(rows), pa.int64()))
            .select(["k", "place", "closed", "others", "sides"])
        )
    places = (
        pa.concat_tables(sides)
        .group_by(["k", "place"], use_threads=False)
        .aggregate([("closed", "max"), ("others", "max"), ("sides", "sum")])
    )
    pair = pc.equal(places.column("sides_sum"), 2).cast(pa.int64())
    dearer = pc.greater(places.column("closed_max"), places.column("others_max")).fill_null(False)
    return (
        pa.table({"k": places.column("k"), "pairs": pair, "dearer": dearer.cast(pa.int64())})
        .group_by("k", use_threads=False)
        .aggregate([("pairs", "sum"), ("dearer", "sum")])
        .rename_columns(["k", "pairs", "dearer"])
        .select(["k", "pairs", "dearer"])
    )


@query(
    "kv_cogroup_custom",
    """WITH placed AS (SELECT o_custkey AS k, o_totalprice AS v, o_orderstatus = 'F' AS closed,
                       row_number() OVER (PARTITION BY o_custkey, o_orderstatus = 'F' ORDER BY o_totalprice) AS place
                       FROM orders)
       SELECT k, max(place * (b.v IS NOT NULL AND a.v IS NOT NULL)::INT)::BIGINT AS pairs,
              count(*) FILTER (WHERE a.v > b.v) AS dearer
       FROM (SELECT * FROM placed WHERE closed) a FULL JOIN (SELECT * FROM placed WHERE NOT closed) b
            USING (k, place) GROUP BY k""",
)
def cogroup_custom(t: Tables):
    """The n-th cheapest closed order of a customer against the n-th cheapest other one."""
    kv = t.orders.select(F.col("o_custkey").alias("k"), "o_totalprice", "o_orderkey", "o_orderstatus")
    compared = cogroup_map(
        kv.filter(F.col("o_orderstatus") == "F"),
        kv.filter(F.col("o_orderstatus") != "F"),
        ["k"],
        "o_totalprice",
        "o_totalprice",
        ["o_orderkey"],
        ["o_orderkey"],
        _dearer,
        "k long, pairs long, dearer long",
        chunk_rows=_LISTED,
        bundle_rows=_BUNDLED,
    )
    return compared.groupBy("k").agg(F.sum("pairs").alias("pairs"), F.sum("dearer").alias("dearer"))


@query(
    "kv_cogroup",
    f"""WITH sides AS (SELECT o_custkey AS k, o_totalprice AS v, o_orderstatus = 'F' AS closed
                      FROM orders),
            placed AS (SELECT *, (row_number() OVER (PARTITION BY k, closed ORDER BY v) - 1)
                         // {_LISTED} AS chunk FROM sides),
            a AS (SELECT k, chunk, count(*) AS n, round(sum(v), 2) AS s FROM placed
                  WHERE closed GROUP BY 1, 2),
            b AS (SELECT k, chunk, count(*) AS n, round(sum(v), 2) AS s FROM placed
                  WHERE NOT closed GROUP BY 1, 2)
       SELECT k, chunk, coalesce(a.n, 0) AS closed, coalesce(a.s, 0) AS closed_total,
              coalesce(b.n, 0) AS others, coalesce(b.s, 0) AS others_total
       FROM a FULL JOIN b USING (k, chunk)""",
)
def cogroup(t: Tables):
    """Closed and other orders of each customer, as lists of a few prices."""
    kv = t.orders.select(F.col("o_custkey").alias("k"), "o_totalprice", "o_orderkey", "o_orderstatus")
    both = cogroup_values(
        kv.filter(F.col("o_orderstatus") == "F"),
        kv.filter(F.col("o_orderstatus") != "F"),
        ["k"],
        "o_totalprice",
        "o_totalprice",
        ["o_orderkey"],
        ["o_orderkey"],
        chunk_rows=_LISTED,
    )

    def total(values: str):
        return F.round(F.aggregate(values, F.lit(0.0), lambda a, b: a + b), 2)

    return both.select(
        "k",
        "chunk",
        F.size("left_values").cast("long").alias("closed"),
        total("left_values").alias("closed_total"),
        F.size("right_values").cast("long").alias("others"),
        total("right_values").alias("others_total"),
    )
