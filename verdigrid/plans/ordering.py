"""Sorting, top-k, row numbers, zip and samples.

Sorts end with a unique column, so rows of one frequent value can be placed in
several range partitions.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from verdigrid.operators.ordering import (
    index_rows,
    sample_rows,
    sample_rows_with_replacement,
    zip_rows,
)
from verdigrid.plans.registry import Tables, query


@query(
    "sort_multi",
    """SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
       ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey % 10, o_orderkey""",
)
def sort_multi(t: Tables):
    return t.orders.orderBy(
        F.asc("o_orderpriority"), F.desc("o_totalprice"), F.col("o_orderkey") % 10, "o_orderkey"
    ).select("o_orderkey", "o_orderpriority", "o_totalprice")


@query(
    "sort_nulls",
    """WITH o AS (SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority FROM orders)
       SELECT 'last' AS nulls, priority, o_orderkey,
              row_number() OVER (ORDER BY priority DESC NULLS LAST, o_orderkey) - 1 AS position FROM o
       UNION ALL
       SELECT 'first', priority, o_orderkey,
              row_number() OVER (ORDER BY priority ASC NULLS FIRST, o_orderkey) - 1 FROM o""",
)
def sort_nulls(t: Tables):
    """Both places of nulls, with every row's position in the order."""
    o = t.orders.select(
        "o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("priority")
    )
    last = index_rows(o, [F.col("priority").desc_nulls_last(), F.col("o_orderkey")], "position")
    first = index_rows(o, [F.col("priority").asc_nulls_first(), F.col("o_orderkey")], "position")
    shape = ("priority", "o_orderkey", "position")
    return last.select(F.lit("last").alias("nulls"), *shape).unionByName(
        first.select(F.lit("first").alias("nulls"), *shape)
    )


@query(
    "topk_limit",
    "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 5",
)
def topk_limit(t: Tables):
    return (
        t.customer.orderBy(F.desc("c_acctbal"), "c_custkey")
        .limit(5)
        .select("c_custkey", "c_name", "c_acctbal")
    )


@query(
    "topk_largest_smallest",
    """SELECT * FROM (SELECT 'largest' AS side, o_orderkey, o_totalprice FROM orders
                      ORDER BY o_totalprice DESC, o_orderkey LIMIT 3)
       UNION ALL
       SELECT * FROM (SELECT 'smallest' AS side, o_orderkey, o_totalprice FROM orders
                      ORDER BY o_totalprice, o_orderkey LIMIT 3)""",
)
def topk_largest_smallest(t: Tables):
    top = t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(3)
    bottom = t.orders.orderBy("o_totalprice", "o_orderkey").limit(3)
    shape = ("side", "o_orderkey", "o_totalprice")
    return top.withColumn("side", F.lit("largest")).select(*shape).unionByName(
        bottom.withColumn("side", F.lit("smallest")).select(*shape)
    )


@query(
    "index_rows",
    """SELECT o_orderkey, o_totalprice,
              row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS "index" FROM orders""",
)
def index_rows_(t: Tables):
    return index_rows(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"])


@query(
    "zip_positional",
    """WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS i FROM customer),
            b AS (SELECT c_name, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS i FROM customer)
       SELECT a.c_custkey, b.c_name FROM a JOIN b ON a.i = b.i""",
)
def zip_positional(t: Tables):
    left = t.customer.select("c_custkey")
    right = t.customer.select("c_name", "c_acctbal", F.col("c_custkey").alias("tie"))
    return zip_rows(left, right, ["c_custkey"], ["c_acctbal", "tie"]).select("c_custkey", "c_name")


@query(
    "sample_fixed_size",
    """SELECT o_orderkey, o_totalprice FROM orders
       ORDER BY md5('7:' || o_orderkey), o_orderkey LIMIT 100""",
)
def sample_fixed_size(t: Tables):
    return sample_rows(t.orders.select("o_orderkey", "o_totalprice"), 100, ["o_orderkey"], seed=7)


@query(
    "sample_with_replacement",
    """WITH numbered AS (SELECT o_orderkey, o_totalprice,
                                row_number() OVER (ORDER BY o_orderkey) - 1 AS place FROM orders),
            draws AS (SELECT ('0x' || substr(md5('7:' || i), 1, 15))::BIGINT
                             % (SELECT count(*) FROM orders) AS place FROM range(500) r(i))
       SELECT o_orderkey, o_totalprice FROM draws JOIN numbered USING (place)""",
)
def sample_with_replacement(t: Tables):
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return sample_rows_with_replacement(orders, 500, ["o_orderkey"], seed=7)
