"""Equi-joins.

Sides that repeat keys are aggregated before they are shuffled where the result
allows it. A broadcast is requested only after the side has been measured.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from verdigrid.operators.joins import (
    MAX_BROADCAST_BYTES,
    copartitioned_join,
    measured_bytes,
    salted_join,
    small_side_join,
    with_each,
)
from verdigrid.operators.layout import shared, task_count
from verdigrid.plans.registry import Tables, query
from verdigrid.shared import written

# All customers, those in debt under no key, and spending on all orders, every seventh
# customer's under a key of its own: neither side covers the other.
_KEYED = "SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS custkey, c_name FROM customer"
_SPENT = """SELECT CASE WHEN o_custkey % 7 = 0 THEN -o_custkey ELSE o_custkey END AS custkey,
                   count(*) AS n, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1"""


def keyed(t: Tables):
    return t.customer.select(F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("custkey"), "c_name")


def spent(t: Tables):
    key = F.when(F.col("o_custkey") % 7 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    return t.orders.groupBy(key.alias("custkey")).agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("spent")
    )


def _sql(how: str) -> str:
    return f"SELECT custkey, c_name, n, spent FROM ({_KEYED}) a {how} JOIN ({_SPENT}) b USING (custkey)"


@query("join_inner", _sql("INNER"))
def inner(t: Tables):
    return keyed(t).join(spent(t), "custkey", "inner")


@query("join_left", _sql("LEFT"))
def left(t: Tables):
    return keyed(t).join(spent(t), "custkey", "left")


@query("join_right", _sql("RIGHT"))
def right(t: Tables):
    return keyed(t).join(spent(t), "custkey", "right")


@query("join_full", _sql("FULL"))
def full(t: Tables):
    return keyed(t).join(spent(t), "custkey", "full")


@query(
    "join_semi",
    "SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
)
def semi(t: Tables):
    return t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left_semi")


@query(
    "join_anti",
    """SELECT d.doc_id, d.lang FROM
         (SELECT CASE WHEN lang = 'de' THEN NULL ELSE doc_id END AS doc_id, lang FROM documents) d
       WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
)
def anti(t: Tables):
    keyed = t.documents.select(F.when(F.col("lang") != "de", F.col("doc_id")).alias("doc_id"), "lang")
    return keyed.join(t.labels, "doc_id", "left_anti")


@query(
    "join_cross",
    """SELECT p_type, discount, count(*) AS n, round(sum(p_retailprice * (1 - discount)), 3) AS revenue
       FROM part CROSS JOIN (VALUES (0.0::DOUBLE), (0.1), (0.2), (0.3)) AS d(discount)
       GROUP BY p_type, discount""",
)
def cross(t: Tables):
    """Product with a short list, written as a generator: no join and no shuffle."""
    scenarios = with_each(t.part, "discount", [0.0, 0.1, 0.2, 0.3])
    return scenarios.groupBy("p_type", "discount").agg(
        F.count("*").alias("n"),
        F.round(F.sum(F.col("p_retailprice") * (1 - F.col("discount"))), 3).alias("revenue"),
    )


_AMOUNTS = 50_000


@query(
    "join_cross_long",
    f"""SELECT n_regionkey, count(*) AS n, CAST(sum(amount * (n_nationkey + 1)) AS BIGINT) AS weighted,
               count(DISTINCT amount) AS amounts
        FROM nation CROSS JOIN (SELECT unnest(range({_AMOUNTS})) AS amount) GROUP BY 1""",
)
def cross_long(t: Tables):
    """Product with fifty thousand values: rows meet lists of values by their number."""
    scenarios = with_each(t.nation.select("n_nationkey", "n_regionkey"), "amount", range(_AMOUNTS))
    per_amount = scenarios.groupBy("n_regionkey", "amount").agg(
        F.count("*").alias("c"), F.sum(F.col("amount") * (F.col("n_nationkey") + 1)).alias("w")
    )
    return per_amount.groupBy("n_regionkey").agg(
        F.sum("c").alias("n"), F.sum("w").alias("weighted"), F.count("*").alias("amounts")
    )


@query(
    "join_diff_names",
    """SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def diff_names(t: Tables):
    supplier, nation = t.supplier, t.nation
    return (
        supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"], "inner")
        .drop("n_nationkey")
        .select("s_suppkey", "s_name", "n_name")
    )


@query(
    "join_multi_key",
    """SELECT partkey, suppkey, sold, returned FROM
         (SELECT l_partkey AS partkey, l_suppkey AS suppkey, sum(l_quantity) AS sold
          FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2)
       JOIN (SELECT l_partkey AS partkey, l_suppkey AS suppkey, sum(l_quantity) AS returned
          FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) USING (partkey, suppkey)""",
)
def multi_key(t: Tables):
    def quantity(flag: str, name: str):
        rows = t.lineitem.filter(F.col("l_returnflag") == flag)
        return rows.groupBy(
            F.col("l_partkey").alias("partkey"), F.col("l_suppkey").alias("suppkey")
        ).agg(F.sum("l_quantity").alias(name))

    return quantity("N", "sold").join(quantity("R", "returned"), ["partkey", "suppkey"])


@query(
    "join_alias_dedup",
    """SELECT a.c_custkey, a.c_name, b.c_custkey AS next_key, b.c_name AS next_name
       FROM customer a JOIN customer b ON a.c_custkey + 1 = b.c_custkey""",
)
def alias_dedup(t: Tables):
    a, b = t.customer.alias("a"), t.customer.alias("b")
    return a.join(b, F.col("a.c_custkey") + 1 == F.col("b.c_custkey")).select(
        "a.c_custkey",
        "a.c_name",
        F.col("b.c_custkey").alias("next_key"),
        F.col("b.c_name").alias("next_name"),
    )


@query(
    "join_star",
    """SELECT r_name, n_name, count(*) AS n,
              round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
         LEFT JOIN customer ON o_custkey = c_custkey
         JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       GROUP BY r_name, n_name""",
)
def star(t: Tables):
    """Lines become one row per order, orders one row per customer, before each join."""
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.count("*").alias("n"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
    )
    per_customer = (
        per_order.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey")
        .agg(F.sum("n").alias("n"), F.sum("revenue").alias("revenue"))
    )
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name"
    )
    with_customer = per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    return (
        small_side_join(with_customer, places, "c_nationkey")
        .groupBy("r_name", "n_name")
        .agg(F.sum("n").alias("n"), F.round(F.sum("revenue"), 4).alias("revenue"))
    )


@query(
    "join_broadcast",
    """SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def broadcast(t: Tables):
    """No hint and no measuring: the session's thresholds decide.

    A side whose file statistics lie below ``spark.sql.autoBroadcastJoinThreshold`` is
    broadcast by the planner; a planned merge join whose side turns out below
    ``spark.sql.adaptive.autoBroadcastJoinThreshold`` is converted while it runs. Beyond
    both, or at -1, the sides are shuffled and skewed partitions split.
    """
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return t.customer.join(nation, "c_nationkey").select("c_custkey", "c_name", "n_name")


@query(
    "join_sql_hint",
    """SELECT s_suppkey, s_acctbal, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def sql_hint(t: Tables):
    """A strategy asked for in SQL: broadcast for a side measured as small, else merge."""
    hint = "BROADCAST" if measured_bytes(t.nation) <= MAX_BROADCAST_BYTES else "MERGE"
    return t.spark.sql(
        f"""SELECT /*+ {hint}(n) */ s_suppkey, s_acctbal, n_name
           FROM {{suppliers}} s JOIN {{nations}} n ON s_nationkey = n_nationkey""",
        suppliers=t.supplier,
        nations=t.nation,
    )


@query(
    "join_sort_merge",
    """SELECT o_orderkey, o_totalprice, c_name, c_mktsegment
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def sort_merge(t: Tables):
    """Two shuffled sides; adaptive execution splits a skewed customer."""
    customer = t.customer.hint("merge")
    return t.orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_totalprice", "c_name", "c_mktsegment"
    )


@query(
    "join_shuffle_hash",
    """SELECT p_type, count(*) AS n, round(sum(quantity), 2) AS quantity FROM part
       JOIN (SELECT l_partkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1)
         ON p_partkey = l_partkey GROUP BY p_type""",
)
def shuffle_hash(t: Tables):
    """Two shuffled sides of unique keys; the smaller one is hashed instead of sorted."""
    sold = t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("quantity"))
    part = t.part.select("p_partkey", "p_type").hint("shuffle_hash")
    return (
        sold.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_type")
        .agg(F.count("*").alias("n"), F.round(F.sum("quantity"), 2).alias("quantity"))
    )


@query(
    "join_skew_salted",
    """SELECT p.o_orderstatus, p.label, count(*) AS n, round(sum(o_totalprice), 2) AS total
       FROM orders o JOIN (VALUES ('P', 'pending'), ('F', 'filled'), ('O', 'open')) p(o_orderstatus, label)
         ON o.o_orderstatus = p.o_orderstatus GROUP BY 1, 2""",
)
def skew_salted(t: Tables):
    """Three keys hold all rows; each is spread over as many salts as its rows need."""
    from verdigrid.sources.readers import inline_table

    rows = [("P", "pending"), ("F", "filled"), ("O", "open")]
    labels = inline_table(t.spark, rows, "o_orderstatus string, label string")
    joined = salted_join(
        t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"),
        labels,
        ["o_orderstatus"],
        spread_by=["o_orderkey"],
        task_rows=1_000,
        strategy="merge",
    )
    return joined.groupBy("o_orderstatus", "label").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "join_copartitioned",
    """SELECT orderkey, o_totalprice, lines, round(quantity, 2) AS quantity FROM
         (SELECT o_orderkey AS orderkey, o_totalprice FROM orders)
       JOIN (SELECT l_orderkey AS orderkey, count(*) AS lines, sum(l_quantity) AS quantity
             FROM lineitem GROUP BY 1) USING (orderkey)""",
)
def copartitioned(t: Tables):
    """One row per order on both sides, laid out alike."""
    orders = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_totalprice")
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("orderkey")).agg(
        F.count("*").alias("lines"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )
    return copartitioned_join(orders, lines, ["orderkey"], task_count(t.orders))


@query(
    "join_reused_side",
    """WITH s AS (SELECT o_custkey AS custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS spent
                 FROM orders GROUP BY 1)
       SELECT 'segment' AS kind, c_mktsegment AS label, CAST(sum(orders) AS BIGINT) AS orders,
              round(sum(spent), 2) AS spent
       FROM s JOIN customer ON custkey = c_custkey GROUP BY 2
       UNION ALL
       SELECT 'event', first, CAST(sum(orders) AS BIGINT), round(sum(spent), 2)
       FROM s JOIN (SELECT user_id AS custkey, min(event_type) AS first FROM events GROUP BY 1)
         USING (custkey) GROUP BY 2""",
)
def reused_side(t: Tables):
    """One row per customer, laid out once by key, then joined twice."""
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("spent")
    )

    def summed(df, kind, label):
        return df.groupBy(F.lit(kind).alias("kind"), F.col(label).alias("label")).agg(
            F.sum("orders").alias("orders"), F.round(F.sum("spent"), 2).alias("spent")
        )

    with shared(per_customer.repartition(task_count(t.orders), "custkey")) as side:
        customers = t.customer.select(F.col("c_custkey").alias("custkey"), "c_mktsegment")
        first = t.events.groupBy(F.col("user_id").alias("custkey")).agg(
            F.min("event_type").alias("first")
        )
        by_segment = summed(side.join(customers, "custkey"), "segment", "c_mktsegment")
        by_event = summed(side.join(first, "custkey"), "event", "first")
        return written(by_segment.unionByName(by_event), "reused-side")
