"""Filters and predicates. Comparisons with literals reach the parquet scan."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdigrid.operators.joins import small_side_join
from verdigrid.plans.registry import Tables, query


@query(
    "filter_compare",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_totalprice > 100000 AND o_totalprice >= 100001 AND o_totalprice < 400000
         AND o_totalprice <= 399999 AND o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'""",
)
def compare(t: Tables):
    price = F.col("o_totalprice")
    return (
        t.orders.filter((price > 100000) & (price >= 100001) & (price < 400000) & (price <= 399999))
        .where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "5-LOW"))
        .select("o_orderkey", "o_totalprice")
    )


@query("filter_sql_string", "SELECT p_partkey, p_size FROM part WHERE p_size > 30 AND p_type = 'PROMO'")
def sql_string(t: Tables):
    return t.part.filter("p_size > 30 AND p_type = 'PROMO'").select("p_partkey", "p_size")


@query(
    "filter_logic",
    """SELECT o_orderkey FROM orders
       WHERE (o_totalprice < 50000 OR o_custkey % 5 = 0 OR o_orderpriority LIKE '%HIGH')
         AND NOT (o_orderstatus = 'O' AND NOT o_totalprice >= 20000)""",
)
def logic(t: Tables):
    price = F.col("o_totalprice")
    wanted = (price < 50000) | (F.col("o_custkey") % 5 == 0) | F.col("o_orderpriority").like("%HIGH")
    small_open = (F.col("o_orderstatus") == "O") & ~(price >= 20000)
    return t.orders.filter(wanted & ~small_open).select("o_orderkey")


@query(
    "filter_chained",
    """SELECT c_custkey, c_name, c_acctbal FROM customer
       WHERE c_acctbal < 2500 AND c_nationkey % 3 = 1 AND c_mktsegment <> 'BUILDING'""",
)
def chained(t: Tables):
    return (
        t.customer.filter(F.col("c_acctbal") < 2500)
        .filter(F.col("c_nationkey") % 3 == 1)
        .filter(F.col("c_mktsegment") != "BUILDING")
        .select("c_custkey", "c_name", "c_acctbal")
    )


@query(
    "filter_isin",
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P')""",
)
def isin(t: Tables):
    return t.orders.filter(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("P")
    ).select("o_orderkey", "o_orderpriority")


@query(
    "filter_nulls",
    """WITH o AS (SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority FROM orders)
       SELECT CASE WHEN priority IS NULL THEN 'missing' ELSE 'present' END AS state,
              o_orderkey FROM o WHERE priority IS NULL OR priority IS NOT NULL AND priority < '3'""",
)
def nulls(t: Tables):
    o = t.orders.select(
        "o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("priority")
    )
    missing = o.filter(F.col("priority").isNull()).select(F.lit("missing").alias("state"), "o_orderkey")
    present = o.filter(F.col("priority").isNotNull() & (F.col("priority") < "3"))
    return missing.unionByName(present.select(F.lit("present").alias("state"), "o_orderkey"))


@query(
    "filter_between",
    """SELECT p_partkey, p_size, p_retailprice FROM part
       WHERE p_size BETWEEN 10 AND 20 AND p_retailprice BETWEEN 950 AND 1500""",
)
def between(t: Tables):
    return t.part.filter(
        F.col("p_size").between(10, 20) & F.col("p_retailprice").between(950, 1500)
    ).select("p_partkey", "p_size", "p_retailprice")


@query(
    "filter_like",
    """SELECT p_partkey, p_name, p_brand FROM part
       WHERE p_name LIKE '%ring%' AND p_brand LIKE 'Brand#1_'""",
)
def like(t: Tables):
    return t.part.filter(F.col("p_name").like("%ring%") & F.col("p_brand").like("Brand#1_")).select(
        "p_partkey", "p_name", "p_brand"
    )


@query(
    "filter_rlike",
    """SELECT p_partkey, p_name FROM part
       WHERE regexp_matches(p_name, '^(red|blue) .*[gt]$')""",
)
def rlike(t: Tables):
    return t.part.filter(F.col("p_name").rlike("^(red|blue) .*[gt]$")).select("p_partkey", "p_name")


@query(
    "filter_string_match",
    """SELECT page_id, url FROM pages
       WHERE starts_with(url, 'http') AND (ends_with(url, 'x') OR contains(url, '/fr/'))
         AND contains(lower(url), 'example')""",
)
def string_match(t: Tables):
    url = F.col("url")
    return t.pages.filter(
        url.startswith("http")
        & (url.endswith("x") | url.contains("/fr/"))
        & F.lower(url).contains("example")
    ).select("page_id", "url")


@query(
    "filter_modulo",
    "SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey % 2 = 0 AND c_nationkey % 5 <> 1",
)
def modulo(t: Tables):
    return t.customer.filter((F.col("c_custkey") % 2 == 0) & (F.col("c_nationkey") % 5 != 1)).select(
        "c_custkey", "c_nationkey"
    )


@query(
    "filter_denylist",
    """SELECT c.c_custkey, c.c_mktsegment FROM customer c
       WHERE c.c_nationkey NOT IN (SELECT n_nationkey FROM nation JOIN region
             ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE'))""",
)
def denylist(t: Tables):
    denied = (
        t.nation.join(t.region.filter(F.col("r_name").isin("ASIA", "EUROPE")),
                      F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_nationkey").alias("c_nationkey"))
    )
    return small_side_join(t.customer, denied, "c_nationkey", "left_anti").select(
        "c_custkey", "c_mktsegment"
    )


@query(
    "sql_view_filter",
    """SELECT c_custkey, c_name, c_acctbal FROM customer
       WHERE c_acctbal BETWEEN 4000 AND 6000 AND c_mktsegment IN ('BUILDING', 'HOUSEHOLD')
         AND c_name IS NOT NULL ORDER BY c_acctbal DESC""",
)
def view_filter(t: Tables):
    return t.spark.sql(
        """SELECT c_custkey, c_name, c_acctbal FROM {customers}
           WHERE c_acctbal BETWEEN 4000 AND 6000 AND c_mktsegment IN ('BUILDING', 'HOUSEHOLD')
             AND c_name IS NOT NULL
           ORDER BY c_acctbal DESC, c_custkey""",
        customers=t.customer,
    )
