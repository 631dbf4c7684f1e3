"""Conditional columns and the null and NaN suite.

The tables hold no nulls, so gaps are derived from values: the price of status
'P' orders is null, that of '5-LOW' orders is NaN.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from verdigrid.functions.conditions import banded
from verdigrid.functions.missing import clean_number, clean_table, is_missing, null_profile, number_status
from verdigrid.plans.registry import Tables, query

_GAPS = """SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority,
                  CASE WHEN o_orderstatus = 'P' THEN NULL
                       WHEN o_orderpriority = '5-LOW' THEN 'nan'::DOUBLE
                       ELSE o_totalprice END AS price
           FROM orders"""


def with_gaps(t: Tables):
    price = (
        F.when(F.col("o_orderstatus") == "P", F.lit(None))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(float("nan")))
        .otherwise(F.col("o_totalprice"))
    )
    priority = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    return t.orders.select("o_orderkey", priority.alias("priority"), price.alias("price"))


@query(
    "case_bands",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'large' ELSE 'small' END AS size,
              CASE WHEN o_totalprice > 400000 THEN 'High' WHEN o_totalprice > 150000 THEN 'Mid'
                   ELSE 'Low' END AS band
       FROM orders""",
)
def bands(t: Tables):
    return t.orders.select(
        "o_orderkey",
        F.when(F.col("o_totalprice") > 250000, "large").otherwise("small").alias("size"),
        banded("o_totalprice", [(400000, "High"), (150000, "Mid")], "Low").alias("band"),
    )


@query(
    "case_compound",
    """SELECT o_orderkey,
              CASE WHEN o_orderstatus = 'F' AND o_totalprice > 300000 THEN o_totalprice * 0.2
                   WHEN o_orderpriority = '1-URGENT' OR o_totalprice > 450000 THEN o_totalprice * 0.15
                   ELSE o_totalprice * 0.1 END AS bonus
       FROM orders""",
)
def compound(t: Tables):
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        F.when((F.col("o_orderstatus") == "F") & (price > 300000), price * 0.2)
        .when((F.col("o_orderpriority") == "1-URGENT") | (price > 450000), price * 0.15)
        .otherwise(price * 0.1)
        .alias("bonus"),
    )


@query(
    "case_no_else",
    "SELECT c_custkey, CASE WHEN c_acctbal > 9000 THEN 'gold' WHEN c_acctbal < 0 THEN 'debt' END AS tag FROM customer",
)
def no_else(t: Tables):
    balance = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey", F.when(balance > 9000, "gold").when(balance < 0, "debt").alias("tag")
    )


@query(
    "case_in_select",
    """SELECT p_partkey, CASE WHEN p_size >= 25 THEN 'big' ELSE 'little' END AS size_class,
              CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END AS is_promo
       FROM part WHERE CASE WHEN p_type = 'PROMO' THEN p_size > 5 ELSE p_size > 10 END""",
)
def in_select(t: Tables):
    promo = F.col("p_type") == "PROMO"
    return t.part.filter(
        F.when(promo, F.col("p_size") > 5).otherwise(F.col("p_size") > 10)
    ).select(
        "p_partkey",
        F.when(F.col("p_size") >= 25, "big").otherwise("little").alias("size_class"),
        F.when(promo, 1).otherwise(0).alias("is_promo"),
    )


_CASE = """SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN 'A' WHEN s_acctbal > 0 THEN 'B'
                                 ELSE 'C' END AS grade FROM """


@query("case_sql", _CASE + "supplier")
def case_sql(t: Tables):
    return t.spark.sql(_CASE + "{suppliers}", suppliers=t.supplier)


@query(
    "nulls_profile",
    f"""SELECT count(*) - count(o_orderkey) AS o_orderkey, count(*) - count(priority) AS priority,
               count(*) - count(price) AS price FROM ({_GAPS})""",
)
def profile(t: Tables):
    return null_profile(with_gaps(t))


@query(
    "nulls_nan_detect",
    f"""SELECT o_orderkey, price IS NULL AS is_null, coalesce(isnan(price), false) AS is_nan
        FROM ({_GAPS}) WHERE price IS NULL OR isnan(price)""",
)
def nan_detect(t: Tables):
    price = F.col("price")
    return with_gaps(t).filter(is_missing(price)).select(
        "o_orderkey", price.isNull().alias("is_null"), F.isnan(price).alias("is_nan")
    )


@query(
    "nulls_eq_safe",
    f"""SELECT o_orderkey, 'null' AS which FROM ({_GAPS}) WHERE priority IS NOT DISTINCT FROM NULL
        UNION ALL
        SELECT o_orderkey, 'urgent' FROM ({_GAPS}) WHERE priority IS NOT DISTINCT FROM '1-URGENT'""",
)
def eq_safe(t: Tables):
    priority = F.col("priority")
    gaps = with_gaps(t)
    none = gaps.filter(priority.eqNullSafe(F.lit(None)))
    urgent = gaps.filter(priority.eqNullSafe("1-URGENT"))
    return none.select("o_orderkey", F.lit("null").alias("which")).unionByName(
        urgent.select("o_orderkey", F.lit("urgent").alias("which"))
    )


@query(
    "nulls_clean",
    f"""SELECT o_orderkey, CASE WHEN price IS NULL THEN 0 WHEN isnan(price) THEN 0
                                ELSE price END AS price FROM ({_GAPS})""",
)
def clean(t: Tables):
    return with_gaps(t).select("o_orderkey", clean_number(F.col("price")).alias("price"))


@query(
    "nulls_status",
    """SELECT status, count(*) AS n FROM (
         SELECT CASE WHEN b IS NULL THEN 'missing' WHEN isnan(b) THEN 'not a number'
                     WHEN b < 0 THEN 'negative' ELSE 'ok' END AS status
         FROM (SELECT CASE c_mktsegment WHEN 'MACHINERY' THEN NULL WHEN 'BUILDING' THEN 'nan'::DOUBLE
                           ELSE c_acctbal END AS b FROM customer)) GROUP BY status""",
)
def status(t: Tables):
    segment = F.col("c_mktsegment")
    balance = (
        F.when(segment == "MACHINERY", F.lit(None))
        .when(segment == "BUILDING", F.lit(float("nan")))
        .otherwise(F.col("c_acctbal"))
    )
    marked = t.customer.select(balance.alias("b"))
    return marked.groupBy(number_status(F.col("b")).alias("status")).agg(F.count("*").alias("n"))


@query(
    "nulls_fill",
    f"""SELECT o_orderkey, coalesce(priority, 'none') AS priority,
               CASE WHEN price IS NULL OR isnan(price) THEN -1 ELSE price END AS by_map,
               CASE WHEN price IS NULL OR isnan(price) THEN 0 ELSE price END AS by_type
        FROM ({_GAPS})""",
)
def fill(t: Tables):
    gaps = with_gaps(t).withColumns({"by_map": F.col("price"), "by_type": F.col("price")}).drop("price")
    return gaps.na.fill({"priority": "none", "by_map": -1.0}).na.fill(0.0, subset=["by_type"])


@query(
    "nulls_drop",
    f"""SELECT 'any' AS rule, count(*) AS n FROM ({_GAPS})
        WHERE priority IS NOT NULL AND price IS NOT NULL AND NOT isnan(price)
        UNION ALL SELECT 'all', count(*) FROM ({_GAPS})
        WHERE priority IS NOT NULL OR (price IS NOT NULL AND NOT isnan(price))
        UNION ALL SELECT 'subset', count(*) FROM ({_GAPS}) WHERE priority IS NOT NULL""",
)
def drop(t: Tables):
    """How many rows each rule of ``na.drop`` keeps, counted in one pass.

    A value is missing if it is null or, in a number, NaN.
    """
    price = F.col("price").isNotNull() & ~F.isnan("price")
    priority = F.col("priority").isNotNull()
    rules = {"any": priority & price, "all": priority | price, "subset": priority}
    kept = with_gaps(t).agg(*[F.count(F.when(rule, 1)).alias(name) for name, rule in rules.items()])
    return kept.unpivot([], list(rules), "rule", "n")


@query(
    "nulls_drop_thresh",
    f"""SELECT o_orderkey, priority FROM ({_GAPS})
        WHERE CAST(priority IS NOT NULL AS INT) + CAST(price IS NOT NULL AND NOT isnan(price) AS INT) >= 1""",
)
def drop_thresh(t: Tables):
    return with_gaps(t).na.drop(thresh=2).select("o_orderkey", "priority")


@query(
    "nulls_replace",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'F' THEN NULL
                               ELSE o_orderstatus END AS o_orderstatus FROM orders""",
)
def replace(t: Tables):
    return t.orders.select("o_orderkey", "o_orderstatus").na.replace(
        {"P": "pending", "F": None}, subset=["o_orderstatus"]
    )


@query(
    "nulls_coalesce",
    f"""SELECT o_orderkey, coalesce(priority, 'unknown') AS priority,
                    coalesce(CASE WHEN isnan(price) THEN NULL ELSE price END, CAST(o_orderkey AS DOUBLE)) AS price
             FROM ({_GAPS})""",
)
def coalesce(t: Tables):
    return with_gaps(t).select(
        "o_orderkey",
        F.coalesce("priority", F.lit("unknown")).alias("priority"),
        F.coalesce(
            F.when(~F.isnan("price"), F.col("price")), F.col("o_orderkey").cast("double")
        ).alias("price"),
    )


@query(
    "nulls_full_clean",
    f"""SELECT o_orderkey, coalesce(priority, 'none') AS priority,
               CASE WHEN price IS NULL OR isnan(price) THEN 0 ELSE price END AS price
        FROM (SELECT CASE WHEN priority = '1-URGENT' THEN NULL ELSE o_orderkey END AS o_orderkey,
                     priority, price FROM ({_GAPS}))
        WHERE o_orderkey IS NOT NULL""",
)
def full_clean(t: Tables):
    key = F.when(~F.col("priority").eqNullSafe("1-URGENT"), F.col("o_orderkey"))
    gaps = with_gaps(t).withColumn("o_orderkey", key)
    return clean_table(gaps, {"priority": "none"}, number="price", required="o_orderkey")
