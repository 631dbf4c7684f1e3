"""Projections, scalar functions, and row-wise maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdigrid.operators.udfs import percent_of
from verdigrid.plans.registry import Tables, query


@query(
    "proj_select_alias",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer""",
)
def select_alias(t: Tables):
    return t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )


@query(
    "proj_with_columns",
    """SELECT o_orderkey, round(o_totalprice * 12, 2) AS yearly,
              o_totalprice > 250000 AS is_large, 'EUR' AS currency
       FROM orders""",
)
def with_columns(t: Tables):
    return (
        t.orders.withColumn("yearly", F.round(F.col("o_totalprice") * 12, 2))
        .withColumns({"is_large": F.col("o_totalprice") > 250000, "currency": F.lit("EUR")})
        .select("o_orderkey", "yearly", "is_large", "currency")
    )


@query(
    "proj_replace",
    """SELECT p_partkey, CAST(round(p_retailprice) AS INTEGER) AS p_retailprice FROM part""",
)
def replace(t: Tables):
    return t.part.withColumn("p_retailprice", F.round("p_retailprice", 0).cast("int")).select(
        "p_partkey", "p_retailprice"
    )


@query(
    "proj_rename_drop",
    """SELECT s_suppkey AS supplier_id, s_name, s_acctbal AS balance FROM supplier""",
)
def rename_drop(t: Tables):
    return (
        t.supplier.withColumnRenamed("s_suppkey", "supplier_id")
        .withColumnsRenamed({"s_acctbal": "balance"})
        .drop("s_nationkey", "no_such_column")
    )


@query(
    "proj_cast",
    """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS key_text,
              CAST(trunc(o_totalprice) AS INTEGER) AS whole,
              CAST(o_orderdate AS DATE) AS day,
              TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rank,
              TRY_CAST(o_orderpriority AS DOUBLE) AS no_number
       FROM orders""",
)
def cast(t: Tables):
    day_text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t.orders.select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_totalprice").cast("int").alias("whole"),
        F.to_date(day_text).alias("day"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("rank"),
        F.col("o_orderpriority").try_cast("double").alias("no_number"),
    )


@query(
    "map_elements",
    """SELECT p_partkey, p_size * 2 AS doubled, upper(p_name) AS loud,
              length(p_name) AS name_length FROM part""",
)
def map_elements(t: Tables):
    return t.part.select(
        "p_partkey",
        (F.col("p_size") * 2).alias("doubled"),
        F.upper("p_name").alias("loud"),
        F.length("p_name").cast("long").alias("name_length"),
    )


@query(
    "map_partitions",
    """SELECT p_partkey, CAST(p_size * 2 AS DOUBLE) AS share FROM part""",
)
def map_partitions(t: Tables):
    shares = percent_of(t.part.select("p_partkey", "p_size"), "p_size", 50.0, "share")
    return shares.select("p_partkey", F.round("share", 6).alias("share"))


@query(
    "fn_string",
    """SELECT p_partkey, upper(p_brand) AS brand_upper, lower(p_type) AS type_lower,
              trim('  ' || p_name || ' ') AS name_trimmed, length(p_name) AS n
       FROM part""",
)
def fn_string(t: Tables):
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))
    return t.part.select(
        "p_partkey",
        F.upper("p_brand").alias("brand_upper"),
        F.lower("p_type").alias("type_lower"),
        F.trim(padded).alias("name_trimmed"),
        F.length("p_name").cast("long").alias("n"),
    )


@query(
    "fn_concat_nulls",
    """WITH o AS (SELECT o_orderkey, o_orderstatus,
                        nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority FROM orders)
       SELECT o_orderkey, o_orderstatus || ' / ' || priority AS strict,
              concat_ws(' / ', o_orderstatus, priority, 'ORD') AS lenient
       FROM o""",
)
def fn_concat_nulls(t: Tables):
    priority = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    return t.orders.select(
        "o_orderkey",
        F.concat("o_orderstatus", F.lit(" / "), priority).alias("strict"),
        F.concat_ws(" / ", F.col("o_orderstatus"), priority, F.lit("ORD")).alias("lenient"),
    )


@query(
    "fn_split",
    """SELECT doc_id,
              len(string_split(text, ' ')) AS by_blank,
              len(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS by_space,
              CASE WHEN contains(text, ' ')
                   THEN substr(text, strpos(text, ' ') + 1) END AS rest
       FROM documents""",
)
def fn_split(t: Tables):
    two = F.split(F.col("text"), " ", 2)
    return t.documents.select(
        "doc_id",
        F.size(F.split("text", " ")).cast("long").alias("by_blank"),
        F.size(F.split("text", r"[ \t\n\r\f]+")).cast("long").alias("by_space"),
        F.get(two, F.lit(1)).alias("rest"),
    )


@query(
    "fn_math",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              l_extendedprice / l_quantity AS unit_price,
              l_extendedprice * (1 - l_discount) AS net,
              l_extendedprice + l_tax - l_quantity AS mixed,
              round(l_quantity / 4, 1) AS quarter,
              CASE WHEN l_tax = 0 THEN NULL ELSE l_discount / l_tax END AS ratio
       FROM lineitem""",
)
def fn_math(t: Tables):
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.try_divide(price, quantity).alias("unit_price"),
        (price * (1 - F.col("l_discount"))).alias("net"),
        (price + F.col("l_tax") - quantity).alias("mixed"),
        F.round(quantity / 4, 1).alias("quarter"),
        F.try_divide(F.col("l_discount"), F.col("l_tax")).alias("ratio"),
    )
