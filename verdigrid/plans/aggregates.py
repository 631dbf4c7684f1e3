"""Aggregations. All of them combine rows before the shuffle."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdigrid.operators.aggregates import describe_columns, fold_product, fold_sum, population_stats
from verdigrid.operators.keyed import combine_by_key
from verdigrid.operators.metrics import number_metrics, observed
from verdigrid.plans.registry import Tables, query


@query(
    "agg_global",
    """SELECT CAST(count(*) AS BIGINT) AS n, round(avg(o_totalprice), 4) AS mean,
              max(o_totalprice) AS highest FROM orders""",
)
def global_(t: Tables):
    return t.orders.agg(
        F.count("*").alias("n"),
        F.round(F.avg("o_totalprice"), 4).alias("mean"),
        F.max("o_totalprice").alias("highest"),
    )


@query(
    "agg_group",
    """SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS total,
              round(avg(l_quantity), 6) AS mean_quantity, min(l_extendedprice) AS lowest,
              max(l_extendedprice) AS highest
       FROM lineitem GROUP BY l_returnflag""",
)
def group(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count("*").alias("n"),
        F.round(F.sum("l_extendedprice"), 2).alias("total"),
        F.round(F.avg("l_quantity"), 6).alias("mean_quantity"),
        F.min("l_extendedprice").alias("lowest"),
        F.max("l_extendedprice").alias("highest"),
    )


@query(
    "agg_multi_key",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity,
              round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
       FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def multi_key(t: Tables):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"),
        F.round(F.sum("l_quantity"), 2).alias("quantity"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("revenue"),
    )


@query(
    "agg_count_nulls",
    """SELECT o_orderstatus, count(*) AS all_rows,
              count(nullif(o_orderpriority, '4-NOT SPECIFIED')) AS with_priority
       FROM orders GROUP BY o_orderstatus""",
)
def count_nulls(t: Tables):
    priority = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    return t.orders.groupBy("o_orderstatus").agg(
        F.count("*").alias("all_rows"), F.count(priority).alias("with_priority")
    )


@query(
    "agg_short_forms",
    """SELECT p_type, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS size_sum
       FROM part GROUP BY p_type""",
)
def short_forms(t: Tables):
    short = t.part.groupBy("p_type").agg({"*": "count", "p_size": "sum"})
    return short.withColumnsRenamed({"count(1)": "n", "sum(p_size)": "size_sum"})


@query(
    "agg_describe",
    """SELECT 'o_totalprice' AS "column", count(o_totalprice) AS count,
              round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS stddev,
              min(o_totalprice) AS min, max(o_totalprice) AS max FROM orders
       UNION ALL
       SELECT 'o_custkey', count(o_custkey), round(avg(o_custkey), 4),
              round(stddev_samp(o_custkey), 4), min(o_custkey), max(o_custkey) FROM orders""",
)
def describe(t: Tables):
    return describe_columns(t.orders, ["o_totalprice", "o_custkey"]).select(
        "column", "count", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"),
        "min", "max",
    )


@query("distinct_rows", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(t: Tables):
    return t.orders.select("o_orderstatus", "o_orderpriority").distinct()


@query(
    "agg_stats_population",
    """SELECT count(l_quantity) AS count, sum(l_quantity) AS sum, min(l_quantity) AS min,
              max(l_quantity) AS max, round(avg(l_quantity), 6) AS mean,
              round(stddev_pop(l_quantity), 6) AS stdev, round(var_pop(l_quantity), 6) AS variance
       FROM lineitem""",
)
def stats_population(t: Tables):
    stats = t.lineitem.agg(*population_stats("l_quantity"))
    return stats.select(
        "count", "sum", "min", "max",
        *[F.round(c, 6).alias(c) for c in ("mean", "stdev", "variance")],
    )


@query(
    "agg_reduce",
    """SELECT l_linenumber, CAST(sum(l_quantity) AS DOUBLE) AS total, max(l_extendedprice) AS highest,
              round(ln(product(1 + l_tax)), 6) AS log_growth
       FROM lineitem GROUP BY l_linenumber""",
)
def reduce_(t: Tables):
    return t.lineitem.groupBy("l_linenumber").agg(
        F.sum("l_quantity").alias("total"),
        F.max("l_extendedprice").alias("highest"),
        F.round(F.ln(F.product(1 + F.col("l_tax"))), 6).alias("log_growth"),
    )


@query(
    "agg_fold_empty",
    """SELECT count(*) AS n, coalesce(round(sum(p_retailprice), 2), 0) AS total,
              coalesce(product(p_size), 1.0) AS product FROM part WHERE p_size > 1000
       UNION ALL
       SELECT count(*), coalesce(round(sum(p_retailprice), 2), 0),
              coalesce(product(CASE WHEN p_size > 0 THEN 1 END), 1.0) FROM part""",
)
def fold_empty(t: Tables):
    def folded(df, factor):
        return df.agg(
            F.count("*").alias("n"),
            F.round(fold_sum("p_retailprice"), 2).alias("total"),
            fold_product(factor).alias("product"),
        )

    none = folded(t.part.filter(F.col("p_size") > 1000), F.col("p_size"))
    return none.unionByName(folded(t.part, F.when(F.col("p_size") > 0, 1)))


@query(
    "agg_two_phase",
    """SELECT round(sum(o_totalprice) / count(o_totalprice), 6) AS mean,
              min(o_totalprice) AS lowest, max(o_totalprice) AS highest,
              round(max(o_totalprice) - min(o_totalprice), 2) AS spread FROM orders""",
)
def two_phase(t: Tables):
    price = F.col("o_totalprice")
    return t.orders.agg(
        F.round(F.try_divide(F.sum(price), F.count(price)), 6).alias("mean"),
        F.min(price).alias("lowest"),
        F.max(price).alias("highest"),
        F.round(F.max(price) - F.min(price), 2).alias("spread"),
    )


@query(
    "agg_having",
    """SELECT user_id, count(*) AS errors FROM events WHERE event_type = 'error'
       GROUP BY user_id HAVING count(*) >= 2""",
)
def having(t: Tables):
    return (
        t.events.filter(F.col("event_type") == "error")
        .groupBy("user_id")
        .agg(F.count("*").alias("errors"))
        .filter(F.col("errors") >= 2)
    )


@query(
    "udaf_grouped",
    """SELECT event_type, round(sqrt(avg(value * value)), 6) AS root_mean_square
       FROM events GROUP BY event_type""",
)
def udaf(t: Tables):
    """Root mean square as a custom state of (rows, sum of squares)."""
    squares = t.events.withColumn("square", F.col("value") * F.col("value"))
    means = combine_by_key(
        squares,
        "event_type",
        ["square"],
        create=lambda g: g.agg(rows=("square", "size"), squares=("square", "sum")),
        merge=lambda g: g.agg(rows=("rows", "sum"), squares=("squares", "sum")),
        finish=lambda s: (s["squares"] / s["rows"]) ** 0.5,
        state=T.StructType().add("rows", T.LongType()).add("squares", T.DoubleType()),
        result=T.StructField("root_mean_square", T.DoubleType()),
    )
    return means.select("event_type", F.round("root_mean_square", 6).alias("root_mean_square"))


@query(
    "metrics_observe",
    """SELECT count(*) AS "rows", count(*) FILTER (WHERE p IS NULL) AS missing, count(p) AS count,
              round(coalesce(sum(p), 0), 2) AS sum, min(p) AS min, max(p) AS max,
              round(coalesce(avg(p), 0), 4) AS avg
       FROM (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS p FROM orders)""",
)
def metrics_observe(t: Tables):
    """Counters taken while the table is being processed, then read from the driver."""
    priced = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price")
    )
    counted, observation = observed(priced, number_metrics("price"))
    counted.write.format("noop").mode("overwrite").save()
    counters = t.spark.createDataFrame(
        [observation.get],
        "rows long, missing long, count long, sum double, min double, max double, avg double",
    )
    return counters.withColumns({"sum": F.round("sum", 2), "avg": F.round("avg", 4)})
