"""Partition layout, shared intermediates, session views.

Partition numbers differ between runs and engines, so the queries return facts
that must hold for any layout.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from verdigrid.operators.layout import (
    adaptive_facts,
    hash_layout,
    map_indexed,
    partition_profile,
    range_layout,
    shared,
    shared_view,
    task_count,
)
from verdigrid.plans.registry import Tables, query
from verdigrid.session import job_settings
from verdigrid.shared import written


@query(
    "layout_repartition",
    """SELECT 'by number' AS how, count(*) AS n, true AS "within" FROM orders
       UNION ALL SELECT 'by key', count(*), true FROM orders""",
)
def repartition(t: Tables):
    """By number and by key; neither makes more partitions than asked for."""
    parts = task_count(t.orders)

    def facts(df, how: str):
        return partition_profile(df).agg(
            F.sum("rows").alias("n"), (F.count("*") <= parts).alias("within")
        ).select(F.lit(how).alias("how"), "n", "within")

    rows = t.orders.select("o_orderkey", "o_orderstatus")
    by_key = hash_layout(rows, parts, ["o_orderstatus"], spread_by=["o_orderkey"], salts=parts)
    return facts(rows.repartition(parts), "by number").unionByName(facts(by_key, "by key"))


@query("layout_coalesce", "SELECT count(*) AS n, true AS merged FROM lineitem")
def coalesce(t: Tables):
    """Half as many partitions, merged without moving rows again."""
    parts = task_count(t.lineitem)
    merged = t.lineitem.select("l_orderkey").repartition(2 * parts).coalesce(parts)
    return partition_profile(merged).agg(
        F.sum("rows").alias("n"), (F.count("*") <= parts).alias("merged")
    )


@query(
    "layout_hash_keys",
    """SELECT count(*) AS n, count(DISTINCT o_custkey) AS keys, 0::BIGINT AS torn FROM orders""",
)
def hash_keys(t: Tables):
    """No key in more partitions than salts. ``torn`` counts keys that break this."""
    salts = 4
    placed = hash_layout(
        t.orders.select("o_custkey", "o_orderkey"), task_count(t.orders), ["o_custkey"],
        spread_by=["o_orderkey"], salts=salts,
    )
    per_part = placed.groupBy("o_custkey", F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))
    per_key = per_part.groupBy("o_custkey").agg(F.sum("n").alias("n"), F.count("*").alias("parts"))
    return per_key.agg(
        F.sum("n").alias("n"),
        F.count("*").alias("keys"),
        F.count(F.when(F.col("parts") > salts, 1)).alias("torn"),
    )


@query("layout_range_keys", "SELECT count(*) AS n, 0::BIGINT AS overlaps FROM orders")
def range_keys(t: Tables):
    """Key ranges of the partitions do not overlap, ties on price included."""
    from pyspark.sql import Window

    rows = t.orders.select("o_totalprice", "o_orderkey")
    placed = range_layout(rows, task_count(rows), ["o_totalprice"], ["o_orderkey"])
    place = F.struct("o_totalprice", "o_orderkey")
    # one row per partition, so the ordered window below is small whatever the table
    bounds = placed.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count("*").alias("n"), F.min(place).alias("first"), F.max(place).alias("last")
    )
    before = F.lag("last").over(Window.orderBy("p"))
    return bounds.withColumn("before", before).agg(
        F.sum("n").alias("n"), F.count(F.when(F.col("first") <= F.col("before"), 1)).alias("overlaps")
    )


@query(
    "layout_partition_profile",
    "SELECT count(*) AS n, true AS every_key_seen, true AS even FROM customer",
)
def profile(t: Tables):
    """Rows and keys per partition, summed up."""
    spread = t.customer.select("c_custkey", "c_mktsegment").repartition(task_count(t.customer))
    facts = partition_profile(spread, "c_mktsegment")
    return facts.agg(
        F.sum("rows").alias("n"),
        (F.max("keys") <= 5).alias("every_key_seen"),
        (F.max("rows") <= 2 * F.avg("rows")).alias("even"),
    )


@query(
    "layout_adaptive",
    """SELECT how, count(DISTINCT o_custkey) AS n, how = 'adaptive' AS merged FROM orders,
              (VALUES ('adaptive'), ('fixed')) m(how) GROUP BY how""",
)
def adaptive(t: Tables):
    """Settings for two jobs only: far too many shuffle partitions, merged or left alone.

    A sixteenth of a task's share leaves partitions so small that several of them fit in
    the advisory size whatever the table, so adaptive execution must merge.
    """
    parts = str(16 * task_count(t.orders))
    facts = []
    for how, on in (("adaptive", "true"), ("fixed", "false")):
        settings = {
            "spark.sql.shuffle.partitions": parts,
            "spark.sql.adaptive.enabled": on,
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
        }
        with job_settings(t.spark, settings):
            seen = adaptive_facts(t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")))
        facts.append((how, seen.rows, seen.partitions < int(parts)))
    return t.spark.createDataFrame(facts, "how string, n long, merged boolean")


@query(
    "map_partitions_indexed",
    """SELECT count(*) AS n, count(*) AS places, 0::BIGINT AS first_place,
              round(sum(o_totalprice), 2) AS total, 0::BIGINT AS torn FROM orders""",
)
def partitions_indexed(t: Tables):
    """Every row gets its partition's number, its place there and a running total.

    Whatever the layout, number and place name a row, and the last total of a partition
    is the sum of its rows (``torn`` counts partitions where it is not).
    """

    def prepare(part: int):
        held = {"place": 0, "total": 0.0}

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            price = pc.fill_null(batch.column("o_totalprice"), 0.0)
            n = batch.num_rows
            totals = pc.add(pc.cumulative_sum(price), held["total"])
            columns = [
                pa.array([part] * n, pa.int32()),
                pa.array(range(held["place"], held["place"] + n), pa.int64()),
                batch.column("o_totalprice"),
                totals,
            ]
            held["place"] += n
            held["total"] = totals[-1].as_py() if n else held["total"]
            return pa.RecordBatch.from_arrays(columns, ["part", "place", "price", "so_far"])

        return work

    kinds = "part int, place long, price double, so_far double"
    rows = written(map_indexed(t.orders.select("o_totalprice"), prepare, kinds), "indexed-map")
    parts = rows.groupBy("part").agg(
        F.count("*").alias("n"), F.min("place").alias("first"), F.max("place").alias("last"),
        F.sum("price").alias("total"), F.max_by("so_far", "place").alias("so_far"),
    )
    off = F.abs(F.col("total") - F.col("so_far")) > 1e-9 * F.abs(F.col("total")) + 1e-6
    return parts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.col("last") - F.col("first") + 1), F.lit(0)).alias("places"),
        F.max("first").alias("first_place"),
        F.round(F.sum("total"), 2).alias("total"),
        F.count_if(off).alias("torn"),
    )


@query(
    "shared_intermediate",
    """SELECT 'priority' AS kind, o_orderpriority AS label, count(*) AS n FROM orders GROUP BY 2
       UNION ALL SELECT 'status', o_orderstatus, count(*) FROM orders GROUP BY 2
       UNION ALL SELECT 'segment', c_mktsegment, count(*) FROM customer GROUP BY 2""",
)
def shared_intermediate(t: Tables):
    """Several consumers of one kept table, and of one kept view, released afterwards."""

    def counted(df, kind: str, column: str):
        return df.groupBy(F.col(column).alias("label")).agg(F.count("*").alias("n")).select(
            F.lit(kind).alias("kind"), "label", "n"
        )

    rows = t.orders.select("o_orderpriority", "o_orderstatus")
    with shared(rows) as kept, shared_view(t.customer.select("c_mktsegment"), "kept_customer") as view:
        by_segment = t.spark.sql(
            f"SELECT 'segment' AS kind, c_mktsegment AS label, count(*) AS n FROM {view} GROUP BY 2"
        )
        both = counted(kept, "priority", "o_orderpriority").unionByName(
            counted(kept, "status", "o_orderstatus")
        )
        return written(both.unionByName(by_segment), "consumers")
