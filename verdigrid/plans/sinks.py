"""Sinks, each followed by reading back what was written."""

from __future__ import annotations

import uuid

import pyarrow.compute as pc
from pyspark.sql import functions as F

from verdigrid.operators.aggregates import exact_sum
from verdigrid.operators.layout import task_count
from verdigrid.plans.registry import Tables, query
from verdigrid.shared import fresh_folder
from verdigrid.sources.readers import read_csv, read_lines
from verdigrid.sources.writers import (
    append_table,
    read_pairs,
    write_csv,
    write_even_files,
    write_lines,
    write_pairs,
    write_per_partition,
)


@query(
    "sink_csv_roundtrip",
    """SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 6) AS mean FROM customer GROUP BY 1""",
)
def csv_roundtrip(t: Tables):
    folder = fresh_folder(t.spark, "summary-csv")
    summary = t.customer.groupBy("c_mktsegment").agg(
        F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 6).alias("mean")
    )
    write_csv(summary, folder)
    return read_csv(t.spark, folder, "c_mktsegment string, n bigint, mean double")


@query("sink_parquet_roundtrip", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def parquet_roundtrip(t: Tables):
    folder = fresh_folder(t.spark, "orders-parquet")
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    rows.write.mode("overwrite").parquet(folder)
    return t.spark.read.schema(rows.schema).parquet(folder)


@query(
    "sink_compact",
    "SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total, true AS few_files FROM orders",
)
def compact(t: Tables):
    """Files of the advisory size in one pass: far more rows than 100,000 to a file."""
    folder = fresh_folder(t.spark, "compact")
    rows = t.orders.select("o_orderkey", "o_totalprice")
    write_even_files(rows, folder)
    back = t.spark.read.schema(rows.schema).parquet(folder)
    return back.select("o_totalprice", F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("n"),
        F.round(exact_sum(F.col("o_totalprice")), 2).alias("total"),
        (F.count_distinct("file") <= 1 + F.count("*") / 100_000).alias("few_files"),
    )


@query("sink_text_roundtrip", "SELECT n_name || ',' || n_regionkey AS line FROM nation UNION ALL SELECT c_name || ',' || c_nationkey FROM customer")
def text_roundtrip(t: Tables):
    nations = t.nation.select(F.concat_ws(",", F.col("n_name"), F.col("n_regionkey")).alias("line"))
    customers = t.customer.select(F.concat_ws(",", F.col("c_name"), F.col("c_nationkey")).alias("line"))
    folder = fresh_folder(t.spark, "names-text")
    write_lines(nations.union(customers), "line", folder)
    return read_lines(t.spark, folder)


@query("sink_sequence_roundtrip", "SELECT c_custkey AS k, c_name AS v FROM customer")
def sequence_roundtrip(t: Tables):
    folder = fresh_folder(t.spark, "pairs-sequence")
    write_pairs(t.customer, "c_custkey", "c_name", folder)
    return read_pairs(t.spark, folder, "k bigint, v string")


@query("sink_table_append", "SELECT o_orderkey, o_orderstatus FROM orders")
def table_append(t: Tables):
    """Two appends to one catalog table whose files lie in the shared folder."""
    name = f"orders_{uuid.uuid4().hex}"
    folder = fresh_folder(t.spark, "orders-table")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    append_table(rows.filter(F.col("o_orderstatus") == "F"), name, folder)
    append_table(rows.filter(F.col("o_orderstatus") != "F"), name, folder)
    schema = t.spark.table(name).schema
    t.spark.sql(f"DROP TABLE {name}")  # the files stay
    return t.spark.read.schema(schema).parquet(folder)


@query(
    "sink_foreach_partition",
    """SELECT 'files' AS side, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys,
              count(DISTINCT upper(c_name)) AS names FROM customer
       UNION ALL SELECT 'summary', count(*), NULL, NULL FROM customer""",
)
def foreach_partition(t: Tables):
    """Each partition opens its own sink work: names in capitals, batch by batch."""

    def prepare(part: int):
        at = ["c_custkey", "c_name"].index("c_name")

        def capitals(batch):
            return batch.set_column(at, "c_name", pc.utf8_upper(batch.column(at)))

        return capitals

    folder = fresh_folder(t.spark, "per-partition")
    rows = t.customer.select("c_custkey", "c_name")
    placed = rows.repartition(task_count(rows), "c_custkey")
    summary = write_per_partition(placed, folder, prepare).agg(F.sum("rows").alias("n"))
    files = t.spark.read.schema(rows.schema).parquet(folder)
    counted = summary.select(
        F.lit("summary").alias("side"), "n", F.lit(None).cast("long").alias("keys"),
        F.lit(None).cast("long").alias("names"),
    )
    per_name = files.groupBy("c_name").agg(F.count("*").alias("c"), F.sum("c_custkey").alias("k"))
    return per_name.agg(
        F.sum("c").alias("n"), F.sum("k").alias("keys"), F.count("*").alias("names")
    ).select(F.lit("files").alias("side"), "n", "keys", "names").unionByName(counted)
