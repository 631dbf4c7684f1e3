"""Writers."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdigrid.operators.joins import measured_bytes
from verdigrid.session import job_settings
from verdigrid.shared import written

#: Bytes of a file that only one task can read.
FILE_BYTES = 64 << 20


def write_csv(df: DataFrame, folder: str, **options) -> None:
    """CSV with a header. Blanks around values are kept, unlike Spark's default."""
    settings = {
        "header": True,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        **options,
    }
    df.write.mode("overwrite").options(**settings).csv(folder)


def write_lines(df: DataFrame, column: str, folder: str, **options) -> None:
    """One line per row."""
    df.select(column).write.mode("overwrite").options(**options).text(folder)


def number_files(df: DataFrame, size: Column, limit: int = FILE_BYTES) -> DataFrame:
    """Add ``file``: a number under which at most ``limit`` bytes of rows lie.

    ``size`` is a row's bytes in the file. Rows are written once with their place; a
    running total inside each partition plus the totals of the partitions before (one
    row per partition) says where a row would begin in one long file, which is cut every
    half ``limit``. The last row of a cut may reach over it by another half; rows larger
    than that get files of their own, numbered -1, -2, ...
    """
    half = max(1, limit // 2)
    placed = written(
        df.withColumn("_size", size.cast("long"))
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id()),
        "placed",
    )
    large = F.col("_size") > half
    light, heavy = F.when(large, 0).otherwise(F.col("_size")), large.cast("long")
    totals = placed.groupBy("_part").agg(F.sum(light).alias("_bytes"), F.sum(heavy).alias("_large"))
    # One row per partition, so a single ordered window is bounded.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda column, over: F.coalesce(F.sum(column).over(over), F.lit(0))
    starts = totals.select(
        "_part", total("_bytes", earlier).alias("_bytes"), total("_large", earlier).alias("_large")
    )
    counted = placed.withColumn("_light", total(light, ahead)).withColumn("_heavy", total(heavy, ahead))
    file = F.when(large, -1 - F.col("_large") - F.col("_heavy")).otherwise(
        F.floor((F.col("_bytes") + F.col("_light")) / half)
    )
    return (
        counted.join(F.broadcast(starts), "_part")
        .withColumn("file", file.cast("long"))
        .drop("_size", "_part", "_place", "_bytes", "_large", "_light", "_heavy")
    )


def write_numbered(numbered: DataFrame, folder: str, fmt: str, **options) -> None:
    """One file per number of ``file``, each in a folder of its own."""
    # Files without a row (an empty table) still leave a readable folder.
    placed = numbered.repartition("file")
    placed.write.mode("overwrite").partitionBy("file").format(fmt).options(**options).save(folder)


def write_few_files(
    df: DataFrame, folder: str, files: int | None = None, file_bytes: int = 512 * 1024 * 1024
) -> int:
    """At most ``files`` parquet files; by default as many as the measured size needs.

    One shuffle spreads rows evenly; the work before it keeps its parallelism,
    which merging partitions without a shuffle would take away. Returns the bound.
    """
    bound = files or max(1, math.ceil(measured_bytes(df) / file_bytes))
    df.repartition(bound).write.mode("overwrite").parquet(folder)
    return bound


def write_even_files(df: DataFrame, folder: str, file_bytes: int = 128 << 20) -> None:
    """Files of some ``file_bytes`` of shuffled rows, whatever their number turns out to be.

    Adaptive execution by default makes at least a file per core of the cluster, however
    small; here the size alone decides, so the number of files grows with the rows only.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(file_bytes),
    }
    with job_settings(df.sparkSession, settings):
        df.hint("rebalance").write.mode("overwrite").parquet(folder)


def append_table(df: DataFrame, table: str, folder: str) -> None:
    """Append to a catalog table kept in ``folder``."""
    df.write.mode("append").format("parquet").option("path", folder).saveAsTable(table)


def write_pairs(df: DataFrame, key: str, value: str, folder: str) -> None:
    """Key/value sequence files, which only the RDD interface can write.

    Rows pass through Python one by one: for exchange with old jobs, not for large tables.
    """
    df.select(key, value).rdd.map(tuple).saveAsSequenceFile(folder)


def read_pairs(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Key/value sequence files as a two-column table."""
    return spark.createDataFrame(spark.sparkContext.sequenceFile(folder), schema)


def write_per_partition(
    df: DataFrame,
    folder: str,
    prepare: Callable[[int], Callable[[pa.RecordBatch], pa.RecordBatch]] | None = None,
) -> DataFrame:
    """Files of the partitions, after work that is set up once per partition.

    ``prepare`` gets the partition's number, opens what the partition needs and returns
    the function that every batch of rows passes through; it must keep the columns.
    Without it the rows never leave the JVM.
    Spark writes and commits the files, so a repeated or competing task adds nothing.
    Returns ``partition``, ``rows`` and ``file``, read from what was committed; the
    files carry ``partition`` as one more column.
    """
    names = [*df.columns, "partition"]
    schema = T.StructType([*df.schema.fields, T.StructField("partition", T.IntegerType())])

    if prepare is None:
        marked = df.withColumn("partition", F.spark_partition_id())
        marked.write.mode("overwrite").parquet(folder)
        return _files_of(df.sparkSession, folder, schema)

    def sink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        work = prepare(part)
        for batch in batches:
            done = work(batch)
            mark = pa.array([part] * done.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([*done.columns, mark], names)

    df.mapInArrow(sink, schema).write.mode("overwrite").parquet(folder)
    return _files_of(df.sparkSession, folder, schema)


def _files_of(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .parquet(folder)
        .groupBy("partition")
        .agg(F.count("*").alias("rows"), F.min("_metadata.file_path").alias("file"))
    )
