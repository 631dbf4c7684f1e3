"""Bounded runs of Structured Streaming queries.

Every run uses files as source and sink, so results stay on the executors, and
stops when the input present at its start has been processed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from verdigrid.session import job_settings
from verdigrid.shared import fresh_folder

#: Slices of a stream's input, at the least; rows of a file; files of a slice, at most.
LEAST_SLICES = 1
TASK_ROWS = 4_000_000
FILES_PER_SLICE = 256

#: How often a stream without new input reports that it is idle.
_IDLE_REPORT = "spark.sql.streaming.noDataProgressEventInterval"
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
_SESSION_MERGE = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    glob: str | None = None,
    files_per_batch: int | None = None,
    **options,
) -> DataFrame:
    """Files of a folder as they arrive. ``files_per_batch`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def rate_stream(spark: SparkSession, rows_per_second: int, partitions: int = 8) -> DataFrame:
    """Generated rows ``timestamp, value`` for load trials."""
    return (
        spark.readStream.format("rate")
        .option("rowsPerSecond", rows_per_second)
        .option("numPartitions", partitions)
        .load()
    )


def event_time(df: DataFrame, column: str) -> DataFrame:
    """The column as a timestamp with zone, which watermarks require."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def decode_messages(df: DataFrame, schema: T.StructType | str, value: str = "value") -> DataFrame:
    """Columns of the JSON carried in a binary message value."""
    decoded = F.from_json(F.col(value).cast("string"), schema)
    return df.select(decoded.alias("_data")).select("_data.*")


def windowed_totals(
    df: DataFrame,
    window: Column,
    keys: tuple[str, ...] = (),
    value: str = "value",
) -> DataFrame:
    """Count and sum per window and keys, for tables and streams alike.

    Window bounds come out as two plain timestamps.
    """
    totals = df.groupBy(window.alias("w"), *keys).agg(
        F.count("*").alias("n"), F.round(F.sum(value), 2).alias("total")
    )
    return totals.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        *keys,
        "n",
        "total",
    )


def run_to_files(
    stream: DataFrame, folder: str, checkpoint: str, trigger: Mapping | None = None
) -> StreamingQuery:
    """Append mode into parquet files. Without a trigger: all present input, then stop.

    With a trigger such as ``{"processingTime": "10 seconds"}`` the started query
    is returned and the caller stops it.
    """
    # Read when a query starts: sessions merge inside each input partition.
    with job_settings(stream.sparkSession, {_SESSION_MERGE: "true"}):
        started = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("path", folder)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    if trigger is None:
        started.awaitTermination()
    return started


def run_until_idle(
    stream: DataFrame, folder: str, checkpoint: str, interval: str = "1 second"
) -> StreamingQuery:
    """Append to files on a fixed interval, until the stream's own reports say it is idle.

    A trigger that finds new input runs a batch, and its report says what adding the
    batch took; a report without that means that the trigger found nothing. The first
    such report ends the run. Batches are as in any other run, and a next run goes on
    from the checkpoint.
    """
    with job_settings(stream.sparkSession, {_IDLE_REPORT: "100"}):
        started = run_to_files(stream, folder, checkpoint, {"processingTime": interval})
    try:
        while not started.awaitTermination(0.2):
            report = started.lastProgress
            if report is not None and "addBatch" not in report["durationMs"]:
                break
    finally:
        started.stop()
    return started


def batch_counts(spark: SparkSession, runs: Sequence[tuple[str, StreamingQuery, str]]) -> DataFrame:
    """One row per micro-batch: what it was told to observe, and what came too late.

    Each run is (label, finished query, name of its observation). Result: ``label``,
    ``run``, ``batch``, ``input_rows``, ``observed`` (a map of the observation's
    metrics, which must be whole numbers), ``dropped``: rows that state operators
    refused because of the watermark. A grouped stream counts groups there, as copies
    are merged before they meet the state. Batches without input are left out. A query
    remembers its last ``spark.sql.streaming.numRecentProgressUpdates`` reports.
    """
    rows = []
    for number, (label, run, name) in enumerate(runs):
        for report in run.recentProgress:
            if report["numInputRows"] == 0:
                continue
            seen = report["observedMetrics"].get(name)
            metrics = {k: int(v or 0) for k, v in seen.asDict().items()} if seen else {}
            late = sum(op["numRowsDroppedByWatermark"] for op in report["stateOperators"])
            rows.append((label, number, report["batchId"], report["numInputRows"], metrics, late))
    kinds = "label string, run int, batch long, input_rows long, observed map<string,long>, dropped long"
    return spark.createDataFrame(rows, kinds)


def batch_table_writer(table: str) -> Callable[[DataFrame, int], None]:
    """Append every batch to a catalog table, in a partition under the batch's number.

    The table is made by the first batch. Only the partitions a batch writes are
    replaced, so a batch that is handed over again replaces its own rows and no others.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        marked = batch.withColumn("batch", F.lit(number).cast("long"))
        if not spark.catalog.tableExists(table):
            marked.limit(0).write.format("parquet").partitionBy("batch").saveAsTable(table)
        # By position: the partition column is the last one of both.
        with job_settings(spark, {_OVERWRITE: "dynamic"}):
            marked.write.insertInto(table, overwrite=True)

    return write


def fresh_table(label: str) -> str:
    """A table name nobody else uses."""
    return f"{label}_{uuid.uuid4().hex}"


def run_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
) -> StreamingQuery:
    """Hand every micro-batch and its number to ``write``; all present input, then stop.

    A batch may be handed over again after a failure, under the same number, so
    ``write`` must replace what it wrote for that number.
    """
    started = (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return started


def batch_folder_writer(folder: str) -> Callable[[DataFrame, int], None]:
    """One folder per batch number, replaced when the batch is repeated."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return write


def read_sink(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """What a sink wrote; nothing if no batch has arrived yet."""
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_batches(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Everything ``batch_folder_writer`` wrote, with the batch number."""
    full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    return read_sink(spark, folder, full)


def latest_per_key(changes: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The newest change of every key: what an upsert would have left behind.

    Batches only add the keys they touched; nothing written before is rewritten.
    """
    columns = [c for c in changes.columns if c not in (*keys, "batch")]
    newest = F.max_by(F.struct(*columns), F.col("batch")).alias("_row")
    return changes.groupBy(*keys).agg(newest).select(*keys, "_row.*")


def latest_batch(changes: DataFrame) -> DataFrame:
    """The rows of the last batch: the whole result of a complete-mode stream."""
    last = changes.agg(F.max("batch").alias("b")).first()["b"]
    return changes.filter(F.col("batch") == F.lit(last)).drop("batch")


def time_slices(
    df: DataFrame, column: str, least: int | None = None, task_rows: int = TASK_ROWS
) -> list[str]:
    """Folders with the rows of ``df`` in order of ``column``, written once.

    No row of a folder is later than one of the next, so a stream that gets one folder
    after the other may use a watermark with batches of bounded size: at most
    ``FILES_PER_SLICE`` files of about ``task_rows`` rows, in ``least`` or more folders.
    """
    least = least or LEAST_SLICES
    tasks = max(least, -(-df.count() // task_rows))
    files = max(1, min(tasks // least, FILES_PER_SLICE))
    folder = fresh_folder(df.sparkSession, "slices")
    number = F.floor(F.spark_partition_id() / files)
    ordered = df.repartitionByRange(tasks, column).withColumn("slice", number)
    ordered.write.partitionBy("slice").parquet(folder)
    return [f"{folder}/slice={k}" for k in range(-(-tasks // files))]


def run_slices(
    spark: SparkSession, slices: Sequence[str], inbox: str, run: Callable[[], None]
) -> None:
    """Move one slice after the other into ``inbox`` and call ``run`` for each.

    Slices without rows were never written; the first call is made in any case.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(inbox).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(inbox))
    taken = len(files.listStatus(path(inbox)))
    for source in slices:
        target = path(f"{inbox}/{taken:06d}")
        if files.exists(path(source)):
            files.rename(path(source), target)
        elif taken == 0:
            files.mkdirs(target)
        else:
            continue
        taken += 1
        run()


def stream_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Run over all present input and read back what the file sink holds."""
    spark = stream.sparkSession
    folder = fresh_folder(spark, label)
    run_to_files(stream, folder, fresh_folder(spark, f"{label}-checkpoint"))
    return read_sink(spark, folder, stream.schema)
