"""Partition layout and shared intermediates."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


TASK_ROWS = 4_000_000
#: Bytes of files, mostly compressed, that stand for as many rows.
TASK_BYTES = 64 << 20
#: What Spark says of a source whose size it does not know, or more.
_UNKNOWN_BYTES = 1 << 62


def source_bytes(df: DataFrame) -> int | None:
    """Bytes of what ``df`` reads, from the statistics of its sources; no job runs.

    Null if a source has no statistics, such as rows handed over by the driver.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [
        int(leaves.apply(k).stats().sizeInBytes()) for k in range(leaves.size())
    ]
    return None if any(size >= _UNKNOWN_BYTES for size in sizes) else sum(sizes)


def task_count(df: DataFrame, task_rows: int = TASK_ROWS, task_bytes: int = TASK_BYTES) -> int:
    """Tasks for an explicit layout of ``df``.

    The session's number of shuffle partitions is the least. It is raised by the size of
    the sources, so that no work of ``df`` is done for it; only where a source has no
    statistics are the rows counted, for tasks of about ``task_rows`` rows.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = source_bytes(df)
    if size is None:
        return max(least, -(-df.count() // task_rows))
    return max(least, -(-size // task_bytes))


def hash_layout(
    df: DataFrame,
    partitions: int,
    keys: Sequence[str],
    spread_by: Sequence[str] = (),
    salts: int = 1,
) -> DataFrame:
    """Hash partitions by key.

    With ``salts`` above 1 a key occupies up to ``salts`` partitions, chosen by a
    hash of ``spread_by``, so that a key with a large part of the rows does not
    end up in one task.
    """
    if salts > 1:
        salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts))
        return df.repartition(partitions, *[F.col(k) for k in keys], salt)
    return df.repartition(partitions, *keys)


def range_layout(
    df: DataFrame, partitions: int, keys: Sequence[str], tie_break: Sequence[str] = ()
) -> DataFrame:
    """Range partitions by key; ``tie_break`` lets a frequent key span partitions."""
    return df.repartitionByRange(partitions, *keys, *tie_break)


def partition_profile(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows, and on request distinct keys, of every non-empty partition."""
    numbered = df.withColumn("partition", F.spark_partition_id())
    if key is None:
        return numbered.groupBy("partition").agg(F.count("*").alias("rows"))
    # two grouped steps: copies of a key are counted before they meet
    per_key = numbered.groupBy("partition", key).agg(F.count("*").alias("_rows"))
    return per_key.groupBy("partition").agg(
        F.sum("_rows").alias("rows"), F.count("*").alias("keys")
    )


@dataclass(frozen=True)
class AdaptiveFacts:
    """What adaptive execution made of a plan: see ``adaptive_facts``."""

    rows: int
    partitions: int
    merged: int
    skewed: int
    splits: int
    joins: tuple[str, ...]


def adaptive_facts(df: DataFrame) -> AdaptiveFacts:
    """Run ``df`` under the session's present settings and read its final plan.

    ``rows`` of the result and ``partitions`` it came in; shuffle partitions ``merged``
    with others; ``skewed`` ones and the ``splits`` read in their place; the ``joins`` of
    the final plan. The result stays on the executors; only its rows are counted.
    """
    execution = df._jdf.queryExecution()
    result = execution.toRdd()
    rows = result.count()
    counted = dict.fromkeys(("numCoalescedPartitions", "numSkewedPartitions", "numSkewedSplits"), 0)
    joins, nodes = [], [execution.executedPlan()]
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            nodes.append(node.plan())
            continue
        if name.startswith("AQEShuffleRead"):
            metrics = node.metrics()
            for key in counted:
                if metrics.contains(key):
                    counted[key] += metrics.apply(key).value()
        if "Join" in name:
            joins.append(name.split("(")[0])  # one whose partitions were split says so
        children = node.children()
        nodes.extend(children.apply(k) for k in range(children.size()))
    return AdaptiveFacts(rows, result.getNumPartitions(), *counted.values(), tuple(sorted(joins)))


def map_indexed(
    df: DataFrame,
    prepare: Callable[[int], Callable[[pa.RecordBatch], pa.RecordBatch]],
    schema: T.StructType | str,
) -> DataFrame:
    """Map every partition by a function that knows the partition's number.

    ``prepare`` gets the number once and returns the function that the partition's
    batches pass through in order, so it may keep state between them. The numbers hold
    for one evaluation only; write the result where it is used more than once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare(TaskContext.get().partitionId())
        for batch in batches:
            yield work(batch)

    return df.mapInArrow(run, schema)


@contextmanager
def shared(df: DataFrame, level: StorageLevel = StorageLevel.DISK_ONLY) -> Iterator[DataFrame]:
    """Keep ``df`` on the executors' disks while several consumers run."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


@contextmanager
def shared_view(df: DataFrame, name: str) -> Iterator[str]:
    """The same by view name, for consumers written in SQL."""
    catalog = df.sparkSession.catalog
    df.createOrReplaceTempView(name)
    catalog.cacheTable(name)
    try:
        yield name
    finally:
        catalog.uncacheTable(name)
        catalog.dropTempView(name)
