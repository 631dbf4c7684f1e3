"""Shards of nearly equal bytes, by Karmarkar-Karp differencing.

Documents with equal texts are one indivisible group. A partial partition is a vector
of as many sums as there are shards; the two with the largest spread are combined,
largest sum on smallest, until one is left. Groups are dealt by hash to buckets of
bounded size, each bucket is differenced in one task, and the buckets' partitions are
differenced again in the same way, a level at a time. Tasks see group totals, never
the rows of a group; the rows meet their shard in a join that adaptive execution
splits where a text is very frequent.

A null text has no bytes and is a group of its own, apart from the empty text. Ids may
be null or repeat; every row gets a place. Slots count from 0 without gaps in each
shard; they follow the rows of one written table, so a lost executor changes none.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdigrid.shared import written

SHARDS = 40
ROW_BYTES = 16
#: Groups that one task differences, and partial partitions on the levels above.
BUCKET_GROUPS = 16384
FAN_IN = 1024


def differencing(vectors: np.ndarray) -> np.ndarray:
    """For each column of each partial partition (rows of ``vectors``) its subset."""
    count, width = vectors.shape
    order = np.argsort(vectors, axis=1, kind="stable")
    sums = np.take_along_axis(vectors, order, 1).astype(np.int64)
    names = np.arange(count * width).reshape(count, width)
    names = np.take_along_axis(names, order, 1)
    parent = np.arange(count * width)
    heap = [(int(s[0] - s[-1]), k) for k, s in enumerate(sums)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        parent[names[b, ::-1]] = names[a]
        joined = sums[a] + sums[b, ::-1]
        rank = np.argsort(joined, kind="stable")
        sums[a], names[a] = joined[rank], names[a][rank]
        heapq.heappush(heap, (int(sums[a, 0] - sums[a, -1]), a))
    while (up := parent[parent]).tobytes() != parent.tobytes():
        parent = up
    subset = np.zeros(count * width, np.int64)
    if count:
        subset[names[heap[0][1]]] = np.arange(width)
    return subset[parent].reshape(count, width)


def _place_groups(groups: DataFrame, shards: int, bucket_groups: int) -> DataFrame:
    """Group totals with the subset they fall into inside their bucket."""
    buckets = max(1, -(-groups.count() // bucket_groups))

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("bytes", "descending"), ("h1", "ascending"), ("h2", "ascending")])
        single = np.zeros((table.num_rows, shards), np.int64)
        single[:, -1] = table["bytes"].to_numpy()
        subset = differencing(single)[:, -1] if table.num_rows else np.zeros(0, np.int64)
        return table.append_column("subset", pa.array(subset, pa.int32()))

    bucket = F.pmod(F.xxhash64("h1", "h2", "empty", F.lit(7)), F.lit(buckets))
    return (
        groups.withColumn("bucket", bucket)
        .groupBy("bucket")
        .applyInArrow(
            place, "h1 long, h2 long, empty boolean, bytes long, bucket long, subset int"
        )
    )


def _combine(sums: DataFrame, shards: int, fan_in: int) -> DataFrame:
    """(bucket, subset, bytes) with the subset of ``fan_in`` buckets' combination."""

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("bucket", "ascending"), ("subset", "ascending")])
        names, at = np.unique(table["bucket"].to_numpy(), return_inverse=True)
        vectors = np.zeros((len(names), shards), np.int64)
        subset = table["subset"].to_numpy()
        vectors[at, subset] = table["bytes"].to_numpy()
        joined = differencing(vectors)[at, subset]
        return table.append_column("joined", pa.array(joined, pa.int32()))

    return (
        sums.withColumn("above", F.floor(F.col("bucket") / fan_in).cast("long"))
        .groupBy("above")
        .applyInArrow(place, "bucket long, subset int, bytes long, above long, joined int")
    )


def _numbered(rows: DataFrame, shards: int) -> DataFrame:
    """Rows with a running number per shard inside the task, and the task's number."""

    def run(batches):
        task = TaskContext.get().partitionId()
        seen = np.zeros(shards, np.int64)
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            order = np.argsort(shard, kind="stable")
            ranked = shard[order]
            starts = np.searchsorted(ranked, np.arange(shards))
            place = np.empty(len(shard), np.int64)
            place[order] = np.arange(len(shard)) - starts[ranked] + seen[ranked]
            seen += np.bincount(shard, minlength=shards)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(place), pa.array(np.full(len(shard), task, np.int64))],
                [*batch.schema.names, "place", "task"],
            )

    return rows.mapInArrow(
        run, "doc_id long, size long, text_crc32 long, shard int, place long, task long"
    )


def shard_documents(
    docs: DataFrame,
    shards: int = SHARDS,
    bucket_groups: int = BUCKET_GROUPS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per document."""
    text = F.coalesce(docs["text"], F.lit(""))
    slim = written(
        docs.select(
            docs["doc_id"].cast("long").alias("doc_id"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("h1"),
            F.xxhash64(text, F.lit(1)).alias("h2"),
            docs["text"].isNull().alias("empty"),
        ),
        "sizes",
    )
    totals = slim.groupBy("h1", "h2", "empty").agg(F.sum("size").alias("bytes"))
    groups = written(totals, "groups")
    placed = written(_place_groups(groups, shards, bucket_groups), "placed")
    sums = placed.groupBy("bucket", "subset").agg(F.sum("bytes").alias("bytes"))
    buckets = max(1, -(-groups.count() // bucket_groups))
    names = placed.select("h1", "h2", "empty", "bucket", "subset")
    while buckets > 1:
        level = written(_combine(sums, shards, fan_in), "level")
        step = level.select("bucket", "subset", "above", "joined")
        names = names.join(step, ["bucket", "subset"]).select(
            "h1", "h2", "empty", F.col("above").alias("bucket"), F.col("joined").alias("subset")
        )
        sums = level.groupBy(F.col("above").alias("bucket"), F.col("joined").alias("subset")).agg(
            F.sum("bytes").alias("bytes")
        )
        buckets = -(-buckets // fan_in)
    rows = slim.join(names, ["h1", "h2", "empty"]).select(
        "doc_id", "size", "text_crc32", F.col("subset").alias("shard")
    )
    numbered = written(_numbered(rows, shards), "numbered")
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task and shard.
    offsets = (
        numbered.groupBy("shard", "task")
        .agg(F.count("*").alias("n"))
        .select("shard", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    return numbered.join(offsets, ["shard", "task"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") + F.col("offset")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
