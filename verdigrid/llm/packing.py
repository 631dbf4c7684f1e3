"""Best-fit packing of documents into bins, with conflicts.

Pieces arrive by falling size. Open bins are ordered by what is left in them and carry
two bitmaps: which places of a source are taken, and which clusters of equal texts are
inside. The search begins at the tightest bin that has room and goes on to the next
larger one until a compatible bin is found; else a bin is opened. A bin holds at most
``PER_SOURCE`` documents of one source and no two equal texts.

Only ids, sizes and hashes are shuffled. Rows are dealt to packing groups by a hash of
id and text, so neither a frequent source nor a group of copies meets in one task, and
the number of groups follows from the number of rows. A group is packed as a stream
and starts anew after ``STREAM_ROWS`` pieces, which only equal rows can reach.

Documents longer than a bin are cut into full pieces, one bin each, and a rest. A null
text counts as empty; empty texts have size 0 and share a bin with each other. A null
source conflicts with nothing. Ids may be null or repeat; every row is packed.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 16384
PER_SOURCE = 2
GROUP_ROWS = 8192
STREAM_ROWS = 4 * GROUP_ROWS

SCHEMA = (
    "doc_id long, piece long, start long, size long, source string, cluster string, "
    "bin long, bin_start long"
)


class Packer:
    """Open bins of one packing group."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.open: list[tuple[int, int]] = []  # (left, bin), sorted
        self.left: list[int] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.source_bits: dict[str, int] = {}
        self.cluster_bits: dict[str, int] = {}

    def _places(self, source: str | None) -> int:
        """The bits of a source: one for each document it may have in a bin."""
        if source is None:
            return 0
        at = self.source_bits.setdefault(source, len(self.source_bits) * self.per_source)
        return ((1 << self.per_source) - 1) << at

    def add(self, size: int, source: str | None, cluster: str | None) -> tuple[int, int]:
        """Bin and first byte in it."""
        if size == self.capacity:  # fills a bin alone
            self.left.append(0)
            self.sources.append(0)
            self.clusters.append(0)
            return len(self.left) - 1, 0
        places = self._places(source)
        own = 0
        if cluster is not None:
            own = 1 << self.cluster_bits.setdefault(cluster, len(self.cluster_bits))
        at = bisect_left(self.open, (size, -1))
        while at < len(self.open):
            number = self.open[at][1]
            if not (self.clusters[number] & own) and (
                not places or self.sources[number] & places != places
            ):
                del self.open[at]
                break
            at += 1
        else:
            number = len(self.left)
            self.left.append(self.capacity)
            self.sources.append(0)
            self.clusters.append(0)
        start = self.capacity - self.left[number]
        self.left[number] -= size
        self.clusters[number] |= own
        free = places & ~self.sources[number]
        self.sources[number] |= free & -free
        insort(self.open, (self.left[number], number))
        return number, start


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    per_source: int = PER_SOURCE,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per piece of every document: where it is cut, and its bin.

    ``bin`` is unique over all groups; ``start`` and ``bin_start`` count bytes of the
    UTF-8 text and of the bin.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    size = F.octet_length(text).cast("long")
    h1, h2 = F.xxhash64(text), F.xxhash64(text, F.lit(1))
    slim = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["source"].cast("string").alias("source"),
        size.alias("total"),
        F.when(size > 0, F.concat(F.hex(h1), F.lit("-"), F.hex(h2))).alias("cluster"),
    )
    groups = max(1, -(-docs.count() // group_rows))
    last = F.greatest(F.lit(0), F.ceil(F.col("total") / capacity) - 1)
    pieces = slim.select(
        "*",
        F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(groups)).alias("part"),
        F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("piece"),
    ).select(
        "part",
        "doc_id",
        "piece",
        (F.col("piece") * capacity).alias("start"),
        F.least(F.lit(capacity), F.col("total") - F.col("piece") * capacity).alias("size"),
        "source",
        "cluster",
    )

    def run(batches):
        part = packer = None
        count = first = 0
        for batch in batches:
            cols = batch.to_pydict()
            bins, starts = [], []
            for p, size, source, cluster in zip(
                cols["part"], cols["size"], cols["source"], cols["cluster"]
            ):
                if p != part:
                    first = 0
                elif count == STREAM_ROWS:
                    first += len(packer.left)
                if p != part or count == STREAM_ROWS:
                    part, packer, count = p, Packer(capacity, per_source), 0
                number, start = packer.add(size, source, cluster)
                count += 1
                bins.append((p << 32) + first + number)
                starts.append(start)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in ("doc_id", "piece", "start", "size", "source", "cluster")),
                    pa.array(bins, pa.int64()),
                    pa.array(starts, pa.int64()),
                ],
                ["doc_id", "piece", "start", "size", "source", "cluster", "bin", "bin_start"],
            )

    return (
        pieces.repartition("part")
        .sortWithinPartitions("part", F.desc("size"), "doc_id", "cluster", "piece", "source")
        .mapInArrow(run, SCHEMA)
    )
