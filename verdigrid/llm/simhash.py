"""SimHash near-duplicates: a self-join of binary tries, and one row per group.

Fingerprints go to tables of equal bits: 64 bits in six segments, and a table for
each choice of two segments. Four differing bits leave two segments untouched, so
every link lies inside a group of at least one table. A task holds many groups as one
sorted array, that is, as a forest of binary tries: a node is a range of the array, its
children are split at the next bit. Pairs of nodes are traversed together, one bit a
step; a step to different children spends one of the four allowed bits, and a pair
that has none left and differs is dropped. Pairs whose leaves are already known to be
one component are dropped too, so a dense group of near copies costs little more than
its size. Links leave the task as stars (a spanning forest), never as all pairs.

A group of more than ``FOREST_ROWS`` fingerprints is set aside by its task, which keeps
none of them, and cut into pieces of ``PIECE_ROWS``; pieces are joined pair by pair, each
pair in a task of its own that starts from the two tries' roots.

Copies share a fingerprint and enter the join once. Null text counts as empty and has
fingerprint zero, linked like any other. Ids may repeat; a null id never names a
component unless all ids of the component are null, then the component is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigrid.llm.blocks import Block, blocks
from verdigrid.llm.components import components
from verdigrid.operators.keyed import group_values
from verdigrid.shared import written

SHINGLE = 4
SEED = 42
MAX_BITS = 4
#: (first bit, width) of the segments, from the lowest bit.
SEGMENTS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
TABLES = tuple(combinations(SEGMENTS, len(SEGMENTS) - MAX_BITS))
#: Fingerprints of whole groups that a task joins at once, and node pairs it expands.
FOREST_ROWS = 1 << 17
PIECE_ROWS = 1 << 15
PAIR_ROWS = 1 << 19
#: Groups from this size on first link fingerprints that differ in one bit.
DENSE = 256


def _hashes(text: bytes) -> list[int]:
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        return [digest(joined, SEED)]
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    starts = (ends - sizes)[: 1 - SHINGLE].tolist()
    return [digest(joined[a:b], SEED) for a, b in zip(starts, (ends - 1)[SHINGLE - 1 :].tolist())]


def fingerprints(block: Block) -> np.ndarray:
    """64-bit fingerprints, unsigned."""
    lists = [_hashes(t) for t in block.texts()]
    sizes = np.array([len(x) for x in lists])
    out = np.zeros(len(lists), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        flat = np.fromiter((h for x in lists for h in x), np.uint64, int(sizes.sum()))
        at = np.cumsum(sizes[full]) - sizes[full]
        bits = [
            np.add.reduceat(((flat >> np.uint64(k)) & np.uint64(1)).astype(np.int32), at)
            for k in range(64)
        ]
        for k, count in enumerate(bits):
            out[full] |= (count * 2 > sizes[full]).astype(np.uint64) << np.uint64(k)
    return out


def printed(docs: DataFrame) -> DataFrame:
    """doc_id, fp (long) and two hashes of the text, one row per row of ``docs``."""
    text = F.coalesce(docs["text"], F.lit(""))
    slim = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        text.alias("text"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(text, F.lit(1)).alias("h2"),
    )

    def run(batches):
        for block in blocks(batches, 1):
            ids, _, h1, h2 = block.batch.columns
            fp = pa.array(fingerprints(block).view(np.int64))
            yield pa.RecordBatch.from_arrays([ids, fp, h1, h2], ["doc_id", "fp", "h1", "h2"])

    return slim.mapInArrow(run, "doc_id long, fp long, h1 long, h2 long")


def connect(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of ``a`` and ``b``; every node points to its root afterwards."""
    while True:
        x, y = parent[a], parent[b]
        open_ = x != y
        if not open_.any():
            return
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while (up := parent[parent]).tobytes() != parent.tobytes():
            parent[:] = up


class Forest:
    """Tries of several groups in one array, sorted by group and fingerprint."""

    def __init__(self, starts: np.ndarray, prints: np.ndarray, limit: int = MAX_BITS):
        self.prints, self.limit = prints, limit
        self.starts, self.ends = starts, np.append(starts[1:], len(prints))
        self.parent = np.arange(len(prints))
        self.ones: dict[int, np.ndarray] = {}
        self.changes = np.zeros(0, np.int64)

    def _one_bit_links(self) -> None:
        for a, b in zip(self.starts.tolist(), self.ends.tolist()):
            if b - a < DENSE:
                continue
            own = self.prints[a:b]
            for bit in range(64):
                other = own ^ np.uint64(1 << bit)
                at = np.minimum(np.searchsorted(own, other), len(own) - 1)
                hit = np.flatnonzero(own[at] == other)
                connect(self.parent, a + hit, a + at[hit])

    def _refresh(self) -> None:
        """Running count of places where neighbours are of different components."""
        self.changes = np.cumsum(np.diff(self.parent, prepend=self.parent[:1]) != 0)

    def _settled(self, pairs: np.ndarray) -> np.ndarray:
        a, b, c, d, _ = pairs
        same = self.parent[a] == self.parent[c]
        flat = (self.changes[a] == self.changes[b - 1]) & (self.changes[c] == self.changes[d - 1])
        return same & flat

    def _middle(self, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
        if depth not in self.ones:
            bit = (self.prints >> np.uint64(63 - depth)) & np.uint64(1)
            self.ones[depth] = np.concatenate([[0], np.cumsum(bit.astype(np.int32))]).astype(np.int32)
        ones = self.ones[depth]
        return hi - (ones[hi] - ones[lo])

    def _children(self, pairs: np.ndarray, depth: int) -> np.ndarray:
        a, b, c, d, spent = pairs
        m, n = self._middle(a, b, depth), self._middle(c, d, depth)
        apart = a != c
        out = np.concatenate(
            [
                np.stack([a, m, c, n, spent]),
                np.stack([m, b, n, d, spent]),
                np.stack([a, m, n, d, spent + 1]),
                np.stack([m, b, c, n, spent + 1])[:, apart],
            ],
            axis=1,
        )
        alone = (out[0] == out[2]) & (out[1] - out[0] == 1)
        full = (out[1] > out[0]) & (out[3] > out[2]) & (out[4] <= self.limit)
        return out[:, full & ~alone]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Places that hang on another place, and that place: a spanning forest."""
        self._one_bit_links()
        self._refresh()
        many = self.ends - self.starts > 1
        s, e = self.starts[many], self.ends[many]
        return self._joined(np.stack([s, e, s, e, np.zeros_like(s)]))

    def between(self) -> tuple[np.ndarray, np.ndarray]:
        """The same for links from the first group to the second one."""
        self._refresh()
        return self._joined(np.array([[self.starts[0]], [self.ends[0]], [self.starts[1]], [self.ends[1]], [0]]))

    def _joined(self, roots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Traverse pairs of nodes from pairs of roots."""
        stack = [(0, roots)]
        while stack:
            depth, pairs = stack.pop()
            pairs = pairs[:, ~self._settled(pairs)]
            leaf = (pairs[1] - pairs[0]) * (pairs[3] - pairs[2]) == 1
            x, y = pairs[0, leaf], pairs[2, leaf]
            near = np.bitwise_count(self.prints[x] ^ self.prints[y]) <= self.limit
            if near.any():
                connect(self.parent, x[near], y[near])
                self._refresh()
            pairs = pairs[:, ~leaf]
            if depth < 64 and pairs.shape[1]:
                below = self._children(pairs, depth)
                for at in range(0, below.shape[1], PAIR_ROWS):
                    stack.append((depth + 1, below[:, at : at + PAIR_ROWS]))
        hung = np.flatnonzero(self.parent != np.arange(len(self.parent)))
        return hung, self.parent[hung]


def _found(forest: Forest, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    values = forest.prints.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(values[a]), pa.array(values[b])], ["u", "v"])


def _group_links(limit: int):
    """Links inside the groups of sorted (bucket, fp) rows.

    A group of more than ``limit`` rows is given up as soon as it is seen to be one: the
    task returns its bucket with no partner and lets its other rows pass.
    """

    def joined(groups: np.ndarray, prints: np.ndarray):
        starts = np.flatnonzero(np.diff(groups, prepend=groups[0] - 1))
        if len(starts) < len(groups):
            forest = Forest(starts, prints)
            yield _found(forest, *forest.links())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_g, rest_p = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, given_up = 0, None
        for batch in batches:
            groups, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if given_up is not None:
                kept = groups != given_up
                groups, prints = groups[kept], prints[kept]
            if not len(groups):
                continue
            held.append((groups, prints))
            size += len(groups)
            if size + len(rest_g) <= limit:
                continue
            groups = np.concatenate([rest_g, *(g for g, _ in held)])
            prints = np.concatenate([rest_p, *(p for _, p in held)])
            cut = int(np.searchsorted(groups == groups[-1], True))
            if cut:
                yield from joined(groups[:cut], prints[:cut])
            rest_g, rest_p, held, size = groups[cut:], prints[cut:], [], 0
            if len(rest_g) > limit:
                given_up = int(rest_g[0])
                rest_g, rest_p = rest_g[:0], rest_p[:0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([given_up]), pa.array([None], pa.int64())], ["u", "v"]
                )
        groups = np.concatenate([rest_g, *(g for g, _ in held)])
        if len(groups):
            yield from joined(groups, np.concatenate([rest_p, *(p for _, p in held)]))

    return run


def _pair_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the two pieces of (key, values) rows that share a key, or inside one."""

    def joined(pieces: list[np.ndarray]):
        pieces = [np.sort(p.view(np.uint64)) for p in pieces]
        starts = np.cumsum([0, *map(len, pieces[:-1])])
        forest = Forest(starts, np.concatenate(pieces))
        yield _found(forest, *(forest.links() if len(pieces) == 1 else forest.between()))

    key, pieces = None, []
    for batch in batches:
        for *now, values in zip(*(batch.column(n).to_pylist() for n in ("bucket", "low", "high")), batch.column("values")):
            if now != key and pieces:
                yield from joined(pieces)
                pieces = []
            key = now
            pieces.append(values.values.to_numpy())
    if pieces:
        yield from joined(pieces)


def links(prints: DataFrame, forest_rows: int = FOREST_ROWS, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Links (u, v) between different fingerprints ``fp``: stars of each group."""
    distinct = prints.select(F.col("fp").alias("fp")).distinct()
    buckets = []
    for number, parts in enumerate(TABLES):
        bucket = F.lit(number)
        for first, width in parts:
            bucket = F.shiftleft(bucket.cast("long"), width).bitwiseOR(
                F.shiftrightunsigned("fp", first).bitwiseAND((1 << width) - 1)
            )
        buckets.append(bucket)
    dealt = distinct.select(F.explode(F.array(*buckets)).alias("bucket"), "fp")
    # Sorted by the unsigned value: the order of a trie.
    unsigned = F.col("fp").bitwiseXOR(F.lit(-(2**63)).cast("long"))
    found = written(
        dealt.repartition("bucket")
        .sortWithinPartitions("bucket", unsigned)
        .mapInArrow(_group_links(forest_rows), "u long, v long"),
        "bucket-links",
    )
    large = found.where("v IS NULL").select(F.col("u").alias("bucket"))
    if large.isEmpty():
        return found
    pieces = written(
        group_values(dealt.join(large, "bucket", "left_semi"), ["bucket"], "fp", [], piece_rows), "pieces"
    )
    numbers = pieces.groupBy("bucket").agg(F.max("chunk").alias("last"))
    pairs = pieces.join(numbers, "bucket").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
    between = (
        pairs.select("bucket", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "values")
        .repartition("bucket", "low", "high")
        .sortWithinPartitions("bucket", "low", "high")
        .mapInArrow(_pair_links, "u long, v long")
    )
    return found.where("v IS NOT NULL").unionByName(between)


def near_duplicates(prints: DataFrame) -> DataFrame:
    """``prints`` (doc_id, fp, ...; a written table) with ``root``, ``component_id``.

    The smallest id of each component is written before it is joined, so that adaptive
    execution can split the fingerprints of a large component over many tasks.
    """
    roots = components(links(prints))
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    rooted = written(
        least.join(roots, least["fp"] == roots["u"], "left").select(
            "fp", F.coalesce("root", "fp").alias("root"), "least_id"
        ),
        "rooted",
    )
    named = written(
        rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "component-ids"
    )
    names = rooted.join(named, "root").select("fp", "root", "component_id")
    return prints.join(names, "fp", "left")


def simhash_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id, one row per row of ``docs``."""
    prints = written(printed(docs), "prints")
    return near_duplicates(prints).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one_each(docs: DataFrame) -> DataFrame:
    """One document of each group, with all its columns: the smallest id.

    Documents are told apart by id and text. Rows that are equal in both are copies,
    and one of them stays; only such rows are grouped with their texts.
    """
    prints = written(printed(docs), "prints")
    named = near_duplicates(prints)
    # Null ids come last, so a document without id stays only if it has no other.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "h1", "h2")
    chosen = (
        named.groupBy("root").agg(F.min(order).alias("one")).select("one.doc_id", "one.h1", "one.h2")
    )
    rows = prints.groupBy("doc_id", "h1", "h2").agg(F.count("*").alias("copies"))
    same = lambda a, b: (
        a["doc_id"].eqNullSafe(b["doc_id"]) & (a["h1"] == b["h1"]) & (a["h2"] == b["h2"])
    )
    kept = written(
        rows.join(chosen, same(rows, chosen), "left_semi"), "kept-documents"
    )
    text = F.coalesce(docs["text"], F.lit(""))
    keys = (
        docs["doc_id"].cast("long"),
        F.xxhash64(text),
        F.xxhash64(text, F.lit(1)),
    )

    def taken(some: DataFrame) -> DataFrame:
        where = (
            keys[0].eqNullSafe(some["doc_id"]) & (keys[1] == some["h1"]) & (keys[2] == some["h2"])
        )
        return docs.join(some, where, "left_semi")

    alone = taken(kept.where("copies = 1"))
    repeated = taken(kept.where("copies > 1")).dropDuplicates(["doc_id", "text"])
    return alone.unionByName(repeated)
