"""Ranked lexical search: short lists summed up, long lists skipped through.

The index is a table of segments. A segment covers the documents of one window of
text: their ids and lengths, and for each term its postings (documents rising, with
counts). It knows nothing of queries and is written once.

A segment is a row of some megabytes. Left to themselves, a writer of files buffers a
hundred rows before it looks at their size, a reader takes in 4,096 of a row group at
once, and Python gets up to 64 MB of them together, so a task's memory grows with the
files it reads and writes. The index has row groups of about ``GROUP_BYTES``, or of one
larger segment, and is handed to Python in batches of that size.

A search takes a bounded block of items at a time. One pass over the segments counts
how many documents hold each of the block's terms; a second one runs every item
against every segment of a task:

* lists of rare terms (``SHORT`` of the segment's documents together with the rarer
  ones) are taken term at a time and summed into accumulators, which from then on are
  one more list, with its largest sum as bound;
* that list and the long ones are taken document at a time, a range of documents in a
  step. Lists whose bounds together stay below the item's k-th score so far bring no
  candidate of their own; a candidate is looked up in them, largest bound first, by
  binary search, only while it can still reach that score.

The k-th score carries over from segment to segment of a task. A task returns ``k``
rows for an item at most, and the best of all tasks are ranked by score and id.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII, with
A-Z lower-cased. Null text has no terms, and neither has an empty one. Repeated
document rows are documents each; rows of ``items`` with equal ids are one item with
the terms of all. An item or document id may be null; a null document id comes last
among equal scores. Items without a match have no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdigrid.llm.blocks import bounded
from verdigrid.llm.words import WINDOW_BYTES, Words, byte_class, windows
from verdigrid.session import job_settings
from verdigrid.shared import written

K = 10
#: Terms of a block of items; an item is never split.
BLOCK_TERMS = 200_000
#: Lists that together hold at most this share of a segment's documents are short.
SHORT = 0.25
#: Documents of a step.
STEP = 1024
#: Of the index in files, and of what Python gets of it at once; a segment is never split.
GROUP_BYTES = 1 << 20

_INSIDE = byte_class(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", True)
#: docs, tfs: unsigned integers of 1, 2 or 4 bytes, the lists of all terms one after another.
SEGMENT = (
    "doc_ids array<long>, lengths array<long>, terms array<binary>, dfs array<int>, "
    "docs binary, tfs binary"
)
_SEGMENT = pa.schema(
    [
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("terms", pa.list_(pa.binary())),
        ("dfs", pa.list_(pa.int32())),
        ("docs", pa.binary()),
        ("tfs", pa.binary()),
    ]
)
_LAST = np.iinfo(np.int64).max
#: The size of pages and row groups is looked at after every row.
_ROW_GROUPS = {
    "parquet.block.size": str(GROUP_BYTES),
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "1",
}


def _batches(size: int) -> dict[str, str]:
    """Settings of a job: a batch for Python ends with the row that brings it to ``size`` bytes."""
    return {"spark.sql.execution.arrow.maxBytesPerBatch": str(size)}


def _packed(numbers: np.ndarray) -> bytes:
    kind = np.min_scalar_type(numbers.max(initial=0))
    return numbers.astype(kind.newbyteorder("<")).tobytes()


def _unpacked(packed: pa.BinaryScalar, many: int) -> np.ndarray:
    data = packed.as_buffer()
    return np.frombuffer(data, f"<u{max(data.size // max(many, 1), 1)}")


def _segment(ids: pa.Array, lengths, terms: pa.Array, dfs, docs, tfs) -> pa.RecordBatch:
    columns = [ids, pa.array(lengths, pa.int64()), terms, pa.array(dfs, pa.int32())]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns]
    packed = [pa.array([_packed(x)], pa.binary()) for x in (docs, tfs)]
    return pa.RecordBatch.from_arrays([*lists, *packed], schema=_SEGMENT)


def _segments(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """One segment per window; the windows of a long text make one segment together."""
    parts: list[tuple[pa.Array, np.ndarray]] = []
    length = 0
    for window in windows(batches, 1, _INSIDE, size):
        words = Words(window, _INSIDE)
        ids = window.batch.column(0)
        terms = words.dictionary.cast(pa.binary())
        if window.last and not parts:
            many = max(len(ids), 1)
            key, counts = np.unique(words.numbers.astype(np.int64) * many + words.rows, return_counts=True)
            dfs = np.bincount(key // many, minlength=len(terms))
            lengths = np.bincount(words.rows, minlength=len(ids))
            yield _segment(ids, lengths, terms, dfs, key % many, counts)
            continue
        parts.append((terms, np.bincount(words.numbers, minlength=len(terms))))
        length += len(words.numbers)
        if window.last or len(parts) == 8:
            every = pa.chunked_array([t for t, _ in parts], pa.binary()).combine_chunks().dictionary_encode()
            counts = np.bincount(
                every.indices.to_numpy(), np.concatenate([c for _, c in parts]), len(every.dictionary)
            ).astype(np.int64)
            parts = [(every.dictionary, counts)]
        if window.last:
            terms, counts = parts[0]
            one = np.ones(len(terms), np.int64)
            yield _segment(ids, [length], terms, one, one - 1, counts)
            parts, length = [], 0


def build_index(docs: DataFrame, window_bytes: int = WINDOW_BYTES) -> DataFrame:
    """The segments of ``docs`` (doc_id, text) as a written table."""
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    segments = slim.mapInArrow(lambda some: _segments(some, window_bytes), SEGMENT)
    # With its last row, a batch shall still fit a window.
    with job_settings(docs.sparkSession, _batches(window_bytes * 7 // 8)):
        return written(segments, "lexical-index", _ROW_GROUPS)


def _item_terms(batches):
    for window in windows(batches, 1, _INSIDE):
        words = Words(window, _INSIDE)
        many = len(words.dictionary)
        pairs = np.unique(words.rows * many + words.numbers) if many else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                window.batch.column(0).take(pa.array(pairs // max(many, 1))),
                words.dictionary.cast(pa.binary()).take(pa.array(pairs % max(many, 1))),
            ],
            ["item_id", "term"],
        )


class Items:
    """A block of items: their ids, and the numbers of their terms."""

    def __init__(self, table: pa.Table):
        terms = table.column("term").combine_chunks().dictionary_encode()
        self.terms = terms.dictionary
        ids = table.column("item_id").combine_chunks()
        names = ids.dictionary_encode(null_encoding="encode")
        self.ids = names.dictionary.to_pylist()
        order = np.argsort(names.indices.to_numpy(), kind="stable")
        cuts = np.cumsum(np.bincount(names.indices.to_numpy(), minlength=len(self.ids)))[:-1]
        self.lists = np.split(terms.indices.to_numpy()[order], cuts)
        self.weights = np.zeros(len(self.terms), np.int64)


def _blocks(items: DataFrame) -> Iterator[Items]:
    """Items dealt into blocks of about ``BLOCK_TERMS`` terms, one at a time on the driver."""
    slim = items.select(
        items["item_id"].cast("long").alias("item_id"), items["text"].cast("string").alias("text")
    )
    terms = written(slim.mapInArrow(_item_terms, "item_id long, term binary").distinct(), "item-terms")
    sizes = terms.groupBy("item_id").count().agg(F.sum("count"), F.max("count")).first()
    if not sizes[0]:
        return
    number = -(-sizes[0] // BLOCK_TERMS)
    block = F.pmod(F.xxhash64("item_id"), F.lit(number))
    for k in range(number):
        table = bounded(terms.where(block == k), 3 * BLOCK_TERMS + 8 * sizes[1])
        if table.num_rows:
            yield Items(table)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {n: batch.column(n)[k] for n in batch.schema.names}


def _document_counts(items: Items):
    """In how many documents of the task each term of the block occurs."""

    def run(batches):
        counts = np.zeros(len(items.terms), np.int64)
        for row in _rows(batches):
            at = pc.index_in(row["terms"].values, items.terms)
            here = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
            counts[at.fill_null(0).to_numpy()[here]] += row["dfs"].values.to_numpy()[here]
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["t", "df"])

    return run


class _Best:
    """The best documents of one item so far."""

    def __init__(self, k: int):
        self.k, self.limit = k, 1
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        scores, ids, null = (
            np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.null, null))
        )
        order = np.lexsort((null, ids, -scores))[: self.k]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]
        if len(order) == self.k:
            self.limit = int(self.scores[-1])  # an equal score may still win by its id


class Segment:
    """A segment's lists for the terms of a block, with what each posting adds."""

    def __init__(self, row: dict, items: Items, n_docs: int, n_terms: int):
        ids = row["doc_ids"].values
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(_LAST).to_numpy()
        at = pc.index_in(row["terms"].values, items.terms)
        here = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
        ends = np.cumsum(row["dfs"].values.to_numpy().astype(np.int64))
        starts = ends - row["dfs"].values.to_numpy()
        docs, tfs = (_unpacked(row[n], int(ends[-1]) if len(ends) else 0) for n in ("docs", "tfs"))
        m = 100 - 90 + (90 * row["lengths"].values.to_numpy() * n_docs) // max(n_terms, 1)
        self.lists: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
        for k, term in zip(here.tolist(), at.fill_null(0).to_numpy()[here].tolist()):
            weight = items.weights[term]
            if weight > 0:
                some, tf = docs[starts[k] : ends[k]], tfs[starts[k] : ends[k]].astype(np.int64)
                adds = weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[some]))
                self.lists[term] = some.astype(np.int64), adds, int(adds.max())

    def search(self, terms: np.ndarray, best: _Best, share: float, step: int) -> None:
        lists = sorted((self.lists[t] for t in terms.tolist() if t in self.lists), key=lambda x: len(x[0]))
        if sum(x[2] for x in lists) < best.limit:
            return
        held = np.cumsum([len(x[0]) for x in lists])
        short = int(np.searchsorted(held, share * len(self.ids), "right"))
        if short > 1:  # term at a time
            docs, adds = (np.concatenate([x[k] for x in lists[:short]]) for k in (0, 1))
            order = np.argsort(docs, kind="stable")
            docs, adds = docs[order], adds[order]
            first = np.flatnonzero(np.diff(docs, prepend=-1))
            sums = np.add.reduceat(adds, first)
            lists = [(docs[first], sums, int(sums.max())), *lists[short:]]
        lists.sort(key=lambda x: x[2])
        reach = np.cumsum([x[2] for x in lists])  # of a list and all with smaller bounds
        low = 0
        while low < len(self.ids):  # document at a time, a range of them in a step
            high = min(len(self.ids), low + step)
            leading = int(np.searchsorted(reach, best.limit))  # lists before it are looked up only
            if leading == len(lists):
                return
            total, seen = np.zeros(high - low, np.int64), np.zeros(high - low, bool)
            for docs, adds, _ in lists[leading:]:
                a, b = np.searchsorted(docs, (low, high))
                total[docs[a:b] - low] += adds[a:b]
                seen[docs[a:b] - low] = True
            near = np.flatnonzero(seen)
            for k in range(leading - 1, -1, -1):
                near = near[total[near] + reach[k] >= best.limit]
                if not len(near):
                    break
                docs, adds, _ = lists[k]
                at = np.minimum(np.searchsorted(docs, near + low), len(docs) - 1)
                hit = docs[at] == near + low
                total[near[hit]] += adds[at[hit]]
            near = near[total[near] >= best.limit]
            if len(near):
                best.add(total[near], self.ids[near + low], self.null[near + low])
            low = high


def _searched(items: Items, n_docs: int, n_terms: int, k: int, share: float, step: int):
    def run(batches):
        best = [_Best(k) for _ in items.ids]
        for row in _rows(batches):
            segment = Segment(row, items, n_docs, n_terms)
            for terms, own in zip(items.lists, best):
                segment.search(terms, own, share, step)
        places = np.repeat(np.arange(len(best)), [len(b.scores) for b in best])
        ids, null, scores = (
            np.concatenate([getattr(b, n) for b in best]) for n in ("ids", "null", "scores")
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(items.ids, pa.int64()).take(pa.array(places)),
                pa.array(ids, mask=null),
                pa.array(scores),
            ],
            ["item_id", "doc_id", "score"],
        )

    return run


def search(
    index: DataFrame, items: DataFrame, k: int = K, short: float = SHORT, step: int = STEP
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item.

    ``short`` and ``step`` say how the work is done and change no result.
    """
    totals = index.select(
        F.coalesce(F.sum(F.size(F.filter("lengths", lambda n: n > 0))), F.lit(0)),
        F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)), F.lit(0)),
    ).first()
    n_docs, n_terms = totals
    kind = "item_id long, doc_id long, score long"
    # Not from a list in Python, which would start another set of workers.
    found = index.sparkSession.range(0).select(
        *(F.lit(None).cast("long").alias(c) for c in ("item_id", "doc_id", "score"))
    )
    counted = index.select("terms", "dfs")
    for block in _blocks(items):
        with job_settings(index.sparkSession, _batches(GROUP_BYTES)):
            dfs = counted.mapInArrow(_document_counts(block), "t long, df long")
            rows = bounded(dfs.groupBy("t").agg(F.sum("df").alias("df")), len(block.terms))
            for t, df in zip(rows.column("t").to_pylist(), rows.column("df").to_pylist()):
                block.weights[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
            # Written before the next block is fetched: the driver holds one block.
            found = found.unionByName(
                written(index.mapInArrow(_searched(block, n_docs, n_terms, k, short, step), kind), "searched")
            )
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )


def lexical_search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """Index ``docs`` and search them for every item."""
    return search(build_index(docs), items, k)


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)),
tf AS (SELECT row, doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT row, sum(tf)::BIGINT AS n FROM tf GROUP BY row),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(docs) + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
  FROM tf, whole GROUP BY term),
m AS (SELECT row, 100 - 90 + (90 * n * docs) // terms AS m FROM n, whole),
s AS (SELECT item_id, doc_id, row, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (row) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""
