"""Exact top-k search by distributed histogram selection.

Every pass scores all rows against a block of queries inside the tasks and counts the
scores in bins; the counts of all tasks are added, and the bin that holds a query's
k-th largest score becomes its range in the next pass, until a bin is one score wide.
A task sends bins from the top down to its own k-th score, as no lower bin can hold
the k-th of all. The last pass returns what lies above the k-th score, and of what
equals it the smallest ids, as many as are missing.

Components become floor(256 * x). Queries are rows whose ``vec_id`` is divisible by
50, a bounded block at a time; a query's own row, and any other row with its id, is
not a candidate. Null vectors, vectors with null or non-finite components and rows
without id take no part. A vector is scored against vectors of its own length. Scores
beyond the long range are cut to it. Repeated rows are candidates each; a repeated
query counts once, and rows with one id and different vectors are queries each, with
lists of their own under that id.

The driver holds one block of queries: its winners are written before the next block is
fetched, so no plan refers to it any more.
"""

from __future__ import annotations

from collections.abc import Iterator
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdigrid.llm.blocks import bounded
from verdigrid.shared import fresh_folder

K = 5
EVERY = 50
SCALE = 256.0
#: Queries of one pass, bins of a histogram, rows scored at once.
QUERY_BLOCK = 2048
BIN_BITS = 12
ROW_BLOCK = 1024
LONG = np.iinfo(np.int64)


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and integer components (as doubles) of the sound rows, by vector length."""
    ids, column = batch.column(0), batch.column(1)
    lists = column.cast(pa.large_list(pa.float64()))
    lengths = np.diff(lists.offsets.to_numpy())
    values = lists.flatten() if lists.null_count == 0 else lists.fill_null([]).flatten()
    if lists.null_count:
        lengths = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, lengths)
    x = values.to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes NaN
    starts = np.cumsum(lengths) - lengths
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(x * SCALE))])
    sound = bad[starts + lengths] == bad[starts]
    sound &= ~column.is_null().to_numpy(zero_copy_only=False)
    sound &= ~ids.is_null().to_numpy(zero_copy_only=False)
    names = ids.fill_null(0).to_numpy()
    for n in np.unique(lengths[sound]):
        at = np.flatnonzero(sound & (lengths == n))
        rows = x[starts[at][:, None] + np.arange(n)]
        yield names[at], np.floor(rows * SCALE)


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products, exact also where doubles are not."""
    biggest = max(np.abs(queries).max(initial=0), 1) * max(np.abs(rows).max(initial=0), 1)
    if biggest * queries.shape[1] < 2**53:
        return (queries @ rows.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(queries).dot(whole(rows).T) if queries.shape[1] else np.zeros(
        (len(queries), len(rows)), object
    )
    return np.clip(exact, LONG.min, LONG.max).astype(np.int64)


class Block:
    """A block of queries, grouped by vector length, and scoring of batches."""

    def __init__(self, queries: list[tuple[int, np.ndarray]]):
        self.ids = np.array([q for q, _ in queries], np.int64)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        lengths = np.array([len(v) for _, v in queries])
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            self.by_length[int(n)] = at, np.array([queries[i][1] for i in at], float).reshape(len(at), int(n))

    def scored(self, batches):
        """Places of queries, row ids, scores, and which of them count."""
        for batch in batches:
            for ids, rows in _vectors(batch):
                if rows.shape[1] not in self.by_length:
                    continue
                at, queries = self.by_length[rows.shape[1]]
                for a in range(0, len(ids), ROW_BLOCK):
                    some = ids[a : a + ROW_BLOCK]
                    order = np.argsort(some, kind="stable")
                    some = some[order]
                    found = scores(queries, rows[a : a + ROW_BLOCK][order])
                    yield at, some, found, self.ids[at][:, None] != some[None, :]


def _extremes(block: Block, k: int):
    """Per query the smallest and largest score and the number of candidates."""

    def run(batches):
        n = len(block.ids)
        low, high, count = np.full(n, LONG.max), np.full(n, LONG.min), np.zeros(n, np.int64)
        for at, _, found, valid in block.scored(batches):
            low[at] = np.minimum(low[at], np.where(valid, found, LONG.max).min(1))
            high[at] = np.maximum(high[at], np.where(valid, found, LONG.min).max(1))
            count[at] += valid.sum(1)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[some]) for x in (np.arange(n), low, high, count)],
            ["q", "low", "high", "n"],
        )

    return run


def _histogram(
    block: Block, base: np.ndarray, shift: np.ndarray, ends: np.ndarray, k: np.ndarray
):
    """Counts of the ``ends`` bins from ``base`` on that are 2 ** ``shift`` wide."""

    def run(batches):
        bins = 1 << BIN_BITS
        counts = np.zeros((len(block.ids), bins), np.int32)
        for at, _, found, valid in block.scored(batches):
            # Unsigned, so that ranges over the whole long type do not overflow.
            place = (found.view(np.uint64) - base[at].view(np.uint64)[:, None]) >> shift[at][:, None]
            inside = valid & (found >= base[at][:, None]) & (place < ends[at][:, None])
            rows, columns = np.nonzero(inside)
            flat = rows * bins + place[rows, columns].astype(np.int64)
            counts[at] += np.bincount(flat, minlength=len(at) * bins).reshape(-1, bins).astype(np.int32)
        above = np.cumsum(counts[:, ::-1], axis=1, dtype=np.int64)[:, ::-1] - counts
        q, b = np.nonzero((counts > 0) & (above < k[:, None]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(q), pa.array(b), pa.array(counts[q, b].astype(np.int64))], ["q", "bin", "n"]
        )

    return run


def _winners(block: Block, limit: np.ndarray, ties: np.ndarray):
    """Rows above each query's limit, and the smallest ids among those at it."""

    def run(batches):
        held: dict[int, list[int]] = {}
        for at, ids, found, valid in block.scored(batches):
            rows, columns = np.nonzero(valid & (found > limit[at][:, None]))
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block.ids[at[rows]]),
                        pa.array(at[rows]),
                        pa.array(ids[columns]),
                        pa.array(found[rows, columns]),
                    ],
                    ["query_id", "query", "vec_id", "score"],
                )
            rows, columns = np.nonzero(valid & (found == limit[at][:, None]))
            first = np.searchsorted(rows, rows)  # ids rise inside a query
            near = np.flatnonzero(np.arange(len(rows)) - first < ties[at[rows]])
            for r, c in zip(at[rows[near]].tolist(), ids[columns[near]].tolist()):
                best = held.setdefault(r, [])
                best.append(c)
                if len(best) >= 4 * ties[r]:
                    held[r] = sorted(best)[: ties[r]]
        rows = [(r, c) for r, best in held.items() for c in sorted(best)[: ties[r]]]
        at = np.array([r for r, _ in rows], np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(block.ids[at]),
                pa.array(at),
                pa.array(np.array([c for _, c in rows], np.int64)),
                pa.array(limit[at]),
            ],
            ["query_id", "query", "vec_id", "score"],
        )

    return run


def _query_blocks(rows: DataFrame, every: int, size: int) -> Iterator[Block]:
    """Blocks of at most ``size`` queries, in the order of their ids."""
    chosen = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "embedding"])
    names, vectors = [], []
    for row in chosen.orderBy("vec_id").toLocalIterator():  # one bounded block at a time
        names.append(row["vec_id"])
        vectors.append(row["embedding"])
        if len(names) == size:
            yield from _sound_block(names, vectors)
            names, vectors = [], []
    yield from _sound_block(names, vectors)


def _sound_block(names: list, vectors: list) -> Iterator[Block]:
    batch = pa.RecordBatch.from_arrays(
        [pa.array(names, pa.int64()), pa.array(vectors, pa.list_(pa.float64()))], ["i", "v"]
    )
    queries = [(int(i), v) for ids, rows in _vectors(batch) for i, v in zip(ids, rows)]
    if queries:
        yield Block(queries)


def _located(rows: DataFrame, block: Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each query's k-th largest score, and how many of that score are wanted."""
    n = len(block.ids)
    base, high = np.zeros(n, np.int64), np.zeros(n, np.int64)
    total = np.zeros(n, np.int64)
    spread = rows.mapInArrow(_extremes(block, k), "q long, low long, high long, n long")
    extremes = spread.groupBy("q").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")
    )
    for r in bounded(extremes, n).to_pylist():
        base[r["q"]], high[r["q"]], total[r["q"]] = r["low"], r["high"], r["n"]
    wanted = np.minimum(k, total)  # still to find, from the top of the range
    # Bits of the range in which the k-th score is known to lie.
    bits = np.array([(int(h) - int(b)).bit_length() for b, h in zip(base, high)])
    down = Window.partitionBy("q").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    while wanted.any():
        step = np.minimum(bits, BIN_BITS)
        shift, ends = (bits - step).astype(np.uint64), np.uint64(1) << step.astype(np.uint64)
        counts = (
            rows.mapInArrow(
                _histogram(block, base, shift, ends, wanted), "q long, bin long, n long"
            )
            .groupBy("q", "bin")
            .agg(F.sum("n").alias("n"))
            .withColumn("upto", F.sum("n").over(down))
        )
        asked = F.array(*(F.lit(int(w)) for w in wanted))
        found = (
            counts.withColumn("wanted", F.element_at(asked, (F.col("q") + 1).cast("int")))
            .where((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("n") < F.col("wanted")))
            .select("q", "bin", (F.col("upto") - F.col("n")).alias("above"))
        )
        for r in bounded(found, n).to_pylist():
            q = r["q"]
            base[q] = int(base[q]) + (r["bin"] << int(shift[q]))
            wanted[q] -= r["above"]
        bits = bits - step
        if not bits.any():
            break
    return base, wanted


def top_k(
    embeddings: DataFrame, k: int = K, every: int = EVERY, query_block: int = QUERY_BLOCK
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best candidates of every query."""
    rows = embeddings.select(
        embeddings["vec_id"].cast("long").alias("vec_id"),
        embeddings["embedding"].cast("array<double>").alias("embedding"),
    )
    kind = "query_id long, query long, vec_id long, score long"
    spark = embeddings.sparkSession
    folder, number = fresh_folder(spark, "winners"), 0
    for number, block in enumerate(_query_blocks(rows, every, query_block), 1):
        limit, ties = _located(rows, block, k)
        winners = rows.mapInArrow(_winners(block, limit, ties), kind)
        winners.write.parquet(f"{folder}/block={number}")
    if number:
        found = spark.read.schema(f"{kind}, block int").parquet(folder)
    else:
        found = spark.createDataFrame([], f"{kind}, block int")
    order = Window.partitionBy("query_id", "block", "query").orderBy(F.desc("score"), "vec_id")
    return (
        found
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


SQL = f"""
WITH ints AS (SELECT vec_id,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings),
scored AS (SELECT q.vec_id AS query_id, c.vec_id,
    list_inner_product(q.v, c.v)::BIGINT AS score
  FROM ints q JOIN ints c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id
    ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= {K}
"""
