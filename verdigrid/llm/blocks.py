"""Whole texts in bounded blocks, for operators that run inside tasks.

Spark hands a task Arrow batches; a batch of very long texts can be large, so the
operators work on slices of it: as many rows as hold ``block_bytes`` of text, or a
single row where one text alone is longer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 2 << 20


class Block:
    """Rows of a batch with their texts as one byte array and row bounds."""

    def __init__(self, batch: pa.RecordBatch, data: np.ndarray, bounds: np.ndarray):
        self.batch, self.data, self.bounds = batch, data, bounds

    def texts(self) -> list[bytes]:
        raw, at = self.data.tobytes(), self.bounds.tolist()
        return [raw[a:b] for a, b in zip(at, at[1:])]


def blocks(
    batches: Iterator[pa.RecordBatch], text: int, block_bytes: int = BLOCK_BYTES
) -> Iterator[Block]:
    """Slices of bounded text size; a null text is an empty one."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text).cast(pa.large_binary())
        _, ends, data = column.buffers()
        rows = batch.num_rows
        bounds = np.frombuffer(ends, np.int64, rows + 1, column.offset * 8)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        start = 0
        while start < rows:
            stop = int(np.searchsorted(bounds, bounds[start] + block_bytes, "right")) - 1
            stop = min(rows, max(stop, start + 1))
            yield Block(
                batch.slice(start, stop - start),
                raw[bounds[start] : bounds[stop]],
                bounds[start : stop + 1] - bounds[start],
            )
            start = stop


def keyed_texts(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, with ``doc_id`` as long and ``text`` as string."""
    kinds = {"doc_id": "long", "text": "string", "source": "string"}
    return docs.select(*(docs[c].cast(kinds.get(c, "string")).alias(c) for c in columns))


def measure(
    docs: DataFrame,
    kernel: Callable[[Block], dict[str, np.ndarray | pa.Array | list]],
    schema: str,
) -> DataFrame:
    """One row per document: ``doc_id`` and what ``kernel`` returns for its text."""
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches):
        for block in blocks(batches, 1):
            found = kernel(block)
            yield pa.RecordBatch.from_arrays(
                [block.batch.column(0), *(pa.array(found[n]) for n in names)],
                names=["doc_id", *names],
            )

    return keyed_texts(docs, "doc_id", "text").mapInArrow(run, f"doc_id long, {schema}")


def keep_where(docs: DataFrame, verdict: Callable[[Block], np.ndarray]) -> DataFrame:
    """The rows, with all their columns, for which ``verdict`` is true."""
    text = docs.columns.index("text")

    def run(batches):
        for block in blocks(batches, text):
            yield block.batch.filter(pa.array(verdict(block)))

    return docs.mapInArrow(run, docs.schema)


def bounded(df: DataFrame, rows: int) -> pa.Table:
    """A result that has at most ``rows`` rows whatever the input; more is an error."""
    table = df.limit(rows + 1).toArrow()
    if table.num_rows > rows:
        raise ValueError(f"a result meant to have at most {rows} rows has more")
    return table


def held_out(doc_id: Column) -> Column:
    """True for rows that no label is learnt from; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2
