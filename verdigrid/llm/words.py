"""Words of whole texts as arrays, in windows of bounded size.

A window is a run of whole rows, or a part of one long row that ends before a byte
outside words. Words are maximal runs of the bytes ``inside`` marks; they never cross
rows. UTF-8 keeps ASCII bytes for ASCII characters, so classes that list ASCII
characters only can be judged byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from verdigrid.llm.blocks import blocks

WINDOW_BYTES = 8 << 20
#: A-Z to a-z, every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(ascii_members: bytes, beyond: bool) -> np.ndarray:
    """A table of 256 truth values: the listed bytes, and those above ASCII."""
    table = np.zeros(256, bool)
    table[list(ascii_members)] = True
    table[128:] = beyond
    return table


class Window:
    """``batch`` rows with their bytes; ``continued`` if the row began earlier."""

    def __init__(self, batch: pa.RecordBatch, data: np.ndarray, bounds: np.ndarray, continued: bool, last: bool):
        self.batch, self.data, self.bounds = batch, data, bounds
        self.continued, self.last = continued, last


def windows(
    batches: Iterator[pa.RecordBatch], text: int, inside: np.ndarray, size: int = WINDOW_BYTES
) -> Iterator[Window]:
    """Windows of about ``size`` bytes; only a single longer word makes one larger."""
    for block in blocks(batches, text, size):
        data, start = block.data, 0
        if len(data) <= size:
            yield Window(block.batch, data, block.bounds, False, True)
            continue
        while start < len(data):
            stop = min(len(data), start + size)
            if stop < len(data):
                free = np.flatnonzero(~inside[data[start:stop]])
                if len(free):
                    stop = start + int(free[-1])
                if not len(free) or stop == start:
                    stop = start + size
                    while stop < len(data) and inside[data[stop]]:
                        ahead = np.flatnonzero(~inside[data[stop : stop + size]])
                        stop += int(ahead[0]) if len(ahead) else min(size, len(data) - stop)
            part = data[start:stop]
            yield Window(block.batch, part, np.array([0, len(part)]), start > 0, stop == len(data))
            start = stop


def beginnings(member: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where runs of members begin; they also begin anew at ``edges``."""
    first = member.copy()
    first[1:] &= ~member[:-1]
    first[edges] = member[edges]
    return first


def endings(member: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where runs of members that begin at ``first`` have their last place."""
    final = member.copy()
    final[:-1] &= ~member[1:] | first[1:]
    return final


class Words:
    """All words of a window: places, rows, and numbers into a dictionary.

    ``fold`` maps bytes before words are compared, by default A-Z to a-z.
    """

    def __init__(self, window: Window, inside: np.ndarray, fold: np.ndarray | None = LOWER):
        data, bounds = window.data if fold is None else fold[window.data], window.bounds
        member = inside[data]
        edges = bounds[:-1][bounds[:-1] < len(data)]
        self.place(data, bounds, data[member], member, beginnings(member, edges))

    def place(self, data: np.ndarray, bounds: np.ndarray, letters, member: np.ndarray, first: np.ndarray) -> None:
        """Words of the ``member`` bytes, in ``letters``, each from a ``first`` byte on."""
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(endings(member, first)) + 1
        self.rows = np.repeat(np.arange(len(bounds) - 1), np.diff(np.searchsorted(self.starts, bounds)))
        offsets = np.concatenate([[0], np.cumsum(self.ends - self.starts)]).astype(np.int64)
        array = pa.Array.from_buffers(
            pa.large_binary(),
            len(self.starts),
            [None, pa.py_buffer(offsets), pa.py_buffer(letters)],
        )
        encoded = array.dictionary_encode()
        self.numbers = encoded.indices.to_numpy()
        self.dictionary = encoded.dictionary
        self.data = data
