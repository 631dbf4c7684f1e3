"""Token ids of whole documents, in files of independently coded blocks.

Documents are range-partitioned by id, so the files of a table follow ascending
``doc_id``; a task encodes its documents in order, cuts the stream of ids into blocks
of ``BLOCK_IDS`` and codes them (see ``rangecoder``). A file row is one block: a record
with its own checksum, and an index of the documents in it. Readers need no other
block; a document that spans blocks is put together from the checksums of its parts.

A piece between blanks and line breaks has the same ids wherever it stands (checked for
the tokenizer file in use), so pieces are told apart once a window of text, and each worker
process keeps the ids of pieces it has met, within ``ragged.MEMORY_BYTES``. Where the file
is found to see a piece as runs of letters, digits and runs of others, in either case, runs
take the place of pieces. New ones go to the library many in a text: a run ends with the
only id that ends a word, pieces have a mark between them; where the count of these is not
the expected one, they go one by one. A text longer than a window is encoded part by part.

A null text counts as empty: its document has the end id only. Null ids come first;
rows with equal ids are ordered by hashes of their texts.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verdigrid.llm.ragged import LONGEST_KEPT, MEMORY_BYTES, gathered
from verdigrid.llm.rangecoder import BLOCK_IDS, decode, encode
from verdigrid.llm.words import Window as TextWindow
from verdigrid.llm.words import LOWER, Words, beginnings, byte_class, endings, windows
from verdigrid.shared import fresh_folder

END_ID = 2
#: Only these two part pieces: other white space may be seen differently by the library.
_INSIDE = byte_class(bytes(sorted(set(range(128)) - {10, 32})), True)

#: index: documents of the block as (number in the task, doc_id, first id, ids here).
FILE_SCHEMA = (
    "task long, block long, record binary, "
    "index array<struct<number:long,doc_id:long,start:long,n:long>>"
)


_NO_IDS, _NO_SIZES = np.zeros(0, np.uint32), np.zeros(0, np.int64)
#: A run: ASCII or Latin-1 letters, one digit, or other printing characters of ASCII.
_RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[0-9]|[!-&(-/:;=-@[-`{-~]+")
#: Pieces with one of these are never cut: contractions, added tokens, control characters.
_ODD = {*b"'<", *range(32), 127}
_LETTER, _DIGIT, _OTHER, _CUT_NEVER = 1, 2, 3, 4
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), 0xC3]] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[[*_ODD, 0xC0, 0xC1, 0xC2, *range(0xC4, 256)]] = _CUT_NEVER
_KIND[[10, 32]] = 0
_KIND = _KIND.tobytes()


class _Runs(Words):
    """Runs of a window's pieces (see ``_RUN``), A-Z in lower case; other pieces whole."""

    def __init__(self, window: TextWindow):
        data, bounds = window.data, window.bounds
        raw = data.tobytes()
        kind = np.frombuffer(bytearray(raw.translate(_KIND)), np.uint8)
        member = kind > 0
        edges = bounds[:-1][bounds[:-1] < len(data)]
        first = beginnings(member, edges)
        odd = np.flatnonzero(kind == _CUT_NEVER)
        lead = np.flatnonzero(data[:-1] == 0xC3)
        odd = np.concatenate([odd, lead[(data[lead + 1] | 32) == 0xB7]])  # signs among the letters
        if len(odd):
            starts, ends = np.flatnonzero(first), np.flatnonzero(endings(member, first)) + 1
            whole = np.unique(np.searchsorted(starts, odd, "right") - 1)
            change = np.zeros(len(data) + 1, np.int8)
            change[starts[whole]] += 1
            change[ends[whole]] -= 1
            inside = np.cumsum(change[:-1], dtype=np.int8).view(bool)
            kind[inside] = _LETTER
            letters = np.where(inside, data, LOWER[data])[member].tobytes()
        else:
            letters = raw.translate(LOWER.tobytes(), b"\n ")
        first[1:] |= member[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
        self.place(data, bounds, letters, member, first)

    def in_order(self) -> pa.Array:
        return self.dictionary.take(pa.array(self.numbers))


class _Known:
    """Ids of pieces met so far, as slices of one array; emptied when its bytes are used up."""

    #: What an entry costs besides its piece and ids.
    ENTRY = 150

    def __init__(self, compute: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        self.compute = compute
        self._clear()

    def _clear(self):
        self.number: dict[bytes, int] = {}
        self.flat = np.array([END_ID], np.uint32)  # number 0 is the end of a document
        self.starts, self.sizes = np.array([0, 1]), np.ones(1, np.int64)
        self.total = self.entries = 1
        self.held = 0

    def _add(self, name: str, at: int, values: np.ndarray):
        old = getattr(self, name)
        if at + len(values) > len(old):
            old = np.concatenate([old[:at], np.zeros(at + 2 * len(values), old.dtype)])
            setattr(self, name, old)
        old[at : at + len(values)] = values

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of entries, one after another."""
        lists = pa.LargeListArray.from_arrays(self.starts[: self.entries + 1], self.flat[: self.total])
        return lists.take(pa.array(numbers)).flatten().to_numpy()

    def look_up(self, pieces: list[bytes]) -> np.ndarray:
        """Numbers of pieces, good until the next call."""
        if self.held > MEMORY_BYTES:
            self._clear()
        numbers = np.fromiter(map(self.number.get, pieces, repeat(-1)), np.int64, len(pieces))
        unknown = np.flatnonzero(numbers < 0)
        if len(unknown):
            new = [pieces[k] for k in unknown.tolist()]
            ids, sizes = self.compute(new)
            self._add("flat", self.total, ids)
            self._add("starts", self.entries + 1, self.total + np.cumsum(sizes))
            self._add("sizes", self.entries, sizes)
            numbers[unknown] = np.arange(self.entries, self.entries + len(new))
            self.number.update(x for x in zip(new, numbers[unknown].tolist()) if len(x[0]) <= LONGEST_KEPT)
            self.total, self.entries = self.total + len(ids), self.entries + len(new)
            self.held += self.ENTRY * len(new) + sum(map(len, new)) + ids.nbytes
        return numbers


class Encoder:
    """Ids of texts by a tokenizer file, white-space-free piece by piece."""

    #: A file whose ids of this text are not those of its pieces is refused.
    PROBE = "It's 3.14 don't  A-b\n c's (x) <ok> _y_ 12\n\nÉ ß 'll z!?"
    #: Pieces that a tokenizer must see as runs of letters, digits, and runs of others, in
    #: either case, for the runs to be encoded in place of pieces.
    RUNS = (
        "The QUICK Brown fOX jumped,over:the LAZY.dog (1234567890) x2y A-Z/b;c \"Ja\" e.g. 3.14 $5 "
        "!#$%&()*+,-./:;=>?@[\\]^_`{|}~ a_b _c... Dé,jà ÀÖ.ØöøÿĄ ÑÉ1ß ß2 été. GARÇON"
    )
    #: Pieces go to the library many at a time with this one between them, if it has one id.
    MARK = "\x01"
    TOGETHER = 1000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self.ends = None
        pieces = [p.encode() for p in self.PROBE.replace("\n", " ").split(" ")]
        whole = self.tokenizer.encode(self.PROBE, add_special_tokens=False).ids
        ids, sizes = self._ids(pieces)
        if whole != ids.tolist():
            raise ValueError("the tokenizer's ids of a piece depend on the white space beside it")
        mark = self._library(self.MARK)
        if len(mark) == 1:
            self.mark = mark[0]
            joined = self._ids(pieces)
            if joined[0].tolist() != whole or joined[1].tolist() != sizes.tolist():
                self.mark = None
        self.ends = self._end_ids()
        self.known = _Known(self._ids)

    def _end_ids(self) -> np.ndarray | None:
        """Which ids end a run, if runs can be encoded in place of pieces."""
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        added = self.tokenizer.get_added_tokens_decoder().values()
        if not suffix or not all(set(t.content.encode()) & _ODD for t in added):
            return None
        ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, number in self.tokenizer.get_vocab().items():
            ends[number] = token.endswith(suffix)
        text = np.frombuffer(self.RUNS.encode(), np.uint8)
        runs = _slices(_Runs(TextWindow(None, text, np.array([0, len(text)]), False, True)).in_order())
        want = self.tokenizer.encode(self.RUNS, add_special_tokens=False).ids
        found = [self._library(r.decode()) for r in runs]
        sound = np.concatenate(found).tolist() == want
        single = [f for r, f in zip(runs, found) if _RUN.fullmatch(r)]
        return ends if sound and all(ends[f].sum() == 1 and ends[f[-1]] for f in single) else None

    def _library(self, text: str) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, np.uint32)

    def _ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and each piece's number of ids."""
        if self.ends is None:
            return self._marked(pieces)
        runs = np.fromiter(map(bool, map(_RUN.fullmatch, pieces)), bool, len(pieces))
        flat, sizes = zip(self._ended(list(compress(pieces, runs))), self._marked(list(compress(pieces, ~runs))))
        order = np.argsort(np.concatenate([np.flatnonzero(runs), np.flatnonzero(~runs)]))
        flat, sizes = np.concatenate(flat), np.concatenate(sizes)
        return gathered(flat, (np.cumsum(sizes) - sizes)[order], sizes[order]), sizes[order]

    def _ended(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs in one text: each run has one id that ends it."""
        flat, sizes = [_NO_IDS], [_NO_SIZES]
        for k in range(0, len(runs), self.TOGETHER):
            some = runs[k : k + self.TOGETHER]
            ids = self._library(b" ".join(some).decode())
            at = np.flatnonzero(self.ends[ids])
            if len(at) == len(some):
                flat.append(ids)
                sizes.append(np.diff(at, prepend=-1))
            else:
                ids, n = self._marked(some)
                flat.append(ids)
                sizes.append(n)
        return np.concatenate(flat), np.concatenate(sizes)

    def _marked(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces in one text with marks between them, or one by one."""
        flat, sizes = [_NO_IDS], [_NO_SIZES]
        for k in range(0, len(pieces), self.TOGETHER):
            texts = [p.decode() for p in pieces[k : k + self.TOGETHER]]
            text, marks = f" {self.MARK} ".join(texts), len(texts) - 1
            if self.mark is not None and text.count(self.MARK) == marks:
                ids = self._library(text)
                at = np.flatnonzero(ids == self.mark)
                if len(at) == marks:
                    flat.append(np.delete(ids, at))
                    sizes.append(np.diff(at, prepend=-1, append=len(ids)) - 1)
                    continue
            apart = [self._library(t) for t in texts]
            flat += apart
            sizes.append(np.fromiter(map(len, apart), np.int64, len(apart)))
        return np.concatenate(flat), np.concatenate(sizes)

    def encode(self, window: TextWindow) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the window's rows, one row after another, and each row's number of ids.

        A row's end id follows its last ids, in the window where the row ends.
        """
        words = Words(window, _INSIDE, fold=None) if self.ends is None else _Runs(window)
        rows, known = len(window.bounds) - 1, self.known
        numbers = known.look_up(_slices(words.dictionary))[words.numbers]
        counts = np.bincount(words.rows, known.sizes.take(numbers), rows).astype(np.int64)
        if window.last:
            numbers = np.insert(numbers, np.searchsorted(words.rows, np.arange(rows), "right"), 0)
            counts += 1
        return known.ids(numbers), counts


def _slices(array: pa.LargeBinaryArray) -> list[bytes]:
    _, ends, data = array.buffers()
    raw = data.to_pybytes() if data is not None else b""
    at = np.frombuffer(ends, np.int64, len(array) + 1, array.offset * 8).tolist() if len(array) else []
    return [raw[a:b] for a, b in zip(at, at[1:])]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file, made once in each worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_tokens(docs: DataFrame, path: str, folder: str) -> None:
    """Write the ids of ``docs`` (doc_id, text) as coded blocks into ``folder``."""
    text = F.coalesce(docs["text"], F.lit(""))
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"))
    tie = (F.xxhash64("text"), F.xxhash64("text", F.lit(1)))

    def run(batches):
        task = TaskContext.get().partitionId()
        encoder = _encoder(path)
        buffer: list[np.ndarray] = []
        # Per document: number, id, first id and number of ids so far; the last may go on.
        index: list[list] = []
        held = number = position = block = 0
        unended = False

        def flush(everything: bool):
            """Code full blocks, or all that is left."""
            nonlocal buffer, index, held, block
            ids = np.concatenate(buffer) if buffer else np.zeros(0, np.uint32)
            take = len(ids) if everything else len(ids) // BLOCK_IDS * BLOCK_IDS
            begin, at = block * BLOCK_IDS, 0
            for a in range(0, take, BLOCK_IDS):
                some = ids[a : min(a + BLOCK_IDS, take)]
                first, last = begin + a, begin + a + len(some)
                inside = []
                while at < len(index) and index[at][2] < last:
                    n, doc, start, size = index[at]
                    lo, hi = max(first, start), min(last, start + size)
                    if hi > lo:
                        inside.append({"number": n, "doc_id": doc, "start": lo, "n": hi - lo})
                    if start + size > last or (unended and at == len(index) - 1):
                        break
                    at += 1
                row = (task, block, encode([some])[0], inside)
                block += 1
                kinds = [pa.int64(), pa.int64(), pa.binary(), _INDEX]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], k) for x, k in zip(row, kinds)],
                    ["task", "block", "record", "index"],
                )
            index, buffer, held = index[at:], [ids[take:]], len(ids) - take

        for window in windows(batches, 1, _INSIDE):
            ids, sizes = encoder.encode(window)
            buffer.append(ids)
            held += len(ids)
            for doc, size in zip(window.batch.column(0).to_pylist(), sizes.tolist()):
                if window.continued:
                    index[-1][3] += size
                else:
                    index.append([number, doc, position, size])
                    number += 1
                position += size
            unended = not window.last
            if held >= BLOCK_IDS:
                yield from flush(False)
        yield from flush(True)

    (
        slim.repartitionByRange(F.asc_nulls_first("doc_id"), *tie)
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), *tie)
        .mapInArrow(run, FILE_SCHEMA)
        .write.parquet(folder)
    )


_INDEX = pa.list_(
    pa.struct([("number", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int64())])
)


def _parts(batches):
    """Decoded documents, or their parts where they span blocks, as checksums."""
    for batch in batches:
        for k in range(batch.num_rows):
            task, block, record = (batch.column(c)[k].as_py() for c in ("task", "block", "record"))
            number, doc_id, start, n = batch.column("index").slice(k, 1).flatten().flatten()
            ids = decode([record])[0].astype("<u4")
            first = start.to_numpy() - block * BLOCK_IDS
            ends = zip(first.tolist(), (first + n.to_numpy()).tolist())
            crc = pa.array([zlib.crc32(ids[a:b]) for a, b in ends], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(crc), task)), number, doc_id, start, n, crc],
                ["task", "number", "doc_id", "start", "n", "crc"],
            )


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the checksum's, bits reversed."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def join_checksums(first: int, second: int, second_bytes: int) -> int:
    """crc32 of two strings, one after the other, from the crc32 of each."""
    power, shift, n = 0x80000000, 0x00800000, second_bytes  # 1 and x ** 8
    while n:
        if n & 1:
            power = _times(power, shift)
        shift, n = _times(shift, shift), n >> 1
    return _times(power, first) ^ second


def _joined(batches):
    for batch in batches:
        out = []
        for parts in batch.column("parts").to_pylist():
            crc = parts[0]["crc"]
            for part in parts[1:]:
                crc = join_checksums(crc, part["crc"], 4 * part["n"])
            out.append(crc)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in ("task", "doc_id", "start", "n")), pa.array(out, pa.int64())],
            ["task", "doc_id", "start", "n", "crc"],
        )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    records = spark.read.schema(FILE_SCHEMA).parquet(folder)
    kinds = "task long, number long, doc_id long, start long, n long, crc long"
    parts = records.mapInArrow(_parts, kinds)
    # A document's parts meet by its place in its task; most have one.
    documents = (
        parts.groupBy("task", "number")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.min("start").alias("start"),
            F.sum("n").alias("n"),
            F.sort_array(F.collect_list(F.struct("start", "n", "crc"))).alias("parts"),
        )
        .mapInArrow(_joined, "task long, doc_id long, start long, n long, crc long")
    )
    sizes = records.select("task", F.explode("index").alias("p")).groupBy("task").agg(F.sum("p.n").alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file of the table.
    offsets = sizes.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return documents.join(offsets, "task").select(
        "doc_id",
        (F.col("start") + F.col("offset")).alias("start"),
        F.col("n").alias("n_tokens"),
        F.col("crc").alias("ids_crc32"),
    )


def token_files(docs: DataFrame, path: str) -> DataFrame:
    """Write the ids of ``docs`` to a new folder and read them back."""
    folder = fresh_folder(docs.sparkSession, "tokens")
    write_tokens(docs, path, folder)
    return read_tokens(docs.sparkSession, folder)
