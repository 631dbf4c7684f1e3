"""SentencePiece encoding and decoding by a weighted finite-state transducer.

A model file is compiled once per worker process:

* the normaliser rewrites characters by the model's rules, longest match first, tidies
  white space if the model asks for it, marks blanks and puts a mark in front;
* the pieces are a trie whose arcs end with a piece's id and its weight;
* byte fallback reads a character that is no piece and writes the ids of its bytes.

Weights are from the tropical semiring: costs add along a path, and the cheapest path
wins; of equal ones the path whose last piece begins first. In a unigram model an arc
costs the negative log probability of its piece, a character without a piece ten more
than the dearest piece. A merge-ranked (BPE) model is a language of pairs: a sequence of
pieces is the model's encoding exactly if merging any two neighbours' text gives these
two back, so an arc costs nothing if its piece agrees with the unit before and infinity
if not. Pair weights are computed when a composition first needs them. The transducer is
composed with an input character by character; the cheapest path over states (position,
last unit) is the encoding.

No piece holds a mark behind another character, so a path passes through the start
state before each marked word. Words are told apart once per block; each worker process
keeps the paths of words it has met, within ``ragged.MEMORY_BYTES``. Texts longer than
``PART_BYTES`` are read in parts that end before a blank.

Null text counts as empty; an empty text has no ids. Ids may be null or repeat; every
row gives one row. Other columns are not read.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from verdigrid.llm.blocks import blocks, keyed_texts
from verdigrid.llm.ragged import Memory, gathered

MARK = "▁"
PART_BYTES = 8 << 20
PAIRS = 2_000_000
_UNIGRAM, _BPE = 1, 2
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
#: What a character without a piece costs beyond the dearest piece of a unigram model.
_PENALTY = 10.0


def _units(blob: bytes) -> tuple[list[int], bytes]:
    """The double array and the replacement texts of a compiled character map."""
    size = struct.unpack_from("<I", blob)[0]
    return list(struct.unpack_from(f"<{size // 4}I", blob, 4)), blob[4 + size :]


def character_rules(blob: bytes) -> dict[bytes, bytes]:
    """All (bytes, replacement) rules of a compiled character map; empty for none.

    The map is a double-array trie: a unit's label is its low byte, its children lie at
    its place xor its offset, and a marked child holds the place of a replacement, which
    ends with a zero byte.
    """
    if not blob:
        return {}
    units, texts = _units(blob)
    offset = lambda unit: (unit >> 10) << ((unit & (1 << 9)) >> 6)
    rules, stack = {}, [(0, b"")]
    while stack:
        node, key = stack.pop()
        base = node ^ offset(units[node])
        if key and units[node] >> 8 & 1:
            at = units[base] & 0x7FFFFFFF
            rules[key] = texts[at : texts.index(b"\0", at)]
        for label in range(1, 256):
            child = base ^ label
            if child < len(units) and units[child] & 0x800000FF == label:
                stack.append((child, key + bytes([label])))
    return rules


class Transducer:
    """Normaliser, piece trie, byte fallback and weights of one model."""

    def __init__(self, model: bytes | str):
        """``model``: the content of a model file, or its path."""
        from sentencepiece import sentencepiece_model_pb2 as proto

        if isinstance(model, str):
            with open(model, "rb") as file:
                model = file.read()
        read = proto.ModelProto()
        read.ParseFromString(model)
        spec, trainer = read.normalizer_spec, read.trainer_spec
        self.ranked = trainer.model_type == _BPE
        kinds = {p.type for p in read.pieces}
        if (
            trainer.model_type not in (_UNIGRAM, _BPE)
            or not spec.escape_whitespaces
            or not trainer.byte_fallback
            or trainer.treat_whitespace_as_suffix
            or not kinds <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
        ):
            raise ValueError("only unigram and merge-ranked models with byte fallback are compiled")
        self.prefix, self.tidy = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.rules: dict = {}  # a trie of characters, "" leading to the replacement
        for key, value in character_rules(spec.precompiled_charsmap).items():
            node = self.rules
            for c in key.decode():
                node = node.setdefault(c, {})
            node[""] = value.decode()
        self.rank: dict[str, float] = {}
        self.names = [p.piece for p in read.pieces]
        self.costs = [0.0] * len(self.names)
        self.bytes: list[int] = [-1] * 256
        written: list[bytes] = []
        self.trie: dict = {}
        for k, piece in enumerate(read.pieces):
            out = b""
            if piece.type == _NORMAL:
                self.rank[piece.piece] = piece.score
                self.costs[k] = 0.0 if self.ranked else -piece.score
                out = piece.piece.replace(MARK, " ").encode()
                node = self.trie
                for c in piece.piece:
                    node = node.setdefault(c, {})
                node[""] = k
                if MARK in piece.piece.lstrip(MARK):
                    raise ValueError("a piece holds a mark inside")
            elif piece.type == _BYTE:
                value = int(piece.piece[3:-1], 16)
                self.bytes[value] = k
                out = bytes([value])
            written.append(out)
        #: What an id writes when decoded.
        self.written = np.frombuffer(b"".join(written), np.uint8)
        self.sizes = np.array([len(w) for w in written])
        self.places = np.cumsum(self.sizes) - self.sizes
        #: Costs of characters without a piece, and numbers for them beyond all ids.
        self.fallback = 0.0 if self.ranked else _PENALTY - min(self.rank.values(), default=0.0)
        self.others: dict[str, int] = {}
        self.weights: dict[int, float] = {}
        self.splits: dict[str, tuple[str, str] | None] = {}
        self.edges: dict[int, list[tuple[str, float]] | None] = {}
        self.memory = Memory(lambda words: map(self.path, (w.decode().replace(" ", MARK) for w in words)))

    def normalised(self, text: str) -> str:
        """The text after the model's rules, with plain blanks for marks."""
        if self.rules:
            out, i = [], 0
            while i < len(text):
                node, j, best = self.rules.get(text[i]), i + 1, None
                while node is not None:
                    if "" in node:
                        best = node[""], j
                    node = node.get(text[j]) if j < len(text) else None
                    j += 1
                new, i = best or (text[i], i + 1)
                out.append(new)
            text = "".join(out)
        if self.tidy:
            text = " ".join(w for w in text.split(" ") if w)
        return text

    def _merged(self, text: str) -> list[str]:
        """The pieces that merging by rank leaves, the best pair first, then the left one."""
        parts, none = list(text), -math.inf
        scores = [self.rank.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while scores and (best := max(scores)) > none:
            k = scores.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del scores[k]
            if k:
                scores[k - 1] = self.rank.get(parts[k - 1] + parts[k], none)
            if k < len(scores):
                scores[k] = self.rank.get(parts[k] + parts[k + 1], none)
        return parts

    def _split(self, piece: str) -> tuple[str, str] | None:
        """The two parts of a piece's last merge; null if merging its text does not give it."""
        if piece not in self.splits:
            # Without the piece itself, merging stops at the two parts.
            rank = self.rank.pop(piece)
            parts = self._merged(piece)
            self.rank[piece] = rank
            self.splits[piece] = tuple(parts) if len(parts) == 2 else None
        return self.splits[piece]

    def _edge(self, unit: int, right: bool) -> list[tuple[str, float]] | None:
        """What stands at one edge of a unit while it is merged, each with when it is used up.

        Merges are done in the order of rank, as no piece ranks before its parts.
        """
        key = 2 * unit + right
        if key not in self.edges:
            name, until, edge = self.names[unit], math.inf, []
            while True:
                edge.append((name, until))
                if len(name) == 1:
                    break
                parts = self._split(name)
                if parts is None or any(len(p) > 1 and self.rank[p] <= self.rank[name] for p in parts):
                    edge = None
                    break
                until, name = -self.rank[name], parts[right]
            self.edges[key] = edge and edge[::-1]
        return self.edges[key]

    def _pair(self, left: int, right: int) -> float:
        """0 if the units may follow each other, else infinity."""
        weight = self.weights.get(left << 32 | right)
        if weight is None:
            ends, starts = self._edge(left, True), self._edge(right, False)
            if ends and starts:
                weight = self._apart(ends, starts)
            else:  # ranks out of order: merge the text itself
                a, b = self.names[left], self.names[right]
                weight = 0.0 if self._merged(a + b) == [a, b] else math.inf
            if len(self.weights) >= PAIRS:
                self.weights.clear()
            self.weights[left << 32 | right] = weight
        return weight

    def _apart(self, ends: list[tuple[str, float]], starts: list[tuple[str, float]]) -> float:
        """0 if no merge across the border of two units comes before one beside it."""
        i = j = 0
        while True:
            (a, until), (b, unless) = ends[i], starts[j]
            score = self.rank.get(a + b)
            # Of equal merges the left one comes first.
            if score is not None and -score < until and -score <= unless:
                return math.inf
            if until <= unless:
                if until == math.inf:
                    return 0.0
                i += 1
            else:
                j += 1

    def _other(self, character: str) -> int:
        """The number of a character that begins pieces, or stands in them, but is none."""
        number = self.others.get(character)
        if number is None:
            number = self.others[character] = len(self.names)
            self.names.append(character)
        return number

    def arcs(self, word: str, i: int) -> list[tuple[int, int]]:
        """Units that may follow at ``i`` and where they end, shortest first."""
        out, node, j, n = [], self.trie.get(word[i]), i + 1, len(word)
        while node is not None:
            piece = node.get("")
            if piece is not None:
                out.append((piece, j))
            if j == n:
                break
            node = node.get(word[j])
            j += 1
        if not out or out[0][1] > i + 1:  # byte fallback
            out.insert(0, (self._other(word[i]), i + 1))
        return out

    def _ranked(self, word: str) -> list[tuple[int, int]]:
        """Path of a merge-ranked model, as units and where they begin.

        Every beginning of a word has exactly one encoding, so a position is reached by
        one unit at finite cost, and that cost is 0: the composition is walked in depth,
        longest arcs first, and the first way to the end is the cheapest.
        """
        n, weights, arcs = len(word), self.weights, self.arcs
        reached = bytearray(n + 1)
        way: list[tuple[int, int]] = []
        left, i, open_, stack = -1, 0, arcs(word, 0), []
        while True:
            while not open_:
                left, i, open_ = stack.pop()
                way.pop()
            unit, j = open_.pop()
            if reached[j]:
                continue
            if left >= 0:
                weight = weights.get(left << 32 | unit)
                if (self._pair(left, unit) if weight is None else weight) > 0:
                    continue
            reached[j] = 1
            way.append((unit, i))
            if j == n:
                return way
            stack.append((left, i, open_))
            left, i, open_ = unit, j, arcs(word, j)

    def _cheapest(self, word: str) -> list[tuple[int, int]]:
        """Cheapest path of a unigram model, as units and where they begin."""
        n, none, pieces = len(word), math.inf, len(self.costs)
        cost, last, begin = [none] * (n + 1), [-1] * (n + 1), [0] * (n + 1)
        cost[0] = 0.0
        for i in range(n):  # every position is reached: each character has an arc
            here = cost[i]
            for unit, j in self.arcs(word, i):
                way = here + (self.costs[unit] if unit < pieces else self.fallback)
                if way < cost[j]:
                    cost[j], last[j], begin[j] = way, unit, i
        way, at = [], n
        while at > 0:
            way.append((last[at], begin[at]))
            at = begin[at]
        return way[::-1]

    def path(self, word: str) -> tuple[int, ...]:
        """Ids on the cheapest path of the composition with ``word``."""
        way = self._ranked(word) if self.ranked else self._cheapest(word)
        out: list[int] = []
        for unit, i in way:
            if unit < len(self.costs):
                out.append(unit)
            else:
                out += [self.bytes[b] for b in word[i].encode()]
        return tuple(out)

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text."""
        return self.encode_all([self.normalised(text).encode()], [True])[0]

    def decode(self, ids: np.ndarray) -> str:
        """The text that the ids write."""
        return self.unmarked(self.decode_all(ids)[0]).decode("utf-8", "replace")

    def unmarked(self, text: bytes) -> bytes:
        """A decoded text without the mark in front; all blanks there, if the model tidies."""
        if self.tidy:
            return text.lstrip(b" ")
        return text[1:] if self.prefix and text.startswith(b" ") else text

    def encode_all(self, texts: list[bytes], marked: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text's ids end.

        ``texts`` are normalised; those ``marked`` get the mark in front, if they are
        not empty.
        """
        ahead = b" " if self.prefix else b""
        parts = [ahead + t if m and t else t for t, m in zip(texts, marked)]
        joined = b"".join(parts).replace(MARK.encode(), b" ")
        shrunk = [p.replace(MARK.encode(), b" ") for p in parts] if len(joined) < sum(map(len, parts)) else parts
        bounds = np.cumsum([0, *map(len, shrunk)])
        data = np.frombuffer(joined, np.uint8)
        blank, line = data == 32, data == 10
        first = line | blank
        first[1:] &= line[1:] | ~blank[:-1]
        first[1:] |= line[:-1]
        first[bounds[:-1][bounds[:-1] < len(data)]] = True
        offsets = np.append(np.flatnonzero(first), len(data)).astype(np.int64)
        words = pa.Array.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        ).dictionary_encode()
        found = self.memory.look_up(words.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((x for ids in found for x in ids), np.uint32, int(sizes.sum()))
        at = words.indices.to_numpy()
        ids = gathered(flat, (np.cumsum(sizes) - sizes)[at], sizes[at])
        ends = np.concatenate([[0], np.cumsum(sizes[at])])
        return ids, ends[np.searchsorted(offsets[:-1], bounds[1:])]

    def decode_all(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes that the ids write, and where each id's bytes end."""
        sizes = self.sizes[ids]
        return gathered(self.written, self.places[ids], sizes).tobytes(), np.cumsum(sizes)


_COMPILED: dict[str, Transducer] = {}


def compiled(path: str) -> Transducer:
    """The transducer of a model file, compiled once in each worker process."""
    if path not in _COMPILED:
        _COMPILED[path] = Transducer(path)
    return _COMPILED[path]


def _parts(text: bytes) -> Iterator[bytes]:
    """Parts of about ``PART_BYTES``, each but the first beginning with a single blank's word."""
    start = 0
    while len(text) - start > PART_BYTES:
        cut = text.rfind(b" ", start + 1, start + PART_BYTES)
        while cut > start and text[cut - 1 : cut] == b" ":
            cut -= 1  # a run of blanks stays together
        if cut <= start:
            cut = text.find(b" ", start + PART_BYTES)
            if cut < 0:
                break
        yield text[start:cut]
        start = cut
    yield text[start:]


_RESULT = "doc_id long, n_tokens long, ids_crc32 long, text_crc32 long, same_text boolean"


def encode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, checksums of ids and of the decoded text, and the round trip."""

    def run(batches):
        model = compiled(path)
        for block in blocks(batches, 1, PART_BYTES):
            rows, texts, marked, raws = [], [], [], []
            many = len(block.bounds) - 1
            totals = [np.zeros(many, np.int64) for _ in range(3)]
            same = np.ones(many, bool)

            def settle():
                """Encode and decode the parts at hand, and add them to their rows."""
                ids, ends = model.encode_all(texts, marked)
                written, places = model.decode_all(ids)
                raw_ids, begin, first = ids.astype("<u4").tobytes(), 0, 0
                for row, mark, raw, end in zip(rows, marked, raws, ends.tolist()):
                    stop = int(places[end - 1]) if end else 0
                    text = written[first:stop]
                    if mark:
                        text = model.unmarked(text)
                    totals[0][row] += end - begin
                    totals[1][row] = zlib.crc32(raw_ids[4 * begin : 4 * end], int(totals[1][row]))
                    if text != raw:
                        same[row] = False
                        text = text.decode("utf-8", "replace").encode()
                    totals[2][row] = zlib.crc32(text, int(totals[2][row]))
                    begin, first = end, stop
                for held in (rows, texts, marked, raws):
                    held.clear()

            held = 0
            for row, raw in enumerate(block.texts()):
                plain = raw
                if model.rules or model.tidy:
                    plain = model.normalised(raw.decode("utf-8", "replace")).encode()
                    same[row] = plain == raw
                for k, part in enumerate(_parts(plain)):
                    rows.append(row)
                    texts.append(part)
                    marked.append(k == 0)
                    raws.append(part)
                    held += len(part)
                    if held >= PART_BYTES:
                        settle()
                        held = 0
            settle()
            columns = [block.batch.column(0), *map(pa.array, totals), pa.array(same)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _RESULT.split(", ")])

    return keyed_texts(docs, "doc_id", "text").mapInArrow(run, _RESULT)
