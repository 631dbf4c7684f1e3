"""Secret scans: fixed patterns, and sliding-window entropy by character class.

Candidate strings are the longest runs of one character class (hexadecimal digits,
letters with digits, base64). A window slides over each candidate; its Shannon
entropy follows from counts that change by one character in and one out. Windows at
or above the class's limit are merged to spans. A run belongs to its narrowest class,
so nothing is reported twice by entropy. The allow-list suppresses a candidate by
what it is (only letters, only digits, known sample values) or by what stands before
it (a digest's label). Host and plain path segments of a link are no part of any
candidate; its user-info, query, fragment and long mixed segments are.

Offsets count code points, ends are exclusive. Null text counts as empty: no spans.
Ids may be null or repeat; every input row gives one row. Texts of any length are
scanned whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from verdigrid.llm.blocks import Block, blocks, measure

MASK = "[SECRET]"

ASSIGN = re.compile(
    r"(?ai:(password|passwd|secret|token|api_?key))"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


@dataclass(frozen=True)
class CharClass:
    kind: str
    run: re.Pattern
    window: int
    bits: float


#: From narrow to wide.
CLASSES = (
    CharClass("entropy_hex", re.compile(r"[0-9A-Fa-f]{20,}"), 20, 3.0),
    CharClass("entropy_alnum", re.compile(r"[0-9A-Za-z]{20,}"), 20, 3.6),
    CharClass("entropy_base64", re.compile(r"[0-9A-Za-z+/_=-]{24,}"), 24, 4.0),
)
#: A candidate that one of these matches as a whole is no secret.
ALLOWED_VALUES = (
    re.compile(r"[A-Za-z+/_=-]+"),
    re.compile(r"[0-9+/_=-]+"),
    re.compile(r".*(?:EXAMPLE|example|Example|xxxx|XXXX|0123456789).*"),
)
#: Nor is one that directly follows one of these.
ALLOWED_BEFORE = re.compile(
    r"(?:sha-?(?:1|224|256|384|512)|md5|crc32|commit|etag)[\"']?\s?[:= -]\s?[\"']?\Z",
    re.IGNORECASE,
)
BEFORE = 20
LINK_START = re.compile(r"https?://", re.IGNORECASE)
LINK_REST = re.compile(r"[^\s\"'<>\\^`{|}]*")
WORD = re.compile(r"[0-9A-Za-z]+")
#: A path segment is plain if its words of letters and digits mixed are shorter in all.
PLAIN_CHARS = 16

KINDS = ("assign", "access", "hex", *(c.kind for c in CLASSES))


def hot_windows(text: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Merged spans of the windows whose entropy reaches ``bits``."""
    if len(text) < window:
        return []
    weight = [0.0, *(n * math.log2(n) for n in range(1, window + 1))]
    # Entropy is log2(window) - total / window, with total the sum of n * log2(n).
    limit = (math.log2(window) - bits) * window + 1e-9
    counts = Counter(text[:window])
    total = sum(weight[n] for n in counts.values())
    spans: list[list[int]] = []
    for end in range(window, len(text) + 1):
        if end > window:
            new, old = text[end - 1], text[end - 1 - window]
            if new != old:
                n, m = counts[new], counts[old]
                total += weight[n + 1] - weight[n] + weight[m - 1] - weight[m]
                counts[new] = n + 1
                counts[old] = m - 1
        if total <= limit:
            if spans and end - window <= spans[-1][1]:
                spans[-1][1] = end
            else:
                spans.append([end - window, end])
    return [(a, b) for a, b in spans]


def _allowed(text: str, start: int, value: str) -> bool:
    return any(p.fullmatch(value) for p in ALLOWED_VALUES) or bool(
        ALLOWED_BEFORE.search(text, max(0, start - BEFORE), start)
    )


def _plain(segment: str) -> bool:
    words = WORD.findall(segment)
    return sum(len(w) for w in words if not (w.isalpha() or w.isdigit())) < PLAIN_CHARS


def link_parts(text: str) -> list[tuple[int, int]]:
    """Where the hosts and plain path segments of links stand, in order."""
    parts = []
    heads = [(m.start(), m.end()) for m in LINK_START.finditer(text)]
    for (start, at), (after, _) in zip(heads, [*heads[1:], (len(text), 0)]):
        end = LINK_REST.match(text, at, after).end()
        path = min((k for k in (text.find(c, at, end) for c in "?#") if k >= 0), default=end)
        slash = text.find("/", at, path)
        host = path if slash < 0 else slash
        user = text.rfind("@", at, host)
        parts += [(start, at), (max(at, user + 1), host)]
        at = host
        while at < path:
            stop = text.find("/", at + 1, path)
            stop = path if stop < 0 else stop
            parts.append((at, stop if _plain(text[at + 1 : stop]) else at + 1))
            at = stop
    return parts


def _without(runs: list[tuple[int, int]], parts: list[tuple[int, int]]):
    """What is left of ``runs`` outside ``parts``; both are in order."""
    left, k = [], 0
    for a, b in runs:
        while k < len(parts) and parts[k][1] <= a:
            k += 1
        j = k
        while j < len(parts) and parts[j][0] < b:
            if parts[j][0] > a:
                left.append((a, parts[j][0]))
            a = max(a, parts[j][1])
            j += 1
        if a < b:
            left.append((a, b))
    return left


def find_secrets(text: str) -> list[tuple[int, int, int]]:
    """(start, index of the kind in ``KINDS``, end), sorted."""
    found = [
        (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12
    ]
    found += [
        (m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18
    ]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 16]
    narrower: set[tuple[int, int]] = set()
    links = link_parts(text)
    for k, group in enumerate(CLASSES, 3):
        runs = _without([(m.start(), m.end()) for m in group.run.finditer(text)], links)
        for a, b in runs:
            value = text[a:b]
            if (a, b) not in narrower and not _allowed(text, a, value):
                spans = hot_windows(value, group.window, group.bits)
                found += [(a + x, k, a + y) for x, y in spans]
        narrower.update(runs)
    return sorted(found)


def _table(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


_DIGITS, _UPPER = b"0123456789", bytes(range(65, 91))
_WIDE = _table(_DIGITS + _UPPER + _UPPER.lower() + b"+/_=-")
_HEX = _table(_DIGITS + b"abcdef")
_KEY = _table(_DIGITS + _UPPER)
_SIGN = _table(b":=")


def _long_runs(member: np.ndarray, bounds: np.ndarray, least: int) -> np.ndarray:
    """Where runs of ``member`` of at least ``least`` bytes inside one row begin."""
    cut = bounds[bounds < len(member)]
    first, last = member.copy(), member.copy()
    first[1:] &= ~member[:-1]
    first[cut] = member[cut]
    last[:-1] &= ~member[1:]
    cut = cut[cut > 0]
    last[cut - 1] = member[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts[ends - starts >= least]


def _suspects(block: Block) -> set[int]:
    """Rows that can hold a span at all: others need no pattern matching.

    Texts stand side by side in a block, so runs are cut at the row bounds: every row
    is judged by its own.
    """
    data, bounds = block.data, block.bounds
    at = [np.flatnonzero(_SIGN[data])]
    for member, least in ((_WIDE, 16), (_HEX, 16), (_KEY, 18)):
        at.append(_long_runs(member[data], bounds, least))
    rows = np.searchsorted(bounds, np.concatenate(at), "right") - 1
    return set(np.unique(rows).tolist())


def spans_of(block: Block) -> list[list[tuple[int, int, int]]]:
    suspects = _suspects(block)
    return [
        find_secrets(text.decode("utf-8", "replace")) if row in suspects else []
        for row, text in enumerate(block.texts())
    ]


def _written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _digest(block: Block) -> dict[str, list]:
    every = spans_of(block)
    base = [[s for s in spans if s[1] < 3] for spans in every]
    out = {
        f"n_{name}": [sum(s[1] == k for s in spans) for spans in base]
        for k, name in enumerate(KINDS[:3])
    }
    out["base_sha256"] = [
        hashlib.sha256(_written(spans).encode()).hexdigest() for spans in base
    ]
    out["spans"] = [_written(spans) for spans in every]
    out["n_entropy"] = [len(x) - len(y) for x, y in zip(every, base)]
    return out


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Counts, digest and all spans, one row per row of ``docs``."""
    return measure(
        docs,
        _digest,
        "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
        "n_entropy long",
    )


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, overlaps merged, replaced by ``MASK``."""
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def mask_secrets(docs: DataFrame) -> DataFrame:
    """All rows and columns, with secrets masked in ``text``; ``n_chars`` follows."""
    names = docs.columns
    at = names.index("text")

    def run(batches):
        for block in blocks(batches, at):
            columns = list(block.batch.columns)
            texts = columns[at].to_pylist()
            changed = {}
            for row, spans in enumerate(spans_of(block)):
                if spans:
                    changed[row] = texts[row] = masked(texts[row], spans)
            if changed:
                columns[at] = pa.array(texts, columns[at].type)
                if "n_chars" in names:
                    count = names.index("n_chars")
                    sizes = columns[count].to_pylist()
                    for row, text in changed.items():
                        sizes[row] = len(text)
                    columns[count] = pa.array(sizes, columns[count].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)
