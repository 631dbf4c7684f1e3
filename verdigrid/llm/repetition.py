"""Quality rules by repetition coverage.

Words, lines and word n-grams of a block of whole texts are found and hashed by
numpy: a polynomial rolling hash over bytes gives every word 64 bits, a second one
over words gives every n-gram 64 bits, for all lengths in one pass. A word is
covered at length n if it lies in an n-gram that the same text holds twice or more.
The verdict compares the characters of covered words with all word characters.

Words are runs of anything but space and bytes 9 to 13. Null text counts as empty:
all measures 0, rejected for having fewer than ten words. Ids may be null or repeat;
every input row gives one row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from verdigrid.llm.blocks import Block, keep_where, measure

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
BASE_LENGTH = 5
#: Largest share of word characters inside repeated n-grams, in percent by length.
COVERAGE_PERCENT = {4: 35, 6: 25, 10: 20}
#: Largest share of word characters in lines equal to an earlier line, in percent.
LINE_PERCENT = 30

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, "
    "dup_line_chars long, chars_in_4 long, chars_in_6 long, chars_in_10 long"
)

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring bounds."""
    running = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return running[bounds[1:]] - running[bounds[:-1]]


def _words(block: Block):
    """Start, end and hash of every word, and the word bounds of the rows."""
    data, bounds = block.data, block.bounds
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = bounds[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    terms = _BYTE[data] * _powers(_BASE, len(data))
    np.cumsum(terms, out=terms)
    sums = terms[ends - 1] - np.where(starts > 0, terms[starts - 1], np.uint64(0))
    hashes = sums * _powers(_BASE_INVERSE, len(data))[starts]
    # Length in the hash keeps runs of one byte apart from shorter ones.
    hashes = _mixed(hashes + (ends - starts).astype(np.uint64) * _STEP)
    return starts, ends, hashes, np.searchsorted(starts, bounds)


def _covered(grams: np.ndarray, valid: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words lie in an n-gram that occurs twice or more."""
    at = np.flatnonzero(valid)
    order = np.argsort(grams[at])
    ranked = grams[at][order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(at), bool)
    twice[1:] |= same
    twice[:-1] |= same
    starts = at[order[twice]]
    change = np.zeros(words + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + n, -1)
    return np.cumsum(change[:-1]) > 0


def _lines(text: bytes) -> tuple[int, int]:
    """Lines equal to an earlier line, and the word characters in them."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    if len(lines) == len(set(lines)):
        return 0, 0
    seen: set[bytes] = set()
    count = chars = 0
    for line in lines:
        if line in seen:
            count += 1
            chars += len(b"".join(line.split()).decode("utf-8", "replace"))
        seen.add(line)
    return count, chars


def repetition(block: Block) -> dict[str, np.ndarray]:
    """All measures and both verdicts of the rows of a block."""
    data, bounds = block.data, block.bounds
    starts, ends, hashes, cuts = _words(block)
    n_words = np.diff(cuts)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    chars = points[ends] - points[starts]
    row = np.repeat(np.arange(len(n_words)), n_words)
    stop = cuts[1:][row]
    salt = _mixed(row.astype(np.uint64) * _STEP + np.uint64(1))
    out = {
        "n_words": n_words,
        "word_chars": _sums(chars, cuts),
        "n_symbols": _sums(_SYMBOL[data], bounds),
    }
    lines = np.array([_lines(t) for t in block.texts()], np.int64).reshape(-1, 2)
    out["n_dup_lines"], out["dup_line_chars"] = lines[:, 0], lines[:, 1]
    failed = n_words < MIN_WORDS
    kept = out["dup_line_chars"] * 100 <= LINE_PERCENT * out["word_chars"]
    at, grams = np.arange(len(row)), hashes.copy()
    for n in range(2, max(BASE_LENGTH, *COVERAGE_PERCENT) + 1):
        grams[: 1 - n] = grams[: 1 - n] * _STEP + hashes[n - 1 :]
        if n != BASE_LENGTH and n not in COVERAGE_PERCENT:
            continue
        inside = _covered(_mixed(grams) ^ salt, at + n <= stop, n, len(row))
        if n == BASE_LENGTH:
            out["n_repeat_words"] = _sums(inside, cuts)
            failed |= out["n_repeat_words"] * 100 > MAX_REPEAT_PERCENT * n_words
        if n in COVERAGE_PERCENT:
            found = out[f"chars_in_{n}"] = _sums(np.where(inside, chars, 0), cuts)
            kept &= found * 100 <= COVERAGE_PERCENT[n] * out["word_chars"]
    out["base_failed"], out["kept"] = failed, kept & ~failed
    return out


def quality_rules(docs: DataFrame) -> DataFrame:
    """Measures and verdicts, one row per row of ``docs`` (doc_id, text)."""
    return measure(docs, repetition, SCHEMA)


def keep_sound(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    return keep_where(docs, lambda block: repetition(block)["kept"])


#: The same in SQL, with one set of windows per length.
_COVER = """
grams{n} AS (SELECT doc_id, i, hash_key FROM (
    SELECT doc_id, unnest(range(1, len(words) - {n} + 2)) AS i, words,
           array_to_string(words[i:i + {n} - 1], ' ') AS hash_key
    FROM split WHERE len(words) >= {n})),
twice{n} AS (SELECT doc_id, hash_key FROM grams{n} GROUP BY ALL HAVING count(*) > 1),
cover{n} AS (SELECT doc_id, count(*) AS n_words, sum(length(words[p])) AS chars FROM (
    SELECT DISTINCT g.doc_id, unnest(range(i, i + {n})) AS p
    FROM grams{n} g JOIN twice{n} t ON g.doc_id = t.doc_id AND g.hash_key = t.hash_key)
  JOIN split USING (doc_id) GROUP BY doc_id)"""

SQL = (
    """
WITH split AS (SELECT doc_id, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
"""
    + ",".join(_COVER.format(n=n) for n in sorted({BASE_LENGTH, *COVERAGE_PERCENT}))
    + f""",
lines AS (SELECT doc_id, line, count(*) - 1 AS again FROM (
    SELECT doc_id, unnest(string_split(body, chr(10))) AS line FROM split)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY ALL),
dup AS (SELECT doc_id, sum(again) AS n, sum(again * length(
    regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g'))) AS chars
  FROM lines GROUP BY doc_id),
base AS (SELECT s.doc_id, len(words) AS n_words,
    length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
    coalesce(c{BASE_LENGTH}.n_words, 0) AS n_repeat_words,
    coalesce(dup.chars, 0)::BIGINT AS dup_line_chars,
    {", ".join(f"coalesce(c{n}.chars, 0)::BIGINT AS chars_in_{n}" for n in COVERAGE_PERCENT)}
  FROM split s LEFT JOIN dup USING (doc_id)
    {" ".join(f"LEFT JOIN cover{n} c{n} USING (doc_id)" for n in sorted({BASE_LENGTH, *COVERAGE_PERCENT}))}),
judged AS (SELECT *, n_words < {MIN_WORDS}
    OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND 100 * dup_line_chars <= {LINE_PERCENT} * word_chars
    {"".join(f" AND 100 * chars_in_{n} <= {p} * word_chars" for n, p in COVERAGE_PERCENT.items())}
    AS kept FROM judged
"""
)
