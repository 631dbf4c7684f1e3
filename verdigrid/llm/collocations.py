"""Phrases of two and three words that stand together more often than their parts.

Counting is a multikey three-way quicksort of suffix pointers. A suffix is a word with
the words after it in its piece of text; words are compared by 64-bit hashes that
include the language. Depth after depth (one, two, three words):

* a task merges the equal suffixes of a window of text, packs them by route, and sends
  them off; the route is a hash of all leading words of this depth, so every suffix of
  a phrase meets in one bucket, and a frequent phrase costs one entry a window;
* a bucket is sorted by ``frequent``: pointers are split around a pivot word into less,
  equal and greater; an equal partition goes on with the next word, and at the last one
  its size is the phrase's count. A partition below the least count is abandoned, as
  no phrase in it can reach the count;
* the next depth only follows suffixes whose shorter phrases may be frequent: a bitmap
  of fixed size tells it, and it errs only towards following too many.

Buckets are as many as the words of the corpus ask for. A phrase lies in one bucket with
one entry (24 or 32 bytes) for each window that holds it, so only a phrase found in
millions of windows makes a bucket larger than its share. The words themselves are counted as strings. Equal hashes of
different words would add up their counts, so this is looked for, and if a frequent
word shares its hash, all starts over with another seed.

Null text counts as empty, a null language as ``und``; ids and other columns are not
read. Empty tables give an empty result; repeated rows count each. Phrases of equal
score and count rank by their bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdigrid.llm.blocks import bounded
from verdigrid.llm.words import WINDOW_BYTES, Words, byte_class, windows
from verdigrid.shared import written

LEAST = 10
LONGEST = 3
#: A phrase goes if a longer one around it has this share (in per cent) of its count.
COVERED = 50
TOP = 2000
UNKNOWN = "und"
#: Suffixes that share a bucket, and rows of a group ranked in one task.
BUCKET_WORDS = 1 << 20
RANKED_ROWS = 250_000
#: Bits of the bitmap of frequent phrases.
BITMAP_BITS = 26

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_INSIDE = byte_class(bytes(sorted(set(range(128)) - set(_BREAKS + b" \t"))), True)
_BREAK = byte_class(_BREAKS, False)
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_HALF = np.uint64(32)


def _mixed(keys: list[np.ndarray]) -> np.ndarray:
    """One hash of several words' hashes."""
    out = np.zeros(len(keys[0]), np.uint64)
    for key, odd in zip(keys, _ODD):
        out = (out ^ key) * odd
        out ^= out >> _HALF
    return out


def _texts(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(docs["lang"].cast("string"), F.lit(UNKNOWN))
    return docs.select(lang.alias("lang"), docs["text"].cast("string").alias("text"))


class Suffixes:
    """Words of a window as places of distinct (language, word) pairs."""

    def __init__(self, window, seed: int):
        words = Words(window, _INSIDE)
        langs = window.batch.column(0).dictionary_encode()
        self.langs = langs.dictionary
        number, many = words.numbers.astype(np.int64), len(self.langs)
        if many > 1:
            number = number * many + langs.indices.to_numpy()[words.rows]
        # Distinct pairs, and each word's place among them.
        self.pairs, self.at = np.unique(number, return_inverse=True)
        self.words, self.many = words.dictionary, max(many, 1)
        own = np.fromiter(
            (xxhash.xxh3_64_intdigest(w, seed) for w in self.words.to_pylist()), np.uint64, len(self.words)
        )
        tongue = np.fromiter(
            (xxhash.xxh3_64_intdigest(x, seed + 1) for x in self.langs.to_pylist()), np.uint64, many
        )
        self.hashes = (
            _mixed([own[self.pairs // self.many], tongue[self.pairs % self.many]])
            if len(self.pairs)
            else np.zeros(0, np.uint64)
        )
        breaks = _BREAK[words.data]
        pieces = np.cumsum(breaks, dtype=np.int32)
        #: True where the word follows its predecessor in the same piece.
        self.follows = np.zeros(len(self.at), bool)
        self.follows[1:] = (pieces[words.starts[1:]] == pieces[words.starts[:-1]]) & (
            words.rows[1:] == words.rows[:-1]
        )
        #: For windows that continue a text: is the first word in the last one's piece?
        self.opens = not breaks[: words.starts[0]].any() if len(self.at) else not breaks.any()
        self.closes = not breaks[words.ends[-1] :].any() if len(self.at) else not breaks.any()


def _read(batches, seed: int, size: int) -> Iterator[tuple[Suffixes, np.ndarray, np.ndarray, int]]:
    """Suffixes, hashes of all words, which follow their predecessor, words carried over.

    A text longer than a window goes on with its last words, so that no phrase is cut;
    a phrase counts where its last word stands.
    """
    carried, joined = np.zeros(0, np.uint64), np.zeros(0, bool)
    open_ = False
    for window in windows(batches, 1, _INSIDE, size):
        found = Suffixes(window, seed)
        hashes, follows, old = found.hashes[found.at], found.follows, 0
        if window.continued and len(carried):
            old = len(carried)
            if len(follows):
                follows = follows.copy()
                follows[0] = open_ and found.opens
            hashes, follows = np.concatenate([carried, hashes]), np.concatenate([joined, follows])
        yield found, hashes, follows, old
        if window.last:
            carried, joined = carried[:0], joined[:0]
        else:
            open_ = found.closes and (len(found.at) > 0 or open_)
            carried, joined = hashes[1 - LONGEST :], follows[1 - LONGEST :].copy()
            if len(joined):
                joined[0] = False


def _words_counted(seed: int, size: int) -> Callable:
    def run(batches):
        for found, _, _, _ in _read(batches, seed, size):
            if not len(found.pairs):
                continue
            counts = np.bincount(found.at, minlength=len(found.pairs))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.hashes.view(np.int64)),
                    found.langs.take(pa.array(found.pairs % found.many)).cast(pa.string()),
                    found.words.take(pa.array(found.pairs // found.many)).cast(pa.large_string()).cast(pa.string()),
                    pa.array(counts),
                ],
                ["h", "lang", "word", "n"],
            )

    return run


def _merged(keys: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct combinations of the keys, and how often each occurs."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    at = np.flatnonzero(new)
    return [k[at] for k in keys], np.diff(at, append=len(order))


def _routed(depth: int, seed: int, bitmap, buckets: int, size: int) -> Callable:
    """Suffixes of ``depth`` words, merged by window and packed by bucket."""
    names = ["bucket", *(f"k{d}" for d in range(depth)), "n"]

    def run(batches):
        bits = bitmap.value

        def maybe(keys):
            place = _mixed(keys) >> np.uint64(64 - BITMAP_BITS)
            return bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1 > 0

        for found, hashes, follows, old in _read(batches, seed, size):
            if depth == 2:
                known = maybe([found.hashes])[found.at] if len(found.at) else np.zeros(0, bool)
                if old:
                    known = np.concatenate([maybe([hashes[:old]]), known])
                last = np.flatnonzero(follows & known)
                last = last[known[last - 1]]
            else:
                last = np.flatnonzero(follows)
                last = last[follows[last - 1] & (last > 1)]
                last = last[maybe([hashes[last - 2], hashes[last - 1]])]
                last = last[maybe([hashes[last - 1], hashes[last]])]
            last = last[last >= old]
            if not len(last):
                continue
            keys, counts = _merged([hashes[last - d] for d in range(depth - 1, -1, -1)])
            route = _mixed(keys) % np.uint64(buckets)
            order = np.argsort(route, kind="stable")
            route, cuts = np.unique(route[order], return_index=True)
            cuts = np.append(cuts, len(order)).tolist()
            columns = [k[order] for k in keys] + [counts[order].astype(np.uint64)]
            packed = [[c[a:b].tobytes() for a, b in zip(cuts, cuts[1:])] for c in columns]
            yield pa.RecordBatch.from_arrays(
                [pa.array(route.astype(np.int64)), *(pa.array(p, pa.binary()) for p in packed)], names
            )

    return run


def frequent(
    keys: list[np.ndarray], counts: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray]:
    """Pointers to one suffix of each phrase with at least ``least`` counts, and the counts.

    Multikey three-way quicksort to the depth of ``keys``. All open partitions are
    split in the same step; pointers of a partition lie side by side.
    """
    depths, many = len(keys), len(counts)
    flat = np.concatenate(keys) if many else np.zeros(0, np.uint64)
    pointers, sizes, depth = np.arange(many), np.array([many]), np.zeros(1, np.int64)
    if not many or counts.sum() < least:
        return pointers[:0], counts[:0]
    found: list[np.ndarray] = []
    totals: list[np.ndarray] = []
    while len(sizes):
        starts = np.cumsum(sizes) - sizes
        key = flat[pointers + np.repeat(depth * many, sizes)]
        # Median of three as pivot.
        three = np.stack([key[starts], key[starts + sizes // 2], key[starts + sizes - 1]])
        pivot = np.repeat(np.sort(three, axis=0)[1], sizes)
        less, equal = key < pivot, key == pivot
        left, same = np.cumsum(less), np.cumsum(equal)
        ends = starts + sizes - 1
        n_less = left[ends] - left[starts] + less[starts]
        n_equal = same[ends] - same[starts] + equal[starts]
        # New places: less, equal and greater of each partition, in their old order.
        left -= np.repeat(left[starts] - less[starts], sizes)
        same -= np.repeat(same[starts] - equal[starts], sizes)
        inside = np.arange(len(key)) - np.repeat(starts, sizes)
        place = np.where(
            less,
            left - 1,
            np.where(equal, np.repeat(n_less, sizes) + same - 1, np.repeat(n_less + n_equal, sizes) + inside - left - same),
        )
        moved = np.empty_like(pointers)
        moved[np.repeat(starts, sizes) + place] = pointers
        parts = np.stack([n_less, n_equal, sizes - n_less - n_equal], axis=1).ravel()
        level = np.stack([depth, depth + 1, depth], axis=1).ravel()
        full = parts > 0
        parts, level = parts[full], level[full]
        begin = np.cumsum(parts) - parts
        weight = np.add.reduceat(counts[moved], begin)
        done = (weight >= least) & ((level == depths) | (parts == 1))
        found.append(moved[begin[done]])
        totals.append(weight[done])
        goes_on = (weight >= least) & ~done
        pointers = moved[np.repeat(goes_on, parts)]
        sizes, depth = parts[goes_on], level[goes_on]
    return np.concatenate(found), np.concatenate(totals)


def _bucket_counts(depth: int, least: int) -> Callable:
    names = [*(f"h{d + 1}" for d in range(depth)), "n"]

    def run(batches):
        held: list[list[bytes]] = []
        bucket = None

        def counted():
            columns = [np.frombuffer(b"".join(c), np.uint64) for c in zip(*held)]
            counts = columns.pop().astype(np.int64)
            at, totals = frequent(columns, counts, least)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c[at].view(np.int64)) for c in columns), pa.array(totals)], names
            )

        for batch in batches:
            for route, *packed in zip(*(c.to_pylist() for c in batch.columns)):
                if route != bucket and held:
                    yield from counted()
                    held = []
                bucket = route
                held.append(packed)
        if held:
            yield from counted()

    return run


def _bitmap(table: DataFrame, keys: list[str]):
    """A broadcast bitmap (fixed size) of the keys in ``table``."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                hashes = _mixed([c.to_numpy().view(np.uint64) for c in batch.columns])
                place = hashes >> np.uint64(64 - BITMAP_BITS)
                slot, at = np.unique((place >> np.uint64(6)).astype(np.int64), return_inverse=True)
                bits = np.zeros(len(slot), np.uint64)
                np.bitwise_or.at(bits, at, np.uint64(1) << (place & np.uint64(63)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot), pa.array(bits.view(np.int64))], ["slot", "bits"]
                )

    slots = (
        table.select(*keys)
        .mapInArrow(run, "slot long, bits long")
        .groupBy("slot")
        .agg(F.bit_or("bits").alias("bits"))
    )
    out = np.zeros(1 << BITMAP_BITS - 6, np.uint64)
    got = bounded(slots, len(out))
    out[got.column("slot").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return table.sparkSession.sparkContext.broadcast(out.astype("<u8").view(np.uint8))


def _phrases(
    texts: DataFrame, depth: int, seed: int, bitmap, buckets: int, least: int, size: int
) -> DataFrame:
    """(h1, .., n): phrases of ``depth`` words with their counts, written once."""
    packed = ", ".join(f"k{d} binary" for d in range(depth))
    keys = ", ".join(f"h{d + 1} long" for d in range(depth))
    counted = (
        texts.mapInArrow(_routed(depth, seed, bitmap, buckets, size), f"bucket long, {packed}, n binary")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_bucket_counts(depth, least), f"{keys}, n long")
    )
    return written(counted, f"phrases-{depth}")


def _counted_words(texts: DataFrame, least: int, size: int) -> tuple[DataFrame, int]:
    """(h, lang, word, f) of all words, and the seed whose hashes tell them apart."""
    seed = 0
    while True:
        words = written(
            texts.mapInArrow(_words_counted(seed, size), "h long, lang string, word string, n long")
            .groupBy("h", "lang", "word")
            .agg(F.sum("n").alias("f")),
            "words",
        )
        mixed_up = (
            words.groupBy("h").agg(F.count("*").alias("k"), F.sum("f").alias("f")).where(f"k > 1 AND f >= {least}")
        )
        if mixed_up.isEmpty():
            return words, seed
        seed += 2


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exact: the quotient is at most a million."""
    wide = lambda c: c.cast("decimal(19,0)")
    top = (wide(a) * wide(a)).cast("decimal(32,0)") * F.lit(1000000).cast("decimal(7,0)")
    under = (wide(left) * wide(right)).cast("decimal(38,0)")
    return F.call_function("div", top.cast("decimal(38,0)"), under)


def _top(rows: DataFrame, top: int, place: Column, *ties: str) -> DataFrame:
    """Rows that can be among the first ``top`` of their language by ``place``.

    A language is ranked in parts of about ``RANKED_ROWS`` rows, and what is left of
    the parts again, until few enough are left. ``rows`` is a written table.
    """
    number, before = rows.count(), None
    level = 0
    while number > RANKED_ROWS and number != before:
        parts = -(-number // RANKED_ROWS)
        part = F.pmod(F.xxhash64("h1", "h2", "h3", F.lit(level)), F.lit(parts))
        order = Window.partitionBy("lang", "part").orderBy(F.desc("score"), F.desc("a"), *ties)
        rows = written(
            rows.withColumn("part", part)
            .withColumn("place", place.over(order))
            .where(F.col("place") <= top)
            .drop("part", "place"),
            "ranked",
        )
        before, number, level = number, rows.count(), level + 1
    return rows


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    top: int = TOP,
    covered: int = COVERED,
    window_bytes: int = WINDOW_BYTES,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language."""
    texts = _texts(docs)
    words, seed = _counted_words(texts, least, window_bytes)
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    total = words.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    buckets = max(1, -(-total // BUCKET_WORDS))
    known = words.where(F.col("f") >= least)
    pairs = _phrases(texts, 2, seed, _bitmap(known, ["h"]), buckets, least, window_bytes)
    triples = _phrases(texts, 3, seed, _bitmap(pairs, ["h1", "h2"]), buckets, least, window_bytes)

    def word(side: str, *names: str) -> DataFrame:
        """``known`` with the hash as ``side`` and (f, lang) under other names."""
        return known.select(F.col("h").alias(side), *(F.col(a).alias(b) for a, b in zip(("f", "lang"), names)))

    def pair(first: str, second: str, count: str) -> DataFrame:
        return pairs.select(F.col("h1").alias(first), F.col("h2").alias(second), F.col("n").alias(count))

    around = F.inline(F.array(F.struct(F.col("h1").alias("h1"), F.col("h2").alias("h2")),
                              F.struct(F.col("h2").alias("h1"), F.col("h3").alias("h2"))))
    longer = triples.select("n", around).groupBy("h1", "h2").agg(F.max("n").alias("longer"))
    two = (
        pairs.join(longer, ["h1", "h2"], "left")
        .where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("n")))
        .join(word("h1", "l", "lang"), "h1")
        .join(word("h2", "r"), "h2")
        .select("lang", "h1", "h2", F.lit(None).cast("long").alias("h3"), F.col("n").alias("a"), "l", "r",
                _score(F.col("n"), F.col("l"), F.col("r")).alias("score"))
    )
    three = (
        triples.join(pair("h2", "h3", "r1"), ["h2", "h3"])
        .join(pair("h1", "h2", "l2"), ["h1", "h2"])
        .join(word("h1", "l1", "lang"), "h1")
        .join(word("h3", "r2"), "h3")
        .withColumn("s1", _score(F.col("n"), F.col("l1"), F.col("r1")))
        .withColumn("s2", _score(F.col("n"), F.col("l2"), F.col("r2")))
        .withColumn("one", F.col("s1") <= F.col("s2"))
        .select("lang", "h1", "h2", "h3", F.col("n").alias("a"), F.expr("IF(one, l1, l2) AS l"),
                F.expr("IF(one, r1, r2) AS r"), F.least("s1", "s2").alias("score"))
    )
    # First without the words: all that equal the last place stay.
    spelt = _top(written(two.unionByName(three), "scored"), top, F.rank())
    for place in ("h1", "h2", "h3"):
        names = known.select(F.col("h").alias(place), F.col("word").alias(f"w{place}"))
        spelt = spelt.join(names, place, "left" if place == "h3" else "inner")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    spelt = written(spelt.withColumn("phrase", F.concat_ws(" ", "wh1", "wh2", "wh3")), "spelt")
    return (
        _top(spelt, top, F.row_number(), "phrase")
        .withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= top)
        .join(sizes, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
    )


SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM words
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1),
    lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
sizes AS (SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang),
parts AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT p.*, c.cut, array_to_string(w[1:c.cut], ' ') AS lp, array_to_string(w[c.cut + 1:], ' ') AS rp
  FROM parts p, (VALUES (1), (2)) c(cut) WHERE c.cut < p.k),
scored AS (SELECT c.lang, c.k, c.phrase, c.a, c.cut, x.f AS l, y.f AS r,
    (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.lp JOIN f y ON y.lang = c.lang AND y.phrase = c.rp),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM parts WHERE k = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM parts WHERE k = 3) GROUP BY ALL),
kept AS (SELECT s.* FROM lowest s LEFT JOIN longer o ON s.k = 2 AND o.lang = s.lang AND o.phrase = s.phrase
  WHERE o.a IS NULL OR 100 * o.a < 50 * s.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN sizes USING (lang) QUALIFY rank <= 2000
"""
