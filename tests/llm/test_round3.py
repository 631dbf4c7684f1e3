"""Lexical search, personal data and collocations against brute force; parts of texts."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from verdigrid.llm import collocations, lexical, personal, ragged, words
from verdigrid.llm.words import byte_class

SMALL = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, rank int, score long, "
    "term string, h long, n long, f long, kind int, base string, spans string"
)
TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "ß Éa ßÉ-a_b x1 🙂 日本 a b",
    " ".join(f"w{k % 977}x{k % 5}" for k in range(30_000)),
    "the same words, the same words; the same words " * 5,
    "the same words, the same words; the same words " * 5,
    "a b c. a b c! a b c\na b c: a b c ; a b\tc, A B C? " * 3,
]


def table(spark, texts, langs=("en", None, "fr")):
    rows = [(k, t, langs[k % len(langs)], *[None] * 11) for k, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, "no id, the same words", *[None] * 12), (None, None, *[None] * 12)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def awkward(spark):
    return table(spark, TEXTS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


# Windows of words


def test_words_of_windows_do_not_depend_on_their_size(awkward):
    inside = byte_class(b"abcdefghijklmnopqrstuvwxyz0123456789", True)
    batch = awkward.select("doc_id", "text").toArrow().combine_chunks().to_batches()[0]

    def read(size):
        found = defaultdict(list)
        row = -1
        for w in words.windows(iter([batch]), 1, inside, size):
            got = words.Words(w, inside)
            first = row + (0 if w.continued else 1)
            for r, n in zip(got.rows.tolist(), got.numbers.tolist()):
                found[first + r].append(got.dictionary[n].as_py())
            row = first + len(w.bounds) - 2
        assert row == batch.num_rows - 1
        return dict(found)

    whole = read(1 << 30)
    pattern = re.compile(rb"[a-z0-9\x80-\xff]+")
    for k, text in enumerate(batch.column(1).to_pylist()):
        lowered = re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode())
        assert whole.get(k, []) == pattern.findall(lowered)
    for size in (1, 7, 100, 5000):
        assert read(size) == whole


def test_memory_is_bounded_and_exact(monkeypatch):
    monkeypatch.setattr(ragged, "MEMORY_BYTES", 5000)
    calls = []
    memory = ragged.Memory(lambda ws: calls.extend(ws) or [[len(w)] * 2 for w in ws])
    for _ in range(3):
        many = [b"x" * k for k in range(1, 40)] + [b"y" * 1000]
        assert memory.look_up(many) == [[len(w)] * 2 for w in many]
        assert b"y" * 1000 not in memory.known and memory.held <= 5000 + 40 * 300
    assert ragged.gathered(np.arange(10), np.array([7, 0, 3]), np.array([2, 0, 3])).tolist() == [7, 8, 3, 4, 5]


# Lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return TERM.findall(lowered)


def ranked(docs, items, k=10):
    """Every document scored for every item."""
    counts = [(d, Counter(terms_of(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item].update(terms_of(text))
    rows = []
    for item, query in wanted.items():
        scored = []
        for d, c in counts:
            m = 100 - 90 + 90 * sum(c.values()) * n_docs // n_terms
            total = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in query & c.keys()
            )
            if total > 0:
                scored.append((-total, d is None, d or 0, d))
        scored.sort()
        rows += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(scored[:k])]
    return sorted(rows, key=repr)


def searched(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("step, share", [(1024, 0.25), (3, 0.25), (5, 0.0), (2, 9.0)])
def test_search_by_full_scoring(spark, docs, step, share):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want = ranked([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.collect()])
    # One segment in one task, where limits carry over between steps; then many tasks.
    for parts in (1, 7):
        index = lexical.build_index(docs.coalesce(1).repartition(parts), 1 << 19)
        assert searched(lexical.search(index, items, short=share, step=step)) == want


def test_search_of_awkward_tables(spark, awkward, monkeypatch):
    items = [(1, "the same words"), (2, None), (2, "ONE é"), (3, ""), (None, "w5x0 words"), (4, "a a a"), (1, "ßéa x1"), (5, "zzz")]
    frame = spark.createDataFrame([(*i, None, None) for i in items], "item_id long, text string, score long, doc_id long")
    pairs = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    want = ranked(pairs, items)
    assert {r[0] for r in want} == {1, 2, None, 4}
    assert searched(lexical.lexical_search(awkward, frame)) == want
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 2)  # several blocks of items
    assert searched(lexical.search(lexical.build_index(awkward, 300), frame)) == want
    assert lexical.lexical_search(awkward.limit(0), frame).count() == 0
    assert lexical.lexical_search(awkward, frame.limit(0)).count() == 0


def test_search_ties_go_by_id(spark):
    rows = [(k, "same text here") for k in (9, 3, 7, None, 3, 1, 8, 2, 6, 5, 4, 12, 11)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(0, "here"), (0, "here")], "item_id long, text string")
    got = lexical.lexical_search(frame, items).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == [1, 2, 3, 3, 4, 5, 6, 7, 8, 9] or not got
    more = spark.createDataFrame([(100 + k, "other") for k in range(40)], "doc_id long, text string")
    got = lexical.lexical_search(frame.union(more), items).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == [1, 2, 3, 3, 4, 5, 6, 7, 8, 9]
    assert [r["rank"] for r in got] == list(range(1, 11))


def test_search_takes_segments_one_by_one(spark, monkeypatch):
    def limited(batches, rows, size):
        for batch in batches:
            if batch.num_rows > rows or batch.nbytes > size:
                raise ValueError(f"a batch of {batch.num_rows} rows and {batch.nbytes} bytes")
            yield batch

    texts = [np.random.default_rng(k).bytes(800_000).hex(" ", 4) for k in range(6)]  # 1.8 MB of words each
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").coalesce(1)
    items = [(k, f"{text[:8]} {text[-8:]} absent") for k, text in enumerate(texts)]
    cut = lexical._segments
    monkeypatch.setattr(lexical, "_segments", lambda some, size: cut(limited(some, 1, 2 << 20), size))
    index = lexical.build_index(docs, 1 << 20)
    footers = [pq.ParquetFile(path.removeprefix("file:")).metadata for path in index.inputFiles()]
    assert [f.row_group(k).num_rows for f in footers for k in range(f.num_row_groups)] == [1] * 6
    for name in ("_document_counts", "_searched"):
        make = getattr(lexical, name)
        monkeypatch.setattr(
            lexical, name, lambda *args, make=make: lambda some, run=make(*args): run(limited(some, 1, 8 << 20))
        )
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert searched(lexical.search(index, frame)) == ranked([*enumerate(texts)], items)


# Collocations


def phrases_of(rows, least, top=2000, covered=50):
    """Counts of all phrases, and what the rules leave of them."""
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^ \t]+", piece)
            sizes[lang] += len(w)
            for k in (1, 2, 3):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        found = []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            longer = [n for q, n in candidates.items() if len(q) > len(p) and p in (q[:2], q[1:])]
            if any(100 * n >= covered * a for n in longer):
                continue
            cuts = []
            for k in range(1, len(p)):
                left, right = f[p[:k]], f[p[k:]]
                cuts.append((1_000_000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top]):
            out.append((lang, rank + 1, p.decode(), -a, left, right, sizes[lang], -s))
    return sorted(out)


def mined(df):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.select(*names).collect()))


def random_texts(n, seed=5):
    rnd = random.Random(seed)
    vocabulary = ["a", "b", "É", "c'd", "new", "york", "New", "x y", "日本"]
    glue = [" ", "  ", "\t", ". ", ", ", "\n", "; ", " \r", "\x0b"]
    weights = [30, 2, 2, 3, 2, 1, 1, 1, 1]
    return [
        "".join(rnd.choice(vocabulary) + rnd.choices(glue, weights)[0] for _ in range(rnd.randint(0, 60)))
        for _ in range(n)
    ]


@pytest.mark.parametrize("least", [1, 3, 10])
def test_phrases_by_brute_force(spark, least):
    texts = random_texts(120)
    frame = table(spark, texts, langs=("en", None, "fr", "und", ""))
    rows = [tuple(r) for r in frame.select("text", "lang").collect()]
    assert mined(collocations.collocations(frame, least=least)) == phrases_of(rows, least)
    few = mined(collocations.collocations(frame, least=least, top=4))
    assert few == phrases_of(rows, least, top=4)


def test_phrases_of_long_texts_in_windows_and_many_buckets(spark, awkward, monkeypatch):
    rows = [tuple(r) for r in awkward.select("text", "lang").collect()]
    want = phrases_of(rows, 10)
    assert mined(collocations.collocations(awkward)) == want
    monkeypatch.setattr(collocations, "BUCKET_WORDS", 700)
    monkeypatch.setattr(collocations, "RANKED_ROWS", 50)
    assert mined(collocations.collocations(awkward, window_bytes=64)) == want
    assert mined(collocations.collocations(awkward, top=3)) == phrases_of(rows, 10, top=3)
    assert collocations.collocations(awkward.limit(0)).count() == 0


def test_words_with_equal_hashes_start_over(spark, monkeypatch):
    """A seed whose hashes mix words up is noticed, and the next one is taken."""
    frame = table(spark, random_texts(60, 8))
    rows = [tuple(r) for r in frame.select("text", "lang").collect()]
    counted = collocations._words_counted

    def clashing(seed, size):
        run = counted(seed, size)

        def masked(batches):
            for batch in run(batches):
                few = pa.array(batch.column(0).to_numpy() % 3)
                yield batch.set_column(0, "h", few) if seed == 0 else batch

        return masked

    monkeypatch.setattr(collocations, "_words_counted", clashing)
    assert collocations._counted_words(collocations._texts(frame), 10, 1 << 20)[1] == 2
    assert mined(collocations.collocations(frame)) == phrases_of(rows, 10)


def test_quicksort_counts(spark):
    rng = np.random.default_rng(4)
    for many, variety, depth in ((0, 3, 2), (1, 3, 2), (500, 4, 3), (5000, 40, 2), (5000, 3, 1), (3000, 10**6, 2)):
        keys = [rng.integers(0, variety, many).astype(np.uint64) for _ in range(depth)]
        counts = rng.integers(1, 4, many)
        at, totals = collocations.frequent(keys, counts, 10)
        want = Counter()
        for *key, n in zip(*(k.tolist() for k in keys), counts.tolist()):
            want[tuple(key)] += n
        got = {tuple(int(k[p]) for k in keys): int(t) for p, t in zip(at, totals)}
        assert got == {k: n for k, n in want.items() if n >= 10} and len(at) == len(got)


def test_score_beyond_64_bits(spark):
    a, left, right = 3_000_000_017, 3_000_000_019, 4_000_000_007
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    got = row.select(collocations._score(*map(lambda c: row[c], ("a", "l", "r")))).first()[0]
    assert got == 1_000_000 * a * a // (left * right)


# Personal data

BASE = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    doubled = [int(d) if k % 2 == 0 else int(d) * 2 - (9 if d > "4" else 0) for k, d in enumerate(digits[::-1])]
    return sum(doubled) % 10 == 0


def base_of(text):
    spans = []
    for kind, pattern in enumerate(BASE):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = [True, kind == 1 and all(int(x) <= 255 for x in m[0].split(".")),
                    16 <= len(digits) <= 19 and luhn(digits), 8 <= len(digits) <= 15][kind]
            if good:
                spans.append((kind, m.start(), m.end()))
    return spans


ODD = [
    "a@b@c.d a@b.c+d@e.f é ß x@y.z.1. 1.2.3.4.5.6.7.8 256.1.1.1 01.2.3.004 +1 (23) 45-67 89. +1.2",
    "+123456789012345678 4111 1111 1111 1111-4111111111111111 378282246310005 😀 q@q.qq 4111 1111 1111 1111",
    "1" * 5000 + " " + "a.b" * 3000 + "@" + "c.d" * 3000,
    "+1-555-123-4567" * 200 + " 5.5.5.5" * 300,
    "٣٤٥٦@x.y ４１１１ １.２.３.４ +１２",
]


def test_base_spans(spark, docs, awkward):
    frame = docs.select("doc_id", "text").union(
        spark.createDataFrame([(10**9 + k, t) for k, t in enumerate(ODD)], "doc_id long, text string")
    )
    found = {r["doc_id"]: r for r in personal.find_personal(frame).collect()}
    assert len(found) == frame.count()
    for r in frame.collect():
        spans, got = base_of(r["text"]), found[r["doc_id"]]
        line = ",".join(f"{personal.KINDS[k]}:{a}:{b}" for k, a, b in spans)
        assert got["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [got[f"n_{k}"] for k in personal.KINDS] == [sum(s[0] == i for s in spans) for i in range(4)]
        assert set(filter(None, line.split(","))) <= set(got["spans"].split(","))
    rows = personal.find_personal(awkward).collect()
    assert len(rows) == 13 and all(r["spans"] == "" for r in rows)
    assert personal.find_personal(awkward.limit(0)).count() == 0


def test_contexts_discover_unseen_identifiers(spark):
    rnd = random.Random(6)

    def digits(n):
        return "".join(rnd.choice("0123456789") for _ in range(n))

    def card(good):
        while True:
            number = digits(16)
            if luhn(number) == good:
                return number

    texts = [f"please bill my card {card(True)} for order {digits(8)} today" for _ in range(12)]
    unseen = [card(False) for _ in range(3)]
    texts += [f"please bill my card {n} for the goods" for n in unseen]
    # A second context, known only by the identifiers of the first; a third with neither.
    texts += [f"the number on file is {n}, we think" for n in unseen for _ in range(2)]
    strange = card(False)
    texts += [f"the code of the part is {strange} as said", texts[0], texts[0], None, ""]
    frame = spark.createDataFrame(
        [(k, t, "x") for k, t in enumerate(texts)] + [(None, texts[12], "x")], "doc_id long, text string, spans string"
    )
    found = personal.find_personal(frame, support=3).collect()
    spans = defaultdict(set)
    for r in found:
        spans[r["doc_id"]] = set(filter(None, r["spans"].split(",")))
    for k, number in enumerate(unseen):
        at = texts[12 + k].index(number)
        assert spans[12 + k] == {f"card:{at}:{at + 16}"}
    assert spans[None] == spans[12]
    later = [k for k, t in enumerate(texts) if t and t.startswith("the number")]
    assert all(len(spans[k]) == 1 and next(iter(spans[k])).startswith("card:") for k in later)
    assert not spans[texts.index(f"the code of the part is {strange} as said")]
    # Order numbers stand in a context of their own, without a single seed.
    assert all(len(spans[k]) == 1 for k in range(12))
    none = personal.find_personal(frame, support=1000).collect()
    assert sum(r["n_discovered"] for r in none) == 0


def test_personal_data_stays_native(spark, docs):
    text = personal.find_personal(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", text)
    source = open(personal.__file__).read()
    assert not re.search(r"pandas|pyarrow|mapIn|udf|\.rdd", source)


# Near duplicates and exact search: bounded groups and blocks


def near_prints(many, seed=3):
    """Fingerprints that agree in two segments: a dense family, some pairs, some strangers."""
    rng = np.random.default_rng(seed)
    center, free = np.uint64(0x5A5A_0F0F_3C3C_1234), np.arange(22, 64)

    def flipped(base, count):
        out = base.copy()
        for row in range(len(out)):
            for bit in rng.choice(free, count, replace=False):
                out[row] ^= np.uint64(1) << np.uint64(bit)
        return out

    family = flipped(np.full(many * 9 // 10, center), 5)
    strangers = (rng.integers(0, 2**42, many // 20).astype(np.uint64) << np.uint64(22)) | (center & np.uint64(2**22 - 1))
    partners = flipped(strangers.copy(), 4)
    return np.unique(np.concatenate([family, strangers, partners]))


def component_sets(spark, prints, **sizes):
    from verdigrid.llm import simhash
    from verdigrid.llm.components import components

    frame = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long").repartition(6)
    found = simhash.links(frame, **sizes)
    roots = {r["u"]: r["root"] for r in components(found).collect()}
    sets = defaultdict(set)
    for p in prints.view(np.int64).tolist():
        sets[roots.get(p, p)].add(p)
    return {frozenset(s) for s in sets.values()}


def test_large_buckets_are_joined_in_pieces(spark):
    from verdigrid.llm import simhash

    prints = near_prints(3000)
    parent = np.arange(len(prints))
    for k in range(len(prints)):
        near = np.flatnonzero(np.bitwise_count(prints ^ prints[k]) <= 4)
        simhash.connect(parent, np.full(len(near), k), near)
    want = defaultdict(set)
    for p, root in zip(prints.view(np.int64).tolist(), parent.tolist()):
        want[root].add(p)
    want = {frozenset(s) for s in want.values()}
    assert component_sets(spark, prints) == want
    assert component_sets(spark, prints, forest_rows=400, piece_rows=130) == want


def test_a_bucket_of_a_hundred_thousand_fingerprints(spark):
    """Given up by its task, cut into pieces, and joined by several tasks: equal components."""
    from verdigrid.llm import simhash

    prints = near_prints(115_000)
    assert len(prints) > 100_000
    forest = simhash.Forest(np.array([0]), prints)
    forest.links()
    want = defaultdict(set)
    for p, root in zip(prints.view(np.int64).tolist(), forest.parent.tolist()):
        want[root].add(p)
    got = component_sets(spark, prints, forest_rows=60_000, piece_rows=60_000)
    assert got == {frozenset(s) for s in want.values()}


def test_top_k_of_equal_ids_with_other_vectors(spark):
    """Every vector of a query id has its own list; blocks of one query give the same."""
    from verdigrid.llm import topk

    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0]), (0, [-1.0, 0.5])]
    rows += [(k, [k / 10, -k / 20]) for k in range(1, 9)]
    table_ = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    want = []
    for name, q in {(i, tuple(v)) for i, v in rows if i % 50 == 0}:
        whole = lambda v: [math.floor(256 * x) for x in v]
        scored = sorted((-sum(a * b for a, b in zip(whole(q), whole(v))), i) for i, v in rows if i != name)
        want += [(name, r + 1, i, -s) for r, (s, i) in enumerate(scored[:5])]
    for size in (1, 2, 100):
        got = topk.top_k(table_, query_block=size)
        assert sorted(map(tuple, got.collect())) == sorted(want)
