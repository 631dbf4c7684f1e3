"""Blocks whose lanes share models; runs of letters encoded in place of pieces."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from verdigrid.llm import rangecoder, tokenfiles  # noqa: E402
from verdigrid.llm.words import windows  # noqa: E402

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_a_block_is_coded_by_many_lanes(monkeypatch):
    """Steps are few, and the lanes learn from each other."""
    rng, calls = np.random.default_rng(5), []
    settle = rangecoder._settle
    monkeypatch.setattr(rangecoder, "_settle", lambda *a: (calls.append(1), settle(*a)))
    n = 300_000
    ids = (rng.zipf(1.5, n) % 3000).astype(np.uint32)
    record = rangecoder.encode([ids])[0]
    steps, lanes = rangecoder._shape(n)
    assert steps < 256 and len(calls) <= 2 * steps
    assert (rangecoder.decode([record])[0] == ids).all()
    shares = np.bincount(ids)[np.unique(ids)] / n
    assert len(record) < 1.3 * n * -(shares * np.log2(shares)).sum() / 8
    phrase = np.tile(rng.integers(0, 40_000, 500), 200).astype(np.uint32)
    assert len(rangecoder.encode([phrase])[0]) < 0.2 * len(phrase)


def test_carries_and_every_shape():
    """Certain ids with rare others push low past its words; lane counts change with the size."""
    rng, damaged = np.random.default_rng(3), 0
    for n in (1, 7, 8, 9, 1023, 1024, 2048, 5000, 16_384, 40_001):
        for top in (1, 2, 70_000, 2**30 - 1, 2**30, 2**31 - 1):
            rare = rng.random(n) < 0.02
            ids = np.where(rare, rng.integers(0, top + 1, n), top).astype(np.uint32)
            record = rangecoder.encode([ids])[0]
            assert (rangecoder.decode([record])[0] == ids).all()
            broken = bytearray(record)
            broken[int(rng.integers(16, max(17, len(record)))) % len(record)] ^= 64
            try:  # bits that no id depends on may differ
                assert (rangecoder.decode([bytes(broken)])[0] == ids).all()
            except ValueError:
                damaged += 1
    assert damaged > 20


def test_many_different_ids():
    """More different ids than the order-0 distribution keeps."""
    ids = np.random.default_rng(2).permutation(np.arange(150_000, dtype=np.uint32))
    ids = np.concatenate([ids, ids[::-1]])
    record = rangecoder.encode([ids])[0]
    assert (rangecoder.decode([record])[0] == ids).all() and len(record) < 3 * len(ids)


def _texts():
    rnd = random.Random(4)
    parts = ["and", "And", "ANDÉ", "dé", "é", "É", "ÿ", "×", "÷", "à×b", "Ñ1", "12", "3.14", "'s", "don't", "'LL"]
    parts += ["<|endoftext|>", "<|ENDOFTEXT|>", "a<b", "\x01", "x\x01y", "\t", "\r", "\x1c", "\xa0", "é", "İ", "Σς"]
    parts += ["中文", "🙂", "²", "½", "ǅ", "_", "_a_", "...", ",", "(", ")", "</w>", "‍", "ａ", "ﬁ", "\x7f", "K"]
    glue = ["", "", " ", " ", "  ", "\n", "\n\n", ","]
    for _ in range(1500):
        yield "".join(rnd.choice(parts) + rnd.choice(glue) for _ in range(rnd.randint(0, 14)))
    yield from (None, "", " ", "\n", "and," * 50, "word " * 3000)


def _encoded(encoder, texts, size):
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array([t or "" for t in texts], pa.large_string())],
        ["doc_id", "text"],
    )
    flat, rows = [], []
    for window in windows(iter([batch]), 1, tokenfiles._INSIDE, size):
        ids, counts = encoder.encode(window)
        assert len(ids) == counts.sum()
        rows += [counts.tolist()] if not window.continued else []
        if window.continued:
            rows[-1][-1] += int(counts[0])
        flat.append(ids)
    return np.concatenate(flat).tolist(), [n for r in rows for n in r]


@pytest.mark.parametrize("route", ["runs", "marks", "apart"])
def test_ids_are_the_library_s(route):
    encoder, texts = tokenfiles.Encoder(WORDS), list(_texts())
    assert encoder.ends is not None and encoder.mark is not None
    if route != "runs":
        encoder.ends = None
    if route == "apart":
        encoder.mark = None
    want = [[*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    for size in (8 << 20, 4096):
        ids, counts = _encoded(encoder, texts, size)
        assert counts == [len(w) for w in want]
        assert ids == [x for w in want for x in w]


def test_the_library_gets_new_runs_together(monkeypatch):
    """Case and punctuation make no new runs, and a call takes many; the memory is bounded."""
    encoder, calls = tokenfiles.Encoder(WORDS), []
    library = encoder._library
    monkeypatch.setattr(encoder, "_library", lambda text: (calls.append(len(text.split())), library(text))[1])
    names = ["".join(random.Random(k).choices("abcdefgh", k=9)) for k in range(1500)]
    texts = [" ".join(f"{w} {w}, {w.title()}. ({w.upper()})" for w in names)]
    first = _encoded(encoder, texts, 8 << 20)
    assert calls == [1000, len(set(names)) + 4 - 1000]
    calls.clear()
    assert _encoded(encoder, texts, 8 << 20) == first and not calls
    monkeypatch.setattr(tokenfiles, "MEMORY_BYTES", 1000)
    assert _encoded(encoder, texts, 4096) == first and len(calls) > 2
    assert encoder.known.entries < 1500
