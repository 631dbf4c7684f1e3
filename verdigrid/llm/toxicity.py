"""Toxicity by a noisy channel: restore the intended letters, then score the words.

A character trigram model is counted over all documents. Words that mix letters with
look-alike signs, spell letters apart or repeat them become lattices: each place has
the letters it may stand for, each with the cost of writing it that way. Viterbi takes
the cheapest path under the character model. Restored words and their beginnings are
the features of a logistic model, fitted on a bounded sample of labelled documents;
ids, languages and sources are no inputs.

Null text counts as empty; a text without known features scores the model's bias.
Without any label of the kind asked for the score is 0. Ids may be null or repeat;
every input row gives one row. Texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigrid.llm.blocks import Block, blocks, bounded, held_out, keep_where, keyed_texts, measure
from verdigrid.llm.labelled import labelled_sample

THRESHOLD = 0.3
#: Bound of the labelled sample, of candidate features, and of those in the model.
SAMPLE_ROWS = 8000
CANDIDATES = 20000
FEATURES = 1500
LEAST_TOXIC = 3
PREFIXES = range(3, 9)
#: Restored words a worker remembers; the memory is emptied when full.
REMEMBERED = 250_000

# Character classes of the model: edge of a word, a to z, other letters, digits, signs.
EDGE, OTHER, DIGIT, SIGN, CLASSES = 0, 27, 28, 29, 30
_CLASS = np.full(256, SIGN, np.int64)
_CLASS[[32, *range(9, 14)]] = EDGE
_CLASS[48:58] = DIGIT
_CLASS[65:91] = _CLASS[97:123] = np.arange(1, 27)
_CLASS[128:] = OTHER

# The letters a sign may stand for.
LOOKS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e",
    "*": "aeiou", "#": "aeiou", "%": "aeiou",
}
GAPS = " .-_*~'"
# Costs in nats of writing a letter so: as a sign, with a gap, repeated.
LOOK_COST, ANY_COST, GAP_COST, LONG_COST, PAIR_COST = 1.0, 2.5, 0.7, 0.7, 6.0

_ENDS = ".,;:!?\"'()[]{}<>|*#%&$@+~_-/\\=^`"
_FRONT = "".join(c for c in _ENDS if c not in "@$!|(+")
_LETTERS = re.compile(r"[^\W\d_]+")
_APART = re.compile(r"(?<!\S)(?:[^\s][ .\-_*]){3,}[^\s](?!\S)")
_NOISY = re.compile(r"(.)\1\1|[^\W\d_][0-9@$!|+(€*#%.\-_~']|[0-9@$!|+(€][^\W\d_]", re.DOTALL)


def count_trigrams(docs: DataFrame) -> DataFrame:
    """(gram, n) over all documents; at most ``CLASSES`` ** 3 rows."""

    def run(batches):
        total = np.zeros(CLASSES**3, np.int64)
        for block in blocks(batches, 0):
            data = block.data
            starts = block.bounds[1:-1]
            now = _CLASS[data]
            if len(starts):  # a text begins at an edge
                now = np.insert(now, starts, EDGE)
                data = np.insert(data, starts, 32)
            now = now[(data & 0xC0) != 0x80]
            now = np.concatenate([[EDGE], now, [EDGE]])
            one = np.concatenate([[EDGE], now[:-1]])
            two = np.where(one == EDGE, EDGE, np.concatenate([[EDGE], one[:-1]]))
            code = (two * CLASSES + one) * CLASSES + now
            total += np.bincount(code, minlength=CLASSES**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])

    return (
        keyed_texts(docs, "text")
        .mapInArrow(run, "gram long, n long")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
    )


def trigram_costs(docs: DataFrame) -> np.ndarray:
    """-log P(third | first two), smoothed by the bigram and then evenly."""
    counts = np.zeros(CLASSES**3)
    found = bounded(count_trigrams(docs), CLASSES**3)
    counts[found["gram"].to_numpy()] = found["n"].to_numpy()
    counts = counts.reshape(CLASSES, CLASSES, CLASSES)
    pairs = counts.sum(axis=0) + 0.5
    by_one = pairs / pairs.sum(axis=1, keepdims=True)
    costs = -np.log((counts + 2 * by_one) / (counts.sum(axis=2, keepdims=True) + 2))
    return costs.astype(np.float32)


def _symbol(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    return OTHER if c.isalpha() else DIGIT if c.isdigit() else SIGN


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """For each place the strings it may stand for, with their costs."""
    out, at = [], 0
    while at < len(word):
        c, end = word[at], at + 1
        while end < len(word) and word[end] == c:
            end += 1
        run = end - at
        if c.isalpha():
            if run == 1:
                out.append([(c, 0.0)])
            elif run == 2:
                out.append([(c + c, 0.0), (c, PAIR_COST)])
            else:
                out.append([(c, LONG_COST), (c + c, LONG_COST)])
        else:
            choices = [(c * run, 0.0)]
            looks = LOOKS.get(c, "")
            cost = ANY_COST if len(looks) > 2 else LOOK_COST
            choices += [(x * min(run, 2), cost * run) for x in looks]
            if any(x and x in looks for x in (word[at - 1 : at], word[end : end + 1])):
                choices.append(("", cost * run))  # repeats the letter beside it
            if c in GAPS:
                choices.append(("", GAP_COST * run))
            out.append(choices)
        at = end
    return out


def restore(word: str, costs: np.ndarray) -> str:
    """The cheapest path through the word's lattice; of equal ones, the first found.

    Paths are kept as back references, so the work grows with the word's length only.
    """
    # Per state: cost, the string of the last place, and the path before it.
    paths: dict[tuple[int, int], tuple] = {(EDGE, EDGE): (0.0, "", None)}
    for choices in lattice(word):
        step: dict[tuple[int, int], tuple] = {}
        for (two, one), path in paths.items():
            for string, cost in choices:
                a, b, total = two, one, path[0] + cost
                for c in string:
                    k = _symbol(c)
                    total += costs[a, b, k]
                    a, b = b, k
                best = step.get((a, b))
                if best is None or total < best[0]:
                    step[a, b] = total, string, path
        paths = step
    at = min(paths, key=lambda s: paths[s][0] + costs[s[0], s[1], EDGE])
    path, strings = paths[at], []
    while path is not None:
        strings.append(path[1])
        path = path[2]
    return "".join(reversed(strings))


def words_of(raw: str, costs: np.ndarray) -> list[str]:
    """Letter runs of one written word, restored where it looks disguised."""
    word = raw.lower().rstrip(_ENDS).lstrip(_FRONT)
    if _NOISY.search(word):
        word = restore(word, costs)
    return _LETTERS.findall(word)


def features_of(word: str) -> list[str]:
    return [f"={word}", *(word[:k] for k in PREFIXES if k <= len(word))]


class Features:
    """Features of texts, with a memory of written words."""

    def __init__(self, costs: np.ndarray, known: dict[str, int] | None = None):
        self.costs, self.known = costs, known
        self.memory: dict[str, tuple] = {}

    def _of(self, raw: str) -> tuple:
        names = [f for w in words_of(raw, self.costs) for f in features_of(w)]
        if self.known is None:
            return tuple(names)
        return tuple(self.known[f] for f in names if f in self.known)

    def counts(self, text: str) -> Counter:
        raws = text.split()
        new = set(raws).difference(self.memory)
        if len(self.memory) + len(new) > REMEMBERED:
            self.memory = {}
            new = set(raws)
        for raw in new:
            self.memory[raw] = self._of(raw)
        out: Counter = Counter()
        for found in filter(None, map(self.memory.get, raws)):
            out.update(found)
        for m in _APART.finditer(text):
            out.update(self._of(m[0]))
        return out


def _candidates(sample: DataFrame, costs: np.ndarray) -> list[str]:
    """Features of at least ``LEAST_TOXIC`` toxic documents, the most frequent ones."""

    def run(batches):
        found: Counter = Counter()
        features = Features(costs)
        for block in blocks(batches, 0):
            for text in block.texts():
                found.update(features.counts(text.decode("utf-8", "replace")).keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
            ["feature", "n"],
        )

    frequent = (
        sample.where("label = 1")
        .select("text")
        .mapInArrow(run, "feature string, n long")
        .groupBy("feature")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= LEAST_TOXIC)
        .orderBy(F.desc("n"), "feature")
        .limit(CANDIDATES)
    )
    return bounded(frequent, CANDIDATES)["feature"].to_pylist()


def _likelihood(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log-likelihood gain of a feature's share being its own in either class, signed."""

    def fit(k, n, p):
        p = np.clip(p, 1e-9, 1 - 1e-9)
        return k * np.log(p) + (n - k) * np.log(1 - p)

    a, b = toxic / n_toxic, clean / max(n_clean, 1)
    p = (toxic + clean) / (n_toxic + n_clean)
    gain = (
        fit(toxic, n_toxic, a)
        + fit(clean, n_clean, b)
        - fit(toxic, n_toxic, p)
        - fit(clean, n_clean, p)
    )
    return np.where(a > b, gain, -gain)


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the mean log loss with a small penalty."""
    w, v, m = (np.zeros(x.shape[1], np.float32) for _ in range(3))
    share = (y.sum() + 0.5) / (len(y) + 1)
    bias = math.log(share / (1 - share))
    for k in range(1, rounds + 1):
        gap = 1 / (1 + np.exp(-np.clip(x @ w + bias, -30, 30))) - y
        slope = x.T @ gap.astype(np.float32) / len(y) + 1e-4 * w
        m = 0.9 * m + 0.1 * slope
        v = 0.999 * v + 0.001 * slope * slope
        w = w - 0.05 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
        bias -= 0.5 * float(gap.mean())
    return w, bias


class Model:
    """Weights of the features, and the costs that restore words."""

    def __init__(self, costs: np.ndarray, known: dict[str, int], weights: np.ndarray, bias: float | None):
        self.costs, self.known, self.weights, self.bias = costs, known, weights, bias

    def kernel(self) -> Callable[[Block], np.ndarray]:
        features = Features(self.costs, self.known)
        weights = self.weights.tolist()

        def scores(block: Block) -> np.ndarray:
            if self.bias is None:
                return np.zeros(len(block.bounds) - 1)
            sums = [
                sum(weights[k] * math.log1p(n) for k, n in found.items())
                for found in (
                    features.counts(t.decode("utf-8", "replace")) for t in block.texts()
                )
            ]
            return 1 / (1 + np.exp(-np.clip(np.array(sums, float) + self.bias, -30, 30)))

        return scores


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS
) -> Model:
    """A model of ``labels.toxic``, learnt from at most ``sample_rows`` documents."""
    costs = trigram_costs(docs)
    sample = labelled_sample(docs, labels, "toxic", sample_rows)
    by_label = bounded(sample.groupBy("label").agg(F.count("*").alias("n")), 2)
    sizes = dict(zip(*(by_label[c].to_pylist() for c in ("label", "n"))))
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic:
        return Model(costs, {}, np.zeros(0), None)
    names = _candidates(sample, costs)
    known = {name: k for k, name in enumerate(names)}

    def run(batches):
        features = Features(costs, known)
        for block in blocks(batches, 2):
            found = [features.counts(t.decode("utf-8", "replace")) for t in block.texts()]
            yield pa.RecordBatch.from_arrays(
                [
                    *block.batch.columns[:2],
                    pa.array([list(f) for f in found], pa.list_(pa.int32())),
                    pa.array([list(f.values()) for f in found], pa.list_(pa.int32())),
                ],
                ["place", "label", "ks", "ns"],
            )

    # Rows hold candidates only, whatever the length of the text.
    found = sample.select("place", "label", "text").mapInArrow(
        run, "place long, label int, ks array<int>, ns array<int>"
    )
    rows = bounded(found.orderBy("place", "label"), sample_rows)
    y = rows["label"].to_numpy()
    lists = rows["ks"].combine_chunks()
    places = np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy()))
    ks = lists.flatten().to_numpy()
    ns = rows["ns"].combine_chunks().flatten().to_numpy()
    toxic = np.bincount(ks[y[places] == 1], minlength=len(names))
    clean = np.bincount(ks[y[places] == 0], minlength=len(names))
    chosen = np.argsort(-_likelihood(toxic, clean, n_toxic, n_clean), kind="stable")[:FEATURES]
    column = np.full(len(names), -1)
    column[chosen] = np.arange(len(chosen))
    used = column[ks] >= 0
    x = np.zeros((len(y), len(chosen)), np.float32)
    x[places[used], column[ks[used]]] = np.log1p(ns[used])
    weights, bias = fit_logistic(x, y)
    return Model(costs, {names[k]: i for i, k in enumerate(chosen)}, weights, bias)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted, one row per row of ``docs``."""

    def kernel(block: Block, state=[]) -> dict[str, np.ndarray]:  # noqa: B006
        if not state:
            state.append(model.kernel())
        return {"score": state[0](block)}

    return measure(docs, kernel, "score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_civil(docs: DataFrame, model: Model) -> DataFrame:
    """The documents predicted not to be toxic, with all their columns."""

    def verdict(block: Block, state=[]) -> np.ndarray:  # noqa: B006
        if not state:
            state.append(model.kernel())
        return state[0](block) < THRESHOLD

    return keep_where(docs, verdict)
