"""Quality by a byte-level convolutional network, in numpy.

Filters look at ``WIDTH`` neighbouring bytes. A byte is one of 256 inputs, so the
convolution is a sum of table rows, one table per place in the filter. Outputs are
max-pooled over chunks that overlap by half and cover the whole text; the mean, the
largest and the smallest chunk value of every filter go through one hidden layer into
one probability. The net is fitted by Adam on a bounded sample of labelled documents;
the gradient of max pooling reaches the windows that won.

The only input is the text. Null text counts as empty, an empty text as one window of
zero bytes; both get a score. Without labels the score is 0. Ids may be null or
repeat; every input row gives one row. Texts are read whole, in bounded pieces.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigrid.llm.blocks import Block, bounded, held_out, measure
from verdigrid.llm.labelled import labelled_sample

THRESHOLD = 0.7
#: Bound of the labelled sample in rows and in bytes of text.
SAMPLE_ROWS = 4000
SAMPLE_BYTES = 8 << 20
#: Texts up to this part of the byte bound are sampled first, longer ones by doublings.
SMALL_PART = 64
WIDTH, FILTERS, HIDDEN = 7, 24, 12
#: Bytes of half a chunk, and of a piece that is convolved at once.
HALF = 256
PIECE = 1 << 16
EPOCHS, BATCH, RATE, SEED = 6, 32, 0.01, 11


def _half_chunks(text: np.ndarray) -> int:
    return max(1, -(-len(text) // HALF))


class ByteNet:
    """The net: filter tables, hidden layer and output."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        shapes = {
            "table": (WIDTH, 256, FILTERS),
            "bias": (FILTERS,),
            "inner": (3 * FILTERS, HIDDEN),
            "inner_bias": (HIDDEN,),
            "outer": (HIDDEN,),
            "outer_bias": (1,),
        }
        scale = {"table": 0.3, "inner": 0.3, "outer": 0.3}
        self.p = {
            k: (rng.standard_normal(s) * scale.get(k, 0)).astype(np.float32)
            for k, s in shapes.items()
        }
        self.fitted = False

    def _pooled(self, text: np.ndarray, winners: bool = False):
        """Max of every filter in every half chunk; with ``winners`` also where."""
        halves = _half_chunks(text)
        padded = np.zeros(halves * HALF + WIDTH - 1, np.uint8)
        padded[: len(text)] = text
        table = self.p["table"]
        out = np.empty((halves, FILTERS), np.float32)
        at = np.empty((halves, FILTERS), np.int64) if winners else None
        step = PIECE // HALF
        for first in range(0, halves, step):
            last = min(halves, first + step)
            a, b = first * HALF, last * HALF
            values = table[0][padded[a:b]]
            for j in range(1, WIDTH):
                values += table[j][padded[a + j : b + j]]
            cube = values.reshape(last - first, HALF, FILTERS)
            tail = max(1, len(text)) - a
            if tail < b - a:  # places behind the text take no part
                cube.reshape(-1, FILTERS)[tail:] = -1e9
            if winners:
                best = cube.argmax(axis=1)
                at[first:last] = best + (np.arange(first, last) * HALF)[:, None]
                out[first:last] = np.take_along_axis(cube, best[:, None], 1)[:, 0]
            else:
                out[first:last] = cube.max(axis=1)
        return (out, at, padded) if winners else out

    def _features(self, halves: np.ndarray) -> np.ndarray:
        chunks = np.maximum(halves[:-1], halves[1:]) if len(halves) > 1 else halves
        active = np.tanh(chunks + self.p["bias"])
        return np.concatenate([active.mean(0), active.max(0), active.min(0)])

    def _top(self, features: np.ndarray) -> np.ndarray:
        hidden = np.tanh(features @ self.p["inner"] + self.p["inner_bias"])
        z = hidden @ self.p["outer"] + self.p["outer_bias"][0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        if not self.fitted:
            return np.zeros(len(texts))
        rows = [self._features(self._pooled(t)) for t in texts]
        return self._top(np.array(rows).reshape(-1, 3 * FILTERS)).astype(np.float64)

    def _slopes(self, text: np.ndarray, label: int, g: dict[str, np.ndarray]) -> None:
        """Add the gradients of one document's log loss to ``g``."""
        p = self.p
        halves, at, padded = self._pooled(text, winners=True)
        if len(halves) > 1:
            left = halves[:-1] >= halves[1:]
            chunks = np.where(left, halves[:-1], halves[1:])
            place = np.where(left, at[:-1], at[1:])
        else:
            chunks, place = halves, at
        active = np.tanh(chunks + p["bias"])
        top, low = active.argmax(0), active.argmin(0)
        every = np.arange(FILTERS)
        x = np.concatenate([active.mean(0), active[top, every], active[low, every]])
        hidden = np.tanh(x @ p["inner"] + p["inner_bias"])
        z = float(np.clip(hidden @ p["outer"] + p["outer_bias"][0], -30, 30))
        gap = 1 / (1 + np.exp(-z)) - label
        g["outer"] += gap * hidden
        g["outer_bias"] += gap
        back = gap * p["outer"] * (1 - hidden**2)
        g["inner"] += np.outer(x, back)
        g["inner_bias"] += back
        dx = (p["inner"] @ back).reshape(3, FILTERS)
        da = np.repeat(dx[:1] / len(chunks), len(chunks), axis=0)
        np.add.at(da, (top, every), dx[1])
        np.add.at(da, (low, every), dx[2])
        dz = da * (1 - active**2)
        g["bias"] += dz.sum(0)
        for j in range(WIDTH):
            np.add.at(g["table"][j], (padded[place + j], np.broadcast_to(every, place.shape)), dz)

    def fit(self, texts: list[np.ndarray], labels: np.ndarray) -> None:
        """Adam over shuffled batches; the order follows from the seed."""
        if not len(texts):
            return
        rng = np.random.default_rng(SEED + 1)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        turn, turns = 0, EPOCHS * -(-len(texts) // BATCH)
        for _ in range(EPOCHS):
            order = rng.permutation(len(texts))
            for a in range(0, len(order), BATCH):
                g = {k: np.zeros_like(x) for k, x in self.p.items()}
                batch = order[a : a + BATCH]
                for i in batch:
                    self._slopes(texts[i], int(labels[i]), g)
                turn += 1
                rate = RATE * (1 - 0.9 * turn / turns)
                for k in self.p:
                    slope = g[k] / len(batch)
                    m[k] = 0.9 * m[k] + 0.1 * slope
                    v[k] = 0.99 * v[k] + 0.01 * slope * slope
                    fixed = (m[k] / (1 - 0.9**turn)) / (np.sqrt(v[k] / (1 - 0.99**turn)) + 1e-8)
                    self.p[k] -= (rate * fixed).astype(np.float32)
        self.fitted = True


def _fitting(sizes: np.ndarray, sample_bytes: int) -> np.ndarray:
    """Which texts to take, in ascending order: all together fit in ``sample_bytes``.

    Texts are tried in the given order, but one above a small part of the bound only
    after all shorter ones, class by class of doubled size, so that no single long text
    takes the place of many.
    """
    small = max(1, sample_bytes // SMALL_PART)
    doublings = np.ceil(np.log2(np.maximum(sizes / small, 1)))
    taken, left = [], sample_bytes
    for k in np.argsort(doublings, kind="stable").tolist():
        if sizes[k] <= left:
            taken.append(k)
            left -= int(sizes[k])
    return np.sort(np.array(taken, np.int64))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
) -> ByteNet:
    """A net of ``labels.quality``, from at most ``sample_rows`` and ``sample_bytes``.

    A text that does not fit is left out by itself; only one longer than
    ``sample_bytes`` can never be learnt from.
    """
    sample = labelled_sample(docs, labels, "quality", sample_rows)
    sizes = bounded(
        sample.select("doc_id", "place", F.octet_length("text").alias("size")).orderBy(
            "place", "doc_id"
        ),
        sample_rows,
    ).to_pandas()
    chosen = sizes.iloc[_fitting(sizes["size"].to_numpy(), sample_bytes)]
    net = ByteNet()
    if len(chosen):
        ids = sample.sparkSession.createDataFrame(chosen[["doc_id"]].astype("int64"))
        texts = bounded(
            sample.join(F.broadcast(ids), "doc_id").select(
                "doc_id", "place", F.col("text").cast("binary").alias("text"), "label"
            ),
            sample_rows,
        ).to_pandas()
        texts = texts.sort_values(["place", "doc_id"])
        net.fit([np.frombuffer(t, np.uint8) for t in texts["text"]], texts["label"].to_numpy())
    return net


def score_quality(docs: DataFrame, net: ByteNet) -> DataFrame:
    """doc_id, held_out, score and predicted, one row per row of ``docs``."""

    def kernel(block: Block) -> dict[str, np.ndarray]:
        at = block.bounds.tolist()
        return {"score": net.scores([block.data[a:b] for a, b in zip(at, at[1:])])}

    return measure(docs, kernel, "score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
