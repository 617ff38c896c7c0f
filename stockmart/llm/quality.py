"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins at quantiles of the training texts. Boosting goes round
the features in cycles; each turn fits a tree of a few leaves over one feature's bins to what is
left, and adds a small share of it to that feature's table. Then the pairs of features whose joint
tables would help most get tables of their own, learned in the same way. A score is the sum of one
entry per table, so a batch is scored by vectorised additions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockmart.llm.common import text_of
from stockmart.llm.toxicity import held_out, training_sample
from stockmart.llm.words import slices, texts_of

#: Bound of the training sample, in labelled texts.
MOST_TEXTS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 8
CYCLES, RATE, LEAVES = 60, 0.15, 3
LIMIT = 0.3

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = b"0123456789"
STOPS = b".,;:!?"
SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in STOPS)

FEATURES = (
    "log_bytes", "log_words", "word_length", "longest_word", "distinct_words", "top_word",
    "same_as_before", "upper", "digits", "stops", "exclamations", "bars", "symbols", "high_bytes",
    "line_words", "distinct_lines", "short_lines", "entropy", "titled_words", "marked_words",
)


def features(text: bytes) -> list[float]:
    """The features of a text in UTF-8, in the order of ``FEATURES``."""
    size = max(1, len(text))
    words = text.split()
    n = max(1, len(words))
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [line for line in text.split(b"\n") if line.strip()]
    of_bytes = np.bincount(np.frombuffer(text, np.uint8), minlength=256) if text else np.zeros(256, int)
    share = of_bytes[of_bytes > 0] / size
    among = lambda some: float(of_bytes[list(some)].sum()) / size
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        (size - n) / n,
        max(map(len, counts), default=0),
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        among(UPPER),
        among(DIGITS),
        among(STOPS),
        float(of_bytes[ord("!")]) / size,
        float(of_bytes[ord("|")]) / size,
        among(SYMBOLS),
        float(of_bytes[128:].sum()) / size,
        len(words) / max(1, len(lines)),
        len(set(lines)) / max(1, len(lines)),
        sum(len(line) < 30 for line in lines) / max(1, len(lines)),
        float(-(share * np.log2(share)).sum()),
        sum(map(bytes.istitle, counts)) / max(1, len(counts)),
        sum(not w[-1:].isalnum() and w[-1] < 128 for w in counts) / max(1, len(counts)),
    ]


def feature_rows(texts: pa.Array) -> np.ndarray:
    found = [features(t) for t in texts.cast(pa.large_binary()).to_pylist()]
    return np.array(found, np.float64).reshape(-1, len(FEATURES))


def leaves(gradient: np.ndarray, weight: np.ndarray, most: int) -> np.ndarray:
    """Values of the bins by a tree of at most ``most`` leaves, split where the gain is greatest."""
    g, h = np.concatenate(([0], np.cumsum(gradient))), np.concatenate(([0], np.cumsum(weight)))
    worth = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)
    edges = [0, len(gradient)]
    for _ in range(most - 1):
        best, cut = 1e-9, None
        for a, b in zip(edges, edges[1:]):
            if b - a > 1:
                inner = np.arange(a + 1, b)
                gain = worth(a, inner) + worth(inner, b) - worth(a, b)
                if gain.max() > best:
                    best, cut = float(gain.max()), int(inner[gain.argmax()])
        if cut is None:
            break
        edges = sorted([*edges, cut])
    out = np.empty(len(gradient))
    for a, b in zip(edges, edges[1:]):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


@dataclass
class Model:
    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for i, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            out += table[np.searchsorted(cuts, x[:, i], side="right")]
        wide = [np.searchsorted(c, x[:, i], side="right") for i, c in enumerate(self.pair_cuts)]
        for (i, j), table in self.pairs.items():
            out += table[wide[i], wide[j]]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -40, 40)))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Tables for rows of features ``x`` and labels ``y`` of 0 and 1."""
    if not len(y):
        return Model(0.0, [], [])
    rate = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(rate / (1 - rate)))
    cut = lambda k: [np.unique(np.quantile(x[:, i], np.linspace(0, 1, k + 1)[1:-1])) for i in range(x.shape[1])]
    model = Model(base, cut(BINS), [], cut(PAIR_BINS))
    bins = [np.searchsorted(c, x[:, i], side="right") for i, c in enumerate(model.cuts)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    margin = np.full(len(y), base)
    for _ in range(CYCLES):
        for b, table in zip(bins, model.tables):
            p = 1 / (1 + np.exp(-margin))
            gradient = np.bincount(b, y - p, len(table))
            change = RATE * leaves(gradient, np.bincount(b, p * (1 - p), len(table)), LEAVES)
            table += change
            margin += change[b]
    wide = [np.searchsorted(c, x[:, i], side="right") for i, c in enumerate(model.pair_cuts)]

    def cells(i: int, j: int) -> tuple[np.ndarray, tuple[int, int]]:
        shape = len(model.pair_cuts[i]) + 1, len(model.pair_cuts[j]) + 1
        return wide[i] * shape[1] + wide[j], shape

    p = 1 / (1 + np.exp(-margin))
    gains = {}
    for i, j in combinations(range(x.shape[1]), 2):
        cell, shape = cells(i, j)
        g = np.bincount(cell, y - p, shape[0] * shape[1])
        h = np.bincount(cell, p * (1 - p), shape[0] * shape[1])
        gains[i, j] = float((g**2 / (h + 5.0)).sum())
    for pair in sorted(gains, key=gains.get, reverse=True)[:PAIRS]:
        model.pairs[pair] = np.zeros(cells(*pair)[1])
    for _ in range(CYCLES // 2):
        for pair, table in model.pairs.items():
            cell, shape = cells(*pair)
            p = 1 / (1 + np.exp(-margin))
            g = np.bincount(cell, y - p, table.size).reshape(shape)
            h = np.bincount(cell, p * (1 - p), table.size).reshape(shape)
            # A tree over the pair: the better cut of either feature first, then each side by the other.
            change = RATE * max((_grown(g, h), _grown(g.T, h.T).T), key=lambda t: (g * t - h * t**2 / 2).sum())
            table += change
            margin += change.ravel()[cell]
    return model


def _grown(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    rows = leaves(g.sum(axis=1), h.sum(axis=1), 2)
    out = np.empty(g.shape)
    for value in np.unique(rows):
        side = rows == value
        out[side] = leaves(g[side].sum(axis=0), h[side].sum(axis=0), LEAVES)
    return out


def train(
    docs: DataFrame,
    labels: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    label_col: str = "quality",
    most: int = MOST_TEXTS,
) -> Model:
    """A model from a sample of about ``most`` labelled rows outside of the held-out fold.

    Features are made where the texts are; only they and the labels come to the driver. Without
    labelled rows every score is one half; with one label only they are near that label.
    """
    sample = training_sample(docs, labels, text_col, id_col, label_col, most)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x = feature_rows(texts_of(part, "text"))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("label"), lists], ["label", "x"])

    rows = sample.mapInArrow(measured, "label int, x array<double>").toPandas()
    x = np.array(rows["x"].tolist(), np.float64).reshape(-1, len(FEATURES))
    order = np.lexsort(x.T)
    return fit(x[order], rows["label"].to_numpy(float)[order])


def score(
    docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id", limit: float = LIMIT
) -> DataFrame:
    """doc_id, score and predicted of each row's whole text; nothing is shuffled.

    A null text is empty, and an empty text has features like any other. Null and repeated ids
    stay as they are; an empty table gives no rows; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                chance = sent.value.probability(feature_rows(texts_of(part, "text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(chance)], ["doc_id", "score"])

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(scored, f"doc_id {kind}, score double").withColumn(
        "predicted", (F.col("score") >= limit).cast("int")
    )


