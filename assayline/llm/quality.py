"""Quality classifier: a generalised additive model with pairwise interactions.

Boosted cyclically: in each round every feature in turn gets a shallow tree over its bins,
fitted to the gradient of the logistic loss; the trees of a feature add up to one lookup
table. Then the pairs of features with the largest remaining gain get two-way tables the
same way. A text's score is a sum of table entries, so a batch is scored by additions.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from assayline.llm.tables import id_remainder, pick, unused, with_measure, written

FEATURES = (
    "log_chars",
    "letters",
    "digits",
    "capitals",
    "spaces",
    "marks",
    "symbols",
    "beyond_ascii",
    "word_length",
    "long_words",
    "distinct_words",
    "commonest_word",
    "repeated_lines",
    "line_length",
    "marked_words",
    "sentence_ends",
)


@dataclass(frozen=True)
class QualitySettings:
    # The model is fitted on at most this many labelled rows, those with the smallest hash
    # of their id. Every row is scored.
    sample: int = 20_000
    bins: int = 32
    pair_bins: int = 8
    rounds: int = 150
    pair_rounds: int = 60
    pairs: int = 10
    leaves: int = 4
    rate: float = 0.1
    smoothing: float = 5.0
    threshold: float = 0.3
    # Rows whose crc32(id as text) modulo `folds` is `held` are never learned from.
    folds: int = 5
    held: int = 0


# --- features


def _byte_classes() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for b in range(256):
        c = chr(b)
        if b >= 0x80:
            table[b] = 6
        elif c.isupper():
            table[b] = 1
        elif c.isdigit():
            table[b] = 2
        elif c.isspace():
            table[b] = 3
        elif c in ".,;:?'\"-()":
            table[b] = 4
        elif not c.isalpha():
            table[b] = 5
    return table


_CLASSES = _byte_classes()
_MARKED = re.compile(r"[^\w\s.,;:?'\"()-]+(?=\s|$)")
_ENDS = re.compile(r"[.?!](?=\s|$)")


def features_of(text: str | None) -> list[float]:
    """Shape of a whole text. A null text counts as an empty one."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    kinds = np.bincount(_CLASSES[np.frombuffer(raw, np.uint8)], minlength=7) / n
    words = text.split()
    lines = [line for line in text.split("\n") if line]
    count = max(1, len(words))
    common = Counter(words).most_common(1) if words else [("", 0)]
    repeats = sum(map(len, lines)) - sum(map(len, set(lines)))
    letters = kinds[0] + kinds[1] + kinds[6]
    return [
        float(np.log1p(len(text))),
        letters,
        kinds[2],
        kinds[1] / max(letters, 1e-9),
        kinds[3],
        kinds[4],
        kinds[5],
        kinds[6],
        sum(map(len, words)) / count,
        sum([len(w) > 14 for w in words]) / count,
        len(set(words)) / count,
        common[0][1] / count,
        repeats / max(1, len(text)),
        float(np.log1p(len(text) / max(1, len(lines)))),
        len(_MARKED.findall(text)) / count,
        len(_ENDS.findall(text)) / count,
    ]


def with_shape(df: DataFrame, text: str = "text", name: str = "shape") -> DataFrame:
    """`df` with the features of its text."""
    return with_measure(
        df, text, name, T.ArrayType(T.DoubleType()), pa.list_(pa.float64()), features_of
    )


# --- the model


@dataclass
class QualityModel:
    edges: list[np.ndarray] = field(repr=False)
    tables: list[np.ndarray] = field(repr=False)
    pairs: list[tuple[int, int]]
    coarse: list[np.ndarray] = field(repr=False)  # fine bin -> coarse bin, per feature
    pair_tables: list[np.ndarray] = field(repr=False)
    base: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k]) for k, e in enumerate(self.edges)], axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        bins = self.bins(x)
        total = np.full(len(x), self.base)
        for k, table in enumerate(self.tables):
            total += table[bins[:, k]]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[self.coarse[a][bins[:, a]], self.coarse[b][bins[:, b]]]
        return 1.0 / (1.0 + np.exp(-total))


def _tree(gradient, weight, leaves: int, smoothing: float) -> np.ndarray:
    """A shallow tree over ordered bins: its value in every bin."""
    g, h = np.r_[0.0, np.cumsum(gradient)], np.r_[0.0, np.cumsum(weight)]

    def worth(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + smoothing)

    cuts = [0, len(gradient)]
    while len(cuts) <= leaves:
        best, at = 1e-9, None
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                inner = np.arange(a + 1, b)
                gain = worth(a, inner) + worth(inner, b) - worth(a, b)
                k = int(gain.argmax())
                if gain[k] > best:
                    best, at = gain[k], int(inner[k])
        if at is None:
            break
        cuts = sorted([*cuts, at])
    value = np.zeros(len(gradient))
    for a, b in zip(cuts, cuts[1:]):
        value[a:b] = (g[b] - g[a]) / (h[b] - h[a] + smoothing)
    return value


def _pair_tree(gradient, weight, smoothing: float) -> tuple[np.ndarray, float]:
    """Best cut of one axis, then of the other on either side: values and gain."""
    best, found = -1.0, np.zeros_like(gradient)
    for turned in (False, True):
        g, h = (gradient.T, weight.T) if turned else (gradient, weight)
        for cut in range(1, g.shape[0]):
            value, gain = np.zeros_like(g), 0.0
            for side in (slice(0, cut), slice(cut, None)):
                leaf = _tree(g[side].sum(0), h[side].sum(0), 2, smoothing)
                value[side] = leaf[None, :]
                gain += float((leaf * g[side].sum(0)).sum())
            if gain > best:
                best, found = gain, value.T if turned else value
    return found, best


def train(x: np.ndarray, y: np.ndarray, settings: QualitySettings = QualitySettings()) -> QualityModel:
    """Fit on rows of features and 0/1 labels. Without rows every score is 1/2."""
    n, width = len(y), len(FEATURES)
    if not n:
        return QualityModel([np.zeros(0)] * width, [np.zeros(1)] * width, [], [], [], 0.0)
    share = np.linspace(0, 1, settings.bins + 1)[1:-1]
    edges = [np.unique(np.quantile(x[:, k], share)) for k in range(width)]
    model = QualityModel(edges, [np.zeros(len(e) + 1) for e in edges], [], [], [], 0.0)
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model.base = float(np.log(rate / (1 - rate)))
    bins = model.bins(x)
    total = np.full(n, model.base)

    def slopes():
        p = 1.0 / (1.0 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(settings.rounds):
        for k in range(width):
            g, h = slopes()
            size = len(model.tables[k])
            step = settings.rate * _tree(
                np.bincount(bins[:, k], g, size),
                np.bincount(bins[:, k], h, size),
                settings.leaves,
                settings.smoothing,
            )
            model.tables[k] += step
            total += step[bins[:, k]]
    model.coarse = [
        np.arange(len(t)) * settings.pair_bins // max(1, len(t)) for t in model.tables
    ]
    low = np.stack([model.coarse[k][bins[:, k]] for k in range(width)], axis=1)
    side = settings.pair_bins

    def histogram(a, b, values):
        return np.bincount(low[:, a] * side + low[:, b], values, side * side).reshape(side, side)

    g, h = slopes()
    gains = [
        (-_pair_tree(histogram(a, b, g), histogram(a, b, h), settings.smoothing)[1], a, b)
        for a in range(width)
        for b in range(a + 1, width)
    ]
    model.pairs = [(a, b) for _, a, b in sorted(gains)[: settings.pairs]]
    model.pair_tables = [np.zeros((side, side)) for _ in model.pairs]
    for _ in range(settings.pair_rounds):
        for k, (a, b) in enumerate(model.pairs):
            g, h = slopes()
            value, _ = _pair_tree(histogram(a, b, g), histogram(a, b, h), settings.smoothing)
            model.pair_tables[k] += settings.rate * value
            total += settings.rate * value[low[:, a], low[:, b]]
    return model


def fit(
    shapes: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings()
) -> QualityModel:
    """Learn from labelled rows outside the held-out fold.

    `shapes` has doc_id and the features of every document, `labels` doc_id and quality.
    Rows with a null id or label take no part.
    """
    known = pick(labels, doc_id="doc_id", quality="quality").where(
        F.col("quality").isin(0, 1)
        & (id_remainder("doc_id", settings.folds) != settings.held)
    )
    # Twice the sample passes this bound, so that only about that many rows are sorted and
    # sent, however many parts the table has.
    share = min(1.0, 2 * settings.sample / max(1, known.count()))
    rows = (
        pick(shapes, doc_id="doc_id", shape="shape")
        .join(known, "doc_id")
        .withColumn("order", F.shiftrightunsigned(F.xxhash64("doc_id"), 1))
        .where(F.col("order") <= min(int(share * 2.0**63), 2**63 - 1))
        .orderBy("order", "doc_id", "quality", "shape")
        .limit(settings.sample)
        .select("shape", "quality")
        .toPandas()
    )
    x = np.array(rows["shape"].tolist(), np.float64).reshape(len(rows), len(FEATURES))
    return train(x, rows["quality"].to_numpy(np.float64), settings)


def score(model: QualityModel, shape: Column) -> Column:
    """Probability of label 1 from the features of a text."""

    @F.pandas_udf("double")
    def add_up(shapes: pd.Series) -> pd.Series:
        x = np.array(shapes.tolist(), np.float64).reshape(len(shapes), len(FEATURES))
        return pd.Series(model.scores(x))

    return add_up(shape)


def shapes_of(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and features of every row."""
    return with_shape(pick(docs, doc_id=doc_id, text=text)).drop("text")


def classify(
    docs: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings()
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    One row per input row, repeated rows included. Null and empty texts are scored like any
    other; a null id is not held out. Labels are used only to fit, other columns not at all.
    """
    shapes = written(shapes_of(docs), "quality-shapes")
    model = fit(shapes, labels, settings)
    held = F.coalesce(id_remainder("doc_id", settings.folds) == settings.held, F.lit(False))
    scored = shapes.select("doc_id", held.alias("held_out"), score(model, F.col("shape")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= settings.threshold).cast("int"))


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    settings: QualitySettings = QualitySettings(),
    *,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """The rows whose text is predicted to be of good quality, with their own columns.

    Null and empty texts are scored like any other, repeated rows share one fate, rows with a
    null id are not learned from. An empty table gives no rows; without labels every score is
    1/2, and all rows stay. Columns may have any other names.
    """
    shape = unused(docs, "shape")
    shaped = written(with_shape(docs, text, shape), "quality-kept")
    rows = shaped.select(shaped[doc_id].alias("doc_id"), shaped[shape].alias("shape"))
    model = fit(rows, labels, settings)
    good = score(model, F.col(shape)) >= settings.threshold
    return shaped.where(good).select(*[shaped[c] for c in docs.columns])
