"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes a short vector of counts and shares over its whole length.
Every feature is cut into quantile bins and has a lookup table over them.
Training goes round the features again and again: a shallow tree on one
feature's bins is fitted to the current residuals and a small part of it is
added to that feature's table. Then the pairs of features whose four-leaf trees
explain most of what is left get tables over two coarse bins, boosted in the
same way. Scoring adds up one table entry per feature and pair and passes the
sum through the logistic function.

The model is fitted on the driver from ``SAMPLE`` labelled rows at most, taken in
the order of a hash of doc_id and label. With no labelled row every score is 0.5.

Null text counts as empty; an empty text is scored from its all-zero features.
Rows without label or doc_id take no part in training, a null doc_id is not held
out unless crc32('') says so. A label that comes twice counts twice; repeated
documents count once. An empty table gives no rows. Other columns are never
inputs of a score.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillprice.llm.common import crc_mod, text_or_empty

SAMPLE = 20_000
FOLDS = 5
THRESHOLD = 0.3

BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, LEAVES, RIDGE = 60, 20, 0.2, 3, 5.0

FEATURES = ("log_bytes", "log_words", "word_length", "upper", "digits", "symbols", "stops", "spaces",
            "beyond_ascii", "word_kinds", "top_word", "pair_kinds", "log_lines", "line_kinds",
            "line_words", "marked_words", "capital_words")

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:'\"()-?"]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[33:127] = True
_SYMBOL &= ~(_UPPER | _LOWER | _DIGIT | _STOP)
_PIECE = 1 << 20


def features(text: str) -> np.ndarray:
    """The feature vector of one whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    n = len(raw)
    if not n:
        return np.zeros(len(FEATURES))
    counts = np.zeros(256, np.int64)
    for i in range(0, n, _PIECE):
        counts += np.bincount(np.frombuffer(raw, np.uint8, min(_PIECE, n - i), i), minlength=256)
    words = raw.split()
    m = max(len(words), 1)
    kinds = Counter(words)
    lines = raw.split(b"\n")
    marked = sum(c for w, c in kinds.items() if _SYMBOL[w[-1]])
    capital = sum(c for w, c in kinds.items() if w.isupper() and len(w) > 1)
    letters = max(int(counts[_UPPER | _LOWER].sum()), 1)
    return np.array([
        np.log1p(n), np.log1p(len(words)), (n - counts[_SPACE].sum()) / m, counts[_UPPER].sum() / letters,
        counts[_DIGIT].sum() / n, counts[_SYMBOL].sum() / n, counts[_STOP].sum() / n, counts[_SPACE].sum() / n,
        counts[128:].sum() / n, len(kinds) / m, max(kinds.values(), default=0) / m,
        len(set(zip(words, words[1:]))) / max(len(words) - 1, 1), np.log1p(len(lines)),
        len(set(lines)) / len(lines), np.log1p(len(words) / len(lines)), marked / m, capital / m])


@dataclass
class AdditiveModel:
    """Lookup tables over binned features and pairs of features."""

    intercept: float = 0.0
    edges: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pairs: list = field(default_factory=list)       # (i, j, edges of i, edges of j, table)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, (edges, values) in enumerate(zip(self.edges, self.tables)):
            total += values[np.searchsorted(edges, x[:, f], "right")]
        for i, j, ei, ej, values in self.pairs:
            total += values[np.searchsorted(ei, x[:, i], "right"), np.searchsorted(ej, x[:, j], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _gain(g, h):
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """A tree over ordered bins with gradient and curvature sums: its value in each bin."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for k, (lo, hi) in enumerate(parts):
            if hi - lo < 2:
                continue
            gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
            gt, ht = g[lo:hi].sum(), h[lo:hi].sum()
            gains = _gain(gl, hl) + _gain(gt - gl, ht - hl) - _gain(gt, ht)
            at = int(np.argmax(gains))
            if gains[at] > best[0]:
                best = (float(gains[at]), k, lo + at + 1)
        if best[1] is None:
            break
        lo, hi = parts.pop(best[1])
        parts += [(lo, best[2]), (best[2], hi)]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best one-cut-each-way tree over a table of two binned features: gain and values."""
    cg, ch = (np.pad(t.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for t in (g, h))
    best, out = 0.0, np.zeros_like(g)
    base = _gain(cg[-1, -1], ch[-1, -1])
    for a in range(1, g.shape[0]):
        for b in range(1, g.shape[1]):
            quarters = [(slice(0, a), slice(0, b)), (slice(0, a), slice(b, None)),
                        (slice(a, None), slice(0, b)), (slice(a, None), slice(b, None))]
            gs = [cg[a, b], cg[a, -1] - cg[a, b], cg[-1, b] - cg[a, b],
                  cg[-1, -1] - cg[a, -1] - cg[-1, b] + cg[a, b]]
            hs = [ch[a, b], ch[a, -1] - ch[a, b], ch[-1, b] - ch[a, b],
                  ch[-1, -1] - ch[a, -1] - ch[-1, b] + ch[a, b]]
            gain = sum(map(_gain, gs, hs)) - base
            if gain > best:
                best, out = gain, np.zeros_like(g)
                for where, gq, hq in zip(quarters, gs, hs):
                    out[where] = gq / (hq + RIDGE)
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting of one table per feature, then of the strongest pairs."""
    if not len(y):
        return AdditiveModel()
    model = AdditiveModel(intercept=float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))))
    model.edges = [_edges(x[:, f], BINS) for f in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.edges)]
    total = np.full(len(y), model.intercept)

    def residuals():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, at in enumerate(bins):
            r, w = residuals()
            size = len(model.tables[f])
            step = RATE * _tree(np.bincount(at, r, size), np.bincount(at, w, size))
            model.tables[f] += step
            total += step[at]

    coarse = [_edges(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    cbins = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(coarse)]

    def sums(i, j, v):
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        return np.bincount(cbins[i] * shape[1] + cbins[j], v, shape[0] * shape[1]).reshape(shape)

    r, w = residuals()
    ranked = sorted(((_pair_tree(sums(i, j, r), sums(i, j, w))[0], i, j)
                     for i in range(x.shape[1]) for j in range(i + 1, x.shape[1])), reverse=True)[:PAIRS]
    chosen = [(i, j, np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))) for gain, i, j in ranked if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for i, j, values in chosen:
            r, w = residuals()
            step = RATE * _pair_tree(sums(i, j, r), sums(i, j, w))[1]
            values += step
            total += step[cbins[i], cbins[j]]
    model.pairs = [(i, j, coarse[i], coarse[j], values) for i, j, values in chosen]
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> AdditiveModel:
    """Fit on the labelled rows outside the held-out fold, ``sample`` of them at most."""
    chosen = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (crc_mod("doc_id", FOLDS) != 0))
                    .select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__y"))
                    .orderBy(F.xxhash64("__id", "__y"), "__id", "__y").limit(sample))

    @F.pandas_udf("array<double>")
    def vector(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    # The sample is bounded by its limit, so broadcasting it moves no text.
    rows = (docs.select("doc_id", text_or_empty().alias("text"))
                .join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
                .select("__id", "__y", vector("text").alias("x"))
                .groupBy("__id").agg(F.min("x").alias("x"), F.collect_set("__y").alias("ys")).toPandas())
    rows = rows.explode("ys").sort_values(["__id", "ys"])
    if not len(rows):
        return AdditiveModel()
    return fit(np.array(rows["x"].tolist()), rows["ys"].to_numpy(float))


def scorer(spark: SparkSession, model: AdditiveModel):
    """A function of a text column; only the text goes to Python."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(np.array([features(t) for t in texts]).reshape(-1, len(FEATURES))))

    return scored


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    score = scorer(docs.sparkSession, train(docs, labels))
    scored = docs.select("doc_id", score(text_or_empty()).alias("score"))
    return scored.select("doc_id", (crc_mod("doc_id", FOLDS) == 0).alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, columns as they were."""
    score = scorer(docs.sparkSession, train(docs, labels))
    return docs.filter(score(text_or_empty()) >= threshold)
