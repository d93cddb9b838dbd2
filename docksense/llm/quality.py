"""Quality classifier: histogram gradient-boosted trees over document statistics, flattened for numpy traversal."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docksense.llm.common import utf8
from docksense.llm.labelled import sample, scored, sigmoid

#: Training rows of each class at most.
PER_CLASS = 8000
TREES, DEPTH, BINS, RATE, LEAST, L2 = 80, 4, 64, 0.15, 10, 1.0

FEATURES = [
    "log_bytes", "log_words", "mean_word", "sd_word", "longest_word", "upper", "digits", "punctuation", "symbols",
    "high_bytes", "lines_per_word", "distinct_words", "top_word", "top_line", "distinct_lines", "upper_words",
    "word_ends_punct", "word_ends_symbol", "bars", "exclamations", "symbol_words", "entropy", "mean_line", "short_words",
]
_KIND = np.zeros(256, np.int8)  # byte -> 1 upper, 2 lower, 3 digit, 4 prose punctuation, 5 other ASCII sign, 6 high
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = 1, 2, 3, 6
_KIND[[b for b in range(33, 127) if not chr(b).isalnum()]] = 5
_KIND[[ord(c) for c in ".,;:'\"()?-"]] = 4


def statistics(text: bytes) -> np.ndarray:
    """The features of a whole text; an empty or blank one has zeros."""
    out = np.zeros(len(FEATURES))
    words = text.split()
    if not words:
        return out
    n = len(words)
    raw = np.frombuffer(text, np.uint8)
    byte = np.bincount(raw, minlength=256)
    kind = np.bincount(_KIND, weights=byte, minlength=7)
    ink = max(1.0, kind[1:].sum())
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = _KIND[np.fromiter((w[-1] for w in words), np.uint8, n)]
    heads = _KIND[np.fromiter((w[0] for w in words), np.uint8, n)]
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in text.split(b"\n") if x.strip()]
    line_counts: dict[bytes, int] = {}
    for x in lines:
        line_counts[x] = line_counts.get(x, 0) + 1
    share = byte[byte > 0] / len(raw)
    out[:] = [
        np.log1p(len(raw)), np.log1p(n), lengths.mean(), lengths.std(), lengths.max(), kind[1] / ink, kind[3] / ink,
        kind[4] / ink, kind[5] / ink, kind[6] / ink, len(lines) / n, len(counts) / n, max(counts.values()) / n,
        max(line_counts.values()) / len(lines), len(line_counts) / len(lines), (heads == 1).mean(), (ends == 4).mean(),
        (ends == 5).mean(), byte[124] / ink, byte[33] / ink, ((heads == 5) & (lengths <= 2)).mean(),
        -(share * np.log2(share)).sum(), n / len(lines), (lengths <= 3).mean(),
    ]
    return out


@dataclass
class Forest:
    """All trees as flat arrays: ``feature`` -1 marks a leaf, ``left`` and ``left + 1`` are the children."""

    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """One step down in all trees for all rows at once."""
        rows = np.arange(len(x))[:, None]
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        for _ in range(DEPTH):
            f = self.feature[node]
            down = self.left[node] + (x[rows, np.maximum(f, 0)] > self.limit[node])
            node = np.where(f < 0, node, down)
        return self.base + self.value[node].sum(axis=1)


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boosted trees on binned features, logistic loss, both classes with equal total weight.

    With one class or none the forest is empty and scores that class's share.
    """
    pos = float(y.sum())
    empty = np.empty(0, np.int64)
    if not 0 < pos < len(y):
        return Forest(empty, np.empty(0), empty, np.empty(0), empty, 0.0 if not len(y) else 3.0 if pos else -3.0)
    weight = np.where(y == 1, len(y) / (2 * pos), len(y) / (2 * (len(y) - pos)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    width, n_features = BINS, x.shape[1]
    offset = np.arange(n_features) * width
    feature, limit, left, value, roots = [], [], [], [], []
    margin = np.zeros(len(y))

    def leaf() -> int:
        feature.append(-1)
        limit.append(0.0)
        left.append(0)
        value.append(0.0)
        return len(feature) - 1

    for _ in range(TREES):
        p = sigmoid(margin)
        grad, hess = weight * (p - y), weight * p * (1 - p)
        root = leaf()
        roots.append(root)
        open_ = [(root, np.arange(len(y)))]
        for depth in range(DEPTH + 1):
            nxt = []
            for node, rows in open_:
                g, h = grad[rows].sum(), hess[rows].sum()
                value[node] = -RATE * g / (h + L2)
                margin[rows] += 0 if depth < DEPTH else value[node]
                split = None
                if depth < DEPTH and len(rows) >= 2 * LEAST:
                    flat = (binned[rows] + offset).ravel()
                    hist = [np.bincount(flat, np.repeat(v, n_features), n_features * width).reshape(n_features, width)
                            for v in (grad[rows], hess[rows], np.ones(len(rows)))]
                    gl, hl, nl = (np.cumsum(v, axis=1)[:, :-1] for v in hist)
                    gain = gl ** 2 / (hl + L2) + (g - gl) ** 2 / (h - hl + L2) - g ** 2 / (h + L2)
                    gain[(nl < LEAST) | (len(rows) - nl < LEAST)] = -1
                    f, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
                    if gain[f, b] > 1e-6 and b < len(edges[f]):
                        split = int(f), int(b)
                if split is None:
                    if depth < DEPTH:
                        margin[rows] += value[node]
                    continue
                f, b = split
                a = leaf()
                leaf()
                feature[node], limit[node], left[node] = f, float(edges[f][b]), a
                go = binned[rows, f] > b
                nxt += [(a, rows[~go]), (a + 1, rows[go])]
            open_ = nxt
    return Forest(np.array(feature), np.array(limit), np.array(left), np.array(value), np.array(roots), 0.0)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Forest:
    """Fit on at most ``per_class`` labelled rows of each class that are not held out.

    The statistics are computed on the executors; the driver gets one short row of numbers per sampled text.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf.doc_id, "y": pdf.y, "x": [statistics(bytes(t)) for t in pdf.text]})

    texts = sample(docs, labels, label, per_class).withColumn("text", utf8("text"))
    got = texts.mapInPandas(rows, "doc_id long, y int, x array<double>").toPandas()
    got = got.sort_values("doc_id", kind="stable")
    x = np.stack(got.x.to_list()) if len(got) else np.empty((0, len(FEATURES)))
    order = np.lexsort((*x.T, got.doc_id.to_numpy()))
    return fit(x[order], got.y.to_numpy()[order])


def score(text: str | Column, forest: Forest) -> Column:
    """Score of a text column, 0 to 1. A null text counts as empty. The forest has a few thousand numbers."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.stack([statistics(bytes(t)) for t in texts]) if len(texts) else np.empty((0, len(FEATURES)))
            yield pd.Series(sigmoid(forest.margin(x)) if len(x) else [], dtype="float64")

    return run(utf8(text))


def quality_scores(docs: DataFrame, labels: DataFrame, cut: float = 0.5, per_class: int = PER_CLASS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 from ``cut`` on).

    Null and blank texts are scored by zero statistics. Repeated rows are scored each; a null doc_id is not held out.
    Without labels of both classes every score is the same. An empty table gives an empty table; other columns are
    ignored.
    """
    return scored(docs, score("text", train(docs, labels, per_class=per_class)), cut)


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = 0.5, per_class: int = PER_CLASS) -> DataFrame:
    """The documents with a score from ``cut`` on, all columns as they are."""
    return docs.filter(score("text", train(docs, labels, per_class=per_class)) >= cut)
