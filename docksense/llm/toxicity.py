"""Toxicity: linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docksense.llm.labelled import calibrated, sample, scored, sigmoid

#: Training rows of each class at most.
PER_CLASS = 1500
SIZES = (4, 5, 6)
BUCKET_BITS = 20
SMOOTH, L2, ROUNDS, RATIO = 1.0, 2e-3, 300, 1.5
LEAST_DOCS = 4
CUT = 0.7


def ngram_ids(text: str) -> np.ndarray:
    """Bucket of each n-gram of the lower-case text, for every size; a short text is padded by blanks."""
    chars = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    out, h = [], np.zeros(len(chars), np.uint32)
    for n in range(1, max(SIZES) + 1):
        m = len(chars) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint32(0x01000193) + chars[n - 1:]
        if n in SIZES:
            v = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) + np.uint32(n)
            out.append(v >> np.uint32(32 - BUCKET_BITS))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


@dataclass
class Linear:
    """Weight of each bucket (NB ratio times fitted weight; most are zero) and the offset."""

    weight: np.ndarray
    offset: float

    def score(self, texts: Iterator[str | None]) -> np.ndarray:
        some = self.weight != 0
        out = []
        for text in texts:
            ids = ngram_ids(text or "")
            ids = np.unique(ids[some[ids]])
            out.append(float(self.weight[ids].sum()))
        return sigmoid(np.array(out) + self.offset)


def fit(ids: list[np.ndarray], y: np.ndarray, cut: float = CUT) -> Linear:
    """Log-count ratios of all buckets, then logistic weights on presence times ratio by accelerated gradient steps.

    ``ids`` are the distinct buckets of each text. Buckets with little contrast carry next to nothing after scaling and
    are left out. With one class or none, every score is the same.
    """
    size = 1 << BUCKET_BITS
    y = np.asarray(y, float)
    if not 0 < y.sum() < len(y):
        return Linear(np.zeros(size, np.float32), 0.0 if not len(y) else 3.0 if y.sum() else -3.0)
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    flat, row = np.concatenate(ids).astype(np.int64), np.repeat(np.arange(len(ids)), lengths)
    pos = np.bincount(flat, y[row], size)
    every = np.bincount(flat, minlength=size)
    neg = every - pos
    p, n = pos + SMOOTH, neg + SMOOTH
    ratio = np.log(p / (y.sum() + 2 * SMOOTH)) - np.log(n / (len(y) - y.sum() + 2 * SMOOTH))
    used = (every >= LEAST_DOCS) & (np.abs(ratio) >= RATIO)
    number = np.cumsum(used) - 1
    keep = used[flat]
    col, row = number[flat[keep]], row[keep]
    r = ratio[used]
    x = r[col]  # presence scaled by the ratio
    norm = np.maximum(1.0, np.sqrt(np.bincount(row, x * x, len(y))))
    k = len(r)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    step = 4.0 / max(1e-9, (weight * norm ** 2).max() * len(y) / 8)
    w, w_old, b, b_old = np.zeros(k), np.zeros(k), 0.0, 0.0
    step = min(step, 1.0)
    for t in range(ROUNDS):
        mom = t / (t + 3)
        v, c = w + mom * (w - w_old), b + mom * (b - b_old)
        e = weight * (sigmoid(np.bincount(row, x * v[col], len(y)) + c) - y)
        w_old, b_old = w, b
        w = (v - step * np.bincount(col, e[row] * x, k)) / (1 + step * L2)
        b = c - step * e.sum()
    raw = np.bincount(row, x * w[col], len(y))
    slope, offset = calibrated(raw, y, cut)
    full = np.zeros(size, np.float32)
    full[used] = w * r * slope
    return Linear(full, offset)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS, cut: float = CUT) -> Linear:
    """Fit in one executor task on at most ``per_class`` labelled texts of each class that are not held out.

    Only the weights, a fixed number of them, come to the driver.
    """

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf.doc_id, "y": pdf.y, "ids": [
                np.unique(ngram_ids(t or "")).astype("<i4").tobytes() for t in pdf.text]})

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = pd.concat([*batches, pd.DataFrame({"doc_id": [], "y": [], "ids": []})])
        got["ids"] = got.ids.map(bytes)
        got = got.sort_values(["doc_id", "ids"], kind="stable")
        model = fit([np.frombuffer(b, "<i4") for b in got.ids], got.y.to_numpy(float), cut)
        at = np.flatnonzero(model.weight)
        yield pd.DataFrame({"at": np.r_[-1, at], "w": np.r_[model.offset, model.weight[at]]})

    known = sample(docs, labels, label, per_class)
    known = known.mapInPandas(grams, "doc_id long, y int, ids binary")
    got = known.repartition(1).mapInPandas(learn, "at long, w double").toPandas()
    weight = np.zeros(1 << BUCKET_BITS, np.float32)
    some = got[got["at"] >= 0]
    weight[some["at"].to_numpy()] = some.w.to_numpy()
    offset = got.loc[got["at"] < 0, "w"]
    return Linear(weight, float(offset.iloc[0]) if len(offset) else 0.0)


def score(text: str | Column, model: Linear) -> Column:
    """Score of a text column, 0 to 1. A null text counts as empty. The model is sent once: 2^20 weights, 4 MB."""
    col = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.score(texts), dtype="float64")

    return run(col)


def toxicity_scores(docs: DataFrame, labels: DataFrame, cut: float = CUT, per_class: int = PER_CLASS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 from ``cut`` on).

    Every n-gram of the whole text counts. Null and empty texts have the score of a text without known n-grams.
    Repeated rows are scored each; a null doc_id is not held out. Without labels of both classes every score is the
    same. An empty table gives an empty table; other columns are ignored.
    """
    return scored(docs, score("text", train(docs, labels, per_class=per_class, cut=cut)), cut)
