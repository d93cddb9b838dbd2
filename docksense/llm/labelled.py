"""Bounded samples of labelled rows, shared by the classifiers."""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str) -> Column:
    """True where crc32 of the id as text has remainder 1 by 3; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """At most ``per_class`` labelled training texts of each class: doc_id, text, y.

    Rows are chosen by a hash of their id, so reruns agree. Held-out ids, null ids, null labels and labels other than
    0 and 1 are left out; an id with two labels counts as 1 if either is.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.max(label).alias("y"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    picked = known.filter("y = 0").orderBy(*order).limit(per_class).union(
        known.filter("y = 1").orderBy(*order).limit(per_class))
    one = docs.select(F.col("doc_id").alias("_id"), "text").join(
        F.broadcast(picked), F.col("_id") == F.col("doc_id"))  # at most 2 * per_class rows of two numbers
    return one.select("doc_id", "text", "y")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def calibrated(raw: np.ndarray, y: np.ndarray, cut: float) -> tuple[float, float]:
    """Slope and offset so that sigmoid(slope * raw + offset) >= ``cut`` where raw divides the classes best.

    The best cut has the fewest errors weighed by class; of equal ones the middle of the widest gap.
    """
    order = np.argsort(raw, kind="stable")
    r, t = raw[order], y[order].astype(float)
    pos, neg = max(t.sum(), 1), max((1 - t).sum(), 1)
    loss = np.r_[0.0, np.cumsum(t / pos)] + np.r_[(1 - t).sum() / neg, (1 - t).sum() / neg - np.cumsum((1 - t) / neg)]
    best = np.flatnonzero(loss <= loss.min() + 1e-12)
    if not len(r):
        return 1.0, math.log(cut / (1 - cut))
    lows, highs = np.r_[r[0] - 1, r][best], np.r_[r, r[-1] + 1][best]
    k = int(np.argmax(highs - lows))
    return 1.0, math.log(cut / (1 - cut)) - float(lows[k] + highs[k]) / 2


def scored(docs: DataFrame, score: Column, cut: float) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return docs.select("doc_id", held_out("doc_id").alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= cut).cast("int"))
