"""Repeated passages against a dictionary of all windows."""

import hashlib
import random

import numpy as np
import pytest

from docksense.llm import substring_dedup
from docksense.llm.queries import op6_substring_dedup
from docksense.llm.substring_dedup import drop_repeats, kept_texts, sliding_min


def brute(rows, words=13):
    order = [(d if d is not None else float("inf"), (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in order:
        for i in range(len(w) - words + 1):
            key = tuple(w[i:i + words])
            first[key] = min(d, first.get(key, d))
    out = []
    for (d, w), (doc_id, _) in zip(order, rows):
        gone = set()
        for i in range(len(w) - words + 1):
            if first[tuple(w[i:i + words])] < d:
                gone.update(range(i, i + words))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in op6_substring_dedup(spark, sf).collect()), key=str)
    assert got == brute(rows) and sum(r[2] for r in got) > 0


@pytest.mark.parametrize("hot", [3, 5000])
@pytest.mark.parametrize("words", [13, 5])
def test_odd_texts(spark, monkeypatch, hot, words):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    rng = random.Random(words)
    vocabulary = [f"w{i}é" for i in range(30)] + ["a"] * 5
    passages = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(10, 60))) for _ in range(8)]
    rows = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choice(vocabulary) for _ in range(20))
                 for _ in range(rng.randint(0, 5))]
        rows.append((i * 3 - 20, rng.choice([" ", "\n", " \t "]).join(parts)))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "a " * 40), (504, "a " * 30000), (505, passages[0]), (505, passages[0]),
             (505, passages[0] + " tail"), (None, passages[1]), (None, passages[1]), (None, "x " + passages[2])]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, doc int, row int")
    got = sorted((tuple(r) for r in drop_repeats(df, words).collect()), key=str)
    assert got == brute(rows, words)
    texts = {(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in kept_texts(df, words).collect()}
    assert texts == set(got)


def test_nothing(spark):
    assert drop_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sliding_min():
    x = np.random.default_rng(0).integers(0, 100, 50)
    for n in range(1, 20):
        assert sliding_min(x, n).tolist() == [min(x[i:i + n]) for i in range(len(x) - n + 1)]
