"""Quality and toxicity: held-out accuracy, reruns and odd texts."""

import zlib

import numpy as np
import pytest

from docksense.llm import quality, toxicity
from docksense.llm.queries import op8_toxicity, op9_quality

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("fn, label, least", [(op9_quality, "quality", 0.98), (op8_toxicity, "toxic", 0.95)])
def test_held_out(spark, fn, label, least):
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = fn(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(r.predicted == int(r.score >= (0.5 if label == "quality" else 0.7)) for r in rows)
    own = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in own) / len(own) >= least


@pytest.mark.parametrize("run", [quality.quality_scores, toxicity.toxicity_scores])
def test_odd_texts(spark, run):
    good, bad = "The quiet river runs past the old mill and turns. ", "IDIOT!! moron!! ||| ### trash!! "
    rows = [(i, (good if i % 2 else bad) * (1 + i % 7), "k") for i in range(200)]
    rows += [(900, None, "k"), (901, "", "k"), (902, good * 20000, "k"), (None, good, "k"), (1, good, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(200)] + [(None, 1, 1), (3, None, None)],
                                   "doc_id long, quality int, toxic int")
    got = run(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    one = {r.doc_id: r.predicted for r in got}
    assert one[1] != one[0]
    assert sorted(map(str, got)) == sorted(map(str, run(docs, labels).collect()))
    assert run(docs.limit(0), labels).count() == 0
    assert len({r.score for r in run(docs, labels.limit(0)).collect()}) == 1


def test_forest_walk():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((2000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] < -0.2)).astype(int)
    forest = quality.fit(x, y)

    def walk(row):
        out = forest.base
        for node in forest.roots:
            while forest.feature[node] >= 0:
                node = forest.left[node] + int(row[forest.feature[node]] > forest.limit[node])
            out += forest.value[node]
        return out

    assert np.allclose([walk(r) for r in x[:200]], forest.margin(x[:200]))
    assert ((forest.margin(x) > 0) == y).mean() > 0.97
