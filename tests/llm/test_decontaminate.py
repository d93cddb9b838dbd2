"""Benchmark decontamination against a dictionary of all windows."""

import hashlib
import random
import re

import pytest

from docksense.llm import decontaminate
from docksense.llm.decontaminate import contaminated_spans, contamination
from docksense.llm.queries import op11_decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    known = {}
    for item_id, text in items:
        w = words_of(text)
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            known.setdefault(tuple(w[s:s + n]), set()).add(item_id)
    sizes = {len(k) for k in known}
    out = []
    for doc_id, text in docs:
        w, hit, held = words_of(text), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                ids = known.get(tuple(w[s:s + n]))
                if ids is not None:
                    hit.update(range(s, s + n))
                    held |= {str(i) for i in ids if i is not None}
        digest = hashlib.sha256(",".join(sorted(held)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(held), digest, bool(hit)))
    return sorted(out, key=str)


def frames(spark, docs, items):
    return (spark.createDataFrame([(7, t, d, "x") for d, t in docs], "row int, text string, doc_id long, context string"),
            spark.createDataFrame([(i, t, 5, 6) for i, t in items], "item_id long, text string, n int, window int"))


def result(df):
    return sorted((tuple(r) for r in df.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=str)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = result(op11_decontaminate(spark, sf))
    assert got == brute(docs, items) and any(r[2] for r in got)


def corpus(rng):
    vocabulary = [f"w{i}É" for i in range(8)] + ["a", "B", "日本", "9"]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [make(rng.choice([1, 2, 3, 9, 10, 11, 25])) for _ in range(20)]
    items = [(i // 2, " ".join(p)) for i, p in enumerate(passages)] + [(None, "null id words"), (50, None), (51, " .,- "), (3, "a")]
    docs = []
    for i in range(80):
        parts = [rng.choice(passages) if rng.random() < 0.4 else make(rng.randint(0, 15)) for _ in range(rng.randint(0, 6))]
        docs.append((i // 2, rng.choice([" ", ", ", "\n", "\x7f-\t"]).join(x for p in parts for x in p)))
    docs += [(None, None), (None, ""), (1000, "NULL id wordS"), (1001, "é" * 50), (1002, "...")]
    docs += [(2000, " ".join(passages[5] * 30))] * 3
    return docs, items


@pytest.mark.parametrize(("seed", "part", "window", "shingle"),
                         [(0, 4 << 20, 10, 3), (1, 40, 10, 3), (2, 200, 4, 2), (3, 1, 10, 1), (4, 150, 3, 5)])
def test_odd_texts(spark, monkeypatch, seed, part, window, shingle):
    monkeypatch.setattr(decontaminate, "PART_BYTES", part)
    docs, items = corpus(random.Random(seed))
    d, i = frames(spark, docs, items)
    assert result(contamination(d.repartition(3), i, window, shingle)) == brute(docs, items, window)


def test_many_shingles_for_few_bits(spark, monkeypatch):
    """A filter that lets everything through changes nothing."""
    monkeypatch.setattr(decontaminate, "shingle_filter", lambda s, bits=0: decontaminate.np.full(8, 255, "uint8"))
    docs, items = corpus(random.Random(9))
    assert result(contamination(*frames(spark, docs, items))) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = corpus(random.Random(1))
    d, i = frames(spark, docs, items)
    assert contamination(d.limit(0), i).count() == 0
    got = result(contamination(d, i.limit(0)))
    assert got == brute(docs, []) and not any(r[2] for r in got)


def test_spans(spark):
    d, i = frames(spark, [(1, "x one two three y one two")], [(4, "One two three"), (5, "one, TWO")])
    texts, spans, items = contaminated_spans(d, i)
    assert sorted((r.start, r.end, r.window) for r in spans.collect()) == [
        (1, 3, "one two"), (1, 4, "one two three"), (5, 7, "one two")]
    assert sorted(map(tuple, items.collect())) == [("4", "one two three"), ("5", "one two")]
    assert texts.count() == 1
