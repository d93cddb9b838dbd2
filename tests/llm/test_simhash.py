"""SimHash groups against brute force over all fingerprint pairs."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from docksense.llm.queries import op7_simhash
from docksense.llm.simhash import drop_near_copies, fingerprint_links, shard_links, simhash_groups


def brute_print(text, words=3):
    tokens = "".join(c.lower() if c.isascii() else c for c in text or "")
    tokens = [w for w in __import__("re").split("[\x20\x09-\x0d]+", tokens) if w]
    if not tokens:
        return 0
    grams = [" ".join(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(values, radius=3):
    values, lab = list(values), {}
    for v in values:
        lab[v] = v
    changed = True
    near = [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= radius]
    while changed:
        changed = False
        for a, b in near:
            m = min(lab[a], lab[b])
            changed |= lab[a] != m or lab[b] != m
            lab[a] = lab[b] = m
    return lab


def brute(rows):
    prints = [(d, brute_print(t)) for d, t in rows]
    lab = brute_roots({p for _, p in prints})
    low = {}
    for d, p in prints:
        if d is not None:
            low[lab[p]] = min(d, low.get(lab[p], d))
    return sorted(((d, f"{p:016x}", low.get(lab[p])) for d, p in prints), key=str)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in op7_simhash(spark, sf).collect()), key=str) == brute(rows)


def test_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "É é"), (8, "é é"),
            (9, "a b c d " * 30000), (9, "a b c d " * 30000), (None, "one"), (10, "x\x85y z"), (None, "alone here")]
    df = spark.createDataFrame([(d, t, "k") for d, t in rows], "doc_id long, text string, fp string")
    assert sorted((tuple(r) for r in simhash_groups(df).collect()), key=str) == brute(rows)
    kept = drop_near_copies(df)
    assert kept.columns == ["doc_id", "text", "fp"]
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {1, 4, 9, None} <= set(ids) and not {2, 3, 5} & set(ids)
    assert drop_near_copies(df.limit(0)).count() == 0 and simhash_groups(df.limit(0)).count() == 0


def test_drop_near_copies_keeps_columns_of_any_name(spark):
    rows = [(i, f"text number {i // 2} of some words {i // 2}", i, "r", 1.5, "d", "x") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row long, _more string, first double, doc string, _id string")
    kept = drop_near_copies(df.union(df))
    assert kept.columns == df.columns
    assert {tuple(r) for r in kept.collect()} <= set(rows) and kept.count() == len({r.doc_id for r in kept.collect()})


@pytest.mark.parametrize("shard_rows", [3, 4096])
def test_links_keep_every_component(spark, shard_rows):
    rng = random.Random(5)
    values = set()
    for _ in range(25):
        v = rng.getrandbits(64)
        for _ in range(12):
            values.add(v)
            v ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    links = [(a % (1 << 64), b % (1 << 64)) for a, b in fingerprint_links(df, 3, shard_rows).distinct().collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    lab = {v: v for v in values}
    for _ in values:
        for a, b in links:
            lab[a] = lab[b] = min(lab[a], lab[b])
    assert lab == brute_roots(values)


def test_tree_forest():
    rng = random.Random(1)
    values = [rng.getrandbits(10) for _ in range(200)]
    values = sorted(set(values))
    lab = {v: v for v in values}
    for _ in values:
        for a, b in shard_links(values, 2):
            lab[a] = lab[b] = min(lab[a], lab[b])
    assert lab == brute_roots(values, 2)


def test_no_python_rows_of_text_after_prints(spark, sf_dir):
    df = simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("first", F.lit(1)))
    assert df.columns == ["doc_id", "fingerprint", "component_id"]
