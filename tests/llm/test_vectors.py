"""Embedding near-duplicates and nearest neighbours against brute force."""

import math

import numpy as np
import pandas as pd
import pytest

from docksense.llm import ann
from docksense.llm.embedding_dedup import linked_pairs, near_duplicates
from docksense.llm.queries import op2_embedding_dedup, op4_nearest

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, d int"


def groups(n, pairs):
    lab = list(range(n))
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            m = min(lab[i], lab[j])
            changed |= lab[i] != m or lab[j] != m
            lab[i] = lab[j] = m
    return lab


def brute_links(rows, threshold=0.93):
    def fine(r):
        return r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    rows = sorted(rows, key=lambda r: r[0])
    pairs, links = [], [0] * len(rows)
    unit = [np.array(r[1], float) / np.linalg.norm(np.array(r[1], float)) if fine(r) else None for r in rows]
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]):
                if unit[i] @ unit[j] >= threshold:
                    pairs.append((i, j))
                    links[i] += 1
                    links[j] += 1
    lab = groups(len(rows), pairs)
    return {(rows[i][0], links[i], rows[lab[i]][0], i == lab[i]) for i in range(len(rows))}


def test_query_links(spark, sf_dir):
    rows = [tuple(r)[:3] for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        "vec_id", "embedding", "label").collect()]
    got = {tuple(r) for r in op2_embedding_dedup(spark, sf_dir).select("vec_id", "n_links", "component_id", "kept").collect()}
    assert got == brute_links(rows)


@pytest.mark.parametrize("tile_rows", [4, 1000])
def test_links_of_odd_vectors(spark, tile_rows):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((6, 8))
    rows = [(i, [float(x) for x in base[i % 6] + rng.standard_normal(8) * 0.12], i % 2) for i in range(60)]
    rows += [(100 + i, [1.0] * 8, 1) for i in range(20)]  # copies
    rows += [(200, None, 1), (201, [0.0] * 8, 1), (202, [float("nan")] * 8, 1), (203, [1.0] * 8, None),
             (204, [None] + [1.0] * 7, 1), (205, [float("inf")] * 8, 1), (206, [1.0, 1.0], 1), (207, [2.0, 2.0], 1),
             (208, [1e-30] * 8, 0), (209, [1e30] * 8, 0), (210, [], 0)]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], k) for i, v, k in rows]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    out = near_duplicates(df, 0.93, tile_rows)
    assert {tuple(r) for r in out.select("vec_id", "n_links", "component_id", "kept").collect()} == brute_links(rows)


def test_links_of_nothing(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame([(None, [1.0], 1, "x", 1), (3, None, None, "x", 1)], SCHEMA)
    assert {tuple(r) for r in near_duplicates(odd).collect()} == {(None, 0, None, False), (3, 0, 3, True)}


@pytest.mark.parametrize("two", [False, True])
def test_blocks_of_a_tile_give_all_links(monkeypatch, two):
    from docksense.llm import embedding_dedup

    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(5)
    x = np.repeat(rng.standard_normal((20, 12)), 3, axis=0) + 0.15 * rng.standard_normal((60, 12))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    side = rng.integers(0, 2, 60) if two else np.zeros(60, int)
    copies = rng.integers(1, 4, 60)
    pdf = pd.DataFrame({"pair": 1, "side": side, "cls": np.arange(60), "copies": copies, "embedding": list(x), "axes_": list(x)})
    near = (x @ x.T >= 0.93) & ~np.eye(60, dtype=bool)
    if two:
        near &= side[:, None] != side[None, :]
    links = near @ copies
    got = embedding_dedup._compare(0.93)(pdf).set_index("cls")
    assert near.any() and got.links.to_dict() == {int(k): int(links[k]) for k in np.flatnonzero(links)}
    root = np.arange(60)
    while True:
        new = np.array([min([root[k], *root[near[k]]]) for k in range(60)])
        if (new == root).all():
            break
        root = new
    a, b = got.root.to_dict(), {int(k): int(root[k]) for k in np.flatnonzero(links)}
    assert all((a[k] == a[m]) == (b[k] == b[m]) for k in b for m in b)


def test_bounds_drop_no_pair():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((300, 20)) * np.linspace(3, 0.1, 20)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i, j = linked_pairs(x, x, 0.9)
    a, b = np.nonzero(x @ x.T >= 0.9)
    assert set(zip(i, j)) == set(zip(a, b))


def brute_nearest(rows, k=20):
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    x = np.array([r[1] for r in rows], float)
    out = {}
    for i, r in enumerate(rows):
        if r[0] % 20 == 0:
            s = (x * x[i]).sum(axis=1)
            order = sorted((j for j in range(len(rows)) if rows[j][0] != r[0]), key=lambda j: (-s[j], rows[j][0]))[:k]
            out[r[0]] = [(rows[j][0], s[j]) for j in order]
    return out


def test_query_nearest(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(
        "vec_id", "embedding").collect()]
    want, got = brute_nearest(rows), {}
    for r in op4_nearest(spark, "/root/testdata/sf0.1").orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    exact = {r[0]: np.array(r[1], float) for r in rows}
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    for q, found in got.items():
        assert found == sorted(found, key=lambda t: (-t[1], t[0]))
        assert all(abs(s - exact[q] @ exact[v]) < 1e-9 for v, s in found)
    hit = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    print("recall", hit / (20 * len(want)))
    assert hit / (20 * len(want)) >= 0.98


def test_nearest_of_odd_vectors(spark):
    rows = [(20, [1.0, 2.0]), (0, [0.0, 0.0]), (40, None), (1, [3.0, 1.0]), (2, [3.0, 1.0]), (2, [3.0, 1.0]),
            (3, [float("nan"), 1.0]), (4, [1.0, 1.0, 1.0]), (60, [-1.0, None]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)
    out = ann.nearest(df, df.filter("vec_id % 20 = 0"), k=3).orderBy("rank").collect()
    assert [tuple(r) for r in out] == [(20, 1, 1, 5.0), (20, 2, 2, 5.0), (20, 3, 2, 5.0)]
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_bounds_hold_mostly():
    rng = np.random.default_rng(1)
    x, q = rng.standard_normal((500, 64)), rng.standard_normal((40, 64))
    turn = ann.rotation(64, 256)
    codes, norm, scale = ann.encode(x, turn)
    value, width = ann.estimate(codes, norm, scale, q.astype(np.float32) @ turn.T, np.linalg.norm(q, axis=1), 2.0)
    assert (np.abs(value - q @ x.T) <= width).mean() > 0.9
