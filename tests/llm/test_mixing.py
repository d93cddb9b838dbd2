"""Mixing against a plain computation of targets, and its bounds on taken words."""

import duckdb
import pytest

from docksense.llm import mixing
from docksense.llm.queries import op1_mixing


def targets(sizes):
    """Water filling by repeated resharing."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), list(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= 2 * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ = [s for s in open_ if s not in over]
    return out


def check(rows, sources):
    by = {}
    for r in rows:
        s = sources[r.doc_id]
        by.setdefault(s, []).append(r)
        assert 0 <= r.taken <= 2 * r.size
    sizes = {s: sum(r["size"] for r in rs) for s, rs in by.items()}
    want = targets(sizes)
    for s, rs in by.items():
        assert all(r.source_size == sizes[s] and abs(r.target - want[s]) <= 1e-6 * max(1, want[s]) for r in rs)
        assert abs(sum(r.taken for r in rs) - want[s]) <= 3 * mixing.BLOCK


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, sf):
    sources = {r.doc_id: r.source for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op1_mixing(spark, sf).collect()
    assert len(rows) == len(sources)
    check(rows, sources)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, op1_mixing(spark, sf).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = {r[0]: r for r in con.execute(mixing.ORACLE_SQL).fetchall()}
    for r in rows:
        assert tuple(r)[:3] + (r.taken,) == want[r.doc_id][:3] + want[r.doc_id][4:]
        assert r.target == pytest.approx(want[r.doc_id][3], rel=1e-12)


def test_odd_rows_and_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 500)
    rows = [(i, "w " * (i % 37 + 1), None if i % 5 == 0 else "big" if i % 2 else "é", "x") for i in range(300)]
    rows += [(1000, None, "big", "x"), (1001, "", "null only", "x"), (1002, "huge " * 30000, "zz", "x"), (1003, "a b", "tiny", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    out = mixing.mix_plan(df).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert by[1000].size == by[1001].size == by[1001].taken == 0 and by[1001].target == 0
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + by[r[0]].size
    want = targets(sizes)
    for s in sizes:
        took = sum(by[r[0]].taken for r in rows if r[2] == s)
        assert abs(took - want[s]) <= mixing.BLOCK * (2 + sizes[s] // 500)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    words = {}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == {r.doc_id: r.taken for r in out if r.taken}
    assert mixing.mix_plan(df.limit(0)).count() == 0 and mixing.mix(df.limit(0)).count() == 0


def test_mix_keeps_columns_of_any_name(spark):
    names = ["pos", "_blocks", "_size", "_doc", "_source", "quota", "short", "_copy", "n_chars", "size", "target", "_pos"]
    rows = [(i, "w " * (i % 7 + 1), "a" if i % 3 else "b", *range(7, 7 + len(names))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names))
    plain = df.select("doc_id", "text", "source")
    got = mixing.mix(df)
    assert got.columns == df.columns
    taken = got.collect()
    assert sorted((r.doc_id, r.text) for r in taken) == sorted((r.doc_id, r.text) for r in mixing.mix(plain).collect())
    at = names.index("n_chars")
    for r in taken:
        rest = list(r)[3:]
        assert rest[at] in (7 + at, len(r.text))
        assert rest[:at] + rest[at + 1:] == [v for v in range(7, 7 + len(names)) if v != 7 + at]


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c d", "s")] * 3 + [(7, "e f", "s")] * 2, "doc_id long, text string, source string")
    out = mixing.mix_plan(df).collect()
    assert len(out) == 5 and all(r.taken <= 2 * r.size for r in out)


def test_seats_are_the_highest_quotients(spark):
    weights = [7.5, 1.0, 0.0, 300.25, 40.0, 40.0, 2.5]
    df = spark.createDataFrame([("g", i, w, n) for n in (1, 5, 97) for i, w in enumerate(weights)],
                               "g string, i int, w double, n long").withColumnRenamed("n", "seats")
    got = {(r.seats, r.i): r.quota for r in mixing.sainte_lague(df, ["g", "seats"], "i", "w", "seats").collect()}
    for n in (1, 5, 97):
        seats = [0] * len(weights)
        for _ in range(n):
            best = max(range(len(weights)), key=lambda i: (weights[i] / (seats[i] + 0.5), -i))
            seats[best] += 1
        assert [got[n, i] for i in range(len(weights))] == seats


def test_no_python(spark, sf_dir):
    plan = op1_mixing(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
