"""Every query with a SQL twin gives the same rows on DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from tools.compare import TABLES, rows

ORACLE = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def test_entry(spark):
    df = entry_module.entry(spark)
    assert {r["check_status"] for r in df.collect()} <= {"low", "full", "sufficient", "undefined"}


def test_twins_belong_to_queries():
    assert set(ORACLE) <= set(entry_module.queries())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_same_rows(spark, con, sf_dir, key):
    df = entry_module.queries()[key](spark, sf_dir)
    cur = con.execute(ORACLE[key])
    cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(cols, cur.fetchall())
