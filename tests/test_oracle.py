"""Core queries against their SQL in DuckDB, on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from reelspark.plans.oracle import ORACLE
from reelspark.plans.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{DATA}/{f}')")
    return c


def plain(value):
    if isinstance(value, float):
        return None if value != value else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sql, name):
    df = QUERIES[name](spark, DATA)
    cur = sql.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    expected = sorted((tuple(plain(float(v) if hasattr(v, "as_integer_ratio") and not isinstance(v, (bool, int)) else v) for v in r) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*names).collect()), key=repr)
    norm = lambda rows: [tuple(float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in r) for r in rows]
    assert sorted(norm(got), key=repr) == sorted(norm(expected), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    QUERIES[name](spark, DATA).collect()


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
