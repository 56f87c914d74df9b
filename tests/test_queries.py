"""Every query that has an SQL oracle gives the same rows as DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tether.plans import catalogue
from tether.plans.roles import TABLES

#: The queries of the linkage engine; a folder of its own holds the tests of the others.
QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'").fetchall()
    return c


def plain(v):
    if v is None:
        return ""
    if isinstance(v, bool | int):
        return str(int(v))
    if isinstance(v, float):
        return f"{v:.6g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    rows = result.fetchall()
    assert sorted(got.columns) == sorted(columns)
    own = sorted(columns)
    number = lambda v: plain(float(v)) if isinstance(v, int | float) and not isinstance(v, bool) or type(v).__name__ == "Decimal" else plain(v)
    want = sorted(tuple(number(r[columns.index(c)]) for c in own) for r in rows)
    have = sorted(tuple(number(r[c]) for c in own) for r in got.collect())
    assert have == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {f"ml_{i}" for i in range(1, 10)}))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).columns


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
