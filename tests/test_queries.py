"""Every registered query with SQL against DuckDB on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

from strataloom.plans import load_all

ROOT = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES = load_all()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{ROOT}/{name}.parquet'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.date) and not isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def table(rows, columns, order):
    place = [columns.index(c) for c in order]
    return sorted((tuple(plain(r[i]) for i in place) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_matches_sql(spark, duck, name):
    q = QUERIES[name]
    df = q(spark, ROOT)
    got = [tuple(r) for r in df.collect()]
    found = duck.execute(q.sql)
    names = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    assert table(got, df.columns, order) == table(found.fetchall(), names, order)


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if not q.sql))
def test_runs(spark, name):
    assert QUERIES[name](spark, ROOT).count() > 0


def test_driver_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
