"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from billforge.plans import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    db = duckdb.connect()
    db.execute("set timezone = 'UTC'")
    for f in os.listdir(data):
        db.execute(f"create view {f.split('.')[0]} as select * from '{data}/{f}'")
    return db


def _value(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (list, tuple)):
        return tuple(_value(x) for x in v)
    if isinstance(v, float):
        return round(v, 6)
    return v.replace(tzinfo=None) if hasattr(v, "tzinfo") and v.tzinfo else v


def _rows(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(t[i]) for i in order) for t in tuples), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, data, name):
    got = QUERIES[name](spark, data)
    want = duck.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(names, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry(spark, data):
    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
