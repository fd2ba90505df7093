"""The queries of problems 5 to 10 run, and those with SQL agree with it."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from billforge.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, name):
    got = QUERIES[name](spark, data)
    rows = [tuple(r) for r in got.collect()]
    assert rows or name in ("p10_found",)
    if name.endswith("_found"):
        assert len(rows) == len(set(rows))
    if name in SQL:
        db = duckdb.connect()
        for f in os.listdir(data):
            db.execute(f"create view {f.split('.')[0]} as select * from '{data}/{f}'")
        assert sorted(rows) == sorted(db.execute(SQL[name]).fetchall())


def test_registered():
    assert set(QUERIES) <= set(entry.queries())
