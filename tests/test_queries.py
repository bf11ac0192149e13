"""Every query of the checks on the smallest tables, against its SQL in DuckDB."""

import os
from datetime import date, datetime

import duckdb
import pytest

import __spark_entry__ as entry_points

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry_points.QUERIES, entry_points.SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{SF}/{file}'")
    return con


def plain(v):
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, duck, key):
    df = QUERIES[key](spark, SF)
    columns = sorted(df.columns)
    assert key in SQL, "every query so far has SQL to be checked against"
    result = duck.execute(SQL[key])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in order) for r in result.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert got == want


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
