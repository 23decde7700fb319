"""Every query with SQL against DuckDB on the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.5f}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.fixture(scope="module")
def con(sf_dir="/root/testdata/sf0.001"):
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in os.listdir(sf_dir):
        c.execute(f"create view {f.split('.')[0]} as select * from '{sf_dir}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_sql(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    got = con.execute(entry.oracle_sql()[name])
    names = [x[0] for x in got.description]
    assert sorted(names) == sorted(df.columns)
    cols = sorted(names)
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in got.fetchall())
    assert sorted(tuple(plain(r[c]) for c in cols) for r in df.collect()) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
