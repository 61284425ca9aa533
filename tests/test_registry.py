"""Every registered query against its SQL, on the smallest tables."""

import datetime
import decimal
from collections import Counter

import duckdb
import pytest

from tidemark.registry import ORACLES, QUERIES
from tidemark.registry.base import TABLES

FOLDER = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cur = duck.execute(ORACLES[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    want = Counter(tuple(plain(r[cols.index(c)]) for c in df.columns) for r in cur.fetchall())
    got = Counter(tuple(plain(v) for v in r) for r in df.collect())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_without_sql_give_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
