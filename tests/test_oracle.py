"""Every registered query against its SQL twin (DuckDB) on sf0.001.

The same comparison the driver runs at sf0.01: column names, row count and an
order-insensitive hash of all values.
"""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from skymetrics.plans import catalog

from .conftest import SF_SMALL

TABLES = ["events", "lineitem", "orders"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return None if v is None else str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(_norm(r[i])) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(catalog.oracle_sql()) == set(catalog.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(catalog.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(want)
    assert _canon(df.columns, got) == _canon(ocols, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    first = df.schema
    assert df.count() > 0
    assert E.entry(spark).schema == first
