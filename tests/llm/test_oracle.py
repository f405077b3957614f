"""The corpus queries that have SQL against DuckDB, on sf0.001."""

import duckdb
import pytest

from skymetrics.llm import queries as corpus

from tests.test_oracle import _canon

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(corpus.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = corpus.queries()[name](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(corpus.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert _canon(df.columns, got) == _canon(columns, cur.fetchall())
