"""Every registered query against its DuckDB oracle on sf0.001."""

import collections

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, canon

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows, cols = df.collect(), df.columns
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(cols) == sorted(rel.columns)
    order = sorted(cols)
    a = collections.Counter(tuple(canon(r[cols.index(c)]) for c in order) for r in rows)
    b = collections.Counter(tuple(canon(r[rel.columns.index(c)]) for c in order) for r in rel.fetchall())
    assert a == b


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
