"""Registered queries against their DuckDB oracle on sf0.001 (the driver does the
same at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from tessera.sources.tables import TABLES
from tools.oracle_check import compare

SF = "/root/testdata/sf0.001"



@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if not n.startswith("op")))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert compare(got, want) is None


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "exceeds" in df.columns
