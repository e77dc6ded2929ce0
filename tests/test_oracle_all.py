"""The correctness gate in miniature: every registered query against its
DuckDB oracle on the smallest tables (row count, columns, values)."""

import math

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E

NAMES = sorted(E.QUERIES)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return "NULL" if v is None else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{SF_SMALL}/events.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    rel = duck.sql(E.oracle_sql()[name])
    cols = sorted(rel.columns)
    want = sorted("|".join(_norm(v) for v in r)
                  for r in duck.sql(f"select {', '.join(cols)} from ({E.oracle_sql()[name]})").fetchall())
    df = E.queries()[name](spark, SF_SMALL)
    assert sorted(df.columns) == cols
    got = sorted("|".join(_norm(v) for v in r) for r in df.select(*cols).collect())
    assert got == want
