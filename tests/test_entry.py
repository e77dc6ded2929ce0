"""Driver contract: entry runs, every query has an oracle, and a sample of
queries matches its oracle on the smallest tables."""

import os
import subprocess
import sys

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["service_date", "time_slot", "traffic_count"]
    assert df.count() > 0


def test_every_core_query_has_oracle():
    assert set(E.QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", ["quality_report", "station_top10", "line_flow_daily_with_total",
                                  "paytype_distribution", "inout_minute_station", "ingest_profile"])
def test_matches_oracle_small(spark, name):
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{SF_SMALL}/events.parquet')")
    rel = con.sql(E.oracle_sql()[name])
    want = sorted(tuple(str(v) for v in r) for r in rel.fetchall())
    df = E.queries()[name](spark, SF_SMALL).select(*rel.columns)
    got = sorted(tuple(str(v) for v in r) for r in df.collect())
    assert got == want


@pytest.mark.parametrize("module", ["gateflow.llm", "ahocorasick", "corpus_pipeline"])
def test_core_queries_stay_without_a_module(module):
    code = (f"import sys; sys.modules['{module}'] = None; import __spark_entry__ as E; "
            "print(len(E.queries()), len(E.QUERIES), len(E.oracle_sql()))")
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=here, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    n, core, sql = map(int, done.stdout.split())
    assert n == core == sql and "pipeline operators left out" in done.stderr
