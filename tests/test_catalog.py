"""Registered queries: importable without a session, checked, and right on the small data."""

import glob
import os
import subprocess
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SMALL = "/root/testdata/sf0.001"

SAMPLE = [
    "turnover", "fx_join_long", "fx_join_wide", "ref_scan", "hist_scan", "hist_adjust", "level_percentages", "bars_from_ticks", "fut_ticker",
    "active_futures", "active_cdx", "json_query_result", "flatten_tree", "session_filter", "trading_calendar", "normalize_universe", "rsi",
    "macd", "ptps", "hurst", "bond_info", "topic_states", "live_bars", "bar_cache", "fill_forward", "option_chain_atm",
]


def test_loads_without_a_session():
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the sample tables")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_its_sql(spark, name):
    import check
    import __spark_entry__ as entry

    db = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = entry.queries()[name](spark, SMALL)
    cur = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert check.rows_of(df.collect(), df.columns) == check.rows_of(cur.fetchall(), names)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the sample tables")
def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["ticker", "date", "field", "value"] and df.count() > 0
