"""Registered queries against their SQL.  ``ORACLE=all`` runs every one of them."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SAMPLE = (
    "flt1_validate flt4_dedupe_latest join4_dense_grid join7_reconcile agg5_complete_day_long agg7_rollup_weekly "
    "agg18_summary_stats agg19_histogram agg28_seasonal agg41_boxplot agg43_focus_correlations win5_past_average "
    "win9_tertiles top6_even_hours plan2_outstanding qa7_stage_counts stat4_kruskal stat12_ols_hc3 stat14_holm "
    "src3_explode_hourly str1_revision_stream job_dense_daily_fact"
).split()
NAMES = list(entry.oracle_sql()) if os.environ.get("ORACLE") == "all" else SAMPLE


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, duck, name):
    assert compare(entry.queries()[name](spark, FOLDER), duck, entry.oracle_sql()[name]) is None


def test_registry():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and entry.FLAGSHIP in queries
    ids = {name.split("_")[0] for name in queries}
    wanted = (
        {f"flt{i}" for i in range(1, 15)} | {f"join{i}" for i in range(1, 10)} | {f"agg{i}" for i in range(1, 49)}
        | {f"win{i}" for i in range(1, 10)} | {f"top{i}" for i in range(1, 7)} | {f"set{i}" for i in range(1, 6)}
        | {f"fn{i}" for i in range(1, 14)} | {f"stat{i}" for i in range(1, 16)} | {f"ml{i}" for i in range(1, 13)}
        | {f"qa{i}" for i in range(1, 9)} | {f"job{i}" for i in range(1, 5)} | {f"plan{i}" for i in range(1, 7)}
        | {f"src{i}" for i in range(1, 8)} | {f"snk{i}" for i in range(1, 6)} | {"str1", "str2"}
    )
    assert wanted <= ids, sorted(wanted - ids)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "daily_value" in df.columns
