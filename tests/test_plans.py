"""Physical plans: what reaches the scan, what is shuffled, what stays in the JVM."""

import re
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fieldgauge.operators import daily, filters, joins, ranks, windows
from fieldgauge.queries.bindings import Tables
from fieldgauge.queries.basics import s_fact

FOLDER = "/root/testdata/sf0.001"
PACKAGE = Path(__file__).resolve().parents[1] / "fieldgauge"


@pytest.fixture
def t(spark):
    return Tables(spark, FOLDER)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_day_range_and_columns_reach_the_scan(t):
    raw = t("orders").select(F.col("o_orderdate").cast("timestamp").alias("timestamp"), "o_totalprice", "o_orderstatus")
    text = plan(filters.apply_filters(t("events"), {"event_type": ["click", "view"]}).groupBy("user_id").agg(F.avg("value")))
    assert "PushedFilters: [In(event_type, [click,view])]" in text
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in text
    assert "o_orderstatus" not in plan(raw.select("timestamp").agg(F.max("timestamp"))).split("ReadSchema")[1]


def test_day_range_is_pushed_on_a_timestamp_column(spark, tmp_path):
    path = str(tmp_path / "hours")
    spark.range(10).select(F.timestamp_seconds("id").alias("timestamp"), "id").write.parquet(path)
    text = plan(filters.between_days(spark.read.parquet(path), date(1970, 1, 1), date(1970, 1, 2)))
    assert "GreaterThanOrEqual(timestamp" in text and "LessThan(timestamp" in text


def test_latest_revision_keeps_one_row_per_key_before_the_shuffle(t):
    text = plan(filters.dedupe_latest(t.u, ["location_id", "hour"], ["ingested_at", "event_id"]))
    partial = text.index("Partial")
    assert "WindowGroupLimit" in text and text.index("Exchange") < partial  # below the exchange


def test_daily_and_rolling_share_the_site_exchange(t):
    days = windows.rolling_days(daily.complete_day(t.s, {"reading": "mean"}), "reading")
    # hourly aggregation, daily aggregation, window by site
    assert plan(days).count("Exchange hashpartitioning") <= 3


def test_grid_needs_no_cross_join(t):
    text = plan(s_fact(t))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Generate explode" in text


def test_neighbours_is_an_equi_join(t):
    text = plan(joins.neighbours(t.w_sites))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_ranks_do_not_gather_a_group(t):
    text = plan(ranks.avg_rank(t.w.select("price"), "price"))
    # only the slice totals are numbered in one place
    for line in text.splitlines():
        if "Exchange SinglePartition" in line:
            assert "ENSURE_REQUIREMENTS" in line
    keys = re.findall(r"Window \[.*?\], \[(_slice[^\]]*)\]", text)
    assert any(k.startswith("_slice") for k in keys)


def test_core_operators_stay_in_the_jvm(t):
    for df in (s_fact(t), windows.past_average(t.u, "precipitation"), joins.enrich(t.u, t.u_sites)):
        assert "Python" not in plan(df) and "Arrow" not in plan(df)


def test_library_rules():
    source = {p: p.read_text() for p in PACKAGE.rglob("*.py")}
    for path, text in source.items():
        assert "localCheckpoint" not in text and ".crossJoin(" not in text and ".toPandas(" not in text, path
        assert "F.udf(" not in text and "@udf" not in text, path
    # forced broadcasts: a one-row result, and sides whose rows a parameter bounds
    forced = [(p.name, line.strip()) for p, text in source.items() for line in text.splitlines() if "F.broadcast(" in line]
    assert {name for name, _ in forced} <= {"regression.py", "ranking.py", "syncmers.py"}, forced
