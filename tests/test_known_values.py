"""Small cases worked out by hand."""

import random
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fieldgauge.functions import scalars as fn
from fieldgauge.operators import (
    coverage, daily, filters, joins, models, planning, quality, ranks, regression, reshape,
    selection, summaries, windows,
)
from fieldgauge.plans import spec

UTC = timezone.utc


def at(y, m, d, h=0):
    return datetime(y, m, d, h, tzinfo=UTC)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


READING = (
    "location_id string, timestamp timestamp, temperature_2m double, precipitation double, "
    "wind_speed_10m double, relative_humidity_2m double, source_year int, ingested_at timestamp"
)


def reading(site="a", ts=None, t=20.0, rain=1.0, wind=2.0, humidity=50.0):
    return (site, ts or at(2024, 1, 1), t, rain, wind, humidity, 2024, at(2025, 1, 1))


def test_bands_and_seasons(spark):
    heights = spark.createDataFrame([(h,) for h in (0.0, 199.9, 200.0, 999.9, 1000.0, 2999.9, 3000.0, None)], "h double")
    got = [r[0] for r in heights.select(fn.elevation_band("h")).collect()]
    assert got == ["lowland"] * 2 + ["midland"] * 2 + ["highland"] * 2 + ["alpine"] * 2
    cases = spark.createDataFrame([(1, 10.0), (1, -10.0), (7, 10.0), (7, -10.0), (7, 0.0)], "m int, lat double")
    assert [r[0] for r in cases.select(fn.local_season("m", "lat")).collect()] == [
        "winter", "summer", "summer", "winter", "summer",
    ]


def test_validation_rejects_null_nan_and_infinity(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame(
        [reading(), reading(), reading(t=200.0), reading(rain=nan), reading(wind=inf),
         reading(humidity=None), reading(site=None)], READING)
    kept = filters.dedupe_any(filters.validate(df), ["location_id", "timestamp"])
    assert kept.count() == 1
    with pytest.raises(ValueError, match="precipitation"):
        filters.validate(df.drop("precipitation"))


SITES = (
    "location_id string, name string, country string, region string, latitude double, "
    "longitude double, elevation_m double"
)


def test_daily_rolling_yearly_summary(spark):
    values = [(at(2024, 1, 1, 0), 20.0), (at(2024, 1, 1, 1), 22.0), (at(2024, 1, 31), 10.0),
              (at(2024, 2, 1), 14.0), (at(2025, 1, 1), 18.0)]
    df = spark.createDataFrame([reading(ts=ts, t=t, rain=2.5) for ts, t in values], READING)
    sites = spark.createDataFrame([("a", "A", "LK", "R", 6.9, 79.8, 5.0)], SITES)
    enriched = joins.enrich(df, sites)
    days = windows.rolling_days(daily.daily_metrics(enriched), "daily_avg_temperature_c", output="roll")
    assert rows(days, "date", "daily_avg_temperature_c", "observed_hours", "roll") == [
        (date(2024, 1, 1), 21.0, 2, 21.0), (date(2024, 1, 31), 10.0, 1, 10.0),
        (date(2024, 2, 1), 14.0, 1, 12.0), (date(2025, 1, 1), 18.0, 1, 18.0),
    ]
    yearly = windows.yoy_available(daily.yearly_metrics(enriched), "annual_avg_temperature_c")
    assert rows(yearly, "year", "annual_avg_temperature_c", "yoy_change") == [(2024, 16.5, None), (2025, 18.0, 1.5)]
    summary = daily.pooled_summary(enriched).filter("year = 2024")
    assert rows(summary, "observation_count", "total_precipitation_mm", "avg_temperature_c") == [(4, 10.0, 16.5)]


def test_lapse_rates(spark):
    schema = "season string, elevation_m double, daily_avg_temperature_c double"
    df = spark.createDataFrame(
        [("winter", 0.0, 20.0), ("winter", 1000.0, 14.0), ("winter", 2000.0, 8.0), ("summer", 5.0, 30.0)], schema)
    (row,) = regression.lapse_rates(df).collect()
    assert row.season == "winter" and row.sample_size == 3
    assert row.lapse_rate_c_per_km == pytest.approx(-6) and row.intercept_c == pytest.approx(20)
    assert row.r2 == pytest.approx(1) and row.rmse_c == pytest.approx(0, abs=1e-6)
    empty = regression.lapse_rates(df.filter("season = 'summer'"))
    assert empty.columns[0] == "season" and empty.count() == 0


@pytest.mark.parametrize("slice_hours", [None, 2, 3])
def test_trailing_window(spark, slice_hours):
    data = [("a", at(2024, 1, 1, h), v) for h, v in ((0, 10.0), (1, 20.0), (4, 40.0), (5, 50.0))]
    df = spark.createDataFrame([*data, ("b", at(2024, 1, 1, 1), 100.0)], "location_id string, timestamp timestamp, v double")
    out = windows.past_average(df, "v", 2, output="past", slice_hours=slice_hours)
    assert [r.past for r in out.orderBy("location_id", "timestamp").collect()] == [None, 10.0, None, 40.0, None]
    with pytest.raises(ValueError):
        windows.past_average(df, "v", 0)


def test_past_average_takes_linear_time(spark):
    """A reading in most seconds over five windows; no frame is summed anew for each row."""
    deal = random.Random(4)
    rows = [("a", t, None if t % 7 == 0 else deal.random()) for t in range(-9000, 9000) if t % 5 and not 2000 < t < 7000]
    df = spark.createDataFrame(rows, "location_id string, t long, v double").withColumn("timestamp", F.timestamp_seconds("t"))
    out = windows.past_average(df, "v", 1, output="past")
    frames = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line]
    assert frames and all("-3600" not in line for line in frames), frames
    got = {r.t: r.past for r in out.collect()}
    assert set(got) == {t for _, t, _ in rows}
    known = {t: v for _, t, v in rows if v is not None}
    for t in [*deal.sample(sorted(got), 200), -9000 + 1, 1999, 7001]:
        inside = [known[s] for s in range(t - 3600, t) if s in known]
        assert got[t] == (pytest.approx(sum(inside) / len(inside)) if inside else None), t


def test_purged_split(spark):
    df = spark.createDataFrame([(at(2024, 1, 1, h),) for h in (0, 1, 2, 3, 4, 5)], "timestamp timestamp")
    # horizon of one hour: hour 3 would reach the first cutoff, hour 4 the second
    parts = models.chronological_split(df, datetime(2024, 1, 1, 4), datetime(2024, 1, 1, 5), 1)
    assert [p.count() for p in parts] == [3, 0, 1]
    with pytest.raises(ValueError):
        models.chronological_split(df, datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 4))


def hours_frame(spark):
    first = [("a", at(2024, 1, 1) + timedelta(hours=i), 20.0 if i < 24 else 30.0, 2.0) for i in range(47)]
    last = [("a", at(2024, 1, 4) + timedelta(hours=i), 25.0, 1.0) for i in range(24)]
    return spark.createDataFrame(first + last, "location_id string, timestamp timestamp, temperature_2m double, precipitation double")


def test_complete_day(spark):
    days = daily.complete_day(hours_frame(spark), {"temperature_2m": "mean", "precipitation": "sum"})
    assert rows(days, "date", "temperature_2m", "precipitation", "temperature_2m_hours") == [
        (date(2024, 1, 1), 20.0, 48.0, 24), (date(2024, 1, 2), None, None, 23), (date(2024, 1, 4), 25.0, 24.0, 24),
    ]


def test_period_rollup(spark):
    full = spark.createDataFrame(
        [("a", date(2024, 1, d), v, 24) for d, v in ((1, 48.0), (2, 24.0), (3, 48.0), (4, 48.0))],
        "location_id string, date date, value double, hours bigint")
    run = lambda df, how: rows(
        daily.rollup_period(df, "value", "monthly", how, date(2024, 1, 1), date(2024, 1, 4)), "value", "hours")
    assert run(full, "sum") == [(168.0, 96)]
    assert run(full, "mean") == [(42.0, 96)] and run(full, "min") == [(24.0, 96)] and run(full, "max") == [(48.0, 96)]
    assert run(full.filter("date <> '2024-01-02'"), "sum") == [(None, 72)]
    with pytest.raises(ValueError):
        daily.check_period_request("monthly", "sum", False, date(2024, 1, 1), date(2024, 1, 4), None, 1)
    with pytest.raises(ValueError):
        daily.check_period_request("daily", "mean", True, date(2024, 1, 1), date(2024, 6, 4), None, 1)
    ask = lambda **more: daily.answer_period_request(
        full, "value", "monthly", "sum", date(2024, 1, 1), date(2024, 1, 4), known=full.select("location_id"), **more)
    assert rows(ask(chosen=["a"]), "value") == [(168.0,)]
    for wrong in (dict(chosen=["a", "unknown"]), dict(chosen=[]), dict(chosen=["a"], coverage=(date(2024, 1, 2), date(2024, 1, 4))),
                  dict(chosen=["a"], additive=False), dict(chosen=[str(i) for i in range(101)])):
        with pytest.raises(ValueError):
            ask(**wrong)


def test_summary_card_and_timeline(spark):
    df = spark.createDataFrame(
        [("a", 0, date(2024, 1, 31), 2.0), ("a", 0, date(2024, 2, 1), 4.0), ("a", 0, date(2024, 2, 2), None)],
        "location_id string, band int, date date, value double")
    card = summaries.summary_stats(df, "value").first()
    assert (card["count"], card["mean"], card["median"], card["variance"]) == (2, 3.0, 3.0, 1.0)
    line = summaries.class_timeline(df)
    assert rows(line.filter("period = 'weekly'"), "bucket", "mean", "count") == [(date(2024, 1, 29), 3.0, 2)]
    assert [r[0].month for r in rows(line.filter("period = 'monthly'"), "bucket")] == [1, 2]
    empty = summaries.summary_stats(df.filter("value > 9"), "value").first()
    assert empty["count"] == 0 and empty["mean"] is None and empty["median"] is None


def test_elevation_classes(spark):
    sites = spark.createDataFrame([("a", 0.0), ("b", 800.0), ("c", 4000.0)], "location_id string, elevation_m double")
    assert rows(summaries.with_class(sites), "location_id", "band") == [("a", 0), ("b", 1), ("c", 4)]
    flat = summaries.with_class(sites.filter("location_id = 'a'"))
    assert rows(flat, "band") == [(0,)]


def test_downsampling_keeps_mean_daily_total(spark):
    start, end = date(2020, 1, 1), date(2025, 12, 31)
    days = spark.range(2192).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date")).withColumn(
        "location_id", F.explode(F.array(*[F.lit(str(i)) for i in range(10)]))).withColumn("rain", F.lit(2.0))
    out = daily.downsample(days, ["rain"], 4, start, end)
    assert out.count() == 5480 and rows(out.select("rain").distinct(), "rain") == [(2.0,)]


def test_downsampling_takes_any_number_of_sites(spark):
    start = date(2024, 1, 1)
    days = spark.range(20000).select(
        (F.col("id") % 10000).cast("string").alias("location_id"),
        F.date_add(F.lit(start), (F.col("id") / 10000).cast("int")).alias("date"), F.lit(1.0).alias("rain"))
    out = daily.downsample(days, ["rain"], 2, start, date(2024, 1, 2))
    assert out.count() == 10000 and daily.at_grain(days, ["rain"], "month").count() == 10000
    with pytest.raises(ValueError):
        daily.downsample(days, ["rain"], 0, start, start)


def test_strict_long_completeness(spark):
    def hours(site, metric, value, n=24):
        return [(site, at(2024, 1, 1, i), date(2024, 1, 1), metric, value) for i in range(n)]

    data = hours("a", "temperature_2m", 2.0) + hours("a", "precipitation", 2.0) + hours("b", "precipitation", 2.0, 23)
    data += hours("c", "temperature_2m", 2.0, 23) + [("c", at(2024, 1, 1, 23), date(2024, 1, 1), "temperature_2m", None)]
    df = spark.createDataFrame(data, "location_id string, timestamp timestamp, date date, metric string, value double")
    out = daily.complete_day_long(df)
    assert rows(out, "location_id", "metric", "daily_value", "valid_hours") == [
        ("a", "precipitation", 48.0, 24), ("a", "temperature_2m", 2.0, 24),
        ("b", "precipitation", None, 23), ("c", "temperature_2m", None, 23),
    ]


def test_dense_grid_rolling_and_leap_year(spark):
    sites = spark.createDataFrame([("a",), ("b",)], "location_id string")
    seen = spark.createDataFrame(
        [("a", date(2024, 1, 1), "m0", 24, 24, True, 18.0), ("a", date(2024, 1, 2), "m0", 24, 24, True, 22.0)],
        "location_id string, date date, metric string, observed_hours bigint, valid_hours bigint, is_complete boolean, daily_value double")
    catalogue = [(f"m{i}", "u", "mean") for i in range(12)]
    fact = joins.densify(sites, F.lit(date(2024, 1, 1)), F.lit(date(2024, 1, 3)), catalogue, seen)
    assert fact.count() == 72
    status = coverage.coverage_daily(fact).filter("location_id = 'b' and metric = 'm1'")
    assert rows(status, "missing_hours", "coverage_status") == [(24, "missing")] * 3
    assert quality.grid_size(fact, sites, 3, 12).count() == 0
    assert quality.completeness_invariants(fact).count() == 0
    roll = windows.rolling_complete(fact.filter("location_id = 'a' and metric = 'm0'")).filter("date = '2024-01-02'")
    assert rows(roll, "window_complete_days", "available_day_mean", "complete_mean") == [(2, 20.0, None)]
    year = coverage.yearly(fact).filter("location_id = 'a' and metric = 'm0'")
    assert rows(year, "calendar_days", "is_complete_year") == [(366, False)]
    djf = coverage.seasonal(fact).filter("location_id = 'a' and metric = 'm0'")
    assert rows(djf, "season", "season_year", "calendar_days", "is_complete_season") == [("DJF", 2024, 91, False)]


def test_boxplot(spark):
    schema = "location_id string, elevation_m double, mean double, count bigint"
    df = spark.createDataFrame([(str(i), 10.0, v, 1) for i, v in enumerate((0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 100.0))], schema)
    box = summaries.boxplot(df).filter("band = 0").first()
    assert (box.q1, box["median"], box.q3, box.low, box.high, box.points) == (1.5, 3.0, 4.5, 0.0, 5.0, 7)
    nan = float("nan")
    edge = spark.createDataFrame(
        [("a", 499.0, 1.0, 1), ("b", 500.0, 1.0, 1), ("c", 1499.0, 1.0, 1), ("d", 1500.0, 1.0, 1),
         ("e", 10.0, nan, 1), ("f", nan, 1.0, 1), ("g", 10.0, 1.0, 0)], schema)
    assert rows(summaries.boxplot(edge), "band", "points") == [(0, 1), (1, 2), (2, 1)]


def test_iso_weeks(spark):
    df = spark.createDataFrame([(date(2021, 1, 1),), (date(2024, 3, 3),)], "d date")
    assert rows(df, fn.iso_week("d"), fn.from_iso_week(fn.iso_week("d"))) == [
        ("2020-W53", date(2020, 12, 28)), ("2024-W09", date(2024, 2, 26)),
    ]


def test_neighbours_match_all_pairs(spark):
    import math
    import random

    rng = random.Random(7)
    points = [(f"s{i:03d}", rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(150)]
    points += [("p1", 89.9, 10.0), ("p2", 89.9, -170.0), ("w1", 0.0, 179.9), ("w2", 0.5, -179.9), ("n1", 10.0, 10.0), ("n2", 10.0, 10.5)]
    df = spark.createDataFrame(points, "location_id string, latitude double, longitude double")

    def km(a, b):
        la, lb = math.radians(a[1]), math.radians(b[1])
        h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return 12742 * math.asin(math.sqrt(min(1, h)))

    for limit in (250.0, 2000.0):
        want = sorted((a[0], b[0]) for a in points for b in points if a[0] < b[0] and km(a, b) <= limit)
        assert rows(joins.neighbours(df, limit), "site_a", "site_b") == want


def test_many_to_one_guard(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    ok = spark.createDataFrame([("a", 5), ("b", 6)], "k string, w int")
    assert rows(joins.join_many_to_one(left, ok, ["k"]), "k", "v", "w") == [("a", 1, 5), ("b", 2, 6)]
    with pytest.raises(PySparkException, match="unmatched"):
        joins.join_many_to_one(left, ok.filter("k = 'a'"), ["k"]).collect()
    with pytest.raises(PySparkException, match="repeats"):
        joins.join_many_to_one(left, ok.union(ok), ["k"]).select("v").collect()


def test_bounded_result(spark):
    df = spark.range(20)
    assert selection.bounded(df, ["id"], 20).count() == 20
    with pytest.raises(PySparkException, match="exceeds 19"):
        selection.bounded(df, ["id"], 19).collect()


def test_matrix_refuses_repeated_cell(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, 6.0)], "y int, m int, v double")
    assert rows(reshape.to_matrix(df, ["y"], "m", [1, 2], "v"), "1", "2") == [(5.0, 6.0)]
    with pytest.raises(PySparkException, match="more than once"):
        reshape.to_matrix(df.union(df), ["y"], "m", [1, 2], "v").collect()


def test_plan_sizes_and_sweep(spark):
    sites = spark.range(100).select(F.col("id").cast("string").alias("location_id"))
    plan = planning.expected_chunks(sites, date(2020, 1, 1), date(2025, 12, 31))
    total = plan.agg(F.sum("hours"), F.count("*")).first()
    assert tuple(total) == (5_260_800, 600)
    two = sites.limit(2)
    sweep = planning.outstanding(two, date(2023, 12, 28), date(2024, 1, 8))
    windows_seen = rows(sweep.select("window_start", "window_end").distinct(), "window_start", "window_end")
    assert windows_seen == [
        (date(2023, 12, 28), date(2023, 12, 31)), (date(2024, 1, 1), date(2024, 1, 1)), (date(2024, 1, 2), date(2024, 1, 8)),
    ]
    assert sweep.agg(F.sum("hours")).first()[0] == 2 * 12 * 24
    assert sweep.first().window_start == date(2024, 1, 2)
    held = spark.createDataFrame([("0", date(2024, 1, 4), date(2024, 1, 5))], "location_id string, start date, end date")
    left = planning.outstanding(two, date(2024, 1, 2), date(2024, 1, 8), held).filter("location_id = '0'")
    assert rows(left, "start", "end", "hours") == [
        (date(2024, 1, 2), date(2024, 1, 3), 48), (date(2024, 1, 6), date(2024, 1, 8), 72)]


def test_hour_gaps(spark):
    hours = [at(2024, 1, 1, h) for h in range(24) if h != 5] + [at(2024, 1, 1, 7)]
    df = spark.createDataFrame([("a", h) for h in hours], "location_id string, timestamp timestamp")
    chunks = spark.createDataFrame([("a", date(2024, 1, 1), date(2024, 1, 1))], "location_id string, start date, end date")
    assert rows(planning.hour_gaps(df, chunks), F.hour("timestamp"), "n", "problem") == [(5, 0, "missing"), (7, 2, "repeated")]


SPEC = {"source": "enriched_weather", "group_by": ["location_id"], "aggregations": {"temperature_2m": ["avg", "count"]}}


@pytest.mark.parametrize("change", [
    {"source": "x"}, {"group_by": []}, {"group_by": ["name"]}, {"aggregations": {}},
    {"aggregations": {"temperature_2m": ["median"]}}, {"filters": {"year": [True]}},
    {"filters": {"date": ["2024-01-02", "2024-01-01"]}}, {"filters": {"season": ["dry"]}}, {"extra": 1},
])
def test_invalid_specs(change):
    with pytest.raises(ValueError):
        spec.check_spec({**SPEC, **change})


def test_result_key_ignores_name_and_order():
    a = spec.result_key({**SPEC, "name": "x"}, "v1", "f")
    b = spec.result_key({**SPEC, "name": "y", "aggregations": {"temperature_2m": ["count", "avg", "avg"]}}, "v1", "f")
    assert a == b != spec.result_key(SPEC, "v2", "f")


def test_question_rules():
    data = spec.Dataset({"precipitation": "sum", "temperature_2m": "mean"}, date(2024, 1, 1), date(2024, 12, 31))
    q = lambda **k: spec.Question(**{**dict(
        metric="temperature_2m", start=date(2024, 1, 1), end=date(2024, 1, 2), locations=("a",), group_by="date",
        operation="mean"), **k})
    spec.check_question(q(), data)
    for bad in (q(metric="x"), q(end=date(2025, 1, 2)), q(locations=()), q(locations=("a", "a")), q(operation="sum"),
                q(metric="precipitation", operation="sum"), q(chart="bar"), q(start=date(2024, 1, 3))):
        with pytest.raises(ValueError):
            spec.check_question(bad, data)


def test_ranks_and_quantiles_against_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    hot = np.round(rng.exponential(3, 4000), 1)  # many ties, one large group
    small = rng.normal(size=17)
    data = [("hot", float(v)) for v in hot] + [("small", float(v)) for v in small] + [("one", 5.0), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double")
    q = {r.g: r for r in ranks.exact_quantiles(df, "v", {"a": 0.1, "m": 0.5, "z": 0.99}, ["g"]).collect()}
    assert set(q) == {"hot", "small", "one"}
    for name, values in (("hot", hot), ("small", small), ("one", np.array([5.0]))):
        assert (q[name].a, q[name].m, q[name].z) == pytest.approx(tuple(np.quantile(values, [0.1, 0.5, 0.99])))
    got = {(r.g, r.v): r.v_rank for r in ranks.avg_rank(df.filter("v is not null"), "v", ["g"]).collect()}
    for v in np.unique(hot):
        assert got["hot", float(v)] == (hot < v).sum() + ((hot == v).sum() + 1) / 2


def test_even_hours_and_folds(spark):
    stamps = [at(2024, 1, 1) + timedelta(hours=i) for i in range(50)]
    df = spark.createDataFrame([(s, t) for t in stamps for s in ("a", "b")], "location_id string, timestamp timestamp")
    kept = selection.even_hours(df, 10)
    assert kept.count() == 20 and kept.agg(F.max("timestamp")).first()[0].replace(tzinfo=UTC) == stamps[-1]
    assert selection.even_hours(df, 400).count() == 100
    folds = models.expanding_folds(df, 4).orderBy("fold").collect()
    assert [f.validation_rows for f in folds] == [20] * 4 and [f.train_rows for f in folds] == [20, 40, 60, 80]
    assert all(f.train_end < f.validation_start for f in folds)


def test_sample_is_stable_under_repartitioning(spark):
    df = spark.range(1000)
    a = rows(selection.sample_n(df, 50, ["id"]), "id")
    assert a == rows(selection.sample_n(df.repartition(7), 50, ["id"]), "id") and len(a) == 50


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 4.0), ("a", 5.0)], "g string, v double")
    box = {r.g: (r.n, r.median) for r in summaries.band_quantiles(df, "v", ["g"]).collect()}
    assert box == {None: (3, 2.0), "a": (1, 5.0)}
    bars = summaries.histogram(df, "v", 4, ["g"]).groupBy("g").agg(F.sum("count").alias("n")).collect()
    assert {r.g: r.n for r in bars} == {None: 3, "a": 1}
    marks = {(r.g, r.v): r.v_rank for r in ranks.avg_rank(df, "v", ["g"]).collect()}
    assert marks == {(None, 1.0): 1.0, (None, 2.0): 2.0, (None, 4.0): 3.0, ("a", 5.0): 1.0}
    assert {r.g: r.median for r in summaries.summary_stats(df, "v", ["g"]).collect()} == {None: 2.0, "a": 5.0}


def test_correlations_of_many_columns(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(4)
    data = pd.DataFrame(rng.normal(1e6, 1, (1000, 46)), columns=[f"c{i}" for i in range(46)])
    data["c1"] = data["c0"] * 2 + data["c1"] * 0.1
    data.loc[rng.random(1000) < 0.2, "c2"] = None
    data["flat"] = 3.1
    got = {(r.x, r.y): r.r for r in summaries.corr_matrix(spark.createDataFrame(data), list(data.columns)).collect()}
    want = data.corr()
    assert len(got) == 47 * 47
    for (x, y), r in got.items():
        if "flat" in (x, y):
            assert r is None
        else:
            assert r == pytest.approx(want.loc[x, y], abs=1e-9)


def test_permuting_a_constant_or_useless_feature_loses_nothing(spark):
    from pyspark.ml.regression import LinearRegression

    from fieldgauge.operators import models

    rows = spark.range(600).select("id", (F.col("id") % 17).cast("double").alias("x"), F.lit(2.0).alias("c"))
    rows = rows.withColumn("y", F.col("x") * 3)
    model = models.assembled(LinearRegression(labelCol="y"), ["x", "c"]).fit(rows)
    copies = models.shuffled_variants(rows, ["x", "c"], ["id"], 2, 1)
    assert copies.count() == 600 * 4
    moved = copies.filter("feature = 'x' AND repeat = 1")
    assert rows_sum(moved, "x") == rows_sum(rows, "x") and moved.filter("x * 3 <> y").count() > 400
    loss = {r.feature: r.importance for r in models.permutation_importance(model, rows, "y", ["x", "c"], ["id"]).collect()}
    assert loss["c"] == pytest.approx(0, abs=1e-9) and loss["x"] > 0.5


@pytest.mark.parametrize("n,repeats", [(600, 5), (64, 5), (63, 5), (130, 40), (7, 5), (3, 5), (1, 5), (0, 2)])
def test_donors_are_the_rows_that_follow(spark, monkeypatch, n, repeats):
    from fieldgauge.operators import models

    monkeypatch.setattr(models, "NEIGHBOURS", 32)
    rows = spark.range(n).select("id", F.col("id").cast("double").alias("x"), F.lit(None).cast("double").alias("none"))
    found = models.with_donors(rows, ["x", "none"], ["id"], repeats, 3)
    got = {r.id: [int(d[0]) for d in r._donors] for r in found.collect()}
    assert len(got) == found.count() == n
    order = [r.id for r in rows.orderBy(F.xxhash64(F.lit(3), "id"), "id").collect()]
    for i, row in enumerate(order):
        assert got[row] == [order[(i + k) % n] for k in range(1, min(repeats, n - 1) + 1)], (i, row)
    variants = models.shuffled_variants(rows, ["x", "none"], ["id"], repeats, 3)
    assert variants.count() == n * 2 * repeats
    for repeat in (1, repeats):
        one = variants.filter((F.col("feature") == "x") & (F.col("repeat") == repeat))
        assert sorted(r.x for r in one.collect()) == [float(i) for i in range(n)]


def test_variants_are_not_shuffled(spark):
    from fieldgauge.operators import models

    rows = spark.range(100).select("id", F.col("id").cast("double").alias("x"))
    for repeats in (1, 50):
        plan = models.shuffled_variants(rows, ["x"], ["id"], repeats, 1)._jdf.queryExecution().executedPlan().toString()
        above = plan[: plan.index("Window")]
        assert plan.count("Exchange") == plan[plan.index("Window"):].count("Exchange") and "Generate" in above


def rows_sum(df, column):
    return df.agg(F.sum(column)).first()[0]
