"""Filters, joins and scalar functions on the test tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from fieldgauge.functions import scalars as fn
from fieldgauge.operators import daily, filters, joins, planning, quality, reshape
from fieldgauge.queries.bindings import (
    BAND_SQL, MET_SEASON_SQL, S_CATALOGUE, W_METRICS, r, season_sql,
)
from fieldgauge.queries.registry import query

# ------------------------------------------------------------------ filters ----

U_BOUNDS_SQL = (
    "location_id IS NOT NULL AND timestamp IS NOT NULL AND temperature_2m BETWEEN -100 AND 70 "
    "AND precipitation >= 0 AND wind_speed_10m >= 0 AND relative_humidity_2m BETWEEN 0 AND 100"
)


@query("flt1_validate", f"""
SELECT event_id, location_id, timestamp, {r('temperature_2m')} AS temperature_2m,
       {r('precipitation')} AS precipitation
FROM u WHERE {U_BOUNDS_SQL}""")
def _(t):
    # NaN and infinities next to the NULLs: all must go
    v = F.col("temperature_2m")
    dirty = t.u.withColumn(
        "wind_speed_10m", F.when(v < -15, F.lit(float("nan"))).otherwise(F.col("wind_speed_10m"))
    )
    return filters.validate(dirty).select(
        "event_id", "location_id", "timestamp", "temperature_2m", "precipitation"
    )


@query("flt2_nan_to_null", f"""
SELECT location_id, count(*) AS n_rows, count(value) AS n_values, {r('avg(value)')} AS mean
FROM s_raw GROUP BY 1""")
def _(t):
    v = F.col("value")
    # the same missing values written as NaN, +inf and -inf
    dirty = t("events").select(
        F.col("event_type").alias("location_id"),
        F.when(v >= 5.0, v).when(v >= 3.0, float("nan")).when(v >= 1.0, float("inf"))
        .otherwise(float("-inf")).alias("value"),
    )
    return filters.nan_to_null(dirty, ["value"]).groupBy("location_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_values"), F.avg("value").alias("mean")
    )


@query("flt3_dedupe_any", "SELECT DISTINCT location_id, hour FROM u")
def _(t):
    return filters.dedupe_any(t.u, ["location_id", "hour"]).select("location_id", "hour")


@query("flt4_dedupe_latest", f"""
SELECT location_id, hour, event_id, {r('temperature_2m')} AS temperature_2m FROM (
  SELECT *, row_number() OVER (PARTITION BY location_id, hour
           ORDER BY ingested_at DESC, event_id DESC) AS n FROM u) WHERE n = 1""")
def _(t):
    return filters.dedupe_latest(t.u, ["location_id", "hour"], ["ingested_at", "event_id"]).select(
        "location_id", "hour", "event_id", "temperature_2m"
    )


@query("flt5_between_days", f"""
SELECT event_id, location_id, timestamp, {r('value')} AS value FROM s_raw
WHERE timestamp >= TIMESTAMP '2024-01-08' AND timestamp < TIMESTAMP '2024-01-15'""")
def _(t):
    return filters.between_days(t.s_raw, date(2024, 1, 8), date(2024, 1, 14)).select(
        "event_id", "location_id", "timestamp", "value"
    )


@query("flt6_apply_filters", f"""
SELECT event_type, CAST(timestamp AS DATE) AS date, {r('temperature_2m')} AS temperature_2m
FROM u WHERE CAST(timestamp AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'
  AND event_type IN ('click', 'view') AND source_year IN (2024)""")
def _(t):
    return filters.apply_filters(
        t.u.withColumn("date", F.to_date("timestamp")),
        {"date": ["2024-01-05", "2024-01-09"], "event_type": ["click", "view"], "source_year": [2024]},
    ).select("event_type", "date", "temperature_2m")


@query("flt7_slice", f"""
SELECT location_id, name, region, {BAND_SQL} AS elevation_band FROM w_sites
WHERE region IN ('ASIA', 'EUROPE') AND {BAND_SQL} IN ('highland', 'alpine')""")
def _(t):
    sites = t.w_sites.withColumn("elevation_band", fn.elevation_band("elevation_m"))
    return filters.slice_rows(
        sites, region=["ASIA", "EUROPE"], elevation_band=["highland", "alpine"], country=[]
    ).select("location_id", "name", "region", "elevation_band")


@query("flt8_drop_leap_day", f"""
SELECT location_id, date, {r('value')} AS value FROM y_daily
WHERE NOT (month(date) = 2 AND day(date) = 29)""")
def _(t):
    return filters.drop_leap_day(t.y_daily).select("location_id", "date", "value")


@query("flt9_complete_cases", f"""
SELECT location_id, count(*) AS n_rows, {r('avg(quantity)')} AS quantity FROM w
WHERE quantity IS NOT NULL AND price IS NOT NULL GROUP BY 1""")
def _(t):
    return filters.complete_cases(t.w, ["quantity", "price"]).groupBy("location_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("quantity").alias("quantity")
    )


W_BOUNDS = {"quantity": (10.0, 45.0), "price": (0.0, 80.0), "discount": (0.0, 0.09), "tax": (0.01, 0.08)}


@query("flt10_screen_ranges", " UNION ALL ".join(
    f"SELECT '{c}' AS variable, CAST({lo} AS DOUBLE) AS lower, CAST({hi} AS DOUBLE) AS upper, "
    f"count(*) FILTER ({c} < {lo} OR {c} > {hi}) AS outside, "
    + r(f"100.0 * count(*) FILTER ({c} < {lo} OR {c} > {hi}) / count(*)") + " AS percent FROM w"
    for c, (lo, hi) in W_BOUNDS.items()))
def _(t):
    return filters.screen_ranges(t.w, W_BOUNDS)


@query("flt11_hour_contract", f"""
, h AS (SELECT location_id, hour AS timestamp, temperature_2m FROM u UNION ALL
        SELECT location_id, timestamp, temperature_2m FROM u)
SELECT location_id, timestamp, {r('temperature_2m')} AS temperature_2m FROM h
WHERE timestamp <> date_trunc('hour', timestamp) OR temperature_2m < -100 OR temperature_2m > 70""")
def _(t):
    both = reshape.union_all(
        t.u.select("location_id", F.col("hour").alias("timestamp"), "temperature_2m"),
        t.u.select("location_id", "timestamp", "temperature_2m"),
    )
    return filters.hour_contract_violations(both, ranges={"temperature_2m": (-100.0, 70.0)})


@query("flt12_coordinates", f"""
SELECT location_id, {r('latitude * 8')} AS latitude, {r('longitude')} AS longitude FROM w_sites
WHERE latitude * 8 NOT BETWEEN -90 AND 90 OR longitude NOT BETWEEN -180 AND 180""")
def _(t):
    # stretched so that some sites leave the globe
    return filters.coordinate_violations(
        t.w_sites.select("location_id", (F.col("latitude") * 8).alias("latitude"), "longitude")
    )


@query("flt13_count_where", """
SELECT count(*) FILTER (year(date) < 1996 OR year(date) > 2000) AS outside_years,
       count(*) FILTER (value > 400) AS extreme_values,
       count(*) FILTER (value < 0) AS negative_values FROM y""")
def _(t):
    year = F.year("date")
    return filters.count_where(
        t.y,
        {"outside_years": (year < 1996) | (year > 2000), "extreme_values": F.col("value") > 400,
         "negative_values": F.col("value") < 0},
    )


@query("flt14_latest_days", f"""
SELECT location_id, CAST(timestamp AS DATE) AS date, count(*) AS n_rows, {r('sum(value)')} AS total
FROM s_raw WHERE CAST(timestamp AS DATE) >= (SELECT CAST(max(timestamp) AS DATE) - 6 FROM s_raw)
GROUP BY 1, 2""")
def _(t):
    return filters.latest_days(t.s_raw, 7).groupBy("location_id", F.to_date("timestamp").alias("date")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("total")
    )


# -------------------------------------------------------------------- joins ----

ENRICHED_SQL = f"""
, e AS (SELECT u.*, name, country, region, latitude, longitude, elevation_m,
               {BAND_SQL} AS elevation_band, CAST(timestamp AS DATE) AS date,
               year(timestamp) AS year, {season_sql()} AS season
        FROM u JOIN u_sites USING (location_id))"""


@query("join1_enrich", ENRICHED_SQL + f"""
SELECT event_id, location_id, name, country, region, {r('latitude')} AS latitude,
       {r('elevation_m')} AS elevation_m, elevation_band, date, year, season FROM e""")
def _(t):
    return joins.enrich(t.u, t.u_sites).select(
        "event_id", "location_id", "name", "country", "region", "latitude", "elevation_m",
        "elevation_band", "date", "year", "season",
    )


@query("join2_enrich_left", f"""
, north AS (SELECT * FROM u_sites WHERE latitude >= 0)
SELECT event_id, u.location_id, name, region, {r('elevation_m')} AS elevation_m,
       CAST(timestamp AS DATE) AS date
FROM u LEFT JOIN north ON u.location_id = north.location_id""")
def _(t):
    return joins.enrich_left(t.u, t.u_sites.filter("latitude >= 0")).select(
        "event_id", "location_id", "name", "region", "elevation_m", "date"
    )


@query("join3_many_to_one", f"""
SELECT location_id, country, count(*) AS n_rows, {r('avg(quantity)')} AS quantity
FROM w JOIN w_sites USING (location_id) GROUP BY 1, 2""")
def _(t):
    return joins.join_many_to_one(t.w, t.w_sites, ["location_id"]).groupBy("location_id", "country").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("quantity").alias("quantity")
    )


@query("join3_join_report", """
, known AS (SELECT * FROM w_sites WHERE latitude >= 0 UNION ALL SELECT * FROM w_sites WHERE latitude > 9)
SELECT (SELECT count(*) FROM w) AS left_rows,
       CAST((SELECT count(*) FROM w LEFT JOIN known USING (location_id)) AS BIGINT) AS output_rows,
       (SELECT count(*) FROM w ANTI JOIN known USING (location_id)) AS unmatched_rows,
       (SELECT count(*) FROM (SELECT location_id FROM known GROUP BY 1 HAVING count(*) > 1)) AS repeated_keys""")
def _(t):
    known = t.w_sites.filter("latitude >= 0").unionByName(t.w_sites.filter("latitude > 9"))
    return joins.join_report(t.w, known, ["location_id"])


def s_long(t):
    return reshape.to_long(t.s, ["location_id", "timestamp"], ["reading", "volume"]).withColumn(
        "date", F.to_date("timestamp")
    )


def s_days(t):
    return daily.complete_day_long(s_long(t), sums=["volume"])


def s_bounds(t):
    ends = t.s_raw.agg(
        F.struct(F.to_date(F.min("timestamp")).alias("a"), F.to_date(F.max("timestamp")).alias("b"))
    ).scalar()
    return ends["a"], ends["b"]


def s_fact(t):
    start, end = s_bounds(t)
    return joins.densify(t.s_sites, start, end, S_CATALOGUE, s_days(t))


S_LONG_SQL = """
, s_long AS (
  SELECT location_id, timestamp, CAST(timestamp AS DATE) AS date, 'reading' AS metric, reading AS value FROM s
  UNION ALL SELECT location_id, timestamp, CAST(timestamp AS DATE), 'volume', volume FROM s
), s_days AS (
  SELECT location_id, date, metric, count(*) AS observed_hours, count(value) AS valid_hours,
         count(*) = 24 AND count(DISTINCT timestamp) = 24 AND count(value) = 24 AS is_complete,
         CASE WHEN count(*) = 24 AND count(DISTINCT timestamp) = 24 AND count(value) = 24
              THEN CASE WHEN metric = 'volume' THEN sum(value) ELSE avg(value) END END AS daily_value
  FROM s_long GROUP BY 1, 2, 3
)"""

S_FACT_SQL = S_LONG_SQL + f"""
, bounds AS (SELECT CAST(min(timestamp) AS DATE) AS a, CAST(max(timestamp) AS DATE) AS b FROM s_raw)
, s_metrics AS (SELECT * FROM (VALUES ('reading', 'units', 'mean'), ('volume', 'units/day', 'sum'))
                v(metric, unit, daily_aggregation))
, s_fact AS (
  SELECT g.location_id, g.date, g.metric, g.unit, g.daily_aggregation, o.daily_value,
         coalesce(o.observed_hours, 0) AS observed_hours, coalesce(o.valid_hours, 0) AS valid_hours,
         coalesce(o.is_complete, false) AS is_complete, year(g.date) AS calendar_year,
         {MET_SEASON_SQL.replace('date', 'g.date')} AS season,
         year(g.date) + CASE WHEN month(g.date) = 12 THEN 1 ELSE 0 END AS season_year
  FROM (SELECT location_id, CAST(d AS DATE) AS date, metric, unit, daily_aggregation
        FROM s_sites CROSS JOIN bounds, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS x(d), s_metrics) g
  LEFT JOIN s_days o ON o.location_id = g.location_id AND o.date = g.date AND o.metric = g.metric
)"""


@query("join4_dense_grid", S_FACT_SQL + f"""
SELECT location_id, date, metric, unit, daily_aggregation, {r('daily_value')} AS daily_value,
       observed_hours, valid_hours, is_complete, calendar_year, season, season_year FROM s_fact""")
def _(t):
    return s_fact(t)


# y_global on its dense calendar: a day without an order is missing
def y_fact(t):
    days = t.y_global.select(
        "location_id", "date", F.lit("value").alias("metric"), F.col("value").alias("daily_value"),
        F.col("observed").alias("observed_hours"), F.col("observed").alias("valid_hours"),
        F.lit(True).alias("is_complete"),
    )
    ends = t("orders").agg(
        F.struct(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    ).scalar()
    site = t("orders").select(F.lit("all").alias("location_id")).distinct()
    return joins.densify(site, ends["a"], ends["b"], [("value", "thousand", "sum")], days)


Y_FACT_SQL = f"""
, y_bounds AS (SELECT min(date) AS a, max(date) AS b FROM y_global)
, y_fact AS (
  SELECT 'all' AS location_id, d.date, 'value' AS metric, 'thousand' AS unit,
         'sum' AS daily_aggregation, o.value AS daily_value,
         coalesce(o.observed, 0) AS observed_hours, coalesce(o.observed, 0) AS valid_hours,
         o.value IS NOT NULL AS is_complete, year(d.date) AS calendar_year,
         {MET_SEASON_SQL.replace('date', 'd.date')} AS season,
         year(d.date) + CASE WHEN month(d.date) = 12 THEN 1 ELSE 0 END AS season_year
  FROM (SELECT CAST(x AS DATE) AS date FROM y_bounds, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS s(x)) d
  LEFT JOIN y_global o ON o.date = d.date
), y_year AS (
  SELECT location_id, metric, unit, calendar_year, count(*) AS requested_days,
         count(daily_value) AS complete_days,
         date_diff('day', make_date(calendar_year, 1, 1), make_date(calendar_year + 1, 1, 1)) AS calendar_days,
         avg(daily_value) AS available_day_mean, sum(daily_value) AS available_total
  FROM y_fact GROUP BY ALL
), y_years AS (
  SELECT *, complete_days = calendar_days AS is_complete_year,
         CASE WHEN complete_days = calendar_days THEN available_day_mean END AS annual_mean FROM y_year
)"""


@query("join5_change_vs_previous", Y_FACT_SQL + f"""
SELECT c.calendar_year, c.is_complete_year, {r('c.annual_mean')} AS annual_mean,
       {r('''CASE WHEN c.is_complete_year AND p.is_complete_year
            THEN c.annual_mean - p.annual_mean END''')} AS year_over_year_change
FROM y_years c LEFT JOIN y_years p
  ON p.location_id = c.location_id AND p.metric = c.metric AND c.calendar_year = p.calendar_year + 1""")
def _(t):
    from fieldgauge.operators.coverage import yearly

    return joins.change_vs_previous(yearly(y_fact(t)), "annual_mean", ["location_id", "metric"]).select(
        "calendar_year", "is_complete_year", "annual_mean", "year_over_year_change"
    )


@query("join6_orphans", """
SELECT event_id, location_id FROM u WHERE location_id NOT IN (SELECT location_id FROM w_sites)""")
def _(t):
    # users against the supplier table: users without a supplier of that number
    return joins.orphans(t.u, t.w_sites, ["location_id"]).select("event_id", "location_id")


@query("join7_reconcile", """
, a AS (SELECT location_id, CAST(timestamp AS DATE) AS date, count(*) AS n, sum(value) AS total
        FROM s_raw GROUP BY 1, 2)
, b AS (SELECT * FROM a WHERE date < DATE '2024-01-29')
SELECT m.metric, (SELECT count(*) FROM a JOIN b USING (location_id, date)) AS matched,
       (SELECT count(*) FROM a ANTI JOIN b USING (location_id, date)) AS only_left,
       CAST(0 AS BIGINT) AS only_right, CAST(0 AS DOUBLE) AS max_abs_difference,
       (SELECT count(*) FROM a ANTI JOIN b USING (location_id, date)) = 0 AS agrees
FROM (VALUES ('n'), ('total')) m(metric)""")
def _(t):
    day = F.to_date("timestamp").alias("date")
    a = t.s_raw.groupBy("location_id", day).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("value").alias("total")
    )
    # the same totals by way of the hourly table, for a shorter range of days
    counts = t.s_raw.groupBy("location_id", day).agg(F.count(F.lit(1)).cast("double").alias("n"))
    volumes = t.s.groupBy("location_id", day).agg(F.sum("volume").alias("total"))
    b = counts.join(volumes, ["location_id", "date"]).filter(F.col("date") < "2024-01-29")
    out = joins.reconcile(a, b, ["location_id", "date"], ["n", "total"], 1e-6)
    # differences below the tolerance are float noise
    return out.withColumn("max_abs_difference", F.when(F.col("max_abs_difference") < 1e-6, 0.0).otherwise(F.col("max_abs_difference")))


DISTANCE_SQL = (
    "12742 * asin(sqrt(least(1, pow(sin(radians(b.latitude - a.latitude) / 2), 2) + "
    "cos(radians(a.latitude)) * cos(radians(b.latitude)) * "
    "pow(sin(radians(b.longitude - a.longitude) / 2), 2))))"
)


@query("join8_neighbours", f"""
SELECT a.location_id AS site_a, b.location_id AS site_b, {r(DISTANCE_SQL)} AS distance_km
FROM w_sites a JOIN w_sites b ON a.location_id < b.location_id
WHERE {DISTANCE_SQL} <= 250""")
def _(t):
    return joins.neighbours(t.w_sites, 250.0)


Y_MONTH_SQL = """
, y_month AS (SELECT location_id, year(date) AS year, month(date) AS month, avg(value) AS value,
                     count(*) AS n FROM y GROUP BY 1, 2, 3)"""


def y_month(t):
    return t.y.groupBy("location_id", F.year("date").alias("year"), F.month("date").alias("month")).agg(
        F.avg("value").alias("value"), F.count(F.lit(1)).alias("n")
    )


@query("join9_change_from_base", Y_MONTH_SQL + f"""
SELECT m.location_id, m.year, m.month, {r('m.value - b.value')} AS change
FROM y_month m LEFT JOIN y_month b ON b.location_id = m.location_id AND b.year = m.year AND b.month = 1
WHERE m.month <> 1""")
def _(t):
    changes = joins.change_from_base(y_month(t), "value", 1, by=["year"])
    return changes.select("location_id", "year", "month", "change")


# ---------------------------------------------------------------- functions ----

@query("fn1_elevation_band", f"""
SELECT location_id, {r('elevation_m')} AS elevation_m, {BAND_SQL} AS elevation_band FROM w_sites""")
def _(t):
    return t.w_sites.select("location_id", "elevation_m", fn.elevation_band("elevation_m").alias("elevation_band"))


@query("fn2_local_season", f"""
SELECT {season_sql()} AS season, latitude >= 0 AS north, month(timestamp) AS month, count(*) AS n_rows
FROM w_at_sites GROUP BY 1, 2, 3""")
def _(t):
    month = F.month("timestamp")
    return t.w_at_sites.groupBy(
        fn.local_season(month, "latitude").alias("season"),
        (F.col("latitude") >= 0).alias("north"), month.alias("month"),
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@query("fn3_met_season", f"""
SELECT {MET_SEASON_SQL} AS season,
       year(date) + CASE WHEN month(date) = 12 THEN 1 ELSE 0 END AS season_year,
       count(*) AS n_rows, min(date) AS first_date FROM y GROUP BY 1, 2""")
def _(t):
    return t.y.groupBy(fn.met_season("date").alias("season"), fn.season_year("date").alias("season_year")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date")
    )


@query("fn4_monsoon", """
SELECT CASE WHEN month(date) IN (12,1,2) THEN 'northeast_monsoon'
            WHEN month(date) IN (3,4) THEN 'first_intermonsoon'
            WHEN month(date) IN (5,6,7,8,9) THEN 'southwest_monsoon'
            ELSE 'second_intermonsoon' END AS monsoon, count(*) AS n_rows FROM y GROUP BY 1""")
def _(t):
    return t.y.groupBy(fn.monsoon(F.month("date")).alias("monsoon")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("fn5_buckets", """
SELECT event_id, date_trunc('hour', timestamp) AS hour, CAST(timestamp AS DATE) AS day,
       CAST(date_trunc('week', timestamp) AS DATE) AS week,
       CAST(date_trunc('month', timestamp) AS DATE) AS month,
       CAST(date_trunc('year', timestamp) AS DATE) AS year FROM s_raw""")
def _(t):
    return t.s_raw.select("event_id", *[fn.bucket("timestamp", g).alias(g) for g in fn.GRAINS])


@query("fn6_iso_weeks", """
SELECT DISTINCT date, printf('%d-W%02d', isoyear(date), weekofyear(date)) AS iso_week,
       CAST(date_trunc('week', date) AS DATE) AS monday FROM y""")
def _(t):
    week = fn.iso_week("date")
    return t.y.select("date").distinct().select(
        "date", week.alias("iso_week"), fn.from_iso_week(week).alias("monday")
    )


@query("fn6_period_dates", """
, span AS (SELECT location_id, min(date) AS a, max(date) AS b FROM y GROUP BY 1)
SELECT location_id, 'weekly' AS period, CAST(d AS DATE) AS period_start
FROM span, unnest(generate_series(date_trunc('week', a), b, INTERVAL 1 WEEK)) AS x(d)
UNION ALL
SELECT location_id, 'monthly', CAST(d AS DATE)
FROM span, unnest(generate_series(date_trunc('month', a), b, INTERVAL 1 MONTH)) AS x(d)""")
def _(t):
    span = t.y.groupBy("location_id").agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return reshape.union_all(*[
        span.select("location_id", F.lit(p).alias("period"),
                    F.explode(fn.period_dates("a", "b", p)).alias("period_start"))
        for p in ("weekly", "monthly")
    ])


CLASS_SQL = """
, lim AS (SELECT min(elevation_m) AS lo, max(elevation_m) AS hi FROM w_sites)
, cls AS (SELECT location_id, name, elevation_m, CASE WHEN hi >= 3000 THEN 5 ELSE 4 END AS n, lo,
                 CASE WHEN hi > lo THEN hi ELSE lo + CASE WHEN hi >= 3000 THEN 5 ELSE 4 END END AS top
          FROM w_sites, lim)
, w_class AS (SELECT location_id, name, elevation_m,
    CAST(greatest(0, least(n - 1, (SELECT count(*) FROM range(0, 6) k(i)
       WHERE i <= n AND CASE WHEN i = n THEN top ELSE lo + i * ((top - lo) / n) END <= elevation_m) - 1)) AS BIGINT) AS band
  FROM cls)"""


@query("fn7_elevation_class", CLASS_SQL + f"""
SELECT location_id, {r('elevation_m')} AS elevation_m, band FROM w_class""")
def _(t):
    from fieldgauge.operators.summaries import with_class

    return with_class(t.w_sites).select("location_id", "elevation_m", "band")


@query("fn8_digitize", f"""
SELECT location_id, CAST((elevation_m >= 500)::INT + (elevation_m >= 1500)::INT AS BIGINT) AS band FROM w_sites""")
def _(t):
    return t.w_sites.select("location_id", fn.digitize("elevation_m", (500, 1500)).alias("band"))


@query("fn9_cyclic", f"""
SELECT event_id, {r('sin(2 * pi() * month(timestamp) / 12)')} AS month_sin,
       {r('cos(2 * pi() * month(timestamp) / 12)')} AS month_cos,
       {r('sin(2 * pi() * hour(timestamp) / 24)')} AS hour_sin,
       {r('cos(2 * pi() * hour(timestamp) / 24)')} AS hour_cos FROM s_raw""")
def _(t):
    ms, mc = fn.cyclic(F.month("timestamp"), 12)
    hs, hc = fn.cyclic(F.hour("timestamp"), 24)
    return t.s_raw.select(
        "event_id", ms.alias("month_sin"), mc.alias("month_cos"), hs.alias("hour_sin"), hc.alias("hour_cos")
    )


@query("fn10_rescale", f"""
SELECT location_id, {r('avg(quantity) * 24')} AS daily_total, {r('max(elevation_m) / 1000')} AS elevation_km
FROM w_at_sites GROUP BY 1""")
def _(t):
    return t.w_at_sites.groupBy("location_id").agg(
        fn.rescale(F.avg("quantity"), 24).alias("daily_total"),
        fn.rescale(F.max("elevation_m"), 0.001).alias("elevation_km"),
    )


@query("fn11_as_utc", """
SELECT event_id, timestamp AS utc, CAST(floor(epoch(timestamp)) AS BIGINT) AS epoch_second,
       timestamp - INTERVAL 330 MINUTE AS from_colombo FROM s_raw""")
def _(t):
    ts = F.col("ts")
    return t("events").select(
        "event_id", fn.as_utc(ts).alias("utc"), fn.epoch_seconds(ts).alias("epoch_second"),
        fn.as_utc(ts, F.lit("Asia/Colombo")).alias("from_colombo"),
    )


@query("fn12_valid_id", """
SELECT o_orderpriority AS label, regexp_full_match(o_orderpriority, '[A-Za-z0-9][A-Za-z0-9_-]{0,79}') AS is_identifier,
       regexp_full_match(o_orderpriority, '[a-z0-9_]+') AS is_site_id, count(*) AS n_rows
FROM orders GROUP BY 1""")
def _(t):
    c = "o_orderpriority"
    return t("orders").groupBy(F.col(c).alias("label")).agg(F.count(F.lit(1)).alias("n_rows")).select(
        "label", fn.valid_id("label").alias("is_identifier"), fn.valid_site_id("label").alias("is_site_id"), "n_rows"
    )


@query("fn13_safe_div", f"""
SELECT order_id, line, {r('CASE WHEN tax = 0 THEN NULL ELSE discount / tax END')} AS ratio,
       tax <> 0 AS is_finite FROM w""")
def _(t):
    return t.w.select(
        "order_id", F.col("line").alias("line"), fn.safe_div("discount", "tax").alias("ratio"),
        fn.is_finite(fn.safe_div("discount", "tax")).alias("is_finite"),
    )


# --------------------------------------------------------- sets and reshapes ----

@query("set1_union_all", f"""
SELECT location_id, count(*) AS n_rows, {r('sum(value)')} AS total FROM s_raw GROUP BY 1""")
def _(t):
    weeks = [filters.between_days(t.s_raw, date(2024, 1, d), date(2024, 1, min(d + 6, 31))) for d in (1, 8, 15, 22, 29)]
    return reshape.union_all(*weeks).groupBy("location_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("total")
    )


W_LONG_SQL = ", w_long AS (" + " UNION ALL ".join(
    f"SELECT order_id, line, location_id, '{m}' AS metric, {m} AS value FROM w" for m in W_METRICS
) + ")"


@query("set2_to_long", W_LONG_SQL + f"""
SELECT order_id, line, location_id, metric, {r('value')} AS value FROM w_long""")
def _(t):
    return reshape.to_long(t.w, ["order_id", "line", "location_id"], W_METRICS)


@query("set3_to_long_dropped", W_LONG_SQL + f"""
SELECT location_id, metric, count(*) AS n_rows, {r('avg(value)')} AS mean
FROM w_long WHERE value IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return reshape.to_long(t.w, ["location_id"], W_METRICS, drop_missing=True).groupBy(
        "location_id", "metric"
    ).agg(F.count(F.lit(1)).alias("n_rows"), F.avg("value").alias("mean"))


@query("set4_to_matrix", Y_MONTH_SQL + "SELECT location_id, year, " + ", ".join(
    r(f"max(CASE WHEN month = {m} THEN value END)") + f' AS "{m}"' for m in range(1, 13)
) + " FROM y_month GROUP BY 1, 2")
def _(t):
    return reshape.to_matrix(y_month(t), ["location_id", "year"], "month", range(1, 13), "value")


@query("set5_distinct", "SELECT DISTINCT country, region FROM w_sites")
def _(t):
    return reshape.distinct_values(t.w_sites, "country", "region")


# -------------------------------------------------------------------- gates ----

@query("qa1_unique_grain", """
SELECT location_id, hour, count(*) AS row_count FROM u GROUP BY 1, 2 HAVING count(*) > 1""")
def _(t):
    return quality.unique_grain(t.u, ["location_id", "hour"])


@query("qa2_not_null", "SELECT event_id, location_id FROM u WHERE precipitation IS NULL OR location_id IS NULL")
def _(t):
    return quality.not_null(t.u, ["location_id", "precipitation"]).select("event_id", "location_id")


@query("qa3_grid_size", S_FACT_SQL + """
, checks AS (SELECT count(*) AS actual_rows,
    (SELECT count(*) FROM s_sites) * (SELECT date_diff('day', a, b) + 1 FROM bounds) * 2 AS expected_rows FROM s_fact
  UNION ALL SELECT count(*), (SELECT count(*) FROM s_sites) * (SELECT date_diff('day', a, b) + 1 FROM bounds) * 2 FROM s_days)
SELECT actual_rows, CAST(expected_rows AS BIGINT) AS expected_rows FROM checks WHERE actual_rows <> expected_rows""")
def _(t):
    start, end = s_bounds(t)
    days = F.datediff(end, start) + 1
    gates = [quality.grid_size(df, t.s_sites, days, 2) for df in (s_fact(t), s_days(t))]
    return reshape.union_all(*gates).withColumn("expected_rows", F.col("expected_rows").cast("bigint"))


@query("qa4_completeness_invariants", S_FACT_SQL + """
SELECT location_id, date, metric FROM s_fact
WHERE observed_hours NOT BETWEEN 0 AND 24 OR valid_hours NOT BETWEEN 0 AND observed_hours
   OR is_complete <> (observed_hours = 24 AND valid_hours = 24)
   OR is_complete <> (daily_value IS NOT NULL)
UNION ALL
SELECT location_id, date, metric FROM s_fact WHERE is_complete""")
def _(t):
    fact = s_fact(t)
    # the second half plants a fault: complete days whose value was lost
    broken = fact.filter("is_complete").withColumn("daily_value", F.lit(None).cast("double"))
    return reshape.union_all(
        *[quality.completeness_invariants(f).select("location_id", "date", "metric") for f in (fact, broken)]
    )


@query("qa5_full_coverage", S_FACT_SQL + """
SELECT location_id, date, metric, CASE WHEN observed_hours = 0 THEN 'missing' ELSE 'partial' END AS coverage_status
FROM s_fact WHERE NOT is_complete""")
def _(t):
    from fieldgauge.operators.coverage import coverage_daily

    return quality.full_coverage(coverage_daily(s_fact(t))).select(
        "location_id", "date", "metric", "coverage_status"
    )


@query("qa6_provenance_unique", """
SELECT CAST(event_type AS VARCHAR) AS source_file, CAST(CAST(ts AS DATE) AS VARCHAR) AS source_checksum,
       user_id AS source_row_number, count(*) AS row_count FROM events GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def _(t):
    raw = t("events").select(
        F.col("event_type").alias("source_file"), F.to_date("ts").cast("string").alias("source_checksum"),
        F.col("user_id").alias("source_row_number"),
    )
    return quality.provenance_unique(raw)


@query("qa7_stage_counts", f"""
, known AS (SELECT location_id FROM u_sites WHERE latitude >= 0)
, keys AS (SELECT location_id, hour, count(*) AS n, bool_or({U_BOUNDS_SQL}) AS valid,
                  location_id IN (SELECT location_id FROM known) AS site_known
           FROM u GROUP BY 1, 2)
SELECT CAST(sum(n) AS BIGINT) AS input_rows, count(*) FILTER (valid) AS validated_rows,
       CAST(sum(n) AS BIGINT) - count(*) FILTER (valid) AS rejected_or_duplicate_rows,
       count(*) FILTER (valid AND NOT site_known) AS unmatched_site_rows,
       count(*) FILTER (valid AND site_known) AS output_rows,
       count(DISTINCT CASE WHEN valid AND site_known THEN (location_id, CAST(hour AS DATE)) END) AS daily_rows
FROM keys""")
def _(t):
    return quality.stage_counts(
        t.u.withColumn("timestamp", F.col("hour")), t.u_sites.filter("latitude >= 0")
    )


@query("qa8_reconcile_totals", f"""
, site AS (SELECT location_id, avg(price) AS y, any_value(elevation_m) AS x, sum(discount) AS t
           FROM w_at_sites GROUP BY 1)
SELECT {r('avg(y)')} AS mean_of_site_means, {r('sum(t)')} AS sum_of_site_totals,
       {r('1000 * regr_slope(y, x)')} AS slope, {r('corr(y, x)')} AS correlation,
       {r('1000 * regr_slope(y, x)')} AS slope_from_moments, {r('corr(y, x)')} AS correlation_from_moments,
       {r('(SELECT avg(price) FROM w_at_sites)')} AS pooled_mean,
       {r('(SELECT sum(discount) FROM w_at_sites)')} AS pooled_total FROM site""")
def _(t):
    return quality.reconcile_totals(t.w_at_sites, "price", "elevation_m", "discount").withColumns(
        {c: F.col(c) * 1000 for c in ("slope", "slope_from_moments")}
    )


# ----------------------------------------------------------------- planning ----

PLAN_SQL = """
, plan_years AS (SELECT location_id, y.i AS year, greatest(DATE '2020-03-15', make_date(y.i, 1, 1)) AS start,
    least(DATE '2022-06-30', make_date(y.i, 12, 31)) AS "end" FROM w_sites, range(2020, 2023) y(i))"""


@query("plan1_expected_chunks", PLAN_SQL + """
SELECT location_id, CAST(year AS BIGINT) AS year, start, "end",
       (date_diff('day', start, "end") + 1) * 24 AS hours FROM plan_years""")
def _(t):
    return planning.expected_chunks(t.w_sites, date(2020, 3, 15), date(2022, 6, 30))


def w_retained(t):
    """Unbroken runs of shipping days per supplier, as retained intervals."""
    first = t.w.select("location_id", F.to_date("timestamp").alias("start")).distinct()
    return first.filter(F.col("start").between("1996-01-01", "1996-12-31")).withColumn("end", F.col("start"))


SWEEP_SQL = """
, days AS (SELECT location_id, CAST(d AS DATE) AS day
           FROM w_sites, unnest(generate_series(DATE '1995-11-20', DATE '1997-02-10', INTERVAL 1 DAY)) AS x(d))
, held AS (SELECT DISTINCT location_id, CAST(timestamp AS DATE) AS day FROM w
           WHERE CAST(timestamp AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31')
, left_days AS (SELECT * FROM days ANTI JOIN held USING (location_id, day))
, windowed AS (SELECT location_id, day,
     least(DATE '1997-02-10', make_date(year(day), 12, 31)) AS year_end FROM left_days)
, placed AS (SELECT location_id, day, year_end - CAST(floor(date_diff('day', day, year_end) / 7) * 7 AS INTEGER) AS window_end
             FROM windowed)
, isl AS (SELECT *, greatest(window_end - 6, make_date(year(day), 1, 1), DATE '1995-11-20') AS window_start,
          day - CAST(row_number() OVER (PARTITION BY location_id, window_end ORDER BY day) AS INTEGER) AS island FROM placed)
, chunks AS (SELECT location_id, year(min(day)) AS year, min(day) AS start, max(day) AS "end",
       (date_diff('day', min(day), max(day)) + 1) * 24 AS hours, window_start, window_end
  FROM isl GROUP BY location_id, window_start, window_end, island)"""


def w_outstanding(t, days=7):
    return planning.outstanding(
        t.w_sites, date(1995, 11, 20), date(1997, 2, 10), w_retained(t), days
    )


@query("plan2_outstanding", SWEEP_SQL + """
SELECT location_id, year, start, "end", hours, window_start, window_end FROM chunks""")
def _(t):
    return w_outstanding(t)


@query("plan4_hour_gaps", """
, expected AS (SELECT location_id, h AS timestamp FROM s_sites,
    unnest(generate_series(TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-09 23:00', INTERVAL 1 HOUR)) AS x(h))
, seen AS (SELECT location_id, date_trunc('hour', timestamp) AS timestamp, count(*) AS n FROM s_raw GROUP BY 1, 2)
SELECT location_id, timestamp, coalesce(n, 0) AS n,
       CASE WHEN n IS NULL THEN 'missing' ELSE 'repeated' END AS problem
FROM expected LEFT JOIN seen USING (location_id, timestamp) WHERE coalesce(n, 0) <> 1""")
def _(t):
    chunks = t.s_sites.select("location_id", F.lit(date(2024, 1, 3)).alias("start"), F.lit(date(2024, 1, 9)).alias("end"))
    hours = t.s_raw.withColumn("timestamp", F.date_trunc("hour", "timestamp"))
    return planning.hour_gaps(hours, chunks)


@query("plan5_unavailable_days", """
SELECT location_id, CAST(timestamp AS DATE) AS date, count(*) AS hours FROM u
GROUP BY 1, 2 HAVING count(precipitation) = 0""")
def _(t):
    return planning.unavailable_days(t.u, "precipitation")


@query("plan6_progress", SWEEP_SQL + """
, marked AS (SELECT c.*, location_id IN (SELECT location_id FROM w_sites WHERE latitude >= 0)
                    OR window_start >= DATE '1996-06-01' AS done FROM chunks c)
, open_window AS (SELECT window_start, window_end, count(DISTINCT location_id) AS remaining FROM marked
                  WHERE NOT done GROUP BY 1, 2 ORDER BY 1 DESC LIMIT 1)
SELECT count(*) AS expected_chunks, count(*) FILTER (done) AS completed_chunks,
       CAST(sum(hours) AS BIGINT) AS expected_rows, CAST(sum(hours) FILTER (done) AS BIGINT) AS completed_rows,
       (SELECT window_start FROM open_window) AS active_start, (SELECT window_end FROM open_window) AS active_end,
       (SELECT remaining FROM open_window) AS remaining_sites FROM marked""")
def _(t):
    plan = w_outstanding(t)
    north = t.w_sites.filter("latitude >= 0").select("location_id").withColumn("_north", F.lit(True))
    done = plan.join(north, "location_id", "left").filter(
        F.col("_north").isNotNull() | (F.col("window_start") >= "1996-06-01")
    )
    return planning.progress(plan, done)
