"""Daily, period, coverage and comparison tables on the test tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from fieldgauge.functions import scalars as fn
from fieldgauge.operators import coverage, daily, filters, joins, ranks, selection, summaries, windows
from fieldgauge.queries.basics import (
    CLASS_SQL, ENRICHED_SQL, S_FACT_SQL, S_LONG_SQL, U_BOUNDS_SQL, W_LONG_SQL, Y_FACT_SQL,
    Y_MONTH_SQL, s_days, s_fact, s_long, y_fact, y_month,
)
from fieldgauge.queries.bindings import BAND_SQL, W_METRICS, r, season_sql
from fieldgauge.queries.registry import query

# ------------------------------------------------------------ batch tables ----


def u_enriched(t):
    return joins.enrich(filters.validate(t.u), t.u_sites)


VALID_SQL = ENRICHED_SQL + f", v AS (SELECT * FROM e WHERE {U_BOUNDS_SQL})"
DAILY_SQL = VALID_SQL + """
, daily AS (SELECT location_id, name, region, elevation_m, elevation_band, season, date,
     avg(temperature_2m) AS daily_avg_temperature_c, sum(precipitation) AS daily_precipitation_mm,
     avg(wind_speed_10m) AS daily_avg_wind_speed_ms, count(*) AS observed_hours
  FROM v GROUP BY ALL)"""


@query("agg1_pooled_summary", f"""
, ew AS (SELECT *, {BAND_SQL} AS elevation_band, year(timestamp) AS year, {season_sql()} AS season FROM w_at_sites)
SELECT elevation_band, region, season, year, {r('avg(quantity)')} AS avg_quantity, {r('sum(price)')} AS total_price,
       {r('avg(discount)')} AS avg_discount, {r('avg(tax)')} AS avg_tax, count(*) AS observation_count
FROM ew GROUP BY 1, 2, 3, 4""")
def _(t):
    return daily.pooled_summary(
        joins.enrich(t.w, t.w_sites),
        outputs={"avg_quantity": ("mean", "quantity"), "total_price": ("sum", "price"),
                 "avg_discount": ("mean", "discount"), "avg_tax": ("mean", "tax")},
    )


@query("agg2_daily_metrics", DAILY_SQL + f"""
SELECT location_id, name, region, {r('elevation_m')} AS elevation_m, elevation_band, season, date,
       {r('daily_avg_temperature_c')} AS daily_avg_temperature_c,
       {r('daily_precipitation_mm')} AS daily_precipitation_mm,
       {r('daily_avg_wind_speed_ms')} AS daily_avg_wind_speed_ms, observed_hours FROM daily""")
def _(t):
    return daily.daily_metrics(u_enriched(t))


@query("agg3_yearly_metrics", f"""
SELECT location_id, year(date) AS year, {r('avg(value)')} AS annual_mean FROM y GROUP BY 1, 2""")
def _(t):
    return daily.yearly_metrics(
        t.y.withColumn("year", F.year("date")), ["location_id", "year"], "value", "annual_mean"
    )


S_DAY_SQL = """
, day AS (SELECT location_id, CAST(timestamp AS DATE) AS date,
     CASE WHEN count(reading) = 24 THEN avg(reading) END AS reading, count(reading) AS reading_hours,
     CASE WHEN count(volume) = 24 THEN sum(volume) END AS volume, count(volume) AS volume_hours
  FROM s GROUP BY 1, 2)"""


def s_complete(t):
    return daily.complete_day(t.s, {"reading": "mean", "volume": "sum"})


@query("agg4_complete_day", S_DAY_SQL + f"""
SELECT location_id, date, {r('reading')} AS reading, reading_hours, {r('volume')} AS volume, volume_hours FROM day""")
def _(t):
    return s_complete(t)


@query("agg5_complete_day_long", S_LONG_SQL + f"""
SELECT location_id, date, metric, observed_hours, valid_hours, is_complete, {r('daily_value')} AS daily_value FROM s_days""")
def _(t):
    return s_days(t)


@query("agg6_preview_daily", f"""
SELECT location_id, CAST(timestamp AS DATE) AS date,
       {r('CASE WHEN count(reading) = 24 THEN avg(reading) END')} AS reading, count(reading) AS observed_hours
FROM s WHERE location_id IN ('click', 'error', 'view') AND timestamp >= TIMESTAMP '2024-01-03'
  AND timestamp < TIMESTAMP '2024-01-27' GROUP BY 1, 2""")
def _(t):
    return daily.preview_daily(
        t.s, "reading", "mean", date(2024, 1, 3), date(2024, 1, 26), ["click", "error", "view"]
    )


def rollup_sql(source: str, value: str, hours: str, grain: str, how: str, start: str, end: str) -> str:
    bucket = f"CAST(date_trunc('{grain}', date) AS DATE)"
    return f"""
, b AS (SELECT location_id, {bucket} AS bucket, {how}({value}) AS v, count({value}) AS n, sum({hours}) AS h
        FROM {source} WHERE date BETWEEN DATE '{start}' AND DATE '{end}' GROUP BY 1, 2)
SELECT location_id, bucket AS date, CAST(h AS BIGINT) AS hours,
       {r(f'''CASE WHEN n = date_diff('day', greatest(bucket, DATE '{start}'),
             least(CAST(bucket + INTERVAL 1 {grain} AS DATE) - 1, DATE '{end}')) + 1 THEN v END''')} AS value
FROM b"""


@query("agg7_rollup_weekly", S_DAY_SQL + rollup_sql("day", "reading", "reading_hours", "week", "avg", "2024-01-03", "2024-01-30"))
def _(t):
    days = s_complete(t).select("location_id", "date", F.col("reading").alias("value"), F.col("reading_hours").alias("hours"))
    sites = ["click", "error", "purchase", "signup", "view"]
    return daily.answer_period_request(
        days, "value", "weekly", "mean", date(2024, 1, 3), date(2024, 1, 30), sites, t.s_sites, additive=False,
        coverage=(date(2024, 1, 1), date(2024, 1, 31)),
    )


for _period, _grain, _how, _sql_how in (
    ("monthly", "month", "sum", "sum"), ("yearly", "year", "max", "max"), ("yearly", "year", "min", "min"),
):

    def _rollup(t, period=_period, how=_how):
        days = t.y_global.select("location_id", "date", "value", F.col("observed").alias("hours"))
        return daily.rollup_period(days, "value", period, how, date(1995, 1, 15), date(2001, 6, 30))

    query(f"agg7_rollup_{_period}_{_how}",
          rollup_sql("y_global", "value", "observed", _grain, _sql_how, "1995-01-15", "2001-06-30"))(_rollup)


@query("agg10_location_means", DAILY_SQL + f"""
SELECT location_id, name, elevation_band, {r('avg(daily_avg_temperature_c)')} AS mean_daily_temperature_c,
       {r('avg(daily_precipitation_mm)')} AS mean_daily_precipitation_mm,
       {r('avg(daily_avg_wind_speed_ms)')} AS mean_daily_wind_ms, count(date) AS observed_days
FROM daily GROUP BY 1, 2, 3""")
def _(t):
    return summaries.location_means(daily.daily_metrics(u_enriched(t)))


@query("agg11_equal_weight", f"""
, m AS (SELECT location_id, {BAND_SQL} AS elevation_band, avg(quantity) AS quantity, avg(price) AS price
        FROM w_at_sites GROUP BY 1, 2)
SELECT elevation_band, {r('avg(quantity)')} AS quantity, {r('avg(price)')} AS price, count(*) AS locations
FROM m GROUP BY 1""")
def _(t):
    rows = t.w_at_sites.withColumn("elevation_band", fn.elevation_band("elevation_m"))
    return summaries.equal_weight(rows, ["location_id", "elevation_band"], ["elevation_band"], ["quantity", "price"])


@query("agg12_equal_weight_season", f"""
, m AS (SELECT location_id, {BAND_SQL} AS elevation_band, {season_sql()} AS season, avg(quantity) AS quantity,
               avg(price) AS price FROM w_at_sites GROUP BY 1, 2, 3)
SELECT elevation_band, season, {r('avg(quantity)')} AS quantity, {r('avg(price)')} AS price, count(*) AS locations
FROM m GROUP BY 1, 2""")
def _(t):
    return summaries.equal_weight(
        joins.enrich(t.w, t.w_sites), ["location_id", "elevation_band", "season"],
        ["elevation_band", "season"], ["quantity", "price"],
    )


@query("agg13_band_timeseries", f"""
, m AS (SELECT CAST(date_trunc('month', timestamp) AS DATE) AS period, location_id, {BAND_SQL} AS elevation_band,
               {', '.join(f'avg({m}) AS {m}' for m in W_METRICS)} FROM w_at_sites GROUP BY 1, 2, 3)
SELECT period, elevation_band, {', '.join(f'{r(f"avg({m})")} AS {m}' for m in W_METRICS)},
       count(DISTINCT location_id) AS locations FROM m GROUP BY 1, 2""")
def _(t):
    return summaries.band_timeseries(t.w_at_sites, "month", W_METRICS)


for _grain in ("day", "week", "month"):

    def _to_grain(t, grain=_grain):
        return daily.to_grain(t.w, grain, W_METRICS)

    query(f"agg14_to_grain_{_grain}", f"""
SELECT CAST(date_trunc('{_grain}', timestamp) AS DATE) AS period, location_id,
       {', '.join(f'{r(f"avg({m})")} AS {m}' for m in W_METRICS)} FROM w GROUP BY 1, 2""")(_to_grain)


@query("agg15_period_stat", f"""
SELECT date_trunc('hour', timestamp) AS period, location_id, {r('max(value)')} AS value, count(value) AS observations
FROM s_raw GROUP BY 1, 2""")
def _(t):
    return daily.period_stat(t.s_raw, "hour", "value", "max")


@query("agg16_site_profile", f"""
, m AS (SELECT location_id, name, region, elevation_m, {', '.join(f'avg({m}) AS {m}' for m in W_METRICS)}
        FROM w_at_sites GROUP BY 1, 2, 3, 4)
, l AS ({' UNION ALL '.join(f"SELECT location_id, name, region, elevation_m, '{m}' AS variable, {m} AS mean_value FROM m" for m in W_METRICS)})
SELECT location_id, name, region, {r('elevation_m')} AS elevation_m, variable, {r('mean_value')} AS mean_value
FROM l WHERE mean_value IS NOT NULL""")
def _(t):
    return summaries.site_profile(t.w_at_sites, W_METRICS, ["location_id", "name", "region", "elevation_m"])


CLASSED_SQL = CLASS_SQL + """
, dv AS (SELECT d.location_id, date, band, elevation_m, quantity AS value FROM w_daily d
         JOIN w_class c ON c.location_id = d.location_id WHERE quantity IS NOT NULL)"""


def w_classed(t):
    return t.w_daily.filter("quantity IS NOT NULL").join(summaries.with_class(t.w_sites), "location_id").select(
        "location_id", "name", "elevation_m", "date", "band", F.col("quantity").alias("value")
    )


@query("agg17_class_timeline", CLASSED_SQL + f"""
, p AS (SELECT 'daily' AS period, date AS bucket, band, value FROM dv
  UNION ALL SELECT 'weekly', CAST(date_trunc('week', date) AS DATE), band, value FROM dv
  UNION ALL SELECT 'monthly', CAST(date_trunc('month', date) AS DATE), band, value FROM dv)
SELECT period, bucket, band, {r('avg(value)')} AS mean, count(*) AS count, {r('var_pop(value)')} AS variance
FROM p GROUP BY 1, 2, 3""")
def _(t):
    return summaries.class_timeline(w_classed(t))


@query("agg18_summary_stats", f"""
SELECT count(reading) AS count, {r('avg(reading)')} AS mean, {r('min(reading)')} AS min, {r('max(reading)')} AS max,
       {r('median(reading)')} AS median, {r('var_pop(reading)')} AS variance FROM s""")
def _(t):
    return summaries.summary_stats(t.s, "reading")


HIST_SQL = """
, lim AS (SELECT min(reading) AS lo, max(reading) AS hi FROM s)
, bins AS (SELECT CAST(least(floor((reading - lo) / (hi - lo) * 16), 15) + 1 AS BIGINT) AS bin FROM s, lim WHERE reading IS NOT NULL)"""


@query("agg19_histogram", HIST_SQL + f"""
SELECT CAST(k.i AS BIGINT) AS bin, {r('lo + (k.i - 1) * (hi - lo) / 16')} AS low, {r('lo + k.i * (hi - lo) / 16')} AS high,
       (SELECT count(*) FROM bins WHERE bin = k.i) AS count FROM range(1, 17) k(i), lim""")
def _(t):
    return summaries.histogram(t.s, "reading", 16)


@query("agg20_site_scatter", CLASSED_SQL + f"""
SELECT location_id, {r('elevation_m')} AS elevation_m, band, {r('avg(value)')} AS mean, count(*) AS count
FROM dv GROUP BY location_id, elevation_m, band""")
def _(t):
    return summaries.site_scatter(w_classed(t), "value", ["location_id", "elevation_m", "band"])


@query("agg21_analytics", f"""
, long AS ({' UNION ALL '.join(f"SELECT '{m}' AS metric, location_id, {m} AS value FROM w_daily WHERE date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'" for m in W_METRICS)})
SELECT metric, count(value) AS count, {r('avg(value)')} AS mean, {r('min(value)')} AS min, {r('max(value)')} AS max,
       {r('median(value)')} AS median, {r('var_pop(value)')} AS variance FROM long WHERE value IS NOT NULL GROUP BY 1""")
def _(t):
    bundle = summaries.analytics(
        t.w_daily, W_METRICS, date(1996, 1, 1), date(1999, 12, 31), t.w_sites
    )
    return bundle["stats"]


@query("agg21_analytics_histogram", f"""
, long AS ({' UNION ALL '.join(f"SELECT '{m}' AS metric, {m} AS value FROM w_daily WHERE {m} IS NOT NULL AND date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'" for m in ('quantity', 'price'))})
, lim AS (SELECT metric, min(value) AS lo, max(value) AS hi FROM long GROUP BY 1)
, bins AS (SELECT metric, CAST(least(floor((value - lo) / (hi - lo) * 16), 15) + 1 AS BIGINT) AS bin FROM long JOIN lim USING (metric))
, cnt AS (SELECT metric, bin, count(*) AS n FROM bins GROUP BY 1, 2)
SELECT lim.metric, CAST(k.i AS BIGINT) AS bin, {r('lo + (k.i - 1) * (hi - lo) / 16')} AS low, {r('lo + k.i * (hi - lo) / 16')} AS high,
       coalesce(n, 0) AS count FROM lim, range(1, 17) k(i) LEFT JOIN cnt ON cnt.metric = lim.metric AND cnt.bin = k.i""")
def _(t):
    bundle = summaries.analytics(
        t.w_daily, ["quantity", "price"], date(1996, 1, 1), date(1999, 12, 31), t.w_sites
    )
    return bundle["histogram"]


@query("agg22_downsample", f"""
SELECT location_id, DATE '1995-01-01' + CAST(floor(date_diff('day', DATE '1995-01-01', date) / 12) * 12 AS INTEGER) AS date,
       {r('avg(quantity)')} AS quantity, {r('avg(price)')} AS price
FROM w_daily WHERE date BETWEEN DATE '1995-01-01' AND DATE '2001-07-02' GROUP BY 1, 2""")
def _(t):
    return daily.downsample(t.w_daily, ["quantity", "price"], 12, date(1995, 1, 1), date(2001, 7, 2))


@query("agg23_auto_monthly", f"""
SELECT location_id, CAST(date_trunc('month', date) AS DATE) AS date,
       {r('avg(quantity)')} AS quantity, {r('avg(price)')} AS price FROM w_daily GROUP BY 1, 2""")
def _(t):
    return daily.at_grain(t.w_daily, ["quantity", "price"], "month")


# ----------------------------------------------------------------- coverage ----

@query("agg24_coverage_span", """
SELECT location_id, min(timestamp) AS first_timestamp, max(timestamp) AS last_timestamp, count(*) AS hours
FROM s_raw GROUP BY 1""")
def _(t):
    return coverage.coverage_span(t.s_raw)


@query("agg25_coverage_vs_window", """
, win AS (SELECT date_diff('hour', min(hour), max(hour)) + 1 AS expected FROM u)
, seen AS (SELECT location_id, count(*) AS n FROM (SELECT DISTINCT location_id, hour FROM u) GROUP BY 1)
SELECT location_id, coalesce(n, 0) AS observed_hours, expected AS expected_hours, expected - coalesce(n, 0) AS missing_hours
FROM u_sites LEFT JOIN seen USING (location_id), win""")
def _(t):
    hours = filters.dedupe_any(t.u, ["location_id", "hour"])
    return coverage.coverage_vs_window(hours, t.u_sites, ts="hour")


@query("agg26_coverage_daily", S_FACT_SQL + """
SELECT location_id, date, metric, observed_hours, valid_hours, 24 - valid_hours AS missing_hours, is_complete,
       CASE WHEN observed_hours = 0 THEN 'missing' WHEN is_complete THEN 'complete' ELSE 'partial' END AS coverage_status
FROM s_fact""")
def _(t):
    return coverage.coverage_daily(s_fact(t))


@query("agg27_coverage_locations", S_FACT_SQL + """
SELECT location_id, metric, count(*) AS expected_days, count(*) FILTER (is_complete) AS complete_days,
       CAST(sum(valid_hours) AS BIGINT) AS valid_hours, min(date) FILTER (is_complete) AS first_complete_date,
       max(date) FILTER (is_complete) AS last_complete_date FROM s_fact GROUP BY 1, 2""")
def _(t):
    return coverage.coverage_locations(s_fact(t))


@query("agg28_seasonal", Y_FACT_SQL + f"""
, g AS (SELECT location_id, metric, unit, season, season_year, count(*) AS requested_days,
        count(daily_value) AS complete_days, avg(daily_value) AS available_day_mean, sum(daily_value) AS available_total
  FROM y_fact GROUP BY 1, 2, 3, 4, 5)
, b AS (SELECT *, CASE season WHEN 'DJF' THEN make_date(season_year - 1, 12, 1) WHEN 'MAM' THEN make_date(season_year, 3, 1)
        WHEN 'JJA' THEN make_date(season_year, 6, 1) ELSE make_date(season_year, 9, 1) END AS season_start FROM g)
SELECT location_id, metric, unit, season, season_year, requested_days, complete_days,
       {r('available_day_mean')} AS available_day_mean, {r('available_total')} AS available_total, season_start,
       date_diff('day', season_start, CAST(season_start + INTERVAL 3 MONTH AS DATE)) AS calendar_days,
       complete_days = date_diff('day', season_start, CAST(season_start + INTERVAL 3 MONTH AS DATE)) AS is_complete_season FROM b""")
def _(t):
    return coverage.seasonal(y_fact(t))


@query("agg29_yearly", Y_FACT_SQL + f"""
SELECT location_id, metric, unit, calendar_year, requested_days, complete_days, calendar_days,
       {r('available_day_mean')} AS available_day_mean, {r('available_total')} AS available_total,
       is_complete_year, {r('annual_mean')} AS annual_mean FROM y_years""")
def _(t):
    return coverage.yearly(y_fact(t))


@query("agg30_annual_completeness", f"""
SELECT location_id, year(timestamp) AS year, count(*) AS hours, {r('avg(value)')} AS mean_value,
       {r('sum(value)')} AS total_value,
       date_diff('day', make_date(year(timestamp), 1, 1), make_date(year(timestamp) + 1, 1, 1)) * 24 AS expected_hours,
       count(*) = date_diff('day', make_date(year(timestamp), 1, 1), make_date(year(timestamp) + 1, 1, 1)) * 24 AS is_complete
FROM y GROUP BY 1, 2""")
def _(t):
    return coverage.annual_completeness(t.y, {"mean_value": "value"}, {"total_value": "value"})


@query("agg31_daily_slope", f"""
SELECT region, date, count(*) AS sample_size, {r('1000 * regr_slope(price, elevation_m)')} AS slope_per_km,
       {r('regr_r2(price, elevation_m)')} AS r_squared, {r('min(elevation_m)')} AS min_elevation_m,
       {r('max(elevation_m)')} AS max_elevation_m
FROM w_daily_at_sites WHERE price IS NOT NULL AND elevation_m IS NOT NULL
GROUP BY 1, 2 HAVING count(*) >= 3 AND count(DISTINCT elevation_m) >= 2""")
def _(t):
    return summaries.daily_slope(t.w_daily_at_sites, "price", by=["region", "date"])


# two busier sites, so that days complete at both exist at small scale too
PANEL_SQL = """
, s2 AS (SELECT CASE WHEN location_id IN ('click', 'view') THEN 'browse' ELSE 'other' END AS location_id,
                date_trunc('hour', timestamp) AS timestamp, avg(value) AS reading, sum(value) AS volume FROM s_raw GROUP BY 1, 2)
, day AS (SELECT location_id, CAST(timestamp AS DATE) AS date,
     CASE WHEN count(reading) = 24 THEN avg(reading) END AS reading, CASE WHEN count(volume) = 24 THEN sum(volume) END AS volume
  FROM s2 GROUP BY 1, 2)
, shared AS (SELECT date FROM day WHERE reading IS NOT NULL AND volume IS NOT NULL
             GROUP BY 1 HAVING count(DISTINCT location_id) = (SELECT count(DISTINCT location_id) FROM s2))
, isl AS (SELECT date, date - CAST(row_number() OVER (ORDER BY date) AS INTEGER) AS k FROM shared)
, run AS (SELECT min(date) AS a, max(date) AS b FROM isl WHERE k = (SELECT k FROM isl ORDER BY date DESC LIMIT 1))
, panel AS (SELECT s2.* FROM s2, run WHERE CAST(timestamp AS DATE) BETWEEN a AND b)"""


def s2_panel(t):
    kind = F.when(F.col("location_id").isin("click", "view"), "browse").otherwise("other")
    hours = t.s_raw.groupBy(kind.alias("location_id"), F.date_trunc("hour", "timestamp").alias("timestamp")).agg(
        F.avg("value").alias("reading"), F.sum("value").alias("volume")
    )
    return coverage.balanced_panel(hours, {"reading": "mean", "volume": "sum"})


@query("agg32_balanced_panel", PANEL_SQL + f"""
SELECT location_id, timestamp, {r('reading')} AS reading, {r('volume')} AS volume FROM panel""")
def _(t):
    return s2_panel(t)


@query("agg32_panel_check", PANEL_SQL + """
SELECT count(DISTINCT location_id) AS sites, count(DISTINCT CAST(timestamp AS DATE)) AS days, count(*) AS hours,
       count(*) = count(DISTINCT location_id) * count(DISTINCT CAST(timestamp AS DATE)) * 24 AS is_balanced FROM panel""")
def _(t):
    return coverage.panel_check(s2_panel(t))


@query("agg33_period_summary", f"""
SELECT location_id, {r('avg(quantity)')} AS quantity, {r('avg(discount)')} AS discount, {r('sum(price)')} AS period_total
FROM w_daily GROUP BY 1""")
def _(t):
    return daily.period_summary(t.w_daily, ["quantity", "discount"], "price")


@query("agg34_describe", W_LONG_SQL + f"""
SELECT metric, count(value) AS count, {r('avg(value)')} AS mean, {r('stddev_samp(value)')} AS std, {r('min(value)')} AS min,
       {r('quantile_cont(value, 0.25)')} AS q25, {r('median(value)')} AS median, {r('quantile_cont(value, 0.75)')} AS q75,
       {r('max(value)')} AS max,
       {r('(avg(value * value * value) - 3 * avg(value) * avg(value * value) + 2 * pow(avg(value), 3)) / pow(var_pop(value), 1.5)')} AS skewness
FROM w_long GROUP BY 1""")
def _(t):
    return summaries.describe(t.w, W_METRICS)


@query("agg35_missingness", " UNION ALL ".join(
    f"SELECT location_id, year(timestamp) AS year, count(*) AS n_rows, '{m}' AS variable, "
    f"count(*) - count({m}) AS missing, {r(f'100.0 * (count(*) - count({m})) / count(*)')} AS percent "
    "FROM w GROUP BY 1, 2" for m in W_METRICS))
def _(t):
    return coverage.missingness(t.w.withColumn("year", F.year("timestamp")), W_METRICS, ["location_id", "year"])


@query("agg35_missingness_overall", " UNION ALL ".join(
    f"SELECT count(*) AS n_rows, '{m}' AS variable, count(*) - count({m}) AS missing, "
    f"{r(f'100.0 * (count(*) - count({m})) / count(*)')} AS percent FROM w" for m in W_METRICS))
def _(t):
    return coverage.missingness(t.w, W_METRICS)


@query("agg36_duplicate_counts", """
, d AS (SELECT location_id, hour, event_type FROM u)
SELECT count(*) AS n_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS exact_duplicates,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT location_id, hour FROM d)) AS key_duplicates FROM d""")
def _(t):
    return coverage.duplicate_counts(t.u.select("location_id", "hour", "event_type"), ["location_id", "hour"])


@query("agg37_site_month", f"""
SELECT location_id, year(timestamp) AS year, month(timestamp) AS month, {r('24 * avg(value)')} AS value, count(*) AS hours,
       day(last_day(any_value(date))) * 24 AS expected_hours,
       count(*) = day(last_day(any_value(date))) * 24 AS is_complete FROM y GROUP BY 1, 2, 3""")
def _(t):
    return daily.site_month(t.y, ["value"], rain="value")


@query("agg38_climatology", Y_MONTH_SQL + f"""
, c AS (SELECT location_id, month, avg(value) AS value FROM y_month GROUP BY 1, 2)
SELECT location_id, month, {r('value')} AS value, first_value(month) OVER (PARTITION BY location_id ORDER BY value DESC, month
         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS peak_month,
       first_value(month) OVER (PARTITION BY location_id ORDER BY value, month
         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS trough_month,
       {r('max(value) OVER (PARTITION BY location_id) - min(value) OVER (PARTITION BY location_id)')} AS peak_minus_trough FROM c""")
def _(t):
    return daily.climatology(y_month(t), "value")


@query("agg39_month_year_summary", f"""
SELECT location_id, month(date) AS month, year(date) AS year, {r('avg(value)')} AS mean, {r('median(value)')} AS median,
       {r('stddev_samp(value)')} AS sd, {r('quantile_cont(value, 0.25)')} AS q25, {r('quantile_cont(value, 0.75)')} AS q75
FROM y_daily GROUP BY 1, 2, 3""")
def _(t):
    return daily.month_year_summary(t.y_daily, "value")


@query("agg40_band_quantiles", f"""
, m AS (SELECT location_id, {BAND_SQL} AS band, month(timestamp) AS month, avg(quantity) AS quantity
        FROM w_at_sites GROUP BY 1, 2, 3)
SELECT band, month, count(quantity) AS n, {r('quantile_cont(quantity, 0.25)')} AS q25, {r('median(quantity)')} AS median,
       {r('quantile_cont(quantity, 0.75)')} AS q75 FROM m GROUP BY 1, 2""")
def _(t):
    rows = t.w_at_sites.groupBy(
        "location_id", fn.elevation_band("elevation_m").alias("band"), F.month("timestamp").alias("month")
    ).agg(F.avg("quantity").alias("quantity"))
    return summaries.band_quantiles(rows, "quantity", ["band", "month"])


@query("agg41_boxplot", f"""
, m AS (SELECT location_id, elevation_m, avg(price) AS mean FROM w_at_sites GROUP BY 1, 2)
, p AS (SELECT (elevation_m >= 500)::INT + (elevation_m >= 1500)::INT AS band, mean FROM m)
, q AS (SELECT band, quantile_cont(mean, 0.25) AS q1, median(mean) AS median, quantile_cont(mean, 0.75) AS q3 FROM p GROUP BY 1)
, x AS (SELECT band, min(mean) FILTER (mean BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS low,
        max(mean) FILTER (mean BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS high, count(*) AS points
  FROM p JOIN q USING (band) GROUP BY 1)
SELECT CAST(l.band AS BIGINT) AS band, label, {r('q1')} AS q1, {r('median')} AS median, {r('q3')} AS q3, {r('low')} AS low,
       {r('high')} AS high, coalesce(points, 0) AS points
FROM (VALUES (0, 'Below 500 m'), (1, '500–<1,500 m'), (2, '1,500 m and above')) l(band, label)
LEFT JOIN q USING (band) LEFT JOIN x USING (band)""")
def _(t):
    sites = t.w_at_sites.groupBy("location_id", "elevation_m").agg(
        F.avg("price").alias("mean"), F.count(F.lit(1)).alias("count")
    )
    return summaries.boxplot(sites)


@query("agg42_pivot_mean", "SELECT country, " + ", ".join(
    r(f"avg(value) FILTER (month(date) = {m})") + f' AS "{m}"' for m in range(1, 13)) + " FROM y GROUP BY 1")
def _(t):
    return summaries.pivot_mean(t.y.withColumn("month", F.month("date")), ["country"], "month", range(1, 13), "value")


@query("agg42_country_means", f"""
, m AS (SELECT location_id, country, avg(quantity) AS quantity, avg(price) AS price FROM w_at_sites GROUP BY 1, 2)
SELECT country, {r('avg(quantity)')} AS quantity, {r('avg(price)')} AS price, count(*) AS locations FROM m GROUP BY 1""")
def _(t):
    return summaries.equal_weight(t.w_at_sites, ["location_id", "country"], ["country"], ["quantity", "price"])


def corr_sql(a: str, b: str) -> str:
    return (f"CASE WHEN stddev_pop({a}) FILTER ({b} IS NOT NULL) > 0 AND stddev_pop({b}) FILTER ({a} IS NOT NULL) > 0 "
            f"THEN corr({a}, {b}) END")


@query("agg43_focus_correlations", f"""
, k AS (SELECT *, 1.0::DOUBLE AS fixed FROM w_at_sites)
, c AS ({' UNION ALL '.join(f"SELECT '{m}' AS variable, {corr_sql('quantity', m)} AS correlation, count(*) FILTER (quantity IS NOT NULL AND {m} IS NOT NULL) AS pair_count FROM k" for m in ('price', 'discount', 'tax', 'elevation_m', 'fixed'))})
SELECT variable, {r('correlation')} AS correlation, {r('abs(correlation)')} AS absolute_correlation, pair_count FROM c""")
def _(t):
    rows = t.w_at_sites.withColumn("fixed", F.lit(1.0))
    return summaries.focus_correlations(
        rows, "quantity", ["quantity", "price", "discount", "tax", "elevation_m", "fixed"]
    )


CORR_COLUMNS = ("quantity", "price", "discount", "tax", "elevation_m", "latitude")


@query("agg44_corr_matrix", f"""
, m AS (SELECT location_id, avg(quantity) AS quantity, avg(price) AS price, avg(discount) AS discount, avg(tax) AS tax,
               any_value(elevation_m) AS elevation_m, any_value(latitude) AS latitude FROM w_at_sites GROUP BY 1)
{' UNION ALL '.join(f"SELECT '{a}' AS x, '{b}' AS y, {r(f'corr({a}, {b})')} AS r FROM m" for a in CORR_COLUMNS for b in CORR_COLUMNS)}""")
def _(t):
    means = t.w_at_sites.groupBy("location_id").agg(
        *[F.avg(c).alias(c) for c in W_METRICS],
        F.first("elevation_m").alias("elevation_m"), F.first("latitude").alias("latitude"),
    )
    return summaries.corr_matrix(means, CORR_COLUMNS)


@query("agg45_tally", f"""
, tests AS (SELECT location_id, region, (avg(quantity) - 27.5) / (stddev_samp(quantity) / sqrt(count(quantity))) AS z,
                   avg(discount) AS p FROM w_at_sites GROUP BY 1, 2)
SELECT region, count(*) AS tests, count(*) FILTER (p < 0.05) AS significant, {r('min(z)')} AS min_statistic,
       {r('max(z)')} AS max_statistic, {r('max(p)')} AS max_p FROM tests GROUP BY 1""")
def _(t):
    tests = t.w_at_sites.groupBy("location_id", "region").agg(
        ((F.avg("quantity") - 27.5) / (F.stddev_samp("quantity") / F.sqrt(F.count("quantity")))).alias("statistic"),
        F.avg("discount").alias("p"),
    )
    return summaries.tally(tests, ["region"])


@query("agg46_pair_fits", f"""
{' UNION ALL '.join(f"SELECT '{m}' AS variable, {r(f'regr_slope(quantity, {m})')} AS slope, {r(f'regr_intercept(quantity, {m})')} AS intercept, CAST(regr_count(quantity, {m}) AS BIGINT) AS n FROM w_at_sites" for m in ('price', 'discount', 'tax', 'elevation_m'))}""")
def _(t):
    return summaries.pair_fits(
        t.w_at_sites.select("quantity", "price", "discount", "tax", "elevation_m"),
        "quantity", ["price", "discount", "tax", "elevation_m"],
    )


PAST_SQL = f"""
, past AS (SELECT location_id, timestamp, value,
   avg(value) OVER (PARTITION BY location_id ORDER BY CAST(floor(epoch(timestamp)) AS BIGINT)
                    RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING) AS past FROM s_raw)"""


@query("agg47_annual_features", PAST_SQL + f"""
SELECT location_id, year(timestamp) AS year, {r('avg(value)')} AS mean_value, {r('avg(past)')} AS mean_past_value,
       {r('sum(value)')} AS annual_total FROM past GROUP BY 1, 2""")
def _(t):
    rows = windows.past_average(t.s_raw, "value", 24, output="past")
    return daily.annual_features(rows, "value", "past", "value")


@query("agg48_map_frame", S_DAY_SQL + f"""
, win AS (SELECT location_id, date, reading, reading_hours FROM day WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20')
, scale AS (SELECT coalesce(min(reading), 0) AS lo, coalesce(max(reading), 1) AS hi FROM win)
, grid AS (SELECT location_id, CAST(d AS DATE) AS date FROM s_sites,
           unnest(generate_series(DATE '2024-01-05', DATE '2024-01-20', INTERVAL 1 DAY)) AS x(d))
SELECT g.location_id, g.date, {r('reading')} AS value, coalesce(reading_hours, 0) AS hours,
       {r('lo')} AS scale_min, {r('hi')} AS scale_max
FROM grid g LEFT JOIN win w ON w.location_id = g.location_id AND w.date = g.date, scale""")
def _(t):
    start, end = F.lit(date(2024, 1, 5)), F.lit(date(2024, 1, 20))
    window = s_complete(t).filter(F.col("date").between(start, end)).select(
        "location_id", "date", F.col("reading").alias("value"), F.col("reading_hours").alias("hours")
    )
    return summaries.map_frame(window, t.s_sites, fn.period_dates(start, end, "daily"))


# ------------------------------------------------------------------ windows ----

@query("win1_rolling_days", f"""
SELECT location_id, date, {r('value')} AS value, {r('''avg(value) OVER (PARTITION BY location_id
  ORDER BY date RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)''')} AS rolling FROM y_daily""")
def _(t):
    return windows.rolling_days(t.y_daily, "value", 30, output="rolling").select("location_id", "date", "value", "rolling")


ROLL = "OVER (PARTITION BY location_id, metric ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"


@query("win2_rolling_complete", Y_FACT_SQL + f"""
, x AS (SELECT location_id, date, metric, count(*) {ROLL} AS window_days, count(daily_value) {ROLL} AS window_complete_days,
        avg(daily_value) {ROLL} AS m, sum(daily_value) {ROLL} AS t FROM y_fact)
SELECT location_id, date, metric, window_days, window_complete_days, {r('m')} AS available_day_mean, {r('t')} AS available_day_sum,
       {r('CASE WHEN window_days = 30 AND window_complete_days = 30 THEN m END')} AS complete_mean,
       {r('CASE WHEN window_days = 30 AND window_complete_days = 30 THEN t END')} AS complete_total FROM x""")
def _(t):
    return windows.rolling_complete(y_fact(t)).select(
        "location_id", "date", "metric", "window_days", "window_complete_days", "available_day_mean",
        "available_day_sum", "complete_mean", "complete_total",
    )


Y_YEAR_SQL = ", yy AS (SELECT location_id, year(date) AS year, avg(value) AS value FROM y GROUP BY 1, 2)"


def y_year(t):
    return t.y.groupBy("location_id", F.year("date").alias("year")).agg(F.avg("value").alias("value"))


@query("win3_yoy_available", Y_YEAR_SQL + f"""
, g AS (SELECT * FROM yy WHERE year <> 1997)
SELECT location_id, year, {r('value - lag(value) OVER (PARTITION BY location_id ORDER BY year)')} AS yoy_change FROM g""")
def _(t):
    # without 1997: the change of 1998 is against 1996
    return windows.yoy_available(y_year(t).filter("year <> 1997"), "value").select("location_id", "year", "yoy_change")


@query("win4_anomaly", Y_YEAR_SQL + f"""
SELECT * FROM (SELECT location_id, year, {r('value - avg(value) OVER (PARTITION BY location_id)')} AS anomaly FROM yy) WHERE year >= 1999""")
def _(t):
    return windows.anomaly(y_year(t), "value", show=F.col("year") >= 1999).select("location_id", "year", "anomaly")


@query("win5_past_average", f"""
SELECT event_id, location_id, {r('''avg(precipitation) OVER (PARTITION BY location_id
  ORDER BY CAST(floor(epoch(timestamp)) AS BIGINT) RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING)''')} AS past FROM u""")
def _(t):
    return windows.past_average(t.u, "precipitation", 24, output="past").select("event_id", "location_id", "past")


@query("win6_smooth", f"""
, p AS (SELECT location_id, CAST(timestamp AS DATE) AS period, avg(value) AS value FROM s_raw GROUP BY 1, 2)
SELECT location_id, period, {r('''avg(value) OVER (PARTITION BY location_id ORDER BY period
  ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)''')} AS smoothed_value FROM p""")
def _(t):
    days = daily.period_stat(t.s_raw, "day", "value", "mean")
    return windows.smooth(days, "value", 7).select("location_id", "period", "smoothed_value")


@query("win7_avg_rank", f"""
SELECT order_id, line, location_id, {r('''rank() OVER (PARTITION BY location_id ORDER BY quantity)
  + (count(*) OVER (PARTITION BY location_id, quantity) - 1) / 2''')} AS quantity_rank FROM w WHERE quantity IS NOT NULL""")
def _(t):
    rows = t.w.filter("quantity IS NOT NULL").select("order_id", "line", "location_id", "quantity")
    return ranks.avg_rank(rows, "quantity", ["location_id"]).drop("quantity")


@query("win7_avg_rank_global", f"""
SELECT DISTINCT {r('price')} AS price, {r('''rank() OVER (ORDER BY price) + (count(*) OVER (PARTITION BY price) - 1) / 2''')} AS price_rank FROM w""")
def _(t):
    return ranks.avg_rank(t.w.select("price"), "price").distinct()


@query("win8_rank_by_year", """
, yr AS (SELECT location_id, year(timestamp) AS year, avg(price) AS value FROM w GROUP BY 1, 2)
SELECT location_id, year, rank() OVER (PARTITION BY year ORDER BY value DESC) AS rank FROM yr""")
def _(t):
    yearly = t.w.groupBy("location_id", F.year("timestamp").alias("year")).agg(F.avg("price").alias("value"))
    return windows.rank_by_year(yearly, "value").select("location_id", "year", "rank")


@query("win9_tertiles", """
SELECT location_id, CASE WHEN (SELECT max(elevation_m) - min(elevation_m) FROM w_sites) > 100
  THEN ntile(3) OVER (ORDER BY elevation_m, location_id) END AS tertile FROM w_sites""")
def _(t):
    return windows.tertiles(t.w_sites).select("location_id", "tertile")


# ---------------------------------------------------------------- selection ----

@query("top1_bounded", f"""
SELECT country, region, count(*) AS n_rows, {r('avg(quantity)')} AS quantity FROM w_at_sites
GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 10001""")
def _(t):
    grouped = t.w_at_sites.groupBy("country", "region").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("quantity").alias("quantity")
    )
    return selection.bounded(grouped, ["country", "region"])


@query("top2_top_k", DAILY_SQL + f"""
SELECT location_id, name, date, {r('daily_precipitation_mm')} AS daily_precipitation_mm FROM daily
WHERE daily_precipitation_mm IS NOT NULL ORDER BY daily_precipitation_mm DESC, location_id, date LIMIT 20""")
def _(t):
    return selection.top_k(
        daily.daily_metrics(u_enriched(t)), "daily_precipitation_mm", 20, ["location_id", "date"]
    ).select("location_id", "name", "date", "daily_precipitation_mm")


@query("top3_nulls_last", f"""
, m AS (SELECT location_id, CASE WHEN count(quantity) > 500 THEN abs(avg(quantity) - 27) END AS score FROM w GROUP BY 1)
SELECT location_id, {r('score')} AS score FROM m ORDER BY score DESC NULLS LAST, location_id LIMIT 15""")
def _(t):
    scored = t.w.groupBy("location_id").agg(
        F.when(F.count("quantity") > 500, F.abs(F.avg("quantity") - 27)).alias("score")
    )
    return selection.top_n_nulls_last(scored, "score", 15, ["location_id"])


DRAW_SQL = "md5(concat_ws(':', order_id, line, location_id, timestamp, '{}'))"


@query("top4_sample_for_plot", f"""
SELECT location_id, timestamp, {r('quantity')} AS quantity, {r('price')} AS price FROM w
WHERE ('0x' || substr({DRAW_SQL.format(42)}, 1, 8))::UBIGINT / 4294967296.0 < {selection.PLOT_FRACTION['day']}
ORDER BY {DRAW_SQL.format(43)}, order_id, line LIMIT 5000""")
def _(t):
    return selection.sample_for_plot(t.w, "day", 5000, ["order_id", "line", "location_id", "timestamp"]).select(
        "location_id", "timestamp", "quantity", "price"
    )


@query("top5_sample_n", f"""
SELECT location_id, timestamp, {r('quantity')} AS quantity, {r('price')} AS price FROM w
ORDER BY {DRAW_SQL.format(42)}, order_id, line LIMIT 2000""")
def _(t):
    return selection.sample_n(t.w, 2000, ["order_id", "line", "location_id", "timestamp"]).select(
        "location_id", "timestamp", "quantity", "price"
    )


@query("top6_even_hours", f"""
, ts AS (SELECT timestamp, row_number() OVER (ORDER BY timestamp) - 1 AS i, count(*) OVER () - 1 AS last
         FROM (SELECT DISTINCT timestamp FROM s))
, pick AS (SELECT DISTINCT CASE WHEN last < 200 THEN k.j WHEN k.j = 199 THEN last ELSE CAST(floor(k.j * (last / 199)) AS BIGINT) END AS i
           FROM (SELECT max(last) AS last FROM ts), range(0, 200) k(j))
SELECT location_id, timestamp, {r('reading')} AS reading FROM s
WHERE timestamp IN (SELECT timestamp FROM ts WHERE i IN (SELECT i FROM pick))""")
def _(t):
    return selection.even_hours(t.s, 200).select("location_id", "timestamp", "reading")


# ----------------------------------------------------------- flagship query ----

@query("job_dense_daily_fact", S_FACT_SQL + f"""
SELECT location_id, date, metric, unit, {r('daily_value')} AS daily_value, observed_hours, valid_hours, is_complete, season,
       {r('''avg(daily_value) OVER (PARTITION BY location_id, metric ORDER BY date
       ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)''')} AS rolling_mean FROM s_fact""")
def _(t):
    fact = windows.rolling_days(s_fact(t), "daily_value", 30, ["location_id", "metric"], output="rolling_mean")
    return fact.select("location_id", "date", "metric", "unit", "daily_value", "observed_hours", "valid_hours",
                       "is_complete", "season", "rolling_mean")
