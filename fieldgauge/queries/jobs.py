"""Sources, sinks, jobs, streams and models on the test tables.

Queries about files first write what Spark derives from the tables to a fresh path in
the shared folder, then read it back.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from fieldgauge.functions.scalars import elevation_band
from fieldgauge.operators import filters, models, planning, reshape, selection
from fieldgauge.plans import jobs, spec
from fieldgauge.queries.aggregates import DAILY_SQL, VALID_SQL, u_enriched
from fieldgauge.queries.bindings import BAND_SQL, S_CATALOGUE, W_METRICS, r
from fieldgauge.queries.registry import query
from fieldgauge.session import staging_path
from fieldgauge.sources import lake, store
from fieldgauge.streaming import complete_days, revisions

# ------------------------------------------------------------------ sources ----


def s_lake(t) -> str:
    path = staging_path(t.spark, "lake")
    t.s.withColumn("year", F.year("timestamp")).write.partitionBy("location_id", "year").parquet(path)
    return path


@query("src1_read_lake", f"""
SELECT location_id, CAST(year(timestamp) AS BIGINT) AS year, count(*) AS n_rows, {r('avg(reading)')} AS reading FROM s
WHERE location_id IN ('click', 'view') AND timestamp >= TIMESTAMP '2024-01-10' AND timestamp < TIMESTAMP '2024-01-21' GROUP BY 1, 2""")
def _(t):
    rows = lake.read_lake(t.spark, s_lake(t)).filter(F.col("location_id").isin("click", "view"))
    return filters.between_days_of_year(rows, date(2024, 1, 10), date(2024, 1, 20)).groupBy("location_id", "year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("reading").alias("reading")
    )


CHUNK_FILES = "location_id=*/year=*/*.parquet"


def s_chunks(t, where) -> tuple[str, str]:
    """A lake of one file per site and year, and a journal with the records of some."""
    base = staging_path(t.spark, "chunks")
    lake.write_chunks(t.s, f"{base}/data")
    lake.commit_chunks(t.spark, f"{base}/data", f"{base}/commits", CHUNK_FILES, where)
    return f"{base}/data", f"{base}/commits"


@query("src2_committed_scan", f"""
SELECT location_id, count(*) AS n_rows, {r('avg(reading)')} AS reading FROM s WHERE location_id <> 'error' GROUP BY 1""")
def _(t):
    # commit records for all files but those of one site
    root, journal = s_chunks(t, F.col("location_id") != "error")
    rows = lake.committed_scan(t.spark, root, lake.commit_records(t.spark, journal), CHUNK_FILES)
    return rows.groupBy("location_id").agg(F.count(F.lit(1)).alias("n_rows"), F.avg("reading").alias("reading"))


@query("src3_explode_hourly", f"""
SELECT location_id, timestamp, {r('reading')} AS reading, {r('volume')} AS volume, year(timestamp) AS source_year FROM s""")
def _(t):
    # columnar payloads, one per site and day, as a service would deliver them
    path = staging_path(t.spark, "payload")
    hours = t.s.withColumn("_day", F.to_date("timestamp")).groupBy("location_id", "_day").agg(
        F.array_sort(F.collect_list(F.struct("timestamp", "reading", "volume"))).alias("_h")
    )
    hours.select(
        "location_id",
        F.struct(
            F.transform("_h", lambda h: F.date_format(h["timestamp"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
            F.transform("_h", lambda h: h["reading"]).alias("reading"),
            F.transform("_h", lambda h: h["volume"]).alias("volume"),
        ).alias("hourly"),
    ).write.json(path)
    payloads = t.spark.read.schema(lake.payload_schema(["reading", "volume"])).json(path)
    return lake.explode_hourly(payloads, ["reading", "volume"]).drop("ingested_at")


@query("src4_load_sites", f"""
SELECT 's_' || CAST(location_id AS VARCHAR) AS location_id, name AS query, country AS country_code, region,
       {r('latitude + location_id * 1e-7')} AS latitude, {r('longitude')} AS longitude FROM w_sites""")
def _(t):
    path = staging_path(t.spark, "sites")
    t.w_sites.select(
        F.concat(F.lit("s_"), F.col("location_id").cast("string")).alias("location_id"),
        F.col("name").alias("query"), F.col("country").alias("country_code"), "region",
        (F.col("latitude") + F.col("location_id") * 1e-7).alias("latitude"), "longitude",
    ).write.option("header", True).csv(path)
    return lake.load_sites(t.spark, path)


@query("src4_site_problems", """
SELECT count(*) AS sites, count(*) FILTER (name IS NULL OR country IS NULL OR region IS NULL) AS incomplete,
       count(*) - count(DISTINCT region) AS repeated_ids,
       count(*) - count(DISTINCT (latitude, abs(longitude))) AS repeated_coordinates,
       count(*) FILTER (NOT regexp_full_match(region, '[a-z0-9_]+')) AS bad_ids,
       count(*) FILTER (latitude * 8 NOT BETWEEN -90 AND 90) AS bad_coordinates FROM u_sites""")
def _(t):
    # regions as identifiers and folded coordinates: every kind of defect occurs
    broken = t.u_sites.select(
        F.col("region").alias("location_id"), F.col("name").alias("query"), F.col("country").alias("country_code"),
        "region", (F.col("latitude") * 8).alias("latitude"), F.abs("longitude").alias("longitude"),
    )
    return lake.site_problems(broken)


@query("src5_metric_catalogue", f"""
, c AS (SELECT * FROM (VALUES ('reading', 'Reading', 'units', 'mean'), ('volume', 'Volume', 'units/day', 'sum')) v(metric, label, unit, daily_aggregation))
, l AS (SELECT 'reading' AS metric, reading AS value FROM s UNION ALL SELECT 'volume', volume FROM s)
SELECT metric, label, unit, daily_aggregation, count(value) AS n_values,
       {r("CASE WHEN daily_aggregation = 'sum' THEN sum(value) ELSE avg(value) END")} AS value
FROM l JOIN c USING (metric) GROUP BY 1, 2, 3, 4""")
def _(t):
    catalogue = lake.metric_catalogue(t.spark, [(m, m.title(), u, a) for m, u, a in S_CATALOGUE])
    long = reshape.to_long(t.s, ["location_id"], ["reading", "volume"])
    return long.join(catalogue, "metric").groupBy("metric", "label", "unit", "daily_aggregation").agg(
        F.count("value").alias("n_values"), F.sum("value").alias("_t"), F.avg("value").alias("_m")
    ).withColumn("value", F.when(F.col("daily_aggregation") == "sum", F.col("_t")).otherwise(F.col("_m"))).drop("_t", "_m")


@query("src6_run_sql", f"""
SELECT region, count(*) AS n_rows, {r('avg(quantity)')} AS quantity FROM w_at_sites WHERE price >= 20.0 GROUP BY 1""")
def _(t):
    lake.register(t.spark, fg_readings=t.w, fg_sites=t.w_sites)
    return lake.run_sql(
        t.spark,
        "SELECT region, count(*) AS n_rows, avg(quantity) AS quantity FROM fg_readings "
        "JOIN fg_sites USING (location_id) WHERE price >= :least GROUP BY region",
        least=20.0,
    )


# -------------------------------------------------------------------- sinks ----

@query("snk1_write_table", f"""
SELECT {BAND_SQL} AS elevation_band, count(*) AS n_rows, {r('sum(price)')} AS price FROM w_at_sites
WHERE {BAND_SQL} IN ('highland', 'alpine') GROUP BY 1""")
def _(t):
    path = staging_path(t.spark, "table")
    store.write_table(t.w_at_sites.withColumn("elevation_band", elevation_band("elevation_m")), path, ["elevation_band"])
    return t.spark.read.parquet(path).filter(F.col("elevation_band").isin("highland", "alpine")).groupBy(
        "elevation_band"
    ).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("price").alias("price"))


@query("snk2_write_once", """
SELECT count(*) AS written_rows, true AS second_write_refused, count(*) AS n_rows FROM w""")
def _(t):
    path = staging_path(t.spark, "once")
    rows = store.write_once(t.w, path)
    try:
        store.write_once(t.w, path)
        refused = False
    except FileExistsError:
        refused = True
    return t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(rows).cast("bigint").alias("written_rows"), F.lit(refused).alias("second_write_refused"), "n_rows"
    )


@query("snk3_export", f"""
SELECT country, count(*) AS n_rows, {r('avg(quantity)')} AS quantity FROM w_at_sites GROUP BY 1
UNION ALL SELECT country, count(*), {r('avg(quantity)')} FROM w_at_sites GROUP BY 1""")
def _(t):
    table = t.w_at_sites.groupBy("country").agg(F.count(F.lit(1)).alias("n_rows"), F.avg("quantity").alias("quantity"))
    paths = {fmt: staging_path(t.spark, f"export-{fmt}") for fmt in ("parquet", "csv")}
    for fmt, path in paths.items():
        store.export(table, path, fmt)
    return reshape.union_all(
        t.spark.read.parquet(paths["parquet"]),
        t.spark.read.schema(table.schema).option("header", True).csv(paths["csv"]),
    )


@query("snk5_fingerprint", """
SELECT l_returnflag AS flag, count(*) AS n_rows, true AS same_in_other_order, false AS same_with_change FROM lineitem GROUP BY 1""")
def _(t):
    rows = t("lineitem").withColumnRenamed("l_returnflag", "flag")
    first = store.fingerprint(rows, ["flag"])
    again = store.fingerprint(rows.repartition(13, "l_partkey").select(*reversed(rows.columns)), ["flag"])
    changed = store.fingerprint(
        rows.withColumn("l_tax", F.when(F.col("l_linenumber") == 1, F.col("l_tax") + 0.01).otherwise(F.col("l_tax"))), ["flag"]
    )
    both = lambda df, tag: df.select("flag", F.struct("n_rows", "hash_xor", "hash_sum").alias(tag))
    return both(first, "a").join(both(again, "b"), "flag").join(both(changed, "c"), "flag").select(
        "flag", F.col("a.n_rows").alias("n_rows"), (F.col("a") == F.col("b")).alias("same_in_other_order"),
        (F.col("a") == F.col("c")).alias("same_with_change"),
    )


def u_tables(t):
    tables = jobs.derive(t.u.drop("event_id", "hour", "event_type"), t.u_sites)
    return tables


def u_release(t):
    root = staging_path(t.spark, "store")
    store.publish(t.spark, u_tables(t), root, "v1")
    return store.ReleaseStore(t.spark, root), root


@query("src7_store_read", DAILY_SQL + f"""
SELECT location_id, date, {r('daily_avg_temperature_c')} AS daily_avg_temperature_c FROM daily
WHERE elevation_band = 'alpine' AND date >= DATE '2024-01-15'""")
def _(t):
    release, _root = u_release(t)
    return release.read(
        "daily_metrics", ["location_id", "date", "daily_avg_temperature_c"],
        (F.col("elevation_band") == "alpine") & (F.col("date") >= "2024-01-15"),
    )


@query("snk4_publish", DAILY_SQL + """
SELECT 'v1' AS version, 'daily_metrics' AS table_name, count(*) AS n_rows, true AS verified FROM daily
UNION ALL SELECT 'v1', 'enriched_weather', count(*), true FROM v
UNION ALL SELECT 'v1', 'locations', count(*), true FROM u_sites
UNION ALL SELECT 'v1', 'summaries', (SELECT count(*) FROM (SELECT DISTINCT elevation_band, region, season, year FROM v)), true
UNION ALL SELECT 'v1', 'yearly_metrics', (SELECT count(*) FROM (SELECT DISTINCT location_id, year FROM v)), true
UNION ALL SELECT 'v1', 'lapse_rates', (SELECT count(*) FROM (SELECT season FROM daily WHERE daily_avg_temperature_c IS NOT NULL
     GROUP BY 1 HAVING count(DISTINCT elevation_m) > 1)), true""")
def _(t):
    release, _root = u_release(t)
    changed = release.verify().select("table_name").withColumn("_changed", F.lit(True))
    return release.manifest().join(changed, "table_name", "left").select(
        "version", "table_name", "n_rows", F.col("_changed").isNull().alias("verified")
    )


@query("snk4_release_gates", """
, gone AS (SELECT location_id FROM u_sites WHERE location_id % 10 = 3)
, planned AS (SELECT location_id, 24 AS hours FROM u_sites WHERE location_id % 10 <> 7)
, hours AS (SELECT location_id, timestamp FROM u WHERE temperature_2m IS NOT NULL)
, keyed AS (SELECT location_id, timestamp, count(*) AS n FROM hours GROUP BY 1, 2)
SELECT 'repeated_site' AS gate, 0::BIGINT AS violations
UNION ALL SELECT 'repeated_hour', (SELECT count(*) FROM keyed WHERE n > 1)
UNION ALL SELECT 'repeated_day', 0 UNION ALL SELECT 'site_without_id', 0 UNION ALL SELECT 'hour_without_key', 0
UNION ALL SELECT 'day_without_key', 0
UNION ALL SELECT 'unknown_site', (SELECT count(DISTINCT location_id) FROM hours WHERE location_id IN (FROM gone) OR location_id NOT IN (SELECT location_id FROM u_sites))
UNION ALL SELECT 'empty_locations', 0 UNION ALL SELECT 'empty_enriched_weather', 0 UNION ALL SELECT 'empty_daily_metrics', 0
UNION ALL SELECT 'planned_site_missing', (SELECT count(*) FROM planned WHERE location_id IN (FROM gone))
UNION ALL SELECT 'site_not_planned', (SELECT count(*) FROM u_sites WHERE location_id NOT IN (FROM gone) AND location_id NOT IN (SELECT location_id FROM planned))
UNION ALL SELECT 'readings_against_plan', abs((SELECT count(*) FROM hours) - (SELECT sum(hours) FROM planned))::BIGINT""")
def _(t):
    # some sites are lost after the readings were made, and the plan has others
    days = t.u.select("location_id", F.to_date("timestamp").alias("date")).distinct()
    plan = t.u_sites.filter("location_id % 10 <> 7").select("location_id", F.lit(24).alias("hours"))
    tables = {"locations": t.u_sites.filter("location_id % 10 <> 3"), "enriched_weather": t.u, "daily_metrics": days}
    return store.release_problems(tables, plan)


@query("plan3_verify_chunks", """
, c AS (SELECT DISTINCT location_id, year(timestamp) AS year FROM s)
SELECT location_id, year, CASE location_id WHEN 'error' THEN 'half_committed' WHEN 'view' THEN 'mismatch'
       WHEN 'click' THEN 'unplanned' ELSE 'verified' END AS status FROM c
UNION ALL SELECT location_id, year + 1, 'absent' FROM c WHERE location_id <> 'click'""")
def _(t):
    # one site without records, one whose files are replaced after their records, one not planned
    root, journal = s_chunks(t, F.col("location_id") != "error")
    rewrite_chunks(t, root, "view")
    named = lambda df: df.withColumns({
        "location_id": F.regexp_extract("path", "location_id=([^/]*)/", 1),
        "year": F.regexp_extract("path", "year=([0-9]+)/", 1).cast("int"),
    })
    planned = t.s.filter("location_id <> 'click'").select("location_id", F.year("timestamp").alias("year")).distinct()
    plan = planned.unionByName(planned.withColumn("year", F.col("year") + 1))
    return planning.verify_chunks(
        plan, named(lake.data_files(t.spark, root, digest=True, pattern=CHUNK_FILES)),
        named(lake.commit_records(t.spark, journal).drop("location_id")), ["location_id", "year"],
    )


def rewrite_chunks(t, root: str, site: str) -> None:
    """Put other content under the names of a site's data files."""
    files = lake.data_files(t.spark, root, pattern=f"location_id={site}/year=*/*.parquet")
    jvm, conf = t.spark.sparkContext._jvm, t.spark.sparkContext._jsc.hadoopConfiguration()
    for row in files.collect():  # one name per year
        path = jvm.org.apache.hadoop.fs.Path(row.path)
        other = staging_path(t.spark, "altered")
        t.spark.read.parquet(row.path).withColumn("volume", F.lit(0.0)).coalesce(1).write.parquet(other)
        written = t.spark.read.format("binaryFile").load(f"{other}/*.parquet").select("path").first().path
        system = path.getFileSystem(conf)
        system.delete(path, False)
        system.rename(jvm.org.apache.hadoop.fs.Path(written), path)


# --------------------------------------------------------------------- jobs ----

U_SPEC = {
    "name": "regional means",
    "source": "enriched_weather",
    "filters": {"date": ["2024-01-05", "2024-01-25"], "elevation_band": ["alpine", "highland"]},
    "group_by": ["region", "season"],
    "aggregations": {"temperature_2m": ["avg", "max", "count"], "precipitation": ["sum"]},
}
SPEC_SQL = VALID_SQL + f"""
SELECT region, season, {r('avg(temperature_2m)')} AS temperature_2m_avg, count(temperature_2m) AS temperature_2m_count,
       {r('max(temperature_2m)')} AS temperature_2m_max, {r('sum(precipitation)')} AS precipitation_sum EXTRA
FROM v WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' AND elevation_band IN ('alpine', 'highland') GROUP BY 1, 2"""


@query("agg8_run_spec", SPEC_SQL.replace("EXTRA", ""))
def _(t):
    return spec.run_spec(u_enriched(t), U_SPEC)


@query("job1_result_for", SPEC_SQL.replace("EXTRA", ", false AS first_reused, true AS second_reused"))
def _(t):
    release, root = u_release(t)
    _result, first = jobs.result_for(release, U_SPEC, f"{root}/results")
    renamed = {**U_SPEC, "name": "another name", "group_by": ["season", "region", "region"]}
    result, second = jobs.result_for(release, renamed, f"{root}/results")
    return result.withColumns({"first_reused": F.lit(first), "second_reused": F.lit(second)})


def question_sql(groups: str, how: str) -> str:
    return f"""
, dq AS (SELECT location_id, CAST(timestamp AS DATE) AS date, CASE WHEN count(reading) = 24 THEN avg(reading) END AS value FROM s
   WHERE timestamp >= TIMESTAMP '2024-01-02' AND timestamp < TIMESTAMP '2024-01-30' AND location_id IN ('click', 'view', 'error') GROUP BY 1, 2)
, st AS (SELECT DISTINCT event_type AS location_id, upper(event_type) AS name, substr(event_type, 1, 1) AS country,
                CAST(length(event_type) AS DOUBLE) AS elevation_m FROM events)
SELECT {groups}, {r(f'{how}(value)')} AS value, count(value) AS complete_days FROM dq JOIN st USING (location_id) GROUP BY ALL"""


for _group, _columns, _op, _how in (
    ("date", "date", "max", "max"), ("location", "location_id, name", "min", "min"),
    ("country", "country", "mean", "avg"), ("elevation", "location_id, name, elevation_m", "mean", "avg"),
):

    def _ask(t, group=_group, op=_op):
        c = F.col("event_type")
        sites = t("events").select(c.alias("location_id")).distinct().select(
            "location_id", F.upper("location_id").alias("name"), F.substring("location_id", 1, 1).alias("country"),
            F.length("location_id").cast("double").alias("elevation_m"),
        )
        asked = spec.Question(
            "reading", date(2024, 1, 2), date(2024, 1, 29), ("click", "view", "error"), group, op
        )
        data = spec.Dataset({"reading": "mean", "volume": "sum"}, date(2024, 1, 1), date(2024, 1, 31))
        return spec.run_question(t.s, sites, asked, data)

    query(f"agg9_question_by_{_group}", question_sql(_columns, _how))(_ask)


@query("job2_metadata", """
SELECT CAST(min(timestamp) AS DATE) AS start, CAST(max(timestamp) AS DATE) AS "end", m.metric, m.label, m.unit, m.aggregation,
       (SELECT count(DISTINCT location_id) FROM u_sites) AS sites
FROM u, (VALUES ('temperature_2m', 'Temperature', '°C', 'mean'), ('precipitation', 'Precipitation', 'mm/day', 'sum'),
  ('relative_humidity_2m', 'Relative humidity', '%', 'mean'), ('wind_speed_10m', 'Wind speed · 10 m', 'm/s', 'mean')) m(metric, label, unit, aggregation)
GROUP BY m.metric, m.label, m.unit, m.aggregation""")
def _(t):
    return jobs.metadata(t.u, t.u_sites)


EVIDENCE_SQL = {
    "location_comparison": DAILY_SQL + f"""
SELECT location_id, name, elevation_band, {r('avg(daily_avg_temperature_c)')} AS mean_daily_temperature_c,
       {r('avg(daily_precipitation_mm)')} AS mean_daily_precipitation_mm, {r('avg(daily_avg_wind_speed_ms)')} AS mean_daily_wind_ms,
       count(date) AS observed_days FROM daily GROUP BY 1, 2, 3""",
    "elevation_comparison": DAILY_SQL + f"""
, l AS (SELECT location_id, elevation_band, avg(daily_avg_temperature_c) AS a, avg(daily_precipitation_mm) AS b FROM daily GROUP BY 1, 2)
SELECT elevation_band, {r('avg(a)')} AS mean_location_temperature_c, {r('avg(b)')} AS mean_location_daily_precipitation_mm,
       count(location_id) AS locations FROM l GROUP BY 1""",
    "annual_anomalies": VALID_SQL + f"""
, yv AS (SELECT location_id, name, region, elevation_m, year, avg(temperature_2m) AS a FROM v GROUP BY ALL)
SELECT location_id, name, region, {r('elevation_m')} AS elevation_m, year, {r('a')} AS annual_avg_temperature_c,
       {r('a - lag(a) OVER (PARTITION BY location_id ORDER BY year)')} AS temperature_yoy_change_c,
       {r('a - avg(a) OVER (PARTITION BY location_id)')} AS anomaly_vs_study_mean_c FROM yv""",
    "wettest_location_days": DAILY_SQL + f"""
SELECT location_id, name, date, {r('daily_precipitation_mm')} AS daily_precipitation_mm FROM daily
WHERE daily_precipitation_mm IS NOT NULL ORDER BY daily_precipitation_mm DESC, location_id, date LIMIT 20""",
    "seasonal_lapse_rates": DAILY_SQL + f"""
SELECT season, {r('regr_slope(daily_avg_temperature_c, elevation_m)')} AS slope_c_per_m,
       {r('1000 * regr_slope(daily_avg_temperature_c, elevation_m)')} AS lapse_rate_c_per_km,
       {r('regr_intercept(daily_avg_temperature_c, elevation_m)')} AS intercept_c, {r('regr_r2(daily_avg_temperature_c, elevation_m)')} AS r2,
       {r('sqrt(regr_syy(daily_avg_temperature_c, elevation_m) * (1 - regr_r2(daily_avg_temperature_c, elevation_m)) / count(*))')} AS rmse_c,
       count(*) AS sample_size FROM daily GROUP BY 1 HAVING count(DISTINCT elevation_m) >= 2""",
}

for _table, _sql in EVIDENCE_SQL.items():

    def _evidence(t, table=_table):
        return jobs.evidence(u_tables(t))[table]

    query(f"job3_{_table}", _sql)(_evidence)


@query("job3_evidence_notes", DAILY_SQL + """
, n AS (SELECT 'location_comparison' AS table_name, (SELECT count(DISTINCT location_id) FROM daily) AS n_rows
  UNION ALL SELECT 'elevation_comparison', (SELECT count(DISTINCT elevation_band) FROM daily)
  UNION ALL SELECT 'annual_anomalies', (SELECT count(*) FROM (SELECT DISTINCT location_id, year FROM v))
  UNION ALL SELECT 'wettest_location_days', (SELECT least(20, count(daily_precipitation_mm)) FROM daily)
  UNION ALL SELECT 'seasonal_lapse_rates', (SELECT count(*) FROM (SELECT season FROM daily
     WHERE daily_avg_temperature_c IS NOT NULL GROUP BY 1 HAVING count(DISTINCT elevation_m) > 1)))
SELECT 'v1' AS version, table_name, n_rows, n_rows AS rows_read, true AS has_method FROM n""")
def _(t):
    output = staging_path(t.spark, "evidence")
    notes = jobs.write_evidence(u_tables(t), output, "v1")
    read = reshape.union_all(*[
        t.spark.read.parquet(f"{output}/{name}").agg(F.count(F.lit(1)).alias("rows_read")).select(
            F.lit(name).alias("table_name"), "rows_read") for name in EVIDENCE_SQL
    ])
    return notes.join(read, "table_name").select(
        "version", "table_name", "n_rows", "rows_read", (F.length("method") > 0).alias("has_method")
    )


@query("job4_process", DAILY_SQL + """
SELECT 'daily_metrics' AS table_name, count(*) AS n_rows FROM daily
UNION ALL SELECT 'enriched_weather', count(*) FROM v
UNION ALL SELECT 'summaries', (SELECT count(*) FROM (SELECT DISTINCT elevation_band, region, season, year FROM v))
UNION ALL SELECT 'yearly_metrics', (SELECT count(*) FROM (SELECT DISTINCT location_id, year FROM v))
UNION ALL SELECT 'lapse_rates', (SELECT count(*) FROM (SELECT season FROM daily GROUP BY 1 HAVING count(DISTINCT elevation_m) > 1))
UNION ALL SELECT 'input', (SELECT count(*) FROM u)
UNION ALL SELECT 'rejected', (SELECT count(*) FROM u) - (SELECT count(*) FROM v)""")
def _(t):
    output = staging_path(t.spark, "processed")
    counts = jobs.process(t.spark, t.u.drop("event_id", "hour", "event_type"), t.u_sites, output)
    tables = ["daily_metrics", "enriched_weather", "summaries", "yearly_metrics", "lapse_rates"]
    sizes = [
        t.spark.read.parquet(f"{output}/{n}").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
        for n in tables
    ]
    stages = t.spark.createDataFrame(
        [("input", counts["input_rows"]), ("rejected", counts["rejected_or_duplicate_rows"])],
        "table_name string, n_rows bigint",
    )
    return reshape.union_all(*sizes, stages)


# ------------------------------------------------------------------ streams ----

REVISED_SQL = """
, rev AS (SELECT location_id, timestamp, value, timestamp AS loaded_at, 'first' AS source_file, event_id AS source_row_number FROM s_raw
  UNION ALL SELECT location_id, timestamp, value + 1, timestamp + INTERVAL 9 DAY, 'second', event_id FROM s_raw
            WHERE timestamp < TIMESTAMP '2024-01-12'
  UNION ALL SELECT location_id, timestamp + INTERVAL 10 SECOND, value, timestamp + INTERVAL 9 DAY, 'second', event_id FROM s_raw
            WHERE timestamp < TIMESTAMP '2024-01-12' AND location_id = 'view')
, cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY location_id, timestamp
          ORDER BY loaded_at DESC, source_file DESC, source_row_number DESC) AS n FROM rev) WHERE n = 1)
SELECT location_id, CAST(timestamp AS DATE) AS date, count(*) AS readings, """ + r("avg(value)") + """ AS mean FROM cur GROUP BY 1, 2"""


def revisions_of(t):
    first = t.s_raw.select(
        "location_id", "timestamp", "value", F.col("timestamp").alias("loaded_at"),
        F.lit("first").alias("source_file"), F.col("event_id").alias("source_row_number"),
    )
    early = first.filter(F.col("timestamp") < F.lit("2024-01-12").cast("timestamp")).withColumns(
        {"loaded_at": F.col("loaded_at") + F.expr("interval 9 days"), "source_file": F.lit("second")}
    )
    corrected = early.withColumn("value", F.col("value") + 1)
    late = early.filter("location_id = 'view'").withColumn("timestamp", F.col("timestamp") + F.expr("interval 10 seconds"))
    return first, corrected.unionByName(late)


def day_means(rows):
    current = filters.dedupe_latest(rows, ["location_id", "timestamp"], revisions.REVISION_ORDER)
    return current.groupBy("location_id", F.to_date("timestamp").alias("date")).agg(
        F.count(F.lit(1)).alias("readings"), F.avg("value").alias("mean")
    )


@query("str1_apply_revisions", REVISED_SQL)
def _(t):
    first, second = revisions_of(t)
    return revisions.apply_revisions(first, second).groupBy("location_id", F.to_date("timestamp").alias("date")).agg(
        F.count(F.lit(1)).alias("readings"), F.avg("value").alias("mean")
    )


@query("str1_revision_stream", REVISED_SQL)
def _(t):
    base = staging_path(t.spark, "revisions")
    for n, part in enumerate(revisions_of(t)):
        part.coalesce(2).write.mode("append").parquet(f"{base}/in")
        schema = part.schema
        # each call takes what has arrived since the last one
        stream = t.spark.readStream.schema(schema).parquet(f"{base}/in")
        revisions.revision_stream(
            stream, f"{base}/raw", f"{base}/daily", day_means, f"{base}/checkpoint"
        ).awaitTermination()
    return revisions.current_days(t.spark.read.parquet(f"{base}/daily"))


@query("str2_complete_day_stream", f"""
, day AS (SELECT location_id, CAST(timestamp AS DATE) AS date, count(DISTINCT timestamp) AS hours,
     CASE WHEN count(reading) = 24 THEN avg(reading) END AS reading, count(reading) AS reading_hours,
     CASE WHEN count(volume) = 24 THEN sum(volume) END AS volume, count(volume) AS volume_hours
  FROM s WHERE location_id <> 'error' GROUP BY 1, 2)
SELECT location_id, date, {r('reading')} AS reading, reading_hours, {r('volume')} AS volume, volume_hours, hours = 24 AS streamed FROM day""")
def _(t):
    # the files of one site have no records, and the records come after the files
    metrics = {"reading": "mean", "volume": "sum"}
    root, journal = s_chunks(t, F.col("location_id") != "error")
    schema = t.spark.read.option("basePath", root).parquet(root).schema
    hours = complete_days.arriving_hours(t.spark, root, schema, CHUNK_FILES)
    days = complete_days.complete_day_stream(hours, complete_days.arriving_commits(t.spark, journal), metrics)
    base = staging_path(t.spark, "days")
    days.writeStream.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(
        f"{base}/out", format="parquet", outputMode="append"
    ).awaitTermination()
    streamed = t.spark.read.schema(days.schema).parquet(f"{base}/out")
    committed = lake.committed_scan(t.spark, root, lake.commit_records(t.spark, journal), CHUNK_FILES)
    rest = complete_days.open_days(committed, streamed, metrics)
    return streamed.withColumn("streamed", F.lit(True)).unionByName(rest.withColumn("streamed", F.lit(False)))


@query("str2_closed_day_stream", f"""
, day AS (SELECT location_id, CAST(timestamp AS DATE) AS date, CASE WHEN count(reading) = 24 THEN avg(reading) END AS reading,
     count(reading) AS reading_hours, CASE WHEN count(volume) = 24 THEN sum(volume) END AS volume, count(volume) AS volume_hours
  FROM s GROUP BY 1, 2)
SELECT location_id, date, {r('reading')} AS reading, reading_hours, {r('volume')} AS volume, volume_hours FROM day""")
def _(t):
    base = staging_path(t.spark, "days")
    t.s.write.parquet(f"{base}/in")
    metrics = {"reading": "mean", "volume": "sum"}
    days = complete_days.closed_day_stream(t.spark.readStream.schema(t.s.schema).parquet(f"{base}/in"), metrics)
    days.writeStream.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(
        f"{base}/out", format="parquet", outputMode="append"
    ).awaitTermination()
    closed = t.spark.read.schema(days.schema).parquet(f"{base}/out")
    hours = t.spark.read.schema(t.s.schema).parquet(f"{base}/in")
    return closed.unionByName(complete_days.open_days(hours, closed, metrics))


# ------------------------------------------------------------------- models ----

ML_COLUMNS = ["elevation_m", "latitude", "longitude", "month_sin", "month_cos", "year"]


def ml_rows(t):
    return models.features(t.w_at_sites.filter("quantity IS NOT NULL")).select(
        "location_id", "country", "timestamp", "order_id", "line", "quantity", *ML_COLUMNS
    )


@query("ml1_features", f"""
SELECT location_id, {r('elevation_m')} AS elevation_m, {r('latitude')} AS latitude, {r('longitude')} AS longitude,
       {r('avg(sin(2 * pi() * month(timestamp) / 12))')} AS month_sin, {r('avg(cos(2 * pi() * month(timestamp) / 12))')} AS month_cos,
       {r('avg(sin(2 * pi() * hour(timestamp) / 24))')} AS hour_sin, {r('avg(cos(2 * pi() * hour(timestamp) / 24))')} AS hour_cos,
       {r('avg(year(timestamp))')} AS year FROM w_at_sites GROUP BY 1, 2, 3, 4, elevation_m, latitude, longitude""")
def _(t):
    made = models.features(t.w_at_sites)
    return made.groupBy("location_id", "elevation_m", "latitude", "longitude").agg(
        *[F.avg(c).alias(c) for c in ("month_sin", "month_cos", "hour_sin", "hour_cos", "year")]
    )


@query("ml2_time_holdout", f"""
, cut AS (SELECT date_trunc('month', max(timestamp)) AS c FROM y)
SELECT CASE WHEN timestamp < c THEN 'train' ELSE 'test' END AS part, count(*) AS n_rows, CAST(min(timestamp) AS DATE) AS first_day,
       CAST(max(timestamp) AS DATE) AS last_day, {r('avg(value)')} AS mean FROM y, cut GROUP BY 1""")
def _(t):
    return reshape.union_all(*[
        part.select(F.lit(name).alias("part"), "timestamp", "value")
        for name, part in zip(("train", "test"), models.time_holdout(t.y))
    ]).groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.to_date(F.min("timestamp")).alias("first_day"),
        F.to_date(F.max("timestamp")).alias("last_day"), F.avg("value").alias("mean"),
    )


@query("ml3_chronological_split", f"""
, p AS (SELECT CASE WHEN timestamp + INTERVAL 6 HOUR < TIMESTAMP '2024-01-15' THEN 'train'
   WHEN timestamp >= TIMESTAMP '2024-01-15' AND timestamp + INTERVAL 6 HOUR < TIMESTAMP '2024-01-22 12:00' THEN 'validation'
   WHEN timestamp >= TIMESTAMP '2024-01-22 12:00' THEN 'test' END AS part, value FROM s_raw)
SELECT part, count(*) AS n_rows, {r('avg(value)')} AS mean FROM p WHERE part IS NOT NULL GROUP BY 1""")
def _(t):
    parts = models.chronological_split(t.s_raw, datetime(2024, 1, 15), datetime(2024, 1, 22, 12), 6)
    return reshape.union_all(*[
        part.select(F.lit(name).alias("part"), "value") for name, part in zip(("train", "validation", "test"), parts)
    ]).groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"), F.avg("value").alias("mean"))


# rows of the models, and the part of them before the last month
ML_SQL = """
, ml AS (SELECT location_id, country, timestamp, quantity, elevation_m FROM w_at_sites WHERE quantity IS NOT NULL)
, cut AS (SELECT date_trunc('month', max(timestamp)) AS c FROM ml)"""


@query("ml4_compare_models", ML_SQL + f"""
, b AS (SELECT avg(quantity) AS m FROM ml, cut WHERE timestamp < c)
, t AS (SELECT count(*) AS n, avg(abs(quantity - m)) AS mae, sqrt(avg(pow(quantity - m, 2))) AS rmse FROM ml, cut, b WHERE timestamp >= c)
SELECT name AS model, n AS test_rows, {r('mae')} AS baseline_mae, {r('rmse')} AS baseline_rmse, true AS near_baseline, name = 'mean baseline' AS is_baseline
FROM t, (VALUES ('mean baseline'), ('linear regression'), ('random forest'), ('gradient boosting')) v(name)""")
def _(t):
    # the quantities are random, so no model can do much better or worse than their mean
    train, test = models.time_holdout(ml_rows(t))
    table, _fitted = models.compare_models(train, test, "quantity", ML_COLUMNS)
    named = F.col("model") == "mean baseline"
    ends = table.filter(named).agg(F.struct(F.first("mae").alias("mae"), F.first("rmse").alias("rmse"))).scalar()
    rows = test.agg(F.count("quantity")).scalar()
    ratio = F.col("rmse") / ends["rmse"]
    return table.select(
        "model", rows.alias("test_rows"), ends["mae"].alias("baseline_mae"), ends["rmse"].alias("baseline_rmse"),
        ratio.between(0.8, 1.25).alias("near_baseline"), (named & (F.col("rmse") == ends["rmse"])).alias("is_baseline"),
    )


PREDICTED_SQL = """
, pr AS (SELECT location_id, region, price AS actual, avg(price) OVER (PARTITION BY location_id) AS prediction FROM w_at_sites)"""


def w_predicted(t):
    means = t.w.groupBy("location_id").agg(F.avg("price").alias("prediction"))
    return t.w_at_sites.join(means, "location_id").select("location_id", "region", F.col("price").alias("actual"), "prediction")


@query("ml5_evaluate", PREDICTED_SQL + f"""
SELECT region, {r('avg(abs(actual - prediction))')} AS mae, {r('sqrt(avg(pow(actual - prediction, 2)))')} AS rmse,
       {r('1 - sum(pow(actual - prediction, 2)) / (var_pop(actual) * count(*))')} AS r2 FROM pr GROUP BY 1""")
def _(t):
    return models.evaluate(w_predicted(t), "actual", by=["region"])


@query("ml6_error_by_site", PREDICTED_SQL + f"SELECT location_id, {r('avg(abs(actual - prediction))')} AS mae FROM pr GROUP BY 1")
def _(t):
    return models.error_by_site(w_predicted(t), "actual")


@query("ml7_expanding_folds", """
, ts AS (SELECT timestamp, row_number() OVER (ORDER BY timestamp) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT timestamp FROM s))
, f AS (SELECT timestamp, CASE WHEN i < n - (n // 5) * 4 THEN 0 ELSE (i - (n - (n // 5) * 4)) // (n // 5) + 1 END AS fold FROM ts)
, rr AS (SELECT s.timestamp, fold FROM s JOIN f USING (timestamp))
SELECT k.i AS fold, (SELECT min(timestamp) FROM rr) AS train_start, (SELECT max(timestamp) FROM rr WHERE fold < k.i) AS train_end,
       (SELECT min(timestamp) FROM rr WHERE fold = k.i) AS validation_start, (SELECT max(timestamp) FROM rr WHERE fold = k.i) AS validation_end,
       CAST((SELECT count(*) FROM rr WHERE fold < k.i) AS BIGINT) AS train_rows, (SELECT count(*) FROM rr WHERE fold = k.i) AS validation_rows
FROM range(1, 5) k(i)""")
def _(t):
    return models.expanding_folds(t.s, 4)


def listed(choices) -> str:
    return ", ".join("({}, '{}')".format(n, str(dict(c)).replace("'", "''")) for n, c in enumerate(choices))


@query("ml8_random_search", ML_SQL + f"""
, tr AS (SELECT timestamp, quantity FROM ml, cut WHERE timestamp < c)
, st AS (SELECT timestamp, row_number() OVER (ORDER BY timestamp) - 1 AS i, count(*) OVER () - 1 AS last FROM (SELECT DISTINCT timestamp FROM tr))
, pick AS (SELECT DISTINCT CASE WHEN last < 400 THEN k WHEN k = 399 THEN last ELSE CAST(floor(k * (last / 399::DOUBLE)) AS BIGINT) END AS i
           FROM (SELECT DISTINCT last FROM st), range(0, 400) x(k) WHERE k <= last)
, tu AS (SELECT timestamp, row_number() OVER (ORDER BY timestamp) - 1 AS i, count(*) OVER () AS n FROM st JOIN pick USING (i))
, fo AS (SELECT timestamp, CASE WHEN i < n - (n // 5) * 4 THEN 0 ELSE (i - (n - (n // 5) * 4)) // (n // 5) + 1 END AS fold FROM tu)
, rr AS (SELECT quantity, fold FROM tr JOIN fo USING (timestamp))
, part AS (SELECT k.i AS fold, (SELECT count(*) FROM rr WHERE fold < k.i) AS train_rows, (SELECT count(*) FROM rr WHERE fold = k.i) AS rows,
           (SELECT sqrt(avg(pow(quantity - (SELECT avg(quantity) FROM rr WHERE fold < k.i), 2))) FROM rr WHERE fold = k.i) AS base FROM range(1, 5) k(i))
SELECT candidate::BIGINT AS candidate, fold, parameters, train_rows, rows, {r('base')} AS baseline_rmse, true AS near_baseline
FROM part, (VALUES {listed(models.candidates())}) v(candidate, parameters)""")
def _(t):
    train, _test = models.time_holdout(ml_rows(t))
    table, _best, _model = models.random_search(
        train, "quantity", ML_COLUMNS, models.candidates(), tuning=selection.even_hours(train, 400)
    )
    return table.withColumn("near_baseline", (F.col("rmse") / F.col("baseline_rmse")).between(0.8, 1.25)).drop("rmse")


def forest(t):
    train, test = models.time_holdout(ml_rows(t))
    kept = models.for_many_passes(train.select("quantity", *ML_COLUMNS))
    grown = models.default_models("quantity")["random forest"].setParams(**models.grown_from_cached_nodes(t.spark))
    model = models.assembled(grown, ML_COLUMNS).fit(kept)
    kept.unpersist()
    return model, test


FEATURES_SQL = f"""
, v AS (SELECT * FROM (VALUES {', '.join(f"('{c}')" for c in ML_COLUMNS)}) v(feature))"""


@query("ml9_permutation_importance", FEATURES_SQL + "SELECT feature, true AS near_zero, true AS spread_is_smaller FROM v")
def _(t):
    # the target is random, so no feature is worth much, however the forest uses it
    model, test = forest(t)
    found = models.permutation_importance(
        model, test, "quantity", ML_COLUMNS, ["order_id", "line", "location_id", "timestamp"]
    )
    return found.select("feature", (F.abs("importance") < 0.5).alias("near_zero"), F.col("spread").between(0, 0.5).alias("spread_is_smaller"))


@query("ml10_split_importance", FEATURES_SQL + "SELECT feature, true AS is_share, true AS shares_add_up FROM v")
def _(t):
    found = models.split_importance(forest(t)[0], ML_COLUMNS, t.spark)
    total = found.agg(F.sum("split_importance")).scalar()
    return found.select(
        "feature", F.col("split_importance").between(0, 1).alias("is_share"), (F.abs(total - 1) < 1e-9).alias("shares_add_up")
    )


def site_features(t):
    return t.w_at_sites.groupBy("location_id", "country", "elevation_m").agg(*[F.avg(m).alias(m) for m in W_METRICS])


@query("ml11_group_kfold", f"""
, f AS (SELECT location_id, country, any_value(elevation_m) AS elevation_m FROM w_at_sites GROUP BY 1, 2)
SELECT location_id, country, {r('elevation_m')} AS actual, true AS baseline_without_group, true AS within_range FROM f""")
def _(t):
    rows = site_features(t)
    held, _ = models.group_kfold(rows, "elevation_m", W_METRICS, "country")
    # the mean of the training rows follows from what is left out
    total = rows.agg(F.struct(F.sum("elevation_m").alias("s"), F.count("elevation_m").alias("n"), F.min("elevation_m").alias("lo"),
                              F.max("elevation_m").alias("hi"))).scalar()
    parts = held.groupBy("fold").agg(F.sum("actual").alias("_s"), F.count("actual").alias("_n"))
    mean = (total["s"] - F.col("_s")) / (total["n"] - F.col("_n"))
    return held.join(parts, "fold").select(
        "location_id", "country", "actual", (F.abs(F.col("baseline") - mean) < 1e-6).alias("baseline_without_group"),
        F.col("prediction").between(total["lo"], total["hi"]).alias("within_range"),
    )


@query("ml11_fold_importance", f"""
, f AS (SELECT DISTINCT location_id, country FROM w_at_sites)
SELECT (SELECT count(*) FROM f) AS sites, feature, CAST(5 AS BIGINT) AS folds, true AS shares_add_up
FROM (VALUES {', '.join(f"('{m}')" for m in W_METRICS)}) v(feature)""")
def _(t):
    _, importance = models.group_kfold(site_features(t), "elevation_m", W_METRICS, "country", importance_repeats=5)
    whole = importance.groupBy("fold").agg(F.sum("split_importance").alias("_all"), F.first("test_rows").alias("_rows"))
    sites = whole.agg(F.sum("_rows")).scalar()
    return importance.join(whole, "fold").groupBy("feature").agg(
        F.count("importance").alias("folds"), F.bool_and(F.abs(F.col("_all") - 1) < 1e-9).alias("shares_add_up")
    ).select(sites.alias("sites"), "feature", "folds", "shares_add_up")


@query("ml12_weighted_importance", f"""
, f AS (SELECT region, year(timestamp) AS fold, count(quantity) AS w, avg(quantity) AS v FROM w_at_sites GROUP BY 1, 2)
, m AS (SELECT region, sum(w * v) / sum(w) AS m FROM f GROUP BY 1)
SELECT region, {r('any_value(m)')} AS mean_importance, {r('sqrt(sum(w * pow(v - m, 2)) / sum(w))')} AS fold_spread
FROM f JOIN m USING (region) GROUP BY 1""")
def _(t):
    folds = t.w_at_sites.groupBy("region", F.year("timestamp").alias("fold")).agg(
        F.count("quantity").alias("w"), F.avg("quantity").alias("v")
    )
    return models.weighted_importance(folds, "v", "w", ["region"])

