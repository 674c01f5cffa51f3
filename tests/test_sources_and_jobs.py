"""Readers, sinks, the release store, jobs and streams on written files."""

import hashlib
import json
import os
from datetime import datetime, timedelta, timezone

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fieldgauge.operators import daily, planning
from fieldgauge.plans import jobs
from fieldgauge.sources import lake, store
from fieldgauge.streaming import complete_days, revisions

UTC = timezone.utc


@pytest.fixture
def raw_root(tmp_path):
    """Two committed files and one without its record; then a second day of 23 hours."""
    def add(site, name, start, hours, committed=True):
        folder = tmp_path / f"location_id={site}" / "year=2024"
        folder.mkdir(parents=True, exist_ok=True)
        stamps = pd.date_range(start, periods=hours, freq="h", tz="UTC").as_unit("us")
        path = folder / f"weather{name}.parquet"
        pd.DataFrame({"timestamp": stamps, "temperature_2m": 20.0, "precipitation": 2.0}).to_parquet(path, index=False)
        if committed:
            record = {"request": {"location_id": site, "start": start, "end": start},
                      "sha256": hashlib.sha256(path.read_bytes()).hexdigest()}
            (folder / f"_source{name}.json").write_text(json.dumps(record, indent=1))

    add("a", "-1", "2024-01-01", 24)
    add("a", "-2", "2024-01-02", 23)
    add("b", "-1", "2024-01-01", 24, committed=False)
    return tmp_path


def test_committed_scan_and_preview(spark, raw_root):
    rows = lake.committed_scan(spark, str(raw_root))
    assert rows.count() == 47 and [r[0] for r in rows.select("location_id").distinct().collect()] == ["a"]
    from datetime import date

    days = daily.preview_daily(rows, "precipitation", "sum", date(2024, 1, 1), date(2024, 1, 3), ["a", "b"])
    assert sorted((r.date.day, r.precipitation, r.observed_hours) for r in days.collect()) == [(1, 48.0, 24), (2, None, 23)]


def test_verify_committed_files(spark, raw_root):
    files = lake.data_files(spark, str(raw_root), digest=True)
    records = lake.sidecars(spark, str(raw_root))
    local = F.regexp_replace("path", "^file:/+", "/")
    status = planning.verify_chunks(
        files.select(local.alias("path")), files.select(local.alias("path"), "sha256"),
        records.select(local.alias("path"), "recorded_sha256"), ["path"])
    found = {r.path.split("location_id=")[1]: r.status for r in status.collect()}
    assert found == {
        "a/year=2024/weather-1.parquet": "verified", "a/year=2024/weather-2.parquet": "verified",
        "b/year=2024/weather-1.parquet": "half_committed",
    }


def test_lake_prunes_partitions(spark, raw_root):
    df = lake.read_lake(spark, str(raw_root)).filter("location_id = 'a' and year = 2024").select("temperature_2m")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(location_id" in plan and "ReadSchema: struct<temperature_2m:double>" in plan


def test_payload(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps(
        {"location_id": "a", "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "t": [1, None], "r": [None, None]}}))
    payload = spark.read.schema(lake.payload_schema(["t", "r"])).json(str(tmp_path))
    out = lake.explode_hourly(payload, ["t", "r"])
    assert dict(out.dtypes)["r"] == "double"
    assert [(r.timestamp.hour, r.t, r.r, r.source_year) for r in out.orderBy("timestamp").collect()] == [
        (0, 1.0, None, 2024), (1, None, None, 2024)]
    with pytest.raises(ValueError, match="snow"):
        lake.explode_hourly(payload, ["t", "snow"])
    (tmp_path / "q.json").write_text(json.dumps({"location_id": "b", "hourly": {"time": ["2024-01-01T00:00"], "t": [1, 2], "r": [1]}}))
    broken = spark.read.schema(lake.payload_schema(["t", "r"])).json(str(tmp_path / "q.json"))
    with pytest.raises(PySparkException, match="equal length"):
        lake.explode_hourly(broken, ["t", "r"]).collect()


HEAD = "location_id,query,country_code,region,latitude,longitude\n"


@pytest.mark.parametrize("body,problem", [
    ("a,A,LK,R,6,80\na,B,LK,R,7,80\n", "repeated_ids"), ("a,A,LK,R,6,80\nb,B,LK,R,6,80\n", "repeated_coordinates"),
    ("A-1,A,LK,R,6,80\n", "bad_ids"), ("a,A,LK,R,96,80\n", "bad_coordinates"), ("a,,LK,R,6,80\n", "incomplete"),
    ("a,A,LK,R,north,80\n", "incomplete"), ("", "empty"),
])
def test_site_catalogue_defects(spark, tmp_path, body, problem):
    path = tmp_path / "sites.csv"
    path.write_text(HEAD + body)
    with pytest.raises(ValueError, match=problem):
        lake.load_sites(spark, str(path))
    path.write_text(HEAD + "a,A,LK,R,6,80\n")
    assert lake.load_sites(spark, str(path)).count() == 1
    path.write_text("location_id\na\n")
    with pytest.raises(ValueError, match="lacks columns"):
        lake.load_sites(spark, str(path))


READING = ("location_id string, timestamp timestamp, temperature_2m double, precipitation double, "
           "wind_speed_10m double, relative_humidity_2m double, source_year int, ingested_at timestamp")
SITES = ("location_id string, name string, country string, region string, latitude double, "
         "longitude double, elevation_m double")


@pytest.fixture
def tables(spark):
    rows = [(s, datetime(2024, 1, d, h, tzinfo=UTC), t + d, rain, 2.0, 50.0, 2024, datetime(2024, 2, 1, tzinfo=UTC))
            for s, t, rain in (("low", 20.0, 1.0), ("high", 10.0, 0.75)) for d in (1, 2) for h in (0, 1)]
    sites = spark.createDataFrame(
        [("low", "Low", "LK", "R", 6.0, 80.0, 5.0), ("high", "High", "LK", "R", 7.0, 81.0, 1800.0)], SITES)
    return jobs.derive(spark.createDataFrame(rows, READING), sites)


def test_publish_reuse_and_evidence(spark, tables, tmp_path):
    root = str(tmp_path / "store")
    manifest = store.publish(spark, tables, root, "v1")
    assert {r.table_name: r.n_rows for r in manifest.collect()}["enriched_weather"] == 8
    twice = {**tables, "enriched_weather": tables["enriched_weather"].union(tables["enriched_weather"])}
    with pytest.raises(ValueError, match="repeated_hour"):
        store.publish(spark, twice, root, "v2")
    with pytest.raises(FileExistsError):
        store.publish(spark, tables, root, "v1")
    with pytest.raises(ValueError, match="version"):
        store.publish(spark, tables, root, "../v3")
    with pytest.raises(ValueError, match="lacks columns"):
        store.publish(spark, {**tables, "summaries": tables["summaries"].drop("season")}, root, "v4")
    release = store.ReleaseStore(spark, root)
    assert release.version == "v1" and release.verify().count() == 0
    with pytest.raises(ValueError):
        release.read("secrets")
    job = {"source": "enriched_weather", "group_by": ["location_id"], "aggregations": {"temperature_2m": ["avg", "count"]}}
    result, reused = jobs.result_for(release, job, f"{root}/results")
    assert not reused and sorted(map(tuple, result.collect())) == [("high", 11.5, 4), ("low", 21.5, 4)]
    again, reused = jobs.result_for(release, {**job, "name": "other"}, f"{root}/results")
    assert reused and again.count() == 2
    bounded = {**job, "filters": {"date": ["2024-01-02", "2024-01-02"], "location_id": ["low"]}}
    assert [tuple(r) for r in jobs.result_for(release, bounded, f"{root}/results")[0].collect()] == [("low", 22.0, 2)]
    none = {**job, "filters": {"location_id": ["nowhere"]}}
    assert jobs.result_for(release, none, f"{root}/results")[0].count() == 0
    bands = {r.elevation_band: r for r in jobs.evidence(tables)["elevation_comparison"].collect()}
    assert bands["lowland"].mean_location_temperature_c == 21.5
    assert bands["highland"].mean_location_daily_precipitation_mm == 1.5


def test_release_against_the_study_plan(spark, tables, tmp_path):
    root = str(tmp_path / "store")
    hours = lambda *chunks: spark.createDataFrame(chunks, "location_id string, year int, hours int")
    failing = {
        "planned_site_missing": hours(("low", 2024, 4), ("high", 2024, 2), ("other", 2024, 2)),
        "site_not_planned": hours(("low", 2024, 8)),
        "readings_against_plan": hours(("low", 2024, 5), ("high", 2024, 4)),
    }
    for gate, plan in failing.items():
        found = {r.gate: r.violations for r in store.release_problems(tables, plan).filter("violations > 0").collect()}
        assert list(found) == [gate]
        with pytest.raises(ValueError, match=gate):
            store.publish(spark, tables, root, "v1", plan=plan)
    whole = hours(("low", 2024, 4), ("high", 2024, 4))
    # two of 24 hours of each day are there: the study is not covered
    with pytest.raises(ValueError, match="missing hours"):
        store.publish(spark, tables, root, "v1", plan=whole)
    # a version that failed can be published again
    assert store.publish(spark, tables, root, "v1").count() == 6
    surplus = {**tables, "enriched_weather": tables["enriched_weather"].unionByName(
        tables["enriched_weather"].limit(1).withColumn("location_id", F.lit("ghost")))}
    found = {r.gate: r.violations for r in store.release_problems(surplus, whole).collect()}
    assert (found["unknown_site"], found["readings_against_plan"], found["repeated_hour"]) == (1, 1, 0)
    lost = tables["enriched_weather"].withColumn("timestamp", F.when(F.hour("timestamp") > 0, F.col("timestamp")))
    found = {r.gate: r.violations for r in store.release_problems({**tables, "enriched_weather": lost}).collect()}
    assert found["hour_without_key"] == 4
    none = {n: df.limit(0) for n, df in tables.items()}
    found = {r.gate for r in store.release_problems(none).filter("violations > 0").collect()}
    assert found == {"empty_locations", "empty_enriched_weather", "empty_daily_metrics"}


def test_each_table_is_read_once_for_all_gates(spark, tables, tmp_path):
    store.publish(spark, tables, str(tmp_path / "s"), "v1")
    release = store.ReleaseStore(spark, str(tmp_path / "s"))
    plan = store.release_problems({n: release.read(n) for n in tables})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3


def test_evidence_is_written_with_its_notes(spark, tables, tmp_path):
    notes = {r.table_name: r for r in jobs.write_evidence(tables, str(tmp_path / "e"), "v1").collect()}
    assert set(notes) == set(jobs.EVIDENCE_METHODS)
    for name, note in notes.items():
        held = spark.read.parquet(str(tmp_path / "e" / name))
        assert (note.n_rows, note.columns, note.method) == (held.count(), held.columns, jobs.EVIDENCE_METHODS[name])
    with pytest.raises(FileExistsError):
        jobs.write_evidence(tables, str(tmp_path / "e"), "v1")


def test_fingerprint_sees_content_only(spark, tables):
    df = tables["enriched_weather"]
    text = store.fingerprint_text(df)
    assert text == store.fingerprint_text(df.repartition(5).select(*reversed(df.columns)))
    assert text != store.fingerprint_text(df.withColumn("name", F.lit("x")))
    assert text != store.fingerprint_text(df.limit(7))


def test_process_counts(spark, tmp_path):
    stamp = lambda h: datetime(2024, 1, 1, h, tzinfo=UTC)
    good = ("a", stamp(0), 20.0, 1.0, 2.0, 50.0, 2024, stamp(0))
    rows = [good, good, ("a", stamp(1), 200.0, 1.0, 2.0, 50.0, 2024, stamp(0)), ("z", stamp(0), 20.0, 1.0, 2.0, 50.0, 2024, stamp(0))]
    sites = spark.createDataFrame([("a", "A", "LK", "R", 6.0, 80.0, 5.0)], SITES)
    counts = jobs.process(spark, spark.createDataFrame(rows, READING), sites, str(tmp_path / "out"))
    assert counts == {"input_rows": 4, "validated_rows": 2, "rejected_or_duplicate_rows": 2,
                      "unmatched_site_rows": 1, "output_rows": 1, "daily_rows": 1}
    assert spark.read.parquet(str(tmp_path / "out/enriched_weather")).filter("elevation_band = 'lowland'").count() == 1


def test_revisions_backfill_and_correction(spark):
    schema = "location_id string, timestamp timestamp, v double, loaded_at timestamp, source_file string, source_row_number int"
    t = lambda d, h=0: datetime(2024, 1, d, h, tzinfo=UTC)
    first = spark.createDataFrame([("a", t(5), 20.0, t(6), "f1", 1)], schema)
    later = spark.createDataFrame([("a", t(5), 22.0, t(7), "f2", 1), ("a", t(4), 18.0, t(7), "f2", 2)], schema)
    for left, right in ((first, later), (later, first)):
        now = revisions.apply_revisions(left, right)
        assert sorted((r.timestamp.day, r.v) for r in now.collect()) == [(4, 18.0), (5, 22.0)]
    same = revisions.apply_revisions(first, first)
    assert same.count() == 1


def test_halo_rebuild_equals_a_full_one(spark):
    from fieldgauge.operators.windows import rolling_days

    raw = spark.range(75).select(
        F.lit("a").alias("location_id"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
        F.col("id").cast("double").alias("v")).withColumn("timestamp", F.col("day").cast("timestamp"))

    def build(rows):
        days = rows.groupBy("location_id", F.to_date("timestamp").alias("date")).agg(F.avg("v").alias("v"))
        return rolling_days(days, "v", 30, output="v30")

    touched = revisions.touched_days(raw.filter("day = '2024-02-10'"), halo_days=29)
    part = revisions.recompute_affected(raw, touched, build, halo_days=29)
    full = {r.date: r.v30 for r in build(raw.drop("day")).collect()}
    got = {r.date: r.v30 for r in part.collect()}
    assert len(got) == 30 and all(full[d] == v for d, v in got.items())


def test_revision_log_opens_the_touched_days_only(spark, tmp_path):
    schema = "location_id string, timestamp timestamp, v double, loaded_at timestamp, source_file string, source_row_number int"
    t = lambda d, h=0: datetime(2024, 1, d, h, tzinfo=UTC)
    batches = [
        [("a", t(d, h), float(d), t(20), "f1", h) for d in range(1, 11) for h in (0, 1)],
        [("a", t(3), 30.0, t(21), "f2", 1), ("b", t(3), 7.0, t(21), "f2", 2)],
        [("a", t(3), 31.0, t(22), "f3", 1), ("a", t(9, 5), 90.0, t(22), "f3", 2)],
    ]
    build = lambda rows: revisions.apply_revisions(rows, rows.limit(0)).groupBy(
        "location_id", F.to_date("timestamp").alias("date")).agg(F.avg("v").alias("v"), F.count("v").alias("n"))
    log, daily_path = str(tmp_path / "log"), str(tmp_path / "daily")
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(spark.createDataFrame([], schema).schema).parquet(str(tmp_path / "in"))
        revisions.revision_stream(stream, log, daily_path, build, str(tmp_path / "ck")).awaitTermination()
    whole = spark.createDataFrame([r for rows in batches for r in rows], schema)
    key = lambda df: sorted(map(tuple, df.select("location_id", "date", "v", "n").collect()))
    assert key(revisions.current_days(spark.read.parquet(daily_path))) == key(build(whole))
    days = spark.createDataFrame([("2024-01-03",), ("2024-01-09",), ("2024-02-01",)], "day string").select(F.col("day").cast("date"))
    read = lambda path, upto: revisions.revisions_of_days(spark, path, whole.schema, days, upto)
    files = {f.split("/log/")[1].rsplit("/", 1)[0] for f in read(log, 9).inputFiles()}
    assert files == {"day=2024-01-03/batch=0", "day=2024-01-03/batch=1", "day=2024-01-03/batch=2", "day=2024-01-09/batch=0", "day=2024-01-09/batch=2"}
    assert read(log, 0).count() == 4 and read(log, 9).count() == 8
    # a batch that is run again adds nothing
    revisions.append_revisions(spark.createDataFrame(batches[1], schema), log, 1)
    assert read(log, 9).count() == 8
    short = str(tmp_path / "short")
    revisions.compact(spark, log, short, whole.schema)
    assert read(short, 0).count() == 6 and len(read(short, 0).inputFiles()) == 2
    assert key(build(spark.read.parquet(short).drop("day", "batch"))) == key(build(whole))
    revisions.append_revisions(spark.createDataFrame([("a", t(3), 32.0, t(23), "f4", 1)], schema), short, 3)
    assert {r.v for r in build(read(short, 3).drop("day")).filter("date = '2024-01-03' and location_id = 'a'").collect()} == {17.5}


def test_a_failed_writer_does_not_block_the_next(spark, tmp_path):
    half = tmp_path / "key" / "attempt-dead"
    half.mkdir(parents=True)
    (half / "part-0.parquet").write_bytes(b"half")
    assert store.finished_attempt(spark, str(tmp_path / "key")) is None
    path = store.fresh_attempt(str(tmp_path / "key"))
    assert store.write_once(spark.range(3), path) == 3
    assert store.finished_attempt(spark, str(tmp_path / "key")).endswith(path.rpartition("/")[2])


def test_closed_day_stream(spark, tmp_path):
    hours = spark.range(24 * 5).select(
        F.lit("a").alias("location_id"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int"))).alias("timestamp"),
        F.lit(2.0).alias("rain"))
    held = hours.filter("timestamp <> '2024-01-02 05:00:00'")
    held.unionByName(held).write.parquet(str(tmp_path / "in"))  # every hour twice
    stream = spark.readStream.schema(hours.schema).parquet(str(tmp_path / "in"))
    days = complete_days.closed_day_stream(stream, {"rain": "sum"}, "1 hour")
    days.writeStream.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(
        str(tmp_path / "out"), format="parquet", outputMode="append").awaitTermination()
    got = sorted((r.date.day, r.rain, r.rain_hours) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    # the last day stays open behind the watermark
    assert got == [(1, 48.0, 24), (2, None, 23), (3, 48.0, 24), (4, 48.0, 24)]


class CommitLake:
    """Files and records that arrive one by one, each at a stated time."""

    FILES = "location_id=*/year=*/weather*.parquet"

    def __init__(self, spark, base):
        self.spark, self.base = spark, base
        (base / "commits").mkdir()

    def _arrive(self, path, day):
        stamp = datetime(2025, 1, day, tzinfo=UTC).timestamp()
        os.utime(path, (stamp, stamp))

    def data(self, name, day, stamps, value=2.0, site="a"):
        path = self.base / "data" / f"location_id={site}" / "year=2024" / f"weather-{name}.parquet"
        path.parent.mkdir(parents=True, exist_ok=True)
        pd.DataFrame({"timestamp": pd.DatetimeIndex(stamps).as_unit("us"), "rain": value}).to_parquet(path, index=False)
        self._arrive(path, day)
        return path

    def record(self, path, day, start, end, site="a"):
        file = self.base / "commits" / f"{site}-{path.stem}.json"
        file.write_text(json.dumps({"path": str(path), "sha256": "", "request": {"location_id": site, "start": start, "end": end}}))
        self._arrive(file, day)

    def run(self):
        """The days that came out by now, after one more call of the stream."""
        schema = "timestamp timestamp, rain double, location_id string, year int"
        from pyspark.sql.types import _parse_datatype_string

        hours = complete_days.arriving_hours(self.spark, str(self.base / "data"), _parse_datatype_string(schema), self.FILES)
        commits = complete_days.arriving_commits(self.spark, str(self.base / "commits"))
        days = complete_days.complete_day_stream(hours, commits, {"rain": "sum"}, "1 day", timedelta(days=5))
        days.writeStream.option("checkpointLocation", str(self.base / "ck")).trigger(availableNow=True).start(
            str(self.base / "out"), format="parquet", outputMode="append").awaitTermination()
        found = self.spark.read.schema(days.schema).parquet(str(self.base / "out")).collect()
        return sorted((r.location_id, r.date.day, r.rain, r.rain_hours) for r in found)


def test_complete_day_stream(spark, tmp_path):
    at = lambda start, n: pd.date_range(start, periods=n, freq="h", tz="UTC")
    held = CommitLake(spark, tmp_path)
    # a whole day and half of the next; the data comes before its record
    first = held.data("1", 1, at("2024-03-01", 36))
    assert held.run() == []
    held.record(first, 1, "2024-03-01", "2024-03-02")
    assert held.run() == [("a", 1, 48.0, 24)]
    # the other half, with three hours again under other values, and a file that has no record
    second = held.data("2", 2, at("2024-03-02 09:00", 15), 3.0)
    held.data("3", 2, at("2024-03-03", 24))
    held.record(second, 2, "2024-03-02", "2024-03-02")
    whole = [("a", 1, 48.0, 24), ("a", 2, 12 * 2.0 + 12 * 3.0, 24)]
    assert held.run() == whole
    # an earlier year may come later; a day of 23 hours waits
    short = held.data("4", 3, at("2023-06-05", 23), site="b")
    old = held.data("5", 3, at("2022-06-07", 24), site="b")
    held.record(short, 3, "2023-06-05", "2023-06-05", site="b")
    held.record(old, 3, "2022-06-07", "2022-06-07", site="b")
    whole.append(("b", 7, 48.0, 24))
    assert held.run() == sorted(whole)
    # later arrivals move the clock on: the incomplete day is closed, the file without record goes
    for day in (12, 20):
        later = held.data(f"9{day}", day, at(f"2024-05-{day}", 24), site="c")
        held.record(later, day, f"2024-05-{day}", f"2024-05-{day}", site="c")
        whole.append(("c", day, 48.0, 24))
        held.run()
    assert held.run() == sorted([*whole, ("b", 5, None, 23)])


def test_commit_journal(spark, tmp_path):
    rows = spark.range(60).select(
        F.concat(F.lit("s"), F.col("id") % 3).alias("location_id"), F.col("id").cast("double").alias("v"),
        (F.lit("2024-12-31").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int"))).alias("timestamp"))
    root, journal = str(tmp_path / "data"), str(tmp_path / "commits")
    files = "location_id=*/year=*/*.parquet"
    lake.write_chunks(rows, root)
    assert lake.commit_records(spark, journal).count() == 0
    lake.commit_chunks(spark, root, journal, files, F.col("location_id") == "s1")
    lake.commit_chunks(spark, root, journal, files, F.col("location_id") != "s2")
    records = lake.commit_records(spark, journal).collect()
    assert sorted((r.location_id, str(r.start), str(r.end)) for r in records) == [
        (s, a, b) for s in ("s0", "s1") for a, b in (("2024-12-31", "2024-12-31"), ("2025-01-01", "2025-01-02"))]
    assert all(hashlib.sha256(open(r.path, "rb").read()).hexdigest() == r.recorded_sha256 for r in records)
    committed = lake.committed_scan(spark, root, lake.commit_records(spark, journal), files)
    assert committed.count() == 40 and committed.filter("location_id = 's2'").isEmpty()


def test_only_select_is_run(spark):
    with pytest.raises(ValueError):
        lake.run_sql(spark, "DROP TABLE x")
