"""Complete days as a stream: a day is emitted the moment its 24 hours are committed."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fieldgauge.operators.daily import HOURS_PER_DAY, statistic
from fieldgauge.sources.lake import COMMIT_SCHEMA, local_path

#: keeps the state of a stream on disk and in the checkpoint; needed for state with timers
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def arriving_hours(
    spark: SparkSession, root: str, schema: T.StructType, pattern: str = "location_id=*/year=*/weather*.parquet",
    files_per_batch: int = 1000,
) -> DataFrame:
    """Rows of new data files as a stream, committed or not, with their ``file`` and when it ``arrived``."""
    rows = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
        .option("basePath", root).parquet(f"{root}/{pattern}")
    )
    return rows.select(
        "*", local_path(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_modification_time").alias("arrived"),
    )


def arriving_commits(spark: SparkSession, journal: str, files_per_batch: int = 1000) -> DataFrame:
    """New commit records as a stream: ``file``, site, first and last day, and when it ``arrived``."""
    found = spark.readStream.schema(COMMIT_SCHEMA).option("maxFilesPerTrigger", files_per_batch).json(journal)
    return found.select(
        local_path("path").alias("file"), "request.location_id", "request.start", "request.end",
        F.col("_metadata.file_modification_time").alias("arrived"),
    )


class DayState(StatefulProcessor):
    """What has arrived of one site-day: the hours by file, and the files with a record."""

    def __init__(self, metrics: Mapping[str, str], expected: int, patience: timedelta, site: str):
        self.metrics, self.expected = dict(metrics), expected
        self.patience = int(patience.total_seconds() * 1000)
        self.names = [site, "date", *(c for m in metrics for c in (m, f"{m}_hours"))]

    def init(self, handle: StatefulProcessorHandle) -> None:
        values = ", ".join(f"`{m}`:double" for m in self.metrics)
        self.handle = handle
        self.day = handle.getValueState(
            "day", f"emitted boolean, last bigint, files array<string>, held array<struct<file:string,at:bigint,{values}>>"
        )

    def _read(self) -> tuple[bool, int, set, dict]:
        if not self.day.exists():
            return False, 0, set(), {}
        emitted, last, files, held = self.day.get()
        return emitted, last, set(files), {(h[0], h[1]): tuple(h[2:]) for h in held}

    def _write(self, emitted: bool, last: int, files: set, held: dict) -> None:
        # the values of a day that is out are not needed any more
        kept = [] if emitted else [(*k, *v) for k, v in sorted(held.items())]
        self.day.update((emitted, last, sorted(files), kept))

    def _hours(self, files: set, held: dict) -> dict:
        """Values of the committed hours; of an hour in two files the first file's."""
        hours: dict = {}
        for (file, at), values in sorted(held.items()):
            if file in files:
                hours.setdefault(at, values)
        return hours

    def _row(self, key: tuple, hours: dict) -> Row:
        out: list = []
        for i, how in enumerate(self.metrics.values()):
            known = [v[i] for _, v in sorted(hours.items()) if v[i] is not None]
            out += [_of_day(how, known) if len(known) == self.expected else None, len(known)]
        return Row(**dict(zip(self.names, (*key, *out))))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        emitted, last, files, held = self._read()
        for row in rows:
            if row["committed"]:
                files.add(row["file"])
            elif not emitted:
                held.setdefault((row["file"], row["at"]), tuple(row[m] for m in self.metrics))
            last = max(last, row["stamp"])
        hours = {} if emitted else self._hours(files, held)
        if len(hours) == self.expected:
            emitted = True
            yield self._row(key, hours)
        self._write(emitted, last, files, held)
        self.handle.registerTimer(last + self.patience)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        emitted, last, files, held = self._read()
        if last + self.patience > expiredTimerInfo.getExpiryTimeInMs():
            return  # something arrived since, which set a later timer
        hours = {} if emitted else self._hours(files, held)
        if hours:
            yield self._row(key, hours)
        self.day.clear()


def _of_day(how: str, values: list[float]) -> float:
    return {"mean": sum(values) / len(values), "sum": sum(values), "min": min(values), "max": max(values)}[how]


def complete_day_stream(
    hours: DataFrame, commits: DataFrame, metrics: Mapping[str, str], delay: str = "2 days",
    patience: timedelta = timedelta(days=30), site: str = "location_id", ts: str = "timestamp",
    expected: int = HOURS_PER_DAY,
) -> DataFrame:
    """Day values with the 24-hour rule: site, date, and per metric its value and known hours.

    ``hours`` and ``commits`` are the streams of :func:`arriving_hours` and
    :func:`arriving_commits`.  A day comes out in the batch in which the last of its 24
    distinct hours has both its row and the record of its file, whichever is later; a file
    without record does not count.  An hour that two files hold counts once.

    Time here is arrival, not observation, so backfills of earlier years are never late.  A day
    to which nothing has been added for ``patience`` is closed by a timer: its hours, if fewer
    than 24 are committed, come out with NULL values and its state goes.  State is one small row
    per open site-day.  Files that arrive more than ``delay`` behind the newest are late.
    """
    if unknown := set(metrics.values()) - {"mean", "sum", "min", "max"}:
        raise ValueError(f"a day has no {sorted(unknown)}; use mean, sum, min or max")
    spark = hours.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    kind = hours.schema[site].dataType
    values = [F.col(m).cast("double").alias(m) for m in metrics]
    readings = hours.select(
        F.col(site), F.to_date(ts).alias("date"), F.lit(False).alias("committed"), "file",
        F.unix_micros(F.col(ts).cast("timestamp")).alias("at"), *values, "arrived", F.unix_millis("arrived").alias("stamp"),
    )
    every_day = F.sequence("start", "end", F.expr("interval 1 day"))
    records = commits.select(
        F.col("location_id").cast(kind).alias(site), F.explode(every_day).alias("date"), F.lit(True).alias("committed"), "file",
        F.lit(None).cast("bigint").alias("at"), *[F.lit(None).cast("double").alias(m) for m in metrics], "arrived",
        F.unix_millis("arrived").alias("stamp"),
    )
    output = T.StructType([T.StructField(site, kind), T.StructField("date", T.DateType())])
    for m in metrics:
        output = output.add(m, T.DoubleType()).add(f"{m}_hours", T.LongType())
    return (
        readings.unionByName(records).withWatermark("arrived", delay).groupBy(site, "date")
        .transformWithState(DayState(metrics, expected, patience, site), output, "Append", "EventTime")
    )


def closed_day_stream(
    stream: DataFrame, metrics: Mapping[str, str], delay: str = "2 days",
    site: str = "location_id", ts: str = "timestamp", expected: int = HOURS_PER_DAY,
) -> DataFrame:
    """Day values of a stream without records, one row per site-day when the day has closed.

    Repeats of a site-hour within the delay count once.  State is one small row per open
    site-day and one key per site-hour inside the delay; all of it stays in the JVM.
    """
    hours = stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([site, ts])
    return (
        hours.groupBy(F.window(ts, "1 day"), F.col(site))
        .agg(*day_values(metrics, expected))
        .select(site, F.col("window.start").cast("date").alias("date"),
                *[c for m in metrics for c in (m, f"{m}_hours")])
    )


def day_values(metrics: Mapping[str, str], expected: int = HOURS_PER_DAY) -> list[Column]:
    """Per metric the value of a day with all its hours, and how many there are."""
    values = []
    for name, how in metrics.items():
        values.append(F.when(F.count(name) == expected, statistic(how, name)).alias(name))
        values.append(F.count(name).alias(f"{name}_hours"))
    return values


def open_days(
    hours: DataFrame, emitted: DataFrame, metrics: Mapping[str, str],
    site: str = "location_id", ts: str = "timestamp", expected: int = HOURS_PER_DAY,
) -> DataFrame:
    """The final batch: values of the site-days of ``hours`` that the stream has not emitted.

    These are the days that are still incomplete when no more hours come.
    """
    left = hours.withColumn("date", F.to_date(ts)).join(emitted.select(site, "date"), [site, "date"], "left_anti")
    return left.dropDuplicates([site, ts]).groupBy(site, "date").agg(*day_values(metrics, expected))
