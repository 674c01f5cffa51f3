"""Late and corrected readings: newest revision wins, whatever day it belongs to."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from fieldgauge.operators.filters import dedupe_latest
from fieldgauge.session import folders

REVISION_ORDER = ("loaded_at", "source_file", "source_row_number")


def apply_revisions(
    existing: DataFrame, arrivals: DataFrame, keys: Sequence[str] = ("location_id", "timestamp"),
    newest_first: Sequence[str] = REVISION_ORDER,
) -> DataFrame:
    """Current state after arrivals: the whole source again, newest revision per key.

    No observation-time bound is used: it would lose backfills of earlier days.
    """
    return dedupe_latest(existing.unionByName(arrivals), keys, newest_first)


def touched_days(
    arrivals: DataFrame, site: str = "location_id", ts: str = "timestamp", halo_days: int = 0
) -> DataFrame:
    """Site-days that arrivals change.

    ``halo_days`` adds the days after them whose trailing windows see the change (29 for
    a 30-day window).
    """
    days = F.sequence(F.to_date(ts), F.date_add(F.to_date(ts), halo_days), F.expr("interval 1 day"))
    return arrivals.select(site, F.explode(days).alias("day")).distinct()


def recompute_affected(
    raw: DataFrame, touched: DataFrame, build: Callable[[DataFrame], DataFrame],
    site: str = "location_id", halo_days: int = 0, day: str = "date",
) -> DataFrame:
    """Rebuild only the touched site-days.

    ``raw`` holds every revision and is partitioned by ``day``.  A trailing window on a
    touched day also looks at the ``halo_days`` before it, so those are read as well, and
    of what ``build`` makes only the touched days (its column ``day``) are kept.  The days
    to read join as a small table, which prunes the directories at run time; no list of
    them passes through the driver.
    """
    back = F.sequence(F.date_sub("day", halo_days), F.col("day"), F.expr("interval 1 day"))
    needed = touched.select(site, F.explode(back).alias("day")).distinct()
    rows = raw.join(needed, [site, "day"], "left_semi").drop("day")
    return build(rows).join(touched.withColumnRenamed("day", day), [site, day], "left_semi")


def append_revisions(batch: DataFrame, log: str, number: int, ts: str = "timestamp") -> None:
    """Add a batch to the log of revisions, laid out by day first: ``day=<d>/batch=<n>``.

    Run again, a batch replaces the directories it wrote and no other.
    """
    rows = batch.withColumns({"day": F.to_date(ts), "batch": F.lit(number)})
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(log)


def revisions_of_days(
    spark: SparkSession, log: str, schema: StructType, days: DataFrame, upto: int, day: str = "day"
) -> DataFrame:
    """The logged revisions of some days, of batches up to ``upto``, with their ``day``.

    Only the directories of these days are listed and opened, so a batch costs as much as the
    days it touches, however long the log is.  The names of the days, one per calendar day, pass
    through the driver.
    """
    wanted = {f"day={r[0]}" for r in days.select(F.col(day).cast("string")).distinct().collect()}
    held = sorted(wanted & set(folders(spark, log)))
    columns = StructType([*schema, StructField("day", DateType()), StructField("batch", IntegerType())])
    if not held:
        return spark.createDataFrame([], columns).drop("batch")
    # the schema is given, so no file is opened to infer it
    logged = spark.read.schema(columns).option("basePath", log).parquet(*[f"{log}/{name}" for name in held])
    return logged.filter(F.col("batch") <= upto).drop("batch")


def compact(
    spark: SparkSession, log: str, target: str, schema: StructType, keys: Sequence[str] = ("location_id", "timestamp"),
    newest_first: Sequence[str] = REVISION_ORDER, files: int | None = None,
) -> None:
    """Write a shorter log: one file per day and the newest revision of each key.

    Later batches may be appended to it and rebuild the same days as from the long log, since
    older revisions can never win again.  The long log is left as it is; nothing is replaced in
    place, so a reader of either sees a whole one.
    """
    columns = StructType([*schema, StructField("day", DateType()), StructField("batch", IntegerType())])
    logged = spark.read.schema(columns).option("basePath", log).parquet(log)
    kept = dedupe_latest(logged.drop("batch"), keys, newest_first)
    # older than every batch of the stream
    dealt = kept.withColumn("batch", F.lit(-1)).repartition(*([files] if files else []), "day")
    dealt.write.mode("errorifexists").partitionBy("day", "batch").parquet(target)


def revision_stream(
    stream: DataFrame, raw_path: str, daily_path: str,
    build: Callable[[DataFrame], DataFrame], checkpoint: str,
    site: str = "location_id", ts: str = "timestamp", halo_days: int = 0,
) -> StreamingQuery:
    """Append arriving revisions to the log and rebuild the site-days they touch.

    A batch opens the log only at the days it touches and the ``halo_days`` around them, and
    leaves out what later batches wrote, so a replay adds nothing twice.  The rebuilt days of a
    batch carry its number; a reader takes the newest per key with :func:`current_days`.
    """

    def absorb(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        held = batch.persist()
        append_revisions(held, raw_path, number, ts)
        touched = touched_days(held, site, ts, halo_days)
        around = F.sequence(F.date_sub("day", halo_days), F.col("day"), F.expr("interval 1 day"))
        needed = touched.select(F.explode(around).alias("day"))
        history = revisions_of_days(spark, raw_path, batch.schema, needed, number)
        days = recompute_affected(history, touched, build, site, halo_days)
        days.write.mode("overwrite").parquet(f"{daily_path}/batch={number}")
        held.unpersist()

    return (
        stream.writeStream.foreachBatch(absorb)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_days(
    df: DataFrame, keys: Sequence[str] = ("location_id", "date"), batch: str = "batch"
) -> DataFrame:
    """Newest rebuilt row of each site-day."""
    return dedupe_latest(df, keys, [batch]).drop(batch)
