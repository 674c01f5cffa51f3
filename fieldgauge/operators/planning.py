"""What should be there, what is there, what is outstanding."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F


def _days(start: Column, end: Column) -> Column:
    return F.datediff(end, start) + 1


def expected_chunks(
    sites: DataFrame, start: date, end: date, site: str = "location_id"
) -> DataFrame:
    """Site x calendar year, clipped to the study range, with the hours to expect."""
    if end < start:
        raise ValueError("the study ends before it starts")
    lo, hi = F.lit(start), F.lit(end)
    year = F.explode(F.sequence(F.lit(start.year), F.lit(end.year)))
    return (
        sites.select(F.col(site), year.alias("year"))
        .withColumn("start", F.greatest(lo, F.make_date("year", F.lit(1), F.lit(1))))
        .withColumn("end", F.least(hi, F.make_date("year", F.lit(12), F.lit(31))))
        .withColumn("hours", _days(F.col("start"), F.col("end")) * 24)
    )


def sweep_windows(day: Column, end: date, days: int) -> tuple[Column, Column]:
    """Window a day falls in, counting back from the study end and, in earlier years,
    from the last day of the year, so that no window crosses New Year."""
    year_end = F.least(F.lit(end), F.make_date(F.year(day), F.lit(12), F.lit(31)))
    back = F.floor(F.datediff(year_end, day) / days)
    last = F.date_sub(year_end, (back * days).cast("int"))
    first = F.greatest(F.date_sub(last, days - 1), F.make_date(F.year(day), F.lit(1), F.lit(1)))
    return first, last


def outstanding(
    sites: DataFrame, start: date, end: date, retained: DataFrame | None = None, days: int = 7,
    site: str = "location_id",
) -> DataFrame:
    """Chunks still to fetch, newest window first, all sites of a window together.

    Days that retained intervals cover are taken out; what is left of a window is put
    back together into unbroken intervals.
    """
    if not 1 <= days <= 31:
        raise ValueError("a window spans 1 to 31 days")
    if end < start:
        raise ValueError("the study ends before it starts")
    every_day = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    wanted = sites.select(site, F.explode(every_day).alias("day"))
    if retained is not None:
        held = retained.select(
            site,
            F.explode(
                F.sequence(
                    F.greatest(F.col("start"), F.lit(start)), F.least(F.col("end"), F.lit(end)),
                    F.expr("interval 1 day"),
                )
            ).alias("day"),
        ).distinct()
        wanted = wanted.join(held, [site, "day"], "left_anti")
    first, last = sweep_windows(F.col("day"), end, days)
    windowed = wanted.withColumns({"window_start": first, "window_end": last})
    # at most ``days`` rows per site and window
    order = Window.partitionBy(site, "window_start", "window_end").orderBy("day")
    island = F.date_sub("day", F.row_number().over(order))
    last_start = F.greatest(F.lit(start), F.col("window_start"))
    return (
        windowed.withColumn("_island", island)
        .groupBy(site, "window_start", "window_end", "_island")
        .agg(F.min("day").alias("start"), F.max("day").alias("end"))
        .select(
            site, F.year("start").alias("year"), "start", "end",
            (_days(F.col("start"), F.col("end")) * 24).alias("hours"),
            last_start.alias("window_start"), "window_end",
        )
        .orderBy(F.col("window_start").desc(), site, F.col("start").desc())
    )


def verify_chunks(plan: DataFrame, files: DataFrame, sidecars: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Status of every planned or found chunk.

    ``files`` holds keys and ``sha256``; ``sidecars`` keys and ``recorded_sha256``.  A
    pair counts only when both exist and the digests agree; a half pair is retried.
    """
    keys = list(keys)
    found = files.select(*keys, "sha256").join(
        sidecars.select(*keys, "recorded_sha256"), keys, "full_outer"
    )
    planned = plan.select(*keys).withColumn("_planned", F.lit(True))
    both = F.col("sha256").isNotNull() & F.col("recorded_sha256").isNotNull()
    neither = F.col("sha256").isNull() & F.col("recorded_sha256").isNull()
    return planned.join(found, keys, "full_outer").select(
        *keys,
        F.when(F.col("_planned").isNull(), "unplanned")
        .when(neither, "absent")
        .when(~both, "half_committed")
        .when(F.col("sha256") != F.col("recorded_sha256"), "mismatch")
        .otherwise("verified")
        .alias("status"),
    )


def hour_gaps(
    df: DataFrame, chunks: DataFrame, site: str = "location_id", ts: str = "timestamp"
) -> DataFrame:
    """Expected hours that are missing or occur more than once, per site.

    ``chunks`` holds site, start and end days (closed).
    """
    first = F.col("start").cast("timestamp")
    last = F.col("end").cast("timestamp") + F.expr("interval 23 hours")
    expected = chunks.select(
        F.col(site), F.explode(F.sequence(first, last, F.expr("interval 1 hour"))).alias(ts)
    )
    seen = df.groupBy(site, ts).agg(F.count(F.lit(1)).alias("n"))
    checked = expected.join(seen, [site, ts], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return checked.filter("n <> 1").select(
        site, ts, "n", F.when(F.col("n") == 0, "missing").otherwise("repeated").alias("problem")
    )


def unavailable_days(
    df: DataFrame, value: str, site: str = "location_id", ts: str = "timestamp"
) -> DataFrame:
    """Days that have rows but not one value."""
    return (
        df.groupBy(F.col(site), F.to_date(ts).alias("date"))
        .agg(F.count(F.lit(1)).alias("hours"), F.count(value).alias("_valid"))
        .filter("_valid = 0")
        .drop("_valid")
    )


def progress(plan: DataFrame, done: DataFrame, site: str = "location_id") -> DataFrame:
    """One row: chunks and rows planned and completed, and the newest unfinished window
    with the sites it still lacks."""
    keys = [site, "start", "end"]
    marked = plan.join(
        done.select(*keys).distinct().withColumn("_done", F.lit(True)), keys, "left"
    ).withColumn("_done", F.coalesce("_done", F.lit(False)))
    windows = marked.groupBy("window_start", "window_end").agg(
        F.count(F.lit(1)).alias("chunks"),
        F.count_if("_done").alias("completed"),
        F.sum("hours").alias("hours"),
        F.coalesce(F.sum(F.when(F.col("_done"), F.col("hours"))), F.lit(0)).alias("completed_hours"),
        F.count_distinct(F.when(~F.col("_done"), F.col(site))).alias("remaining"),
        F.count_distinct(site).alias("sites"),
    )
    open_window = F.col("completed") < F.col("chunks")
    newest = F.max_by(
        F.struct("window_start", "window_end", "remaining", "sites"),
        F.when(open_window, F.col("window_start")),
    )
    return windows.agg(
        F.sum("chunks").alias("expected_chunks"),
        F.sum("completed").alias("completed_chunks"),
        F.sum("hours").alias("expected_rows"),
        F.sum("completed_hours").alias("completed_rows"),
        newest.alias("_active"),
    ).select(
        "expected_chunks", "completed_chunks", "expected_rows", "completed_rows",
        F.col("_active.window_start").alias("active_start"),
        F.col("_active.window_end").alias("active_end"),
        F.col("_active.remaining").alias("remaining_sites"),
    )
