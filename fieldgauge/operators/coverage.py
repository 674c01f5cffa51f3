"""Coverage reports and the completeness-aware seasonal and yearly tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldgauge.functions.scalars import days_in_year, season_start
from fieldgauge.operators.daily import HOURS_PER_DAY, complete_day


def coverage_span(df: DataFrame, keys: Sequence[str] = ("location_id",), ts: str = "timestamp") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(ts).alias("first_timestamp"),
        F.max(ts).alias("last_timestamp"),
        F.count(F.lit(1)).alias("hours"),
    )


def coverage_vs_window(
    df: DataFrame, sites: DataFrame, site: str = "location_id", ts: str = "timestamp"
) -> DataFrame:
    """Hours per site against the study window (first to last reading of any site)."""
    span = df.agg(
        F.floor((F.unix_timestamp(F.max(ts)) - F.unix_timestamp(F.min(ts))) / 3600) + 1
    ).scalar()
    seen = df.groupBy(site).agg(F.count(F.lit(1)).alias("observed_hours"))
    observed = F.coalesce("observed_hours", F.lit(0).cast("bigint"))
    return (
        sites.select(site).join(seen, site, "left")
        .select(site, observed.alias("observed_hours"), span.alias("expected_hours"))
        .withColumn("missing_hours", F.col("expected_hours") - F.col("observed_hours"))
    )


def coverage_daily(fact: DataFrame, keys: Sequence[str] = ("location_id", "date", "metric")) -> DataFrame:
    return fact.select(
        *keys, "observed_hours", "valid_hours",
        (HOURS_PER_DAY - F.col("valid_hours")).alias("missing_hours"),
        "is_complete",
        F.when(F.col("observed_hours") == 0, "missing")
        .when(F.col("is_complete"), "complete")
        .otherwise("partial")
        .alias("coverage_status"),
    )


def coverage_locations(fact: DataFrame, keys: Sequence[str] = ("location_id", "metric"), day: str = "date") -> DataFrame:
    """Per site and metric.  First and last complete day do not promise no gap between."""
    complete = F.when(F.col("is_complete"), F.col(day))
    return fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("expected_days"),
        F.count_if("is_complete").alias("complete_days"),
        F.sum("valid_hours").alias("valid_hours"),
        F.min(complete).alias("first_complete_date"),
        F.max(complete).alias("last_complete_date"),
    )


def _calendar_part(fact: DataFrame, by: Sequence[str], additive: Column, value: str) -> DataFrame:
    return fact.groupBy(*by).agg(
        F.count(F.lit(1)).alias("requested_days"),
        F.count(value).alias("complete_days"),
        F.avg(value).alias("available_day_mean"),
        F.sum(F.when(additive, F.col(value))).alias("available_total"),
    )


def seasonal(
    fact: DataFrame, keys: Sequence[str] = ("location_id", "metric", "unit"),
    value: str = "daily_value", additive: Column | None = None,
) -> DataFrame:
    """DJF/MAM/JJA/SON per season year (December opens the next), with completeness."""
    additive = F.col("daily_aggregation") == "sum" if additive is None else additive
    grouped = _calendar_part(fact, [*keys, "season", "season_year"], additive, value)
    start = season_start("season", "season_year")
    return grouped.withColumn("season_start", start).withColumn(
        "calendar_days", F.datediff(F.add_months("season_start", 3), "season_start")
    ).withColumn("is_complete_season", F.col("complete_days") == F.col("calendar_days"))


def yearly(
    fact: DataFrame, keys: Sequence[str] = ("location_id", "metric", "unit"),
    value: str = "daily_value", additive: Column | None = None,
) -> DataFrame:
    """Years with their completeness; an annual mean only for a complete year."""
    additive = F.col("daily_aggregation") == "sum" if additive is None else additive
    grouped = _calendar_part(fact, [*keys, "calendar_year"], additive, value).withColumn(
        "calendar_days", days_in_year("calendar_year")
    )
    whole = F.col("complete_days") == F.col("calendar_days")
    return grouped.withColumns(
        {"is_complete_year": whole, "annual_mean": F.when(whole, F.col("available_day_mean"))}
    )


def annual_completeness(
    df: DataFrame, means: Mapping[str, str], totals: Mapping[str, str], site: str = "location_id",
    ts: str = "timestamp",
) -> DataFrame:
    """Hours per site-year against the hours of that year, with means and totals."""
    grouped = df.groupBy(F.col(site), F.year(ts).alias("year")).agg(
        F.count(F.lit(1)).alias("hours"),
        *[F.avg(c).alias(name) for name, c in means.items()],
        *[F.sum(c).alias(name) for name, c in totals.items()],
    )
    expected = days_in_year("year") * HOURS_PER_DAY
    return grouped.withColumns(
        {"expected_hours": expected, "is_complete": F.col("hours") == expected}
    )


def shared_days(daily: DataFrame, n_sites: Column | int, metrics: Sequence[str], site: str = "location_id",
                day: str = "date") -> DataFrame:
    """Days on which every site has every metric."""
    valid = daily.dropna(subset=list(metrics))
    counts = valid.groupBy(day).agg(F.count_distinct(site).alias("_sites"))
    return counts.filter(F.col("_sites") == n_sites).select(day)


def last_run(days: DataFrame, day: str = "date") -> DataFrame:
    """Start, end and length of the last unbroken run of days.

    The days are distinct calendar days (one row each), so the window is as small
    as the calendar.
    """
    order = Window.partitionBy().orderBy(day)
    island = F.date_sub(day, F.row_number().over(order))
    runs = days.select(day, island.alias("_island")).groupBy("_island").agg(
        F.min(day).alias("start"), F.max(day).alias("end"), F.count(F.lit(1)).alias("days")
    )
    return runs.agg(F.max_by(F.struct("start", "end", "days"), "end").alias("r")).select("r.*")


def balanced_panel(
    df: DataFrame, metrics: Mapping[str, str], site: str = "location_id", ts: str = "timestamp"
) -> DataFrame:
    """Readings of the last unbroken run of days complete for all sites and metrics."""
    daily = complete_day(df, metrics, site, ts)
    n_sites = df.agg(F.count_distinct(site)).scalar()
    run = last_run(shared_days(daily, n_sites, list(metrics), site)).agg(
        F.struct(F.first("start").alias("start"), F.first("end").alias("end"))
    ).scalar()
    return df.filter(F.to_date(ts).between(run["start"], run["end"]))


def panel_check(panel: DataFrame, site: str = "location_id", ts: str = "timestamp") -> DataFrame:
    """One row: sites, days, rows and whether rows = sites x days x 24."""
    return panel.agg(
        F.count_distinct(site).alias("sites"),
        F.count_distinct(F.to_date(ts)).alias("days"),
        F.count(F.lit(1)).alias("hours"),
    ).withColumn("is_balanced", F.col("hours") == F.col("sites") * F.col("days") * HOURS_PER_DAY)


def missingness(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Missing values per variable (and group), as count and percent; one aggregation."""
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return counted.unpivot([*by, "n_rows"], list(columns), "variable", "missing").withColumn(
        "percent", F.try_divide(F.col("missing"), F.col("n_rows")) * 100
    )


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, repeats of whole rows and repeats of the key.

    Rows are combined by content first, then by key: two map-side combined
    aggregations rather than two distinct counts over the whole table.
    """
    rest = [c for c in df.columns if c not in keys]
    whole = df.groupBy(*keys, *rest).agg(F.count(F.lit(1)).alias("_n"))
    per_key = whole.groupBy(*keys).agg(
        F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_contents")
    )
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("_rows") - F.col("_contents")), F.lit(0)).alias("exact_duplicates"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("key_duplicates"),
    )
