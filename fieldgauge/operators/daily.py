"""Hourly readings to days and periods, with the completeness rules.

Two day values exist side by side.  ``daily_metrics`` describes the hours that were
kept and reports how many; ``complete_day`` gives a value only for a day whose 24
hours are all there.  Missing is never zero.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldgauge.functions.scalars import PERIOD_GRAIN, bucket
from fieldgauge.operators.filters import between_days, dedupe_any

HOURS_PER_DAY = 24
# fixed values: longest request per period, in days
PERIOD_LIMITS = {"daily": 93, "weekly": 366, "monthly": 1096, "yearly": 3660}
STATISTICS = {"mean": F.avg, "avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum}


def statistic(how: str, column: Column | str) -> Column:
    if how not in STATISTICS:
        raise ValueError(f"unknown statistic {how!r}; use one of {sorted(STATISTICS)}")
    return STATISTICS[how](column)


def pooled_summary(
    df: DataFrame,
    by: Sequence[str] = ("elevation_band", "region", "season", "year"),
    outputs: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Pooled over all readings of a group: every reading counts once."""
    if outputs is None:
        outputs = {
            "avg_temperature_c": ("mean", "temperature_2m"),
            "total_precipitation_mm": ("sum", "precipitation"),
            "avg_wind_speed_ms": ("mean", "wind_speed_10m"),
            "avg_relative_humidity_pct": ("mean", "relative_humidity_2m"),
        }
    return df.groupBy(*by).agg(
        *[statistic(how, c).alias(name) for name, (how, c) in outputs.items()],
        F.count(F.lit(1)).alias("observation_count"),
    )


def daily_metrics(
    df: DataFrame,
    keys: Sequence[str] = (
        "location_id", "name", "region", "elevation_m", "elevation_band", "season", "date",
    ),
    outputs: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Day values of the retained hours with ``observed_hours``; nothing is imputed."""
    if outputs is None:
        outputs = {
            "daily_avg_temperature_c": ("mean", "temperature_2m"),
            "daily_precipitation_mm": ("sum", "precipitation"),
            "daily_avg_wind_speed_ms": ("mean", "wind_speed_10m"),
        }
    return df.groupBy(*keys).agg(
        *[statistic(how, c).alias(name) for name, (how, c) in outputs.items()],
        F.count(F.lit(1)).alias("observed_hours"),
    )


def yearly_metrics(
    df: DataFrame,
    keys: Sequence[str] = ("location_id", "name", "region", "elevation_m", "year"),
    value: str = "temperature_2m",
    output: str = "annual_avg_temperature_c",
) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(output))


def complete_day(
    df: DataFrame,
    metrics: Mapping[str, str],
    site: str = "location_id",
    ts: str = "timestamp",
    expected: int = HOURS_PER_DAY,
) -> DataFrame:
    """One row per site-day: each metric's day value, NULL unless all hours are there.

    ``metrics`` maps a column to ``mean`` or ``sum``.  ``<metric>_hours`` counts the
    non-null hours.  Several metrics share the one shuffle.
    """
    values = []
    for name, how in metrics.items():
        values.append(
            F.when(F.count(name) == expected, statistic(how, name)).alias(name)
        )
        values.append(F.count(name).alias(f"{name}_hours"))
    return df.groupBy(F.col(site), F.to_date(ts).alias("date")).agg(*values)


def complete_day_long(
    long: DataFrame,
    sums: Sequence[str] = ("precipitation",),
    site: str = "location_id",
    ts: str = "timestamp",
    day: str = "date",
    metric: str = "metric",
    value: str = "value",
) -> DataFrame:
    """Strict form on long readings: 24 rows, 24 distinct hours and 24 values."""
    counted = long.groupBy(site, day, metric).agg(
        F.count(F.lit(1)).alias("observed_hours"),
        F.count_distinct(ts).alias("_distinct_hours"),
        F.count(value).alias("valid_hours"),
        F.sum(value).alias("_sum"),
        F.avg(value).alias("_mean"),
    )
    is_complete = (
        (F.col("observed_hours") == HOURS_PER_DAY)
        & (F.col("_distinct_hours") == HOURS_PER_DAY)
        & (F.col("valid_hours") == HOURS_PER_DAY)
    )
    candidate = F.when(F.col(metric).isin(*sums), F.col("_sum")).otherwise(F.col("_mean"))
    return counted.select(
        site, day, metric, "observed_hours", "valid_hours",
        is_complete.alias("is_complete"),
        F.when(is_complete, candidate).alias("daily_value"),
    )


def preview_daily(
    readings: DataFrame,
    metric: str,
    how: str,
    start: date,
    end: date,
    sites: Sequence[str],
    site: str = "location_id",
    ts: str = "timestamp",
) -> DataFrame:
    """Daily preview of raw readings: days in range, hours de-duplicated, gaps kept."""
    if not 1 <= len(sites) <= 10:
        raise ValueError("a preview takes 1 to 10 sites")
    if not 0 <= (end - start).days <= 92:
        raise ValueError("a preview covers 1 to 93 days")
    picked = between_days(readings.filter(F.col(site).isin(list(sites))), start, end, ts)
    hours = dedupe_any(picked.select(site, ts, metric), [site, ts])
    days = complete_day(hours, {metric: how}, site, ts)
    return days.withColumnRenamed(f"{metric}_hours", "observed_hours")


def check_period_request(
    period: str, how: str, additive: bool, start: date, end: date,
    coverage: tuple[date, date] | None, n_sites: int,
) -> None:
    if how not in {"mean", "min", "max", "sum"}:
        raise ValueError("choose mean, min, max or sum")
    if how == "sum" and not additive:
        raise ValueError("a total exists only for an additive metric")
    if period not in PERIOD_LIMITS:
        raise ValueError(f"choose a period of {sorted(PERIOD_LIMITS)}")
    if not 0 <= (end - start).days < PERIOD_LIMITS[period]:
        raise ValueError(f"a {period} request covers 1 to {PERIOD_LIMITS[period]} days")
    if coverage and (start < coverage[0] or end > coverage[1]):
        raise ValueError("the request leaves the covered days")
    if not 1 <= n_sites <= 100:
        raise ValueError("choose 1 to 100 sites")


def refuse_unknown_sites(known: DataFrame, chosen: Sequence, site: str = "location_id") -> None:
    """Fails if a chosen site is not in the table; at most 100 names come back."""
    found = known.filter(F.col(site).isin(list(chosen))).select(site).distinct().collect()
    if unknown := sorted(set(chosen) - {r[0] for r in found}, key=str):
        raise ValueError(f"unknown sites {unknown}")


def rollup_period(
    daily: DataFrame,
    value: str,
    period: str,
    how: str,
    start: date,
    end: date,
    site: str = "location_id",
    hours: str = "hours",
    additive: bool = True,
) -> DataFrame:
    """Days to ISO weeks, months or years over a closed range, of any length.

    A bucket has a value only if each of its days inside the range is complete.
    :func:`answer_period_request` is the bounded request for chosen sites.
    """
    if how == "sum" and not additive:
        raise ValueError("a total exists only for an additive metric")
    inside = daily.filter(F.col("date").between(F.lit(start), F.lit(end)))
    if period == "daily":
        return inside.select(site, "date", value, hours)
    grain = PERIOD_GRAIN[period]
    first = F.col("date")
    last = F.date_sub((first + F.expr(f"interval 1 {grain}")).cast("date"), 1)
    wanted = F.datediff(F.least(last, F.lit(end)), F.greatest(first, F.lit(start))) + 1
    grouped = (
        inside.withColumn("date", bucket("date", grain))
        .groupBy(site, "date")
        .agg(
            statistic(how, value).alias("_value"),
            F.count(value).alias("_days"),
            F.sum(hours).alias(hours),
        )
    )
    return grouped.select(
        site, "date", F.when(F.col("_days") == wanted, F.col("_value")).alias(value), hours
    )


def answer_period_request(
    daily: DataFrame, value: str, period: str, how: str, start: date, end: date, chosen: Sequence, known: DataFrame,
    additive: bool = True, coverage: tuple[date, date] | None = None, site: str = "location_id", hours: str = "hours",
) -> DataFrame:
    """:func:`rollup_period` of the ``chosen`` sites, after the request has been checked.

    The range, the statistic and the number of sites are bounded, and every site must be in the
    table ``known``.  Only the days of the chosen sites are read.
    """
    check_period_request(period, how, additive, start, end, coverage, len(set(chosen)))
    refuse_unknown_sites(known, chosen, site)
    asked = daily.filter(F.col(site).isin(list(chosen)))
    return rollup_period(asked, value, period, how, start, end, site, hours, additive)


def to_grain(
    df: DataFrame, grain: str, variables: Sequence[str], keys: Sequence[str] = ("location_id",),
    ts: str = "timestamp",
) -> DataFrame:
    """Mean of every variable per key and hour, day, week or month (one shuffle for all)."""
    return df.groupBy(bucket(ts, grain).alias("period"), *keys).agg(
        *[F.avg(v).alias(v) for v in variables]
    )


def period_stat(
    df: DataFrame, grain: str, metric: str, how: str, keys: Sequence[str] = ("location_id",),
    ts: str = "timestamp",
) -> DataFrame:
    return df.groupBy(bucket(ts, grain).alias("period"), *keys).agg(
        statistic(how, metric).alias("value"), F.count(metric).alias("observations")
    )


def downsample(
    daily: DataFrame, metrics: Sequence[str], bucket_days: int, start: date, end: date,
    site: str = "location_id",
) -> DataFrame:
    """Day buckets of a stated width, shared by all sites; a total stays a mean daily total."""
    if bucket_days < 1:
        raise ValueError("a bucket has at least one day")
    inside = daily.filter(F.col("date").between(F.lit(start), F.lit(end)))
    if bucket_days == 1:
        return inside.select(site, "date", *metrics)
    offset = F.floor(F.datediff("date", F.lit(start)) / bucket_days) * bucket_days
    return inside.groupBy(
        F.col(site), F.date_add(F.lit(start), offset.cast("int")).alias("date")
    ).agg(*[F.avg(m).alias(m) for m in metrics])


def at_grain(
    daily: DataFrame, metrics: Sequence[str], grain: str = "month", site: str = "location_id"
) -> DataFrame:
    """Daily rows, or means per site and ``grain``; the caller states which."""
    if grain == "day":
        return daily.select(site, "date", *metrics)
    return daily.groupBy(F.col(site), bucket("date", grain).alias("date")).agg(
        *[F.avg(m).alias(m) for m in metrics]
    )


def period_summary(
    panel: DataFrame, means: Sequence[str], total: str, site: str = "location_id",
    total_output: str = "period_total",
) -> DataFrame:
    """Per site: mean of the daily values, and the period total of one metric."""
    return panel.groupBy(site).agg(
        *[F.avg(m).alias(m) for m in means], F.sum(total).alias(total_output)
    )


def site_month(
    df: DataFrame, variables: Sequence[str], rain: str | None = None,
    site: str = "location_id", ts: str = "timestamp",
) -> DataFrame:
    """Site-month means with the hours seen and expected; rain as mean daily total."""
    day = F.to_date(ts)
    grouped = df.groupBy(F.col(site), F.year(day).alias("year"), F.month(day).alias("month")).agg(
        *[
            (F.avg(v) * HOURS_PER_DAY if v == rain else F.avg(v)).alias(v)
            for v in variables
        ],
        F.count(F.lit(1)).alias("hours"),
    )
    first = F.make_date("year", "month", F.lit(1))
    expected = F.dayofmonth(F.last_day(first)) * HOURS_PER_DAY
    return grouped.withColumns(
        {"expected_hours": expected, "is_complete": F.col("hours") == expected}
    )


def climatology(
    months: DataFrame, value: str, keys: Sequence[str] = ("location_id",), month: str = "month"
) -> DataFrame:
    """Mean over years per calendar month, with the peak, trough and range of the cycle."""
    cycle = months.groupBy(*keys, month).agg(F.avg(value).alias(value))
    whole = Window.partitionBy(*keys)  # twelve rows
    return cycle.withColumns(
        {
            "peak_month": F.max_by(month, F.struct(value, -F.col(month))).over(whole),
            "trough_month": F.min_by(month, F.struct(value, month)).over(whole),
            "peak_minus_trough": F.max(value).over(whole) - F.min(value).over(whole),
        }
    )


def month_year_summary(
    daily: DataFrame, value: str, keys: Sequence[str] = ("location_id",), day: str = "date"
) -> DataFrame:
    """Mean, median, sd and quartiles of the daily values of each month (at most 31)."""
    quartiles = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return (
        daily.groupBy(*keys, F.month(day).alias("month"), F.year(day).alias("year"))
        .agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), quartiles.alias("_q"))
        .select(
            *keys, "month", "year", "mean", F.col("_q")[1].alias("median"), "sd",
            F.col("_q")[0].alias("q25"), F.col("_q")[2].alias("q75"),
        )
    )


def annual_features(
    df: DataFrame, value: str, trailing: str, total: str, site: str = "location_id",
    ts: str = "timestamp",
) -> DataFrame:
    """Per site and year: mean of a value and of its trailing feature, and a total."""
    return df.groupBy(F.col(site), F.year(ts).alias("year")).agg(
        F.avg(value).alias("mean_value"),
        F.avg(trailing).alias("mean_past_value"),
        F.sum(total).alias("annual_total"),
    )
