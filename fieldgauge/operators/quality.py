"""Data-quality gates.  A gate is a DataFrame of violations: empty means passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from fieldgauge.operators.filters import dedupe_any, validate
from fieldgauge.operators.joins import enrich
from fieldgauge.schemas import READING_BOUNDS, READING_COLUMNS


def unique_grain(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return (
        df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")
    )


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def grid_size(
    fact: DataFrame, sites: DataFrame, days: int | Column, metrics: int,
    site: str = "location_id",
) -> DataFrame:
    """A row when the coverage grid is not exactly sites x days x metrics."""
    expected = sites.agg(F.count(site)).scalar() * days * metrics
    return (
        fact.agg(F.count(F.lit(1)).alias("actual_rows"))
        .withColumn("expected_rows", expected)
        .filter(F.col("actual_rows") != F.col("expected_rows"))
    )


def completeness_invariants(fact: DataFrame) -> DataFrame:
    """Hour bounds; the flag holds exactly with 24 of 24; a value exactly with the flag."""
    hours, valid, flag = F.col("observed_hours"), F.col("valid_hours"), F.col("is_complete")
    return fact.filter(
        ~hours.between(0, 24)
        | ~valid.between(0, hours)
        | (flag != ((hours == 24) & (valid == 24)))
        | (flag != F.col("daily_value").isNotNull())
    )


def full_coverage(coverage: DataFrame) -> DataFrame:
    """Release gate: any incomplete site-day-metric is a violation."""
    return coverage.filter(~F.col("is_complete"))


def provenance_unique(
    raw: DataFrame, columns: Sequence[str] = ("source_file", "source_checksum", "source_row_number")
) -> DataFrame:
    """File rows loaded more than once."""
    return unique_grain(raw, columns)


def stage_counts(
    readings: DataFrame, sites: DataFrame, site: str = "location_id", ts: str = "timestamp",
    required: Sequence[str] = READING_COLUMNS,
    bounds: Mapping[str, tuple[float, float]] = READING_BOUNDS,
) -> DataFrame:
    """One row of counts per stage: input, validated, rejected, unmatched, output, days.

    A single aggregation over marked rows: whether a row passes, whether it is the
    survivor of its key and whether its site is known.
    """
    passes = F.lit(True)
    for name, (low, high) in bounds.items():
        passes = passes & F.coalesce(F.col(name).between(low, high), F.lit(False))
    passes = passes & F.col(site).isNotNull() & F.col(ts).isNotNull()
    marked = readings.select(site, ts, passes.alias("_passes"))
    known = sites.select(site).distinct().withColumn("_known", F.lit(True))
    # one row per key, so repeats of a key cost nothing after the map side
    keys = marked.groupBy(site, ts).agg(
        F.count(F.lit(1)).alias("_rows"), F.max("_passes").alias("_valid")
    )
    days = keys.join(known, site, "left").groupBy(site, F.to_date(ts).alias("_day")).agg(
        F.sum("_rows").alias("_rows"),
        F.count_if("_valid").alias("_valid"),
        F.count_if(F.col("_valid") & F.col("_known").isNotNull()).alias("_out"),
    )
    return days.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum("_valid"), F.lit(0)).alias("validated_rows"),
        F.coalesce(F.sum(F.col("_rows") - F.col("_valid")), F.lit(0)).alias("rejected_or_duplicate_rows"),
        F.coalesce(F.sum(F.col("_valid") - F.col("_out")), F.lit(0)).alias("unmatched_site_rows"),
        F.coalesce(F.sum("_out"), F.lit(0)).alias("output_rows"),
        F.count_if(F.col("_out") > 0).alias("daily_rows"),
    )


def observed_stages(
    readings: DataFrame, sites: DataFrame, site: str = "location_id", ts: str = "timestamp",
) -> tuple[DataFrame, dict[str, Observation]]:
    """The enriched table with a row counter on each stage, filled by the one action that
    writes it."""
    counters = {name: Observation(f"{name}_rows") for name in ("input", "validated", "output")}
    n = F.count(F.lit(1)).alias("rows")
    kept = dedupe_any(validate(readings.observe(counters["input"], n)), [site, ts])
    enriched = enrich(kept.observe(counters["validated"], n), sites, site, ts)
    return enriched.observe(counters["output"], n), counters


def reconcile_totals(
    panel: DataFrame, value: str, elevation: str, total: str, site: str = "location_id"
) -> DataFrame:
    """Totals recomputed another way, with their largest difference.

    Mean of site means against the pooled mean (equal in a balanced panel), the sum of
    site totals against the pooled total, and the slope and correlation across sites
    from raw moments against the built-in regression aggregates.
    """
    per_site = panel.groupBy(site).agg(
        F.avg(value).alias("_y"), F.first(elevation).cast("double").alias("_x"), F.sum(total).alias("_t")
    )
    pooled = panel.agg(F.struct(F.avg(value).alias("mean"), F.sum(total).alias("total"))).scalar()
    x, y = F.col("_x"), F.col("_y")
    n = F.count(F.lit(1))
    sxy = F.sum(x * y) - F.sum(x) * F.sum(y) / n
    sxx = F.sum(x * x) - F.sum(x) * F.sum(x) / n
    syy = F.sum(y * y) - F.sum(y) * F.sum(y) / n
    return per_site.agg(
        F.avg(y).alias("mean_of_site_means"),
        F.sum("_t").alias("sum_of_site_totals"),
        F.regr_slope(y, x).alias("slope"),
        F.corr(y, x).alias("correlation"),
        F.try_divide(sxy, sxx).alias("slope_from_moments"),
        F.try_divide(sxy, F.sqrt(sxx * syy)).alias("correlation_from_moments"),
    ).withColumns({"pooled_mean": pooled["mean"], "pooled_total": pooled["total"]})
