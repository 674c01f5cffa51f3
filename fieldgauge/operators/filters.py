"""Projections, predicates, de-duplication and screening of readings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldgauge.functions.scalars import is_finite
from fieldgauge.schemas import READING_BOUNDS, READING_COLUMNS


def require_columns(df: DataFrame, required: Iterable[str], what: str = "reading") -> DataFrame:
    absent = sorted(set(required) - set(df.columns))
    if absent:
        raise ValueError(f"{what} table lacks columns {absent}")
    return df


def validate(
    df: DataFrame,
    required: Iterable[str] = READING_COLUMNS,
    bounds: Mapping[str, tuple[float, float]] = READING_BOUNDS,
    keys: Sequence[str] = ("location_id", "timestamp"),
) -> DataFrame:
    """Keep rows with keys and every bounded variable in range.

    NULL fails a range test and NaN sorts above every number, so both are dropped
    together with the infinities.  De-duplication is :func:`dedupe_any`.
    """
    require_columns(df, required)
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    for name, (low, high) in bounds.items():
        df = df.filter(F.col(name).between(low, high))
    return df


def nan_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NaN and infinities become NULL: Spark would otherwise count and average them."""
    return df.withColumns({c: F.when(is_finite(c), F.col(c)) for c in columns})


def dedupe_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, any survivor (combined on the map side, so hot keys stay small)."""
    return df.dropDuplicates(list(keys))


def dedupe_latest(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """Newest revision per key: later columns of ``newest_first`` break ties.

    The ``= 1`` filter lets Spark keep only one row per key and map task before the
    shuffle, so a key reloaded very often does not pile up in one reducer.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in newest_first])
    return df.withColumn("_nth", F.row_number().over(newest)).filter("_nth = 1").drop("_nth")


def between_days(df: DataFrame, start: date, end: date, ts: str = "timestamp") -> DataFrame:
    """Whole days start..end as a half-open instant range, which Parquet can prune on."""
    first = F.lit(start.isoformat()).cast("timestamp")
    after = F.lit(end.isoformat()).cast("timestamp") + F.expr("interval 1 day")
    return df.filter((F.col(ts) >= first) & (F.col(ts) < after))


def between_days_of_year(df: DataFrame, start: date, end: date, ts: str = "timestamp",
                         year: str = "year") -> DataFrame:
    """:func:`between_days` for a table partitioned by year: prunes directories as well."""
    return between_days(df, start, end, ts).filter(F.col(year).between(start.year, end.year))


def apply_filters(df: DataFrame, filters: Mapping[str, Sequence]) -> DataFrame:
    """Job filters, all of which must hold: ``date`` is a closed range, others are lists."""
    for name, values in filters.items():
        field = F.col(name)
        df = df.filter(field.between(*values) if name == "date" else field.isin(*values))
    return df


def slice_rows(df: DataFrame, **chosen: Sequence) -> DataFrame:
    """Keep rows whose columns are in the chosen lists; an empty or absent list keeps all."""
    return apply_filters(df, {k: list(v) for k, v in chosen.items() if v})


def drop_leap_day(df: DataFrame, day: str = "date") -> DataFrame:
    return df.filter(~((F.month(day) == 2) & (F.dayofmonth(day) == 29)))


def complete_cases(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def screen_ranges(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Per variable: rows outside the plausible range, as count and percent; keeps no row."""
    outside = [
        F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(c) for c, (lo, hi) in bounds.items()
    ]
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *outside)
    limits = {c: F.struct(F.lit(float(lo)).alias("lower"), F.lit(float(hi)).alias("upper"))
              for c, (lo, hi) in bounds.items()}
    known = F.create_map(*[x for c, s in limits.items() for x in (F.lit(c), s)])
    return (
        counted.unpivot("n_rows", list(bounds), "variable", "outside")
        .select(
            "variable",
            known[F.col("variable")]["lower"].alias("lower"),
            known[F.col("variable")]["upper"].alias("upper"),
            "outside",
            (F.try_divide(F.col("outside"), F.col("n_rows")) * 100).alias("percent"),
        )
    )


def hour_contract_violations(
    df: DataFrame,
    ts: str = "timestamp",
    ranges: Mapping[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """Rows off the full hour or outside a range; an open end is None and NULL is allowed."""
    if ranges is None:
        ranges = {
            "temperature_2m": (-100.0, 70.0),
            "relative_humidity_2m": (0.0, 100.0),
            "precipitation": (0.0, None),
            "wind_speed_10m": (0.0, None),
        }
    broken: Column = F.col(ts) != F.date_trunc("hour", ts)
    for name, (low, high) in ranges.items():
        v = F.col(name)
        if low is not None:
            broken = broken | F.coalesce(v < low, F.lit(False))
        if high is not None:
            broken = broken | F.coalesce(v > high, F.lit(False))
    return df.filter(broken)


def coordinate_violations(
    sites: DataFrame, latitude: str = "latitude", longitude: str = "longitude"
) -> DataFrame:
    return sites.filter(
        ~F.col(latitude).between(-90, 90) | ~F.col(longitude).between(-180, 180)
    )


def count_where(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """One row with the number of rows for which each named predicate holds."""
    return df.agg(*[F.count_if(p).alias(name) for name, p in predicates.items()])


def latest_days(df: DataFrame, n: int, ts: str = "timestamp") -> DataFrame:
    """Rows of the last ``n`` days present in the table.

    The newest day is a scalar subquery (one row, from Parquet statistics where the
    source can), compared on the raw column so the filter still reaches the scan.
    """
    newest = F.to_date(df.agg(F.max(ts)).scalar())
    return df.filter(F.col(ts) >= F.date_sub(newest, n - 1).cast("timestamp"))
