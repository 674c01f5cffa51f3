"""Group comparisons, distributions, correlations and chart tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from fieldgauge.functions.scalars import (
    bucket, class_of, digitize, elevation_band, equal_width_edges, is_finite, safe_div,
)
from fieldgauge.operators.ranks import contingency, exact_quantiles, join_on, quantile_columns, value_ranks
from fieldgauge.session import materialise

# fixed values: boxplot classes
BOX_EDGES = (500, 1500)
BOX_BANDS = ("Below 500 m", "500–<1,500 m", "1,500 m and above")


def location_means(
    daily: DataFrame,
    keys: Sequence[str] = ("location_id", "name", "elevation_band"),
    outputs: Mapping[str, str] | None = None,
) -> DataFrame:
    """Per site: mean of each daily value and the number of days."""
    if outputs is None:
        outputs = {
            "mean_daily_temperature_c": "daily_avg_temperature_c",
            "mean_daily_precipitation_mm": "daily_precipitation_mm",
            "mean_daily_wind_ms": "daily_avg_wind_speed_ms",
        }
    return daily.groupBy(*keys).agg(
        *[F.avg(c).alias(name) for name, c in outputs.items()],
        F.count("date").alias("observed_days"),
    )


def equal_weight(
    df: DataFrame, inner: Sequence[str], outer: Sequence[str], values: Sequence[str],
    count: str = "locations",
) -> DataFrame:
    """Average per inner key first, so a site with more records does not weigh more.

    The first stage combines on the map side; the second sees one row per inner key.
    """
    means = df.groupBy(*inner).agg(*[F.avg(v).alias(v) for v in values])
    return means.groupBy(*outer).agg(
        *[F.avg(v).alias(v) for v in values], F.count(F.lit(1)).alias(count)
    )


def band_timeseries(
    df: DataFrame, grain: str, variables: Sequence[str], site: str = "location_id",
    ts: str = "timestamp", elevation: str = "elevation_m",
) -> DataFrame:
    """Equal-weight band means per period, with the number of sites behind them."""
    placed = df.withColumns({"period": bucket(ts, grain), "elevation_band": elevation_band(elevation)})
    return equal_weight(
        placed, ["period", site, "elevation_band"], ["period", "elevation_band"], variables
    )


def site_profile(
    df: DataFrame, variables: Sequence[str], keys: Sequence[str], elevation: str = "elevation_m"
) -> DataFrame:
    """Mean of every variable per site, long, without sites of unknown elevation.

    Ordered by elevation: one row per site and variable, so the sort is small.
    """
    means = df.groupBy(*keys).agg(*[F.avg(v).cast("double").alias(v) for v in variables])
    return (
        means.filter(F.col(elevation).isNotNull())
        .unpivot(list(keys), list(variables), "variable", "mean_value")
        .filter(F.col("mean_value").isNotNull())
        .orderBy(elevation, *[k for k in keys if k != elevation], "variable")
    )


def with_class(sites: DataFrame, elevation: str = "elevation_m", output: str = "band") -> DataFrame:
    """Equal-width elevation class over the given sites (4, or 5 with a 3000 m site)."""
    limits = sites.agg(
        F.struct(
            F.coalesce(F.min(elevation), F.lit(0.0)).alias("low"),
            F.coalesce(F.max(elevation), F.lit(1.0)).alias("high"),
        )
    ).scalar()
    held = sites.withColumn("_limits", limits)
    placed = held.withColumn(
        "_edges", equal_width_edges(F.col("_limits.low"), F.col("_limits.high"))
    )
    return placed.withColumn(output, class_of(elevation, F.col("_edges"))).drop("_limits", "_edges")


def class_timeline(
    daily: DataFrame, value: str = "value", band: str = "band", day: str = "date",
    by: Sequence[str] = (),
) -> DataFrame:
    """Mean, count and population variance per class by day, ISO week and month.

    The three grains come from one pass over the daily values.
    """
    periods = F.array(
        *[
            F.struct(F.lit(p).alias("period"), bucket(day, g).alias("bucket"))
            for p, g in (("daily", "day"), ("weekly", "week"), ("monthly", "month"))
        ]
    )
    spread = daily.filter(F.col(value).isNotNull()).select(
        *by, band, value, F.explode(periods).alias("_p")
    )
    return spread.groupBy(*by, "_p.period", "_p.bucket", band).agg(
        F.avg(value).alias("mean"),
        F.count(F.lit(1)).alias("count"),
        F.var_pop(value).alias("variance"),
    )


def summary_stats(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, min, max, exact median and population variance (NULL when empty)."""
    by = list(by)
    moments = df.groupBy(*by).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.var_pop(value).alias("variance"),
    )
    middle = exact_quantiles(df, value, {"median": 0.5}, by)
    if by:
        return join_on(moments, middle, by, "left")
    return moments.withColumn("median", middle.scalar())


def counted_stats(cells: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """:func:`summary_stats` of values that :func:`ranks.contingency` has counted."""
    by = list(by)
    v, n = F.col(value), F.col("n")
    means = cells.groupBy(*by).agg((F.sum(n * v) / F.sum(n)).alias("_mean"))
    ranked = join_on(value_ranks(cells, value, by, weight="n"), means, by)
    held, gap = F.col("n_equal"), v - F.col("_mean")
    return ranked.groupBy(*by).agg(
        F.sum(held).alias("count"), F.first("_mean").alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"),
        (F.sum(held * gap * gap) / F.sum(held)).alias("variance"), *quantile_columns({"median": 0.5}, value),
    )


def histogram(
    df: DataFrame, value: str, bins: int = 16, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Equal-width bins between the extremes, the last one closed; empty bins are kept.

    A constant column is widened by half a unit on each side.  Rows that are counted already
    stand for ``weight`` rows each.
    """
    by = list(by)
    known = df.filter(F.col(value).isNotNull()).select(*by, value, *([weight] if weight else []))
    ends = known.groupBy(*by).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    flat = F.col("_lo") == F.col("_hi")
    limits = ends.select(
        *by,
        F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
        F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"),
    )
    number = lambda lo, hi: F.least(
        F.width_bucket(F.col(value).cast("double"), lo, hi, F.lit(bins)), F.lit(bins)
    ).cast("int")
    if by:
        numbered = join_on(known, limits, by).withColumn("bin", number(F.col("_lo"), F.col("_hi")))
    else:
        pair = limits.agg(F.struct(F.first("_lo").alias("lo"), F.first("_hi").alias("hi"))).scalar()
        numbered = known.withColumn("bin", number(pair["lo"], pair["hi"]))
    counts = numbered.groupBy(*by, "bin").agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("count"))
    step = (F.col("_hi") - F.col("_lo")) / bins
    frame = limits.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    return join_on(frame, counts, [*by, "bin"], "left").select(
        *by, "bin",
        (F.col("_lo") + (F.col("bin") - 1) * step).alias("low"),
        F.when(F.col("bin") == bins, F.col("_hi")).otherwise(F.col("_lo") + F.col("bin") * step).alias("high"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def site_scatter(daily: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    return daily.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.avg(value).alias("mean"), F.count(F.lit(1)).alias("count")
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, sample sd, min, quartiles, max, skewness."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "metric", "value"
    )
    moments = long.groupBy("metric").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.skewness("value").alias("skewness"),
    )
    quartiles = exact_quantiles(long, "value", {"q25": 0.25, "median": 0.5, "q75": 0.75}, ["metric"])
    return moments.join(quartiles, "metric", "left")


def band_quantiles(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """n, median and quartiles of a value per group."""
    counts = df.groupBy(*by).agg(F.count(value).alias("n"))
    quartiles = exact_quantiles(df, value, {"q25": 0.25, "median": 0.5, "q75": 0.75}, by)
    return join_on(counts, quartiles, list(by), "left")


def boxplot(
    sites: DataFrame, value: str = "mean", elevation: str = "elevation_m", count: str = "count",
    edges: Sequence[float] = BOX_EDGES, labels: Sequence[str] = BOX_BANDS,
) -> DataFrame:
    """Box statistics per elevation class: whiskers end at the extreme values inside the
    1.5-IQR fences, empty classes stay, and sites without finite values or readings do not."""
    usable = sites.filter(is_finite(value) & is_finite(elevation) & (F.col(count) > 0)).select(
        digitize(elevation, tuple(edges)).alias("band"), F.col(value).cast("double").alias("_v")
    )
    box = exact_quantiles(usable, "_v", {"q1": 0.25, "median": 0.5, "q3": 0.75}, ["band"])
    fence = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("_v").between(F.col("q1") - fence, F.col("q3") + fence)
    drawn = (
        usable.join(box, "band")
        .groupBy("band", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("_v"))).alias("low"),
            F.max(F.when(inside, F.col("_v"))).alias("high"),
            F.count(F.lit(1)).alias("points"),
        )
    )
    names = sites.sparkSession.createDataFrame(list(enumerate(labels)), "band int, label string")
    return names.join(drawn, "band", "left").select(
        "band", "label", "q1", "median", "q3", "low", "high",
        F.coalesce("points", F.lit(0)).alias("points"),
    )


def pivot_mean(
    df: DataFrame, rows: Sequence[str], column: str, values: Sequence, measure: str
) -> DataFrame:
    """Matrix of means; the column values are given, so no extra pass looks for them."""
    return df.groupBy(*rows).pivot(column, list(values)).agg(F.avg(measure))


def paired_correlation(x: str, y: str) -> tuple[Column, Column]:
    """(Pearson r, pair count) over the rows where both are known; NULL for a constant."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    r = safe_div(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b))
    return r, F.count_if(both)


def focus_correlations(
    df: DataFrame, focus: str, variables: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Correlation of one variable with each other, pair-complete, strongest first.

    The other variables become rows of (focus, other) values, which are combined before the
    shuffle: one correlation to compile, whatever the number of variables.
    """
    pairs = F.array(*[
        F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("_other")) for v in variables if v != focus
    ])
    long = df.select(*by, F.col(focus).cast("double").alias("_focus"), F.inline(pairs))
    r, n = paired_correlation("_focus", "_other")
    return (
        long.groupBy(*by, "variable").agg(r.alias("correlation"), n.alias("pair_count"))
        .withColumn("absolute_correlation", F.abs("correlation"))
        .orderBy(*by, F.col("absolute_correlation").desc_nulls_last(), "variable")
    )


def _pair_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """i, j, n, sx, sy, sxx, syy, sxy over the rows that hold both columns.

    One matrix product per Arrow batch and one row per pair and task; values are taken from the
    column mean, so large levels lose no digits.
    """
    centre = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    means = np.array([np.nan if centre[c] is None else float(centre[c]) for c in columns])
    width = len(columns)

    def sums(batches):
        total = np.zeros((4, width, width))
        for batch in batches:
            x = batch.to_numpy(dtype=float) - means
            there = ~np.isnan(x)
            x = np.where(there, x, 0.0)
            there = there.astype(float)
            total += np.stack([there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x])
        i, j = np.triu_indices(width)
        yield pd.DataFrame({
            "i": i, "j": j, "n": total[0][i, j], "sx": total[1][i, j], "sy": total[1][j, i],
            "sxx": total[2][i, j], "syy": total[2][j, i], "sxy": total[3][i, j],
        })

    names = ("n", "sx", "sy", "sxx", "syy", "sxy")
    schema = "i int, j int, " + ", ".join(f"{n} double" for n in names)
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.mapInPandas(sums, schema).groupBy("i", "j").agg(*[F.sum(n).alias(n) for n in names])


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long Pearson matrix, pair-complete: every ordered pair, computed once per unordered pair.

    NULL where fewer than two rows hold both columns or one does not vary.
    """
    names = F.array(*[F.lit(c) for c in columns])
    spread = lambda s, ss: F.col(ss) - F.col(s) * F.col(s) / F.col("n")
    # what is left of a constant by rounding is no spread
    varies = lambda s, ss: spread(s, ss) > F.col(ss) * 1e-14
    r = F.when(
        (F.col("n") >= 2) & varies("sx", "sxx") & varies("sy", "syy"),
        F.when(F.col("i") == F.col("j"), 1.0).otherwise(
            (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n"))
            / F.sqrt(spread("sx", "sxx") * spread("sy", "syy"))
        ),
    )
    upper = _pair_sums(df, columns).select(F.get(names, "i").alias("x"), F.get(names, "j").alias("y"), r.alias("r"))
    return upper.unionAll(upper.filter("x <> y").select("y", "x", "r"))


def linear_fit(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line per group; NULL where x is constant."""
    fits = F.count_distinct(F.when(F.col(y).isNotNull(), F.col(x))) >= 2
    return df.groupBy(*by).agg(
        F.when(fits, F.regr_slope(y, x)).alias("slope"),
        F.when(fits, F.regr_intercept(y, x)).alias("intercept"),
        F.regr_count(y, x).alias("n"),
    )


def pair_fits(df: DataFrame, focus: str, variables: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Line of the focus variable on each comparison variable, pooled over all rows."""
    long = df.unpivot([*ids, focus], [v for v in variables if v != focus], "variable", "value")
    return linear_fit(long, "value", focus, ["variable"])


def tally(
    tests: DataFrame, by: Sequence[str], p: str = "p", statistic: str = "statistic",
    level: float = 0.05,
) -> DataFrame:
    """Tests per group below the level, with the range of the statistic and largest p."""
    return tests.groupBy(*by).agg(
        F.count(F.lit(1)).alias("tests"),
        F.count_if(F.col(p) < level).alias("significant"),
        F.min(statistic).alias("min_statistic"),
        F.max(statistic).alias("max_statistic"),
        F.max(p).alias("max_p"),
    )


def daily_slope(
    fact: DataFrame, value: str = "daily_value", elevation: str = "elevation_m",
    by: Sequence[str] = ("country", "date"),
) -> DataFrame:
    """Value against elevation across sites per country and day: at least three sites at
    two heights.  Slope is per km."""
    known = fact.filter(F.col(value).isNotNull() & F.col(elevation).isNotNull())
    return (
        known.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("sample_size"),
            F.count_distinct(elevation).alias("_heights"),
            (F.regr_slope(value, elevation) * 1000).alias("slope_per_km"),
            F.regr_r2(value, elevation).alias("r_squared"),
            F.min(elevation).alias("min_elevation_m"),
            F.max(elevation).alias("max_elevation_m"),
        )
        .filter((F.col("sample_size") >= 3) & (F.col("_heights") >= 2))
        .drop("_heights")
    )


def map_frame(
    window: DataFrame, sites: DataFrame, buckets: Column, value: str = "value",
    site: str = "location_id",
) -> DataFrame:
    """Every site x period of a loaded window (NULL where absent), with one colour scale
    fixed over the whole window."""
    scale = window.agg(
        F.struct(
            F.coalesce(F.min(value), F.lit(0.0)).alias("lo"),
            F.coalesce(F.max(value), F.lit(1.0)).alias("hi"),
        )
    ).scalar()
    grid = sites.select(site, F.explode(buckets).alias("date"))
    return grid.join(window.select(site, "date", value, "hours"), [site, "date"], "left").select(
        site, "date", value, F.coalesce("hours", F.lit(0)).alias("hours"),
        scale["lo"].alias("scale_min"), scale["hi"].alias("scale_max"),
    )


def site_history(frame: DataFrame, chosen, site: str = "location_id") -> DataFrame:
    """One site's rows of a dense map frame, in time order."""
    return frame.filter(F.col(site) == chosen).orderBy("date")


def analytics(
    daily: DataFrame, metrics: Sequence[str], start, end, sites: DataFrame,
    site: str = "location_id",
) -> dict[str, DataFrame]:
    """Several metrics over a closed day range, from complete daily values.

    Tables ``stats``, ``timeline``, ``scatter`` and ``histogram``, each keyed by metric;
    one long frame serves all metrics, so there is no loop over months or metrics.  It is
    written once, and so are its counts by value, from which the moments, the median and the
    bins are formed: the daily values are read once for the whole bundle.
    """
    inside = daily.filter(F.col("date").between(F.lit(start), F.lit(end)))
    placed = with_class(sites).select(site, "name", "elevation_m", "band")
    values = materialise(
        inside.select(site, "date", *[F.col(m).cast("double").alias(m) for m in metrics])
        .unpivot([site, "date"], list(metrics), "metric", "value")
        .filter(F.col("value").isNotNull())
        .join(placed, site),
        "values",
    )
    cells = contingency(values, ["metric", "value"])
    return {
        "stats": counted_stats(cells, "value", ["metric"]),
        "timeline": class_timeline(values, by=["metric"]),
        "scatter": site_scatter(values, "value", ["metric", site, "name", "elevation_m", "band"]),
        "histogram": histogram(cells, "value", 16, ["metric"], weight="n"),
    }
