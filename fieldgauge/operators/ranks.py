"""Exact ranks, positions and quantiles without pulling a group into one task.

A plain ``rank()`` or ``percentile()`` gathers a whole group in one place.  Here
the distinct values of each group are split at sketched cut points, counted and
numbered slice by slice, and every slice is shifted by the exact number of rows
below it.  The sketch only balances the slices; it never enters the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldgauge.session import materialise

#: least number of slices; a session with more shuffle partitions gets as many slices
SLICES = 64


def slice_count(df: DataFrame) -> int:
    """A power of two that follows the number of shuffle partitions, and so the cluster."""
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(SLICES, 1 << max(0, wanted - 1).bit_length())


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL; the left keys are kept."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def value_ranks(
    df: DataFrame, value: str, by: Sequence[str] = (), keep_slice: bool = False, weight: str | None = None
) -> DataFrame:
    """One row per (group, distinct value): ``n_equal``, ``n_before``, ``n_total``.

    NULL values take no part; a NULL group is a group.  ``n_before`` counts the rows strictly below.  The slice
    number (ascending with the value) can be kept for further prefix computations.  Rows that
    are counted already stand for ``weight`` rows each.
    """
    by = list(by)
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n_equal"))
    )
    slices = slice_count(df)
    cuts = F.percentile_approx(
        F.col(value).cast("double"), [i / slices for i in range(1, slices)], max(2000, 32 * slices)
    )
    if by:
        edges = counts.groupBy(*by).agg(cuts.alias("_cuts"))
        sliced = join_on(counts, edges, by)
    else:
        sliced = counts.withColumn("_cuts", counts.agg(cuts.alias("_cuts")).scalar())
    sliced = _with_slice(sliced, F.col(value).cast("double"), slices).select(*by, value, "n_equal", "_slice")
    inside = Window.partitionBy(*by, "_slice").orderBy(value)
    numbered = sliced.withColumn(
        "_below_in_slice",
        F.coalesce(F.sum("n_equal").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    # one row per group and slice from here on
    sizes = sliced.groupBy(*by, "_slice").agg(F.sum("n_equal").alias("_n"))
    across = Window.partitionBy(*by)
    offsets = sizes.select(
        *by, "_slice",
        F.coalesce(
            F.sum("_n").over(across.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_below_slice"),
        F.sum("_n").over(across).alias("n_total"),
    )
    return join_on(numbered, offsets, [*by, "_slice"]).select(
        *by, value, "n_equal",
        (F.col("_below_slice") + F.col("_below_in_slice")).alias("n_before"),
        "n_total", *(["_slice"] if keep_slice else []),
    )


def _with_slice(df: DataFrame, value: Column, slices: int) -> DataFrame:
    """Number of cut points at or below the value, by halving the sorted points: six steps for 64
    slices rather than a look at each."""
    step = slices // 2
    df = df.withColumn("_slice", F.lit(0))
    while step:
        at = F.get("_cuts", F.col("_slice") + (step - 1))
        df = df.withColumn("_slice", F.col("_slice") + F.when(at <= value, step).otherwise(0))
        step //= 2
    return df


def running_max(
    ranked: DataFrame, value: str, candidate: Column, by: Sequence[str], output: str
) -> DataFrame:
    """Largest candidate at or below each value, over rows kept with their slice."""
    by = list(by)
    rows = ranked.withColumn("_candidate", candidate)
    inside = Window.partitionBy(*by, "_slice").orderBy(value)
    peaks = rows.groupBy(*by, "_slice").agg(F.max("_candidate").alias("_peak"))
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = peaks.select(*by, "_slice", F.max("_peak").over(earlier).alias("_before"))
    return (
        join_on(rows.withColumn("_inside", F.max("_candidate").over(inside)), before, [*by, "_slice"])
        .select(*by, value, F.greatest("_inside", "_before").alias(output))
    )


def avg_rank(
    df: DataFrame, value: str, by: Sequence[str] = (), output: str | None = None
) -> DataFrame:
    """Add the mid-rank of ``value`` in its group; ties share their average rank."""
    by = list(by)
    ranks = value_ranks(df, value, by).select(
        *by, value, (F.col("n_before") + (F.col("n_equal") + 1) / 2).alias(output or f"{value}_rank")
    )
    return join_on(df, ranks, [*by, value], "left")


def contingency(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of ``columns`` with ``n``, the rows that hold them.

    Rank statistics of several margins are sums over these cells, so raw rows are shuffled once
    and combine before that.  The cells are written, as every margin reads them again.
    """
    return materialise(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")), "cells")


def cell_ranks(cells: DataFrame, value: str, by: Sequence[str], output: str) -> DataFrame:
    """Add the mid-rank of ``value`` in its group to cells counted by :func:`contingency`."""
    by = list(by)
    ranks = value_ranks(cells, value, by, weight="n").select(
        *by, value, (F.col("n_before") + (F.col("n_equal") + 1) / 2).alias(output)
    )
    return join_on(cells, ranks, [*by, value])


def row_positions(df: DataFrame, order: Sequence[Column | str], output: str = "position") -> DataFrame:
    """Add the 0-based position of each row in the order of several columns.

    Rows are sorted by ranges of all the order columns, so equal leading values spread over as
    many tasks as they need; the rows before each range are a running sum over one count per
    range.  The sorted rows are written, as ranges must not move between the two steps.
    """
    placed = materialise(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(), "_line": F.monotonically_increasing_id()}),
        "positions",
    )
    ranges = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_line").alias("_first"))
    earlier = Window.partitionBy().orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    return placed.join(starts, "_part").withColumn(output, F.col("_line") + F.col("_shift")).drop("_part", "_line", "_shift")


def small_group_rank(value: str, by: Sequence[str]) -> Column:
    """Mid-rank by window, for groups a calendar bounds (months of a year, days of a month)."""
    group = Window.partitionBy(*by)
    ties = F.count(F.lit(1)).over(Window.partitionBy(*by, value))
    return F.rank().over(group.orderBy(value)) + (ties - 1) / 2


def quantile_columns(probs: dict[str, float], value: str) -> list[Column]:
    """Aggregates over :func:`value_ranks` rows giving linear-interpolated quantiles."""

    def at(position: Column) -> Column:
        holds = (F.col("n_before") <= position) & (position < F.col("n_before") + F.col("n_equal"))
        return F.max(F.when(holds, F.col(value).cast("double")))

    out = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("n_total") - 1)
        low, high = at(F.floor(pos)), at(F.ceil(pos))
        weight = F.max(pos - F.floor(pos))
        out.append((low + (high - low) * weight).alias(name))
    return out


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """One row per group with the named exact quantiles (same rule as numpy's default)."""
    return value_ranks(df, value, by).groupBy(*by).agg(*quantile_columns(probs, value))


def positions(df: DataFrame, value: str) -> DataFrame:
    """Distinct values with their 0-based position in ascending order and the count."""
    return value_ranks(df.select(value).distinct(), value).select(
        value, F.col("n_before").alias("position"), F.col("n_total").alias("n_values")
    )
