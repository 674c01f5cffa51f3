"""Ordered and bounded results, top-k, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from fieldgauge.operators.ranks import positions

# fixed values: share of rows drawn per time grain
PLOT_FRACTION = {"hour": 0.05, "day": 0.5, "week": 1.0, "month": 1.0}


def bounded(df: DataFrame, keys: Sequence[str], most: int = 10000) -> DataFrame:
    """Rows in key order; fails when there are more than ``most``.

    Reads one row past the bound, and counts only those rows.
    """
    head = df.orderBy(*keys).limit(most + 1)
    total = F.count(F.lit(1)).over(Window.partitionBy())
    too_many = F.raise_error(F.lit(f"the result exceeds {most} rows")).cast("boolean")
    return (
        head.withColumn("_rows", total)
        .filter(F.when(F.col("_rows") > most, too_many).otherwise(F.lit(True)))
        .drop("_rows")
        .orderBy(*keys)
    )


def top_k(df: DataFrame, value: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The ``k`` largest values; tie keys make the choice repeatable."""
    return df.filter(F.col(value).isNotNull()).orderBy(F.col(value).desc(), *ties).limit(k)


def top_n_nulls_last(df: DataFrame, score: str, n: int, ties: Sequence[str]) -> DataFrame:
    return df.orderBy(F.col(score).desc_nulls_last(), *ties).limit(n)


def draw_order(keys: Sequence[str], seed: int) -> Column:
    """Digest of the row key and the seed, written out as text: the order of a random draw.

    It depends on the values of the keys alone, so a draw does not change with the partitioning,
    when a lost task is run again, or with the engine that repeats it.
    """
    return F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def sample_for_plot(df: DataFrame, grain: str, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Share of the rows that suits the grain, then at most ``n`` of them."""
    place = F.conv(F.substring(draw_order(keys, seed), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    return sample_n(df.filter(place < PLOT_FRACTION[grain]), n, keys, seed + 1)


def sample_n(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Random sample of fixed size, the same on every run: the first ``n`` rows in draw order."""
    return df.orderBy(draw_order(keys, seed), *keys).limit(n)


def even_hours(df: DataFrame, n: int = 400, ts: str = "timestamp") -> DataFrame:
    """All rows of up to ``n`` instants spread evenly over those present.

    Every site at a chosen instant is kept.
    """
    stamps = positions(df.select(F.unix_micros(F.col(ts).cast("timestamp")).alias("_at")), "_at")
    last = F.max("n_values") - 1
    chosen = (
        stamps.agg(last.alias("_last"))
        .select(
            "_last",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.least(F.lit(n - 1), F.col("_last")))).alias("_i"),
        )
        .select(
            F.when(F.col("_last") < n, F.col("_i"))
            .when(F.col("_i") == n - 1, F.col("_last"))
            .otherwise(F.floor(F.col("_i") * (F.col("_last") / max(n - 1, 1))))
            .alias("position")
        )
        .distinct()
    )
    kept = stamps.join(chosen, "position", "left_semi").select("_at")
    return (
        df.withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp")))
        .join(kept, "_at", "left_semi")
        .drop("_at")
    )
