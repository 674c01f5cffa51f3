"""Positions in a global order, found without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldgauge.session import materialise


def positions(keys: DataFrame, within: list[str], by: list[str], name: str = "position") -> DataFrame:
    """Adds the 0-based position of each row in its ``within`` group, ordered by ``by``.

    The rows are range-partitioned and sorted once, so a hot group spreads over as many tasks
    as its rows need; only one count per (partition, group) is summed afterwards.  Nulls sort
    first.  Rows that tie on every ``by`` column get consecutive positions in any order.  The
    sorted rows are written to the shared folder, because partition numbers must not change
    between the two passes.
    """
    order = [F.col(c) for c in [*within, *by]]
    cut = materialise(
        keys.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}),
        "positions",
    )
    counts = cut.groupBy("_part", *within).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = F.coalesce(
        F.sum("_n").over(
            Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    # a group spans few partitions unless it is hot, and then one row per partition
    starts = counts.select("_part", *[F.col(c).alias(f"_{c}") for c in within], "_first", before.alias("_before"))
    same = F.col("k._part") == F.col("s._part")
    for c in within:
        same &= F.col(f"k.{c}").eqNullSafe(F.col(f"s._{c}"))
    return (
        cut.alias("k")
        .join(starts.alias("s"), same)
        .select(*[F.col(f"k.{c}") for c in keys.columns],
                (F.col("_before") + F.col("_row") - F.col("_first")).alias(name))
    )
