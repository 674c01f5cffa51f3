"""Union, long and matrix forms, distinct values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    """Concatenate by column name, keeping duplicates."""
    return reduce(DataFrame.unionByName, frames)


def to_long(
    df: DataFrame, ids: Sequence[str], metrics: Sequence[str], drop_missing: bool = False,
    metric: str = "metric", value: str = "value",
) -> DataFrame:
    """One row per id and metric (lower-cased); missing values stay unless dropped."""
    typed = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    long = typed.unpivot(list(ids), list(metrics), metric, value).withColumn(metric, F.lower(metric))
    return long.filter(F.col(value).isNotNull()) if drop_missing else long


def to_matrix(
    df: DataFrame, rows: Sequence[str], column: str, values: Sequence, measure: str
) -> DataFrame:
    """Matrix with the given columns; a cell that occurs twice fails rather than hides."""
    cell = F.when(F.count(measure) <= 1, F.max(measure)).otherwise(
        F.raise_error(F.lit("matrix cell occurs more than once")).cast("double")
    )
    return df.groupBy(*rows).pivot(column, list(values)).agg(cell)


def matrix_array(
    df: DataFrame, by: Sequence[str], row: str, column: str, measure: str, output: str = "matrix"
) -> DataFrame:
    """Per group a dense array of rows, each an array over the columns in order.

    A group is a calendar cell (years x days of a month or months), so it is small.
    """
    lines = df.groupBy(*by, row).agg(
        F.array_sort(F.collect_list(F.struct(F.col(column), F.col(measure).cast("double").alias("_v")))).alias("_line")
    )
    return lines.groupBy(*by).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col(row), F.col("_line")))),
            lambda r: F.transform(r["_line"], lambda c: c["_v"]),
        ).alias(output)
    )


def is_rectangular(matrix: Column | str, rows: int | None = None, columns: int | None = None) -> Column:
    m = F.col(matrix) if isinstance(matrix, str) else matrix
    width = F.size(m[0])
    ok = F.forall(m, lambda r: (F.size(r) == width) & F.forall(r, lambda v: v.isNotNull()))
    if rows is not None:
        ok = ok & (F.size(m) == rows)
    if columns is not None:
        ok = ok & (width == columns)
    return ok


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()
