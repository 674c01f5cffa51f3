"""Correlation and rank tests over many cells at once, and multiple-test adjustment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldgauge.functions.distributions import p_chi2, p_t
from fieldgauge.functions.scalars import safe_div
from fieldgauge.operators.ranks import cell_ranks, contingency, join_on, running_max, small_group_rank, value_ranks


def pair_rows(df: DataFrame, pairs: Sequence[tuple[str, str]], by: Sequence[str] = ()) -> DataFrame:
    """Long rows (group, predictor, outcome, x, y) with both values known."""
    cells = F.array(
        *[
            F.struct(
                F.lit(a).alias("predictor"), F.lit(b).alias("outcome"),
                F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"),
            )
            for a, b in pairs
        ]
    )
    return df.select(*by, F.inline(cells)).filter(F.col("x").isNotNull() & F.col("y").isNotNull())


def with_scopes(df: DataFrame, scopes: dict[str, Column], output: str = "scope") -> DataFrame:
    """Copy each row into every scope whose condition it meets."""
    named = F.array(*[F.when(cond, F.lit(name)) for name, cond in scopes.items()])
    return df.withColumn(output, F.explode(F.array_compact(named)))


def _correlated(rows: DataFrame, x: str, y: str, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        safe_div(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y)).alias("r"),
    )


def _tested(result: DataFrame) -> DataFrame:
    """Student-t p-value of a correlation with n - 2 degrees of freedom."""
    free = F.greatest(F.col("n") - 2, F.lit(0))
    t = F.when(F.abs("r") < 1, F.col("r") * F.sqrt(safe_div(free, 1 - F.col("r") * F.col("r"))))
    return result.withColumn("_t", t).withColumn("_df", F.when(free > 0, free)).withColumn(
        "p", F.when((F.abs("r") >= 1) & (free > 0), 0.0).otherwise(p_t("_t", "_df"))
    ).drop("_t", "_df")


def pearson(df: DataFrame, pairs: Sequence[tuple[str, str]], by: Sequence[str] = ()) -> DataFrame:
    keys = [*by, "predictor", "outcome"]
    return _tested(_correlated(pair_rows(df, pairs, by), "x", "y", keys))


def spearman(df: DataFrame, pairs: Sequence[tuple[str, str]], by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of the mid-ranks of both values.

    The rows are counted by (x, y) once; both margins are ranked from the counts.  Ranks have
    the mean (n + 1) / 2, so the sums of products are centred as they are formed.
    """
    keys = [*by, "predictor", "outcome"]
    cells = contingency(pair_rows(df, pairs, by), [*keys, "x", "y"])
    ranked = cell_ranks(cell_ranks(cells, "x", keys, "_rx"), "y", keys, "_ry")
    sizes = cells.groupBy(*keys).agg(F.sum("n").alias("_total"))
    n, middle = F.col("n"), (F.col("_total") + 1) / 2
    x, y = F.col("_rx") - middle, F.col("_ry") - middle
    sums = join_on(ranked, sizes, keys).groupBy(*keys).agg(
        F.sum(n).alias("n"), F.sum(n * x * y).alias("_xy"), F.sum(n * x * x).alias("_xx"), F.sum(n * y * y).alias("_yy")
    )
    # one row has no correlation, as its covariance has no degree of freedom
    r = F.when(F.col("n") > 1, safe_div(F.col("_xy"), F.sqrt(F.col("_xx")) * F.sqrt(F.col("_yy"))))
    return _tested(sums.select(*keys, "n", r.alias("r")))


def kruskal(df: DataFrame, group: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Kruskal-Wallis H (tie-corrected through the variance of the ranks) and its p-value.

    Formed from the counts of (group, value), not from the rows.
    """
    by = list(by)
    known = df.select(*by, group, value).filter(F.col(value).isNotNull())
    cells = cell_ranks(contingency(known, [*by, group, value]), value, by, "_r")
    weight, rank = F.col("n"), F.col("_r")
    parts = cells.groupBy(*by, group).agg(
        F.sum(weight).alias("_n"), F.sum(weight * rank).alias("_s"), F.sum(weight * rank * rank).alias("_ss")
    )
    total, squares = F.sum("_s"), F.sum("_ss")
    n = F.sum("_n")
    between = F.sum(F.col("_s") * F.col("_s") / F.col("_n")) - total * total / n
    variance = F.try_divide(squares - total * total / n, n - 1)
    return (
        parts.groupBy(*by)
        .agg(n.alias("n"), F.count(F.lit(1)).alias("groups"), safe_div(between, variance).alias("statistic"))
        .withColumn("p", p_chi2("statistic", F.col("groups") - 1))
    )


def friedman(
    df: DataFrame, block: str, treatment: str, value: str, by: Sequence[str] = ()
) -> DataFrame:
    """Friedman Q (tie-corrected) and Kendall W; blocks without every treatment drop out.

    A block holds one value per treatment (twelve months of a year), so ranking it is a
    small window.
    """
    by = list(by)
    treatments = df.filter(F.col(value).isNotNull()).groupBy(*by).agg(
        F.count_distinct(treatment).alias("_k")
    )
    known = df.select(*by, block, treatment, value).filter(F.col(value).isNotNull())
    full = known.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*by, block)))
    full = (full.join(treatments, by) if by else full.withColumn("_k", treatments.scalar())).filter(
        F.col("_n") == F.col("_k")
    )
    same = F.count(F.lit(1)).over(Window.partitionBy(*by, block, value))
    ranked = full.withColumns(
        {"_r": small_group_rank(value, [*by, block]), "_tie": same * same - 1}
    )
    sums = ranked.groupBy(*by, treatment).agg(
        F.sum("_r").alias("_s"), F.sum("_tie").alias("_ties"),
        F.count(F.lit(1)).alias("blocks"), F.max("_k").alias("treatments"),
    )
    whole = sums.groupBy(*by).agg(
        F.sum(F.col("_s") * F.col("_s")).alias("_ss"), F.sum("_ties").alias("_ties"),
        F.max("blocks").alias("blocks"), F.max("treatments").alias("treatments"),
    )
    b, k = F.col("blocks"), F.col("treatments")
    correction = 1 - F.col("_ties") / (b * k * (k * k - 1))
    q = safe_div(12.0 / (b * k * (k + 1)) * F.col("_ss") - 3 * b * (k + 1), correction)
    return whole.select(
        *by, "blocks", "treatments", q.alias("statistic"), (q / (b * (k - 1))).alias("kendall_w")
    ).withColumn("p", p_chi2("statistic", F.col("treatments") - 1))


def holm(
    tests: DataFrame, p: str, family: Sequence[str] = (), output: str | None = None
) -> DataFrame:
    """Holm step-down adjusted p-values inside each family.

    Tests with the same p share the largest multiplier, (tests - tests below), and the
    running maximum keeps the order; both come from sliced ranks, so one family with
    very many tests is not sorted in one task.
    """
    family, output = list(family), output or f"{p}_holm"
    ranked = value_ranks(tests, p, family, keep_slice=True)
    adjusted = running_max(
        ranked, p, F.least(F.lit(1.0), (F.col("n_total") - F.col("n_before")) * F.col(p)), family, output
    )
    # a NULL family is a family
    return join_on(tests, adjusted, [*family, p], "left")
