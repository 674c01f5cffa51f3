"""Least squares from grouped sums: lapse rates, robust errors, Wald tests.

Rows are reduced to p x p moment sums by Spark, solved per group on the reduced rows,
and read a second time for the residual sums.  No group is ever gathered in one place.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from fieldgauge.functions.distributions import norm_ppf, p_f, p_norm, p_t, t_critical
from fieldgauge.operators.joins import change_from_base
from fieldgauge.schemas import LAPSE_SCHEMA
from fieldgauge.session import materialise

# ship the small p x p helpers with the task, so workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DOUBLES = T.ArrayType(T.DoubleType())


def lapse_rates(
    daily: DataFrame, season: str = "season", elevation: str = "elevation_m",
    value: str = "daily_avg_temperature_c",
) -> DataFrame:
    """Pooled line of value on elevation per season, where there are two heights or more.

    One grouped aggregation for all seasons; an empty result keeps the schema.
    """
    x, y = F.col(elevation).cast("double"), F.col(value).cast("double")
    known = daily.select(season, x.alias("_x"), y.alias("_y")).dropna()
    fits = known.groupBy(season).agg(
        F.count_distinct("_x").alias("_heights"),
        F.regr_slope("_y", "_x").alias("slope_c_per_m"),
        F.regr_intercept("_y", "_x").alias("intercept_c"),
        F.regr_r2("_y", "_x").alias("r2"),
        F.regr_syy("_y", "_x").alias("_syy"),
        F.count(F.lit(1)).alias("sample_size"),
    )
    left_over = F.greatest(F.lit(0.0), F.col("_syy") * (1 - F.col("r2")))
    out = fits.filter("_heights >= 2").select(
        F.col(season).alias("season"),
        "slope_c_per_m",
        (F.col("slope_c_per_m") * 1000).alias("lapse_rate_c_per_km"),
        "intercept_c", "r2",
        F.sqrt(left_over / F.col("sample_size")).alias("rmse_c"),
        "sample_size",
    )
    return out.to(daily.sparkSession.createDataFrame([], LAPSE_SCHEMA).schema)


def category_levels(df: DataFrame, column: str, most: int = 200) -> list:
    """Sorted levels of a category, refused beyond ``most`` (use ``absorb`` then)."""
    rows = df.select(column).distinct().orderBy(column).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{column} has more than {most} levels; absorb it instead")
    return [r[0] for r in rows]


def with_dummies(df: DataFrame, column: str, levels: Sequence, drop_first: bool = True) -> tuple[DataFrame, list[str]]:
    """0/1 columns for the levels of a category (the first is the reference level)."""
    used = list(levels)[1 if drop_first else 0:]
    names = [f"{column}={v}" for v in used]
    return df.withColumns(
        {n: (F.col(column) == F.lit(v)).cast("double") for n, v in zip(names, used)}
    ), names


def interact(df: DataFrame, column: str, levels: Sequence, numeric: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Products of every level indicator with every numeric column."""
    made = {
        f"{column}={v}:{x}": F.when(F.col(column) == F.lit(v), F.col(x)).otherwise(0.0)
        for v in levels for x in numeric
    }
    return df.withColumns(made), list(made)


def _square(flat, k: int) -> np.ndarray:
    """Upper triangle, row by row, to a full symmetric matrix."""
    m = np.zeros((k, k))
    m[np.triu_indices(k)] = flat
    return m + np.triu(m, 1).T


@pandas_udf(T.StructType([T.StructField("beta", DOUBLES), T.StructField("inverse", DOUBLES)]))
def _solve(gram: pd.Series, xty: pd.Series) -> pd.DataFrame:
    out = []
    for g, b in zip(gram, xty):
        k = len(b)
        scale = np.sqrt(np.array(g)[[i * k - i * (i - 1) // 2 for i in range(k)]])
        if not np.all(scale > 0):
            out.append((None, None))
            continue
        scaled = _square(g, k) / np.outer(scale, scale)
        if np.linalg.matrix_rank(scaled, tol=1e-10) < k:
            out.append((None, None))
            continue
        inverse = np.linalg.inv(scaled) / np.outer(scale, scale)
        out.append((list(inverse @ np.array(b)), list(inverse.ravel())))
    return pd.DataFrame(out, columns=["beta", "inverse"])


@pandas_udf(DOUBLES)
def _sandwich(inverse: pd.Series, meat: pd.Series) -> pd.Series:
    out = []
    for inv, m in zip(inverse, meat):
        k = int(round(len(inv) ** 0.5)) if inv is not None else 0
        if not k or m is None:
            out.append(None)
            continue
        bread = np.array(inv).reshape(k, k)
        out.append(list((bread @ _square(m, k) @ bread).ravel()))
    return pd.Series(out)


@pandas_udf(T.DoubleType())
def _wald(beta: pd.Series, cov: pd.Series, which: pd.Series) -> pd.Series:
    out = []
    for b, c, w in zip(beta, cov, which):
        if b is None or c is None:
            out.append(None)
            continue
        k, pick = len(b), np.array(w, dtype=int)
        v = np.array(c).reshape(k, k)[np.ix_(pick, pick)]
        sub = np.array(b)[pick]
        out.append(float(sub @ np.linalg.solve(v, sub)) / len(pick))
    return pd.Series(out, dtype="float64")


def _dot(a: Sequence[Column], b: Sequence[Column]) -> Column:
    total = F.lit(0.0)
    for x, y in zip(a, b):
        total = total + x * y
    return total


def _moments(
    rows: DataFrame, keys: Sequence[str], values: Sequence[Column], pairs: Sequence[tuple[int, int]],
    output: str, extra: Sequence[Column], weight: Column | None = None,
) -> DataFrame:
    """Per group the sums of products of value pairs, as one array in pair order, and
    the ``extra`` aggregates.

    A few pairs are plain aggregates.  Hundreds of them in one aggregation would outgrow
    what the JVM compiles; the products are then formed per Arrow batch as one matrix
    product and group, and Spark adds up these partial sums.
    """
    w = F.lit(1.0) if weight is None else weight
    if len(pairs) <= 45:
        sums = [F.sum(w * values[i] * values[j]) for i, j in pairs]
        return rows.groupBy(*keys).agg(F.array(*sums).alias(output), *extra)
    names = [f"_v{i}" for i in range(len(values))]
    held = rows.select(*keys, w.alias("_w"), *[v.alias(n) for v, n in zip(values, names)])
    left, right = (np.array(side) for side in zip(*pairs))
    labels = list(keys)

    def partial(batches):
        for batch in batches:
            found = []
            for key, part in batch.groupby(labels, dropna=False, sort=False):
                x = part[names].to_numpy(dtype=float)
                weighted = x * part["_w"].to_numpy(dtype=float)[:, None]
                found.append((*key, (weighted.T @ x)[left, right]))
            yield pd.DataFrame(found, columns=[*labels, "_x"])

    schema = T.StructType([held.schema[k] for k in labels] + [T.StructField("_x", DOUBLES)])
    summed = (
        held.mapInPandas(partial, schema)
        .select(*keys, F.posexplode("_x").alias("_pos", "_x"))
        .groupBy(*keys, "_pos").agg(F.sum("_x").alias("_x"))
    )
    products = summed.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_x"))), lambda s: s["_x"]).alias(output)
    )
    return products.join(rows.groupBy(*keys).agg(*extra), keys)


def _per_group(rows: DataFrame, one_per_group: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach group results to rows.  Without groups there is exactly one result row."""
    return rows.join(one_per_group if by else F.broadcast(one_per_group), list(by) or ["_all"])


def ols(
    df: DataFrame, y: str, x: Sequence[str], by: Sequence[str] = (), absorb: Sequence[str] = (),
    covariance: str = "hc3", cluster: str | None = None,
) -> DataFrame:
    """Least squares per group with HC3 or cluster-robust covariance.

    ``absorb`` fits an own intercept for every combination of these columns without
    making dummies (the within transformation: slopes, residuals, leverages and errors are
    those of the full dummy regression).  Without it a constant is added.

    One row per group: n, parameters, clusters, beta, cov (flattened), sse, sst and terms.
    Rows with a missing value are left out.
    """
    if covariance not in ("hc3", "cluster") or (covariance == "cluster") != (cluster is not None):
        raise ValueError("covariance is hc3, or cluster with a cluster column")
    keys = list(by) or ["_all"]
    extra = [cluster] if cluster else []
    columns = list(dict.fromkeys([*by, *absorb, *extra]))
    rows = df.select(
        *columns, F.col(y).cast("double").alias("_y"),
        *[F.col(v).cast("double").alias(f"_x{i}") for i, v in enumerate(x)],
    ).dropna(subset=["_y", *[f"_x{i}" for i in range(len(x))]])
    if not by:
        rows = rows.withColumn("_all", F.lit(0))
    terms = list(x)
    xs = [f"_x{i}" for i in range(len(x))]
    if absorb:
        cell = list(dict.fromkeys([*keys, *absorb]))
        means = rows.groupBy(*cell).agg(
            F.count(F.lit(1)).alias("_size"), F.avg("_y").alias("_my"),
            *[F.avg(c).alias(f"_m{c}") for c in xs],
        )
        rows = rows.join(means, cell).withColumns(
            {"_yc": F.col("_y") - F.col("_my"), **{c: F.col(c) - F.col(f"_m{c}") for c in xs}}
        )
        base_leverage = 1 / F.col("_size")
        n_absorbed = F.sum(1 / F.col("_size"))  # one per absorbed cell
        target = F.col("_yc")
        design = [F.col(c) for c in xs]
    else:
        terms = ["intercept", *terms]
        base_leverage, n_absorbed = F.lit(0.0), F.lit(0.0)
        target = F.col("_y")
        design = [F.lit(1.0), *[F.col(c) for c in xs]]
    k = len(design)
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    sums = _moments(
        rows, keys, [*design, target], [*upper, *[(i, k) for i in range(k)]], "_sums",
        [
            F.count(F.lit(1)).alias("n"),
            n_absorbed.alias("_absorbed"),
            F.regr_syy("_y", "_y").alias("sst"),
        ],
    ).withColumns(
        {
            "_gram": F.slice("_sums", 1, len(upper)),
            "_xty": F.slice("_sums", len(upper) + 1, k),
        }
    )
    solved = sums.withColumn("_s", _solve("_gram", "_xty")).select(
        *keys, "n", (F.round("_absorbed") + k).cast("int").alias("parameters"), "sst",
        "_s.beta", "_s.inverse",
    )
    # one row per group, written once: the second pass must not repeat the first
    solved = materialise(solved, "solved")
    beta = [F.col("beta")[i] for i in range(k)]
    fitted = _per_group(rows, solved.select(*keys, "beta", "inverse"), by).withColumn(
        "_e", target - _dot(design, beta)
    )
    if covariance == "hc3":
        inner = [_dot(design, [F.col("inverse")[i * k + j] for j in range(k)]) for i in range(k)]
        free = 1 - (base_leverage + _dot(design, inner))
        scored = fitted.withColumn("_w", F.when(free > 1e-12, F.pow(F.col("_e") / free, 2)).otherwise(0.0))
        spread = _moments(
            scored, keys, design, upper, "_meat",
            [F.sum(F.col("_e") * F.col("_e")).alias("sse"), F.lit(None).cast("bigint").alias("clusters")],
            F.col("_w"),
        )
    else:
        per_cluster = fitted.groupBy(*dict.fromkeys([*keys, cluster])).agg(
            *[F.sum(d * F.col("_e")).alias(f"_g{i}") for i, d in enumerate(design)],
            F.sum(F.col("_e") * F.col("_e")).alias("_sse"),
        )
        spread = _moments(
            per_cluster, keys, [F.col(f"_g{i}") for i in range(k)], upper, "_meat",
            [F.sum("_sse").alias("sse"), F.count(F.lit(1)).alias("clusters")],
        )
    joined = solved.join(spread, keys)
    n, p, g = F.col("n"), F.col("parameters"), F.col("clusters")
    small_sample = F.when(g.isNull(), 1.0).otherwise(
        F.try_divide(g, g - 1) * F.try_divide(n - 1, n - p)
    )
    return joined.withColumn("_v", _sandwich("inverse", "_meat")).select(
        *by, "n", "parameters", "clusters", "beta",
        F.transform("_v", lambda v: v * small_sample).alias("cov"),
        "sse", "sst", (1 - F.try_divide("sse", "sst")).alias("r2"),
        F.array(*[F.lit(t) for t in terms]).alias("terms"),
    )


def coefficients(fit: DataFrame, by: Sequence[str] = (), use_t: bool = True, level: float = 0.05) -> DataFrame:
    """One row per term: coefficient, robust error, statistic, p-value and interval."""
    k = F.size("beta")
    long = fit.select(
        *by, "n", "parameters", "clusters", "r2", F.posexplode("terms").alias("_i", "term"), "beta", "cov",
    ).select(
        *by, "term", "n", "r2",
        F.coalesce(F.col("clusters") - 1, F.col("n") - F.col("parameters")).alias("df"),
        F.get("beta", F.col("_i")).alias("coef"),
        F.sqrt(F.get("cov", F.col("_i") * k + F.col("_i"))).alias("standard_error"),
    ).withColumn("statistic", F.try_divide("coef", "standard_error"))
    if use_t:
        p, width = p_t("statistic", "df"), t_critical(F.lit(level), F.col("df"))
    else:
        p, width = p_norm("statistic"), norm_ppf(F.lit(1 - level / 2))
    return long.withColumns({"p": p, "_width": width}).select(
        *by, "term", "n", "r2", "coef", "standard_error", "statistic", "p",
        (F.col("coef") - F.col("_width") * F.col("standard_error")).alias("ci_low"),
        (F.col("coef") + F.col("_width") * F.col("standard_error")).alias("ci_high"),
    )


def wald(fit: DataFrame, tested: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """F test that the coefficients at the given positions are all zero."""
    which = F.array(*[F.lit(i) for i in tested])
    return (
        fit.withColumn("statistic", _wald("beta", "cov", which))
        .withColumn("df_num", F.lit(len(tested)))
        .withColumn("df_denom", F.coalesce(F.col("clusters") - 1, F.col("n") - F.col("parameters")))
        .withColumn("p", p_f("statistic", "df_num", "df_denom"))
        .select(*by, "statistic", "df_num", "df_denom", "p")
    )


def paired_change_wald(
    months: DataFrame, value: str, chosen: Sequence[int], site: str = "location_id",
    group: str = "country", covariates: Sequence[str] = ("latitude", "longitude"),
    elevation: str = "elevation_km", month: str = "month", cluster: str | None = None,
) -> DataFrame:
    """Does the change since the first chosen month depend on elevation?

    Paired site changes, an own intercept per month and group, month-specific slopes, and
    a clustered F test on the month x elevation terms.
    """
    kept = months.filter(F.col(month).isin(list(chosen)))
    changes = change_from_base(kept, value, chosen[0], site, month)
    design, names = interact(changes, month, list(chosen[1:]), [*covariates, elevation])
    fit = ols(
        design, "change", names, absorb=[month, group], covariance="cluster", cluster=cluster or site
    )
    tested = [i for i, n in enumerate(names) if n.endswith(f":{elevation}")]
    return wald(fit, tested)
