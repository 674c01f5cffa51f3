"""Statistics against direct computation on small data."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldgauge.functions import distributions as dist
from fieldgauge.operators import association, models, regression, resampling, reshape


def test_tail_probabilities(spark):
    df = spark.createDataFrame([(2.228138852, 10.0)], "t double, n double")
    row = df.select(
        dist.p_t("t", "n").alias("t"), dist.p_t(F.lit(30.0), F.lit(5)).alias("far"),
        dist.p_f(F.lit(4.102821), F.lit(2), F.lit(10)).alias("f"),
        dist.p_chi2(F.lit(3.841458821), F.lit(1)).alias("c"), dist.p_chi2(F.lit(200.0), F.lit(3)).alias("c_far"),
        dist.norm_ppf(F.lit(0.975)).alias("q"), dist.p_norm(F.lit(1.959963985)).alias("z"),
        dist.t_critical(F.lit(0.05), F.lit(10)).alias("crit"), dist.p_t(F.lit(None), F.lit(3)).alias("none"),
    ).first()
    # far tail by the trapezoid rule on u = 1/t
    u = np.linspace(1e-9, 1 / 30, 200_001)
    density = math.gamma(3) / (math.sqrt(5 * math.pi) * math.gamma(2.5)) * (1 + 1 / (5 * u * u)) ** -3 / (u * u)
    far = 2 * float(np.sum((density[1:] + density[:-1]) / 2 * np.diff(u)))
    assert row.t == pytest.approx(0.05, abs=1e-8) and row.far == pytest.approx(far, rel=1e-6)
    assert row.f == pytest.approx(0.05, abs=1e-6) and row.c == pytest.approx(0.05, abs=1e-9)
    # chi-square with 3 df has a closed form
    assert row.c_far == pytest.approx(math.erfc(10) + math.sqrt(400 / math.pi) * math.exp(-100), rel=1e-6)
    assert row.q == pytest.approx(1.959963985) and row.z == pytest.approx(0.05, abs=1e-9)
    assert row.crit == pytest.approx(2.228138852) and row.none is None


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)], "x double, y double")
    row = association.pearson(df, [("x", "y")]).first()
    assert row.r is None and row.p is None and row.n == 3


def test_holm_matches_step_down(spark):
    p = [0.01, 0.04, 0.03, 0.005, 0.03, 0.9]
    df = spark.createDataFrame([("f", i, v) for i, v in enumerate(p)], "family string, i int, p double")
    order = sorted(range(len(p)), key=lambda i: p[i])
    want, top = {}, 0.0
    for k, i in enumerate(order):
        top = max(top, (len(p) - k) * p[i])
        want[i] = min(1.0, top)
    for r in association.holm(df, "p", ["family"]).collect():
        assert r.p_holm == pytest.approx(want[r.i])


def design(rng, n=60):
    country = rng.integers(0, 6, n)
    x = rng.normal(size=(n, 2)) + country[:, None]
    y = 2 - 3 * x[:, 0] + 0.5 * x[:, 1] + country + rng.normal(size=n)
    return country, x, y


def dummy_fit(country, x, y, kind, cluster=None):
    levels = np.unique(country)
    full = np.column_stack([x, *[(country == c).astype(float) for c in levels]])
    inv = np.linalg.inv(full.T @ full)
    beta = inv @ full.T @ y
    e = y - full @ beta
    n, k = full.shape
    if kind == "hc3":
        h = np.einsum("ij,jk,ik->i", full, inv, full)
        s = full * (e / (1 - h))[:, None]
        cov = inv @ (s.T @ s) @ inv
    else:
        s = np.array([(full[cluster == c] * e[cluster == c][:, None]).sum(axis=0) for c in np.unique(cluster)])
        g = len(s)
        cov = inv @ (s.T @ s) @ inv * g / (g - 1) * (n - 1) / (n - k)
    return beta[:2], cov[:2, :2]


@pytest.mark.parametrize("kind", ["hc3", "cluster"])
def test_absorbed_ols_equals_dummy_regression(spark, kind):
    rng = np.random.default_rng(5)
    country, x, y = design(rng)
    site = np.arange(len(y)) // 3
    df = spark.createDataFrame(
        [(int(c), int(s), float(a), float(b), float(v)) for c, s, (a, b), v in zip(country, site, x, y)],
        "country int, site int, x0 double, x1 double, y double")
    fit = regression.ols(df, "y", ["x0", "x1"], absorb=["country"], covariance=kind,
                         cluster="site" if kind == "cluster" else None)
    row = fit.first()
    beta, cov = dummy_fit(country, x, y, kind, site)
    assert row.beta == pytest.approx(list(beta)) and row["cov"] == pytest.approx(list(cov.ravel()))
    assert row.parameters == 2 + len(set(country))
    wald = regression.wald(fit, [0, 1]).first()
    assert wald.statistic == pytest.approx(beta @ np.linalg.solve(cov, beta) / 2)
    # the same through explicit dummies, wide enough for the batched sums
    wide, names = regression.with_dummies(df, "country", sorted(set(country.tolist())))
    extra = [f"z{i}" for i in range(4)]
    wide = wide.withColumns({z: F.sin(F.col("x0") * (i + 2)) for i, z in enumerate(extra)})
    many = regression.ols(wide, "y", ["x0", "x1", *names, *extra], covariance=kind,
                          cluster="site" if kind == "cluster" else None).first()
    full = np.column_stack([np.ones(len(y)), x, *[(country == c).astype(float) for c in sorted(set(country))[1:]],
                            *[np.sin(x[:, 0] * (i + 2)) for i in range(4)]])
    assert many.beta == pytest.approx(list(np.linalg.lstsq(full, y, rcond=None)[0]))


def f_of(a):
    means = a.mean(axis=1)
    between = a.shape[1] * ((means - means.mean()) ** 2).sum() / (a.shape[0] - 1)
    return between / (((a - means[:, None]) ** 2).sum() / (a.shape[0] * (a.shape[1] - 1)))


def test_block_permutation_converges_to_the_exact_share(spark):
    rng = np.random.default_rng(11)
    values = rng.normal(size=(3, 6)) + np.array([[0.0], [0.6], [1.0]])
    cells = spark.createDataFrame([("c", values.tolist())], "cell string, matrix array<array<double>>")
    got = resampling.block_permutation(cells, ["cell"], replicates=2000, block=3).first()
    centred = values - np.median(values, axis=1, keepdims=True)
    spread = lambda a: f_of(np.abs(a - np.median(a, axis=1, keepdims=True)))
    assert got.level_f == pytest.approx(f_of(values)) and got.spread_f == pytest.approx(spread(values))
    orders = list(itertools.permutations(range(3)))
    level = np.mean([f_of(np.hstack([values[list(a), :3], values[list(b), 3:]])) >= got.level_f - 1e-12
                     for a in orders for b in orders])
    wide = np.mean([spread(np.hstack([centred[list(a), :3], centred[list(b), 3:]])) >= got.spread_f - 1e-12
                    for a in orders for b in orders])
    assert got.level_p == pytest.approx(level, abs=0.045) and got.spread_p == pytest.approx(wide, abs=0.045)
    again = resampling.block_permutation(cells.repartition(3), ["cell"], replicates=2000, block=3).first()
    assert again == got


def test_score_test_matches_exact_share(spark):
    rng = np.random.default_rng(2)
    values = rng.normal(size=(3, 6)) + np.array([[0.0], [0.5], [1.2]])
    long = [("c", y, d + 1, float(values[y, d])) for y in range(3) for d in range(6)]
    df = spark.createDataFrame(long, "cell string, year int, day int, v double")
    scores = resampling.block_scores(df, ["cell"], "year", "day", "v", block=3)
    got = {r.kind: r for r in resampling.block_score_test(scores, ["cell"], replicates=2000).collect()}
    order = values.ravel().argsort().argsort().reshape(values.shape) + 1.0
    stat = lambda a: 6 * ((a.mean(axis=1) - a.mean()) ** 2).sum() / a.var(ddof=1)
    assert got["level"].statistic == pytest.approx(stat(order))
    perms = list(itertools.permutations(range(3)))
    exact = np.mean([stat(np.hstack([order[list(a), :3], order[list(b), 3:]])) >= stat(order) - 1e-10
                     for a in perms for b in perms])
    assert got["level"].p == pytest.approx(exact, abs=0.045)
    assert 0 < got["spread"].p <= 1


def test_stratified_permutation_moves_labels_inside_strata_only(spark):
    # labels constant inside each stratum: every replicate equals the observed labelling
    data = [(f"s{i}", "x" if i < 4 else "y", i // 4, float(i)) for i in range(8)]
    df = spark.createDataFrame(data, "location_id string, country string, band int, v double")
    row = resampling.stratified_permutation(df, "v", "band", "country", replicates=50).first()
    assert row.p == 1.0 and row.statistic == pytest.approx(16 / 3)
    mixed = df.withColumn("band", (F.col("v") % 2).cast("int"))
    p = resampling.stratified_permutation(mixed, "v", "band", "country", replicates=400).first()
    ranks = np.arange(1, 9.0)
    labels = np.arange(8) % 2
    h = lambda m: sum((m == g).sum() * (ranks[m == g].mean() - 4.5) ** 2 for g in (0, 1)) / ranks.var(ddof=1)
    inner = [list(c) for c in itertools.combinations(range(4), 2)]
    exact = []
    for a in inner:
        for b in inner:
            m = np.zeros(8, dtype=int)
            m[a] = 1
            m[[4 + j for j in b]] = 1
            exact.append(h(m) >= h(labels) - 1e-10)
    assert p.p == pytest.approx(np.mean(exact), abs=0.09)


def test_exact_exchange_has_no_constant(spark):
    rng = np.random.default_rng(1)
    values = rng.normal(size=(2, 31))
    cells = spark.createDataFrame([("c", values.tolist())], "cell string, matrix array<array<double>>")
    for block, total in ((7, 32), (3, 2048)):
        row = resampling.exact_exchange(cells, ["cell"], block).first()
        assert row.assignments == total
        assert row.level_p * total == pytest.approx(round(row.level_p * total))
    hits = 0
    for swap in itertools.product([0, 1], repeat=5):
        m = values.copy()
        for j, s in enumerate(swap):
            if s:
                m[:, j * 7:(j + 1) * 7] = m[::-1, j * 7:(j + 1) * 7]
        hits += f_of(m) >= f_of(values) - 1e-12
    assert resampling.exact_exchange(cells, ["cell"], 7).first().level_p == pytest.approx(hits / 32)


@pytest.mark.parametrize("years,width", [(3, 4), (4, 3), (2, 5)])
def test_rotation_test_matches_enumeration(spark, years, width):
    rng = np.random.default_rng(years)
    m = np.array([rng.permutation(width) + 1.0 for _ in range(years)])
    df = spark.createDataFrame([("a", m.tolist())], "site string, ranks array<array<double>>")
    row = resampling.rotation_test(df, ["site"], width=width).first()
    mid = years * (width + 1) / 2
    observed = ((m.sum(axis=0) - mid) ** 2).sum()
    null = [((m[0] + sum(np.roll(m[y + 1], -s) for y, s in enumerate(shift)) - mid) ** 2).sum()
            for shift in itertools.product(range(width), repeat=years - 1)]
    assert row.rotations == len(null) and row.statistic == pytest.approx(observed)
    assert row.rotation_p == pytest.approx(np.mean(np.array(null) >= observed - 1e-9))


def test_matrix_array_shape(spark):
    df = spark.createDataFrame([("a", y, d, y * 10.0 + d) for y in (2021, 2020) for d in (2, 1)], "s string, y int, d int, v double")
    out = reshape.matrix_array(df, ["s"], "y", "d", "v")
    assert out.first().matrix == [[20201.0, 20202.0], [20211.0, 20212.0]]
    assert out.select(reshape.is_rectangular("matrix", 2, 2)).first()[0]


def test_group_folds_and_constant_importance(spark):
    rng = np.random.default_rng(4)
    data = [(f"s{i}", f"c{i % 7}", float(a), 1.0, float(3 * a + rng.normal())) for i, a in enumerate(rng.normal(size=140))]
    df = spark.createDataFrame(data, "location_id string, country string, x double, fixed double, y double")
    held, importance = models.group_kfold(df, "y", ["x", "fixed"], "country", k=3, trees=5, importance_repeats=2)
    assert held.count() == 140 and held.select("location_id").distinct().count() == 140
    assert held.groupBy("country").agg(F.count_distinct("fold").alias("n")).filter("n > 1").count() == 0
    for r in importance.filter("feature = 'fixed'").collect():
        assert r.importance == pytest.approx(0, abs=1e-12) and r.spread == pytest.approx(0, abs=1e-12)
    assert all(r.importance > 0 for r in importance.filter("feature = 'x'").collect())


def test_candidates_are_distinct():
    found = models.candidates(n=10)
    assert len({str(c) for c in found}) == 10
