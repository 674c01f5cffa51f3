"""Ranks over counted cells, exact positions, NULL groups, and what their plans look like."""

import random
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldgauge.functions.distributions import norm_ppf
from fieldgauge.operators import association, ranks, resampling, windows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def midranks(values):
    ordered = sorted(values)
    return [ordered.index(v) + (ordered.count(v) + 1) / 2 for v in values]


def test_spearman_and_kruskal_from_cells(spark):
    deal = random.Random(1)
    rows = [(g, deal.randrange(6), float(deal.randrange(9)) if deal.random() > 0.1 else None) for g in ("a", "b", None) for _ in range(80)]
    df = spark.createDataFrame(rows, "g string, x int, y double")
    got = {r.g: (r.n, r.r) for r in association.spearman(df, [("x", "y")], ["g"]).collect()}
    for g in ("a", "b", None):
        pairs = [(x, y) for k, x, y in rows if k == g and y is not None]
        want = np.corrcoef(*map(midranks, zip(*pairs)))[0, 1]
        assert got[g][0] == len(pairs) and got[g][1] == pytest.approx(want, abs=1e-12)
    tested = {r.g: (r.n, r.groups, r.statistic) for r in association.kruskal(df, "x", "y", ["g"]).collect()}
    for g in ("a", "b", None):
        pairs = [(x, y) for k, x, y in rows if k == g and y is not None]
        rank = np.array(midranks([y for _, y in pairs]))
        h = sum((rank[[x == k for x, _ in pairs]].mean() - rank.mean()) ** 2 * sum(x == k for x, _ in pairs) for k in {x for x, _ in pairs})
        assert tested[g] == (len(pairs), len({x for x, _ in pairs}), pytest.approx(h / rank.var(ddof=1), abs=1e-9))


def test_a_single_pair_has_no_correlation(spark):
    df = spark.createDataFrame([(1, 2.0)], "x int, y double")
    assert association.spearman(df, [("x", "y")]).first().r is None


def test_ranks_of_null_groups(spark):
    yearly = spark.createDataFrame([(None, 1.0), (None, 3.0), (2000, 2.0), (2000, None)], "year int, v double")
    got = {(r.year, r.v): r["rank"] for r in windows.rank_by_year(yearly, "v").collect()}
    assert got == {(None, 1.0): 2, (None, 3.0): 1, (2000, 2.0): 1, (2000, None): None}
    tests = spark.createDataFrame([(None, 0.01), (None, 0.04), ("f", 0.2)], "family string, p double")
    adjusted = {(r.family, r.p): r.p_holm for r in association.holm(tests, "p", ["family"]).collect()}
    assert adjusted == {(None, 0.01): 0.02, (None, 0.04): 0.04, ("f", 0.2): 0.2}


def test_tertiles_of_equal_and_unknown_heights(spark):
    n = 1_000_003
    sites = spark.range(n).select(
        F.col("id").alias("location_id"),
        F.when(F.col("id") == 0, 900.0).when(F.col("id") > 2, 5.0).alias("elevation_m"))
    out = windows.tertiles(sites)
    counts = {r.tertile: r["count"] for r in out.groupBy("tertile").count().collect()}
    assert counts == {None: 2, 1: 333334, 2: 333334, 3: 333333}
    assert out.filter("tertile = 1").agg(F.max("location_id")).first()[0] == 333336
    # the equal heights lie in several ranges
    ranges = sites.repartitionByRange("elevation_m", "location_id").withColumn("at", F.spark_partition_id())
    assert ranges.filter("elevation_m = 5.0").groupBy("at").count().agg(F.max("count")).first()[0] < n / 3
    assert "RangePartitioning" in plan_of(ranges) or "rangepartitioning" in plan_of(ranges)
    flat = spark.createDataFrame([(1, 5.0), (2, 50.0)], "location_id int, elevation_m double")
    assert {r.tertile for r in windows.tertiles(flat).collect()} == {None}
    assert windows.tertiles(flat.limit(0)).collect() == []


def test_row_positions_over_several_columns(spark):
    deal = random.Random(2)
    rows = [(deal.randrange(3), deal.randrange(1000)) for _ in range(500)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    got = sorted((r.position, r.a, r.b) for r in ranks.row_positions(df, ["a", F.col("b").desc()]).collect())
    assert got == [(i, a, b) for i, (a, b) in enumerate(sorted(rows, key=lambda x: (x[0], -x[1])))]


def test_normal_quantile_is_an_expression(spark):
    values = [1e-300, 1e-20, 1e-9, 0.001, 0.0749, 0.075, 0.2, 0.5, 0.6, 0.925, 0.93, 0.999, 1 - 1e-12, 0.0, 1.0, -1.0, None]
    df = spark.createDataFrame([(v,) for v in values], "p double").withColumn("z", norm_ppf("p"))
    assert "Python" not in plan_of(df)
    for r in df.collect():
        want = NormalDist().inv_cdf(r.p) if r.p is not None and 0 < r.p < 1 else None
        assert r.z == (want if want is None else pytest.approx(want, rel=1e-12, abs=1e-12)), r.p


def test_replicates_are_not_shuffled(spark):
    df = spark.range(60).select(
        F.col("id").alias("location_id"), (F.col("id") % 4).alias("country"), (F.col("id") % 3).alias("band"),
        F.explode(F.sequence(F.lit(1), F.lit(3))).alias("month")).withColumn("v", F.pmod(F.xxhash64("location_id", "month"), F.lit(1000)))
    tested = resampling.stratified_permutation(df, "v", "band", "country", by=["month"], replicates=64)
    plan = plan_of(tested)
    drawn = plan[: plan.index("REPARTITION_BY_NUM")]
    # above the chunks only the result per cell is dealt anew, no replicate or site
    above = [line for line in drawn.splitlines() if "Exchange hashpartitioning" in line]
    assert all("replicate" not in line and "location_id" not in line for line in above), above
    assert len({r.p for r in tested.collect()}) >= 1
