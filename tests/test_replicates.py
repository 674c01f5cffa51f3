"""Labels drawn in Arrow batches follow Spark's hashes, and no row is made for a replicate."""

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from fieldgauge.functions import replicates as drawn
from fieldgauge.operators import resampling

SITES = {
    "bigint": [0, 1, -5, 2**40, None], "int": [0, 7, -9, None], "smallint": [1, -2, None], "boolean": [True, False, None],
    "string": ["", "a", "abcd", "abcdefgh", "é" * 7, "x" * 32, "y" * 61, "z" * 100, None],
    "binary": [b"", b"\x00\xff", b"0" * 37, None], "double": [0.0, -0.0, 1.5, float("nan"), None], "float": [-0.0, 2.5, None],
    "date": ["2020-02-29", "1950-01-01", None], "timestamp": ["2020-02-29 01:02:03.5", None],
    "decimal(12,2)": ["1.25", "-3.00", None], "decimal(30,3)": ["0.000", "-123456789012345678901.5", "128.000", None],
}


@pytest.mark.parametrize("kind", SITES)
def test_sites_hash_as_in_spark(spark, kind):
    values = [(str(v) if kind.startswith("decimal") and v else v,) for v in SITES[kind]]
    text = kind.startswith(("decimal", "date", "timestamp"))
    df = spark.createDataFrame(values, "v string" if text else f"v {kind}").select(F.col("v").cast(kind).alias("v")).coalesce(1)
    for seed, replicate in ((1, 0), (2**40, 123)):
        want = [r.h for r in df.select(F.xxhash64(F.lit(seed), F.lit(replicate), "v").alias("h")).collect()]
        column = df.toArrow().column("v").combine_chunks()
        assert drawn.site_hashes(column)(drawn.replicate_seed(seed, replicate)).tolist() == want


def rows(spark):
    """Sites with NULL labels, strata and values, one under two labels, one without any value."""
    data = [
        (f"s{i}", None if i % 11 == 0 else f"c{i % 3}", None if i % 7 == 0 else i % 4, m,
         None if i == 5 or (i + (m or 0)) % 9 == 0 else float((i * 37 + (m or 7) * 11) % 23))
        for i in range(40) for m in (1, 2, None)
    ]
    data += [("s3", "c0", 9, 1, 4.0), (None, "c1", 2, 2, 8.0)] + [(f"s{i}", "c1", i % 2, 5, 3.0) for i in (1, 4)]
    return spark.createDataFrame(data, "location_id string, country string, band int, month int, v double")


def test_p_counts_the_labellings_in_hash_order(spark):
    """Against the labelling of each replicate written out as rows."""
    df, n, seed = rows(spark), 30, 5
    got = {r.month: r for r in resampling.stratified_permutation(
        df, "v", "band", "country", by=["month"], replicates=n, seed=seed, chunk=7).collect()}
    sites = df.select("location_id", "country", "band").distinct()
    order = F.xxhash64(F.lit(seed), "replicate", "location_id")
    slot = F.row_number().over(Window.partitionBy("replicate", "country").orderBy(order, "location_id"))
    whom = sites.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("slot", slot)
    turn = sites.withColumn("slot", F.row_number().over(Window.partitionBy("country").orderBy("band")))
    turns = {(r.country, r.slot): r.band for r in turn.collect()}
    values = {}
    for r in df.filter("v IS NOT NULL").collect():
        values.setdefault(r.month, []).append((r.location_id, r.band, r.v))
    ranks = {m: [sum(w < v for _, _, w in x) + (sum(w == v for _, _, w in x) + 1) / 2 for _, _, v in x] for m, x in values.items()}

    def h(month, pairs):
        r = np.array(ranks[month])
        z, total = (r - r.mean()) / r.std(ddof=1), {}
        for i, label in pairs:
            total.setdefault(label, []).append(z[i])
        return sum(sum(t) ** 2 / len(t) for t in total.values())

    given = {}
    for r in whom.collect():
        given.setdefault(r.replicate, {}).setdefault(r.location_id, []).append(turns[r.country, r.slot])
    assert set(got) == set(values) == {1, 2, None, 5}
    for month, x in values.items():
        if month == 5:  # equal values have no spread
            assert got[5].statistic is None and got[5].p == pytest.approx(1 / (n + 1))
            continue
        seen = h(month, [(i, band) for i, (_, band, _) in enumerate(x)])
        hits = sum(h(month, [(i, b) for i, (s, _, _) in enumerate(x) for b in g[s]]) >= seen - 1e-10 for g in given.values())
        assert got[month].statistic == pytest.approx(seen) and got[month].p == pytest.approx((1 + hits) / (n + 1))


def test_no_row_is_made_for_a_replicate(spark):
    tested = resampling.stratified_permutation(rows(spark), "v", "band", "country", by=["month"], replicates=500)
    plan = tested._jdf.queryExecution().optimizedPlan().toString()
    made = [line for line in plan.splitlines() if "Generate" in line]
    assert made and all("replicate" not in line for line in made), made
