"""Whitening against dense linear algebra over all rows at once, and exact whole numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldgauge.llm import queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(vectors, components=whitening.COMPONENTS):
    """n, deviations, eigenvalues, whitened rows, trace of usable vectors."""
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(0)
    apart = n * x - sums
    y = (apart / n).astype(float)
    v = y.T @ y / n
    values, columns = np.linalg.eigh(v)
    order = np.argsort(-values)[:components]
    order = order[values[order] > 1e-10 * max(values.max(), 1e-300)]
    return n, [sum(e * e for e in row) for row in apart], values[order], y @ columns[:, order] / np.sqrt(values[order]), v.trace()


def compare(found, vectors, ids):
    n, far, values, white, trace = plain(vectors)
    rows = {}
    for r in found.collect():
        rows.setdefault(r.vec_id, []).append(r)
    assert set(rows) == set(ids)
    signs = None
    for vec_id, deviation, expect in zip(ids, far, white):
        got = rows[vec_id][0]
        assert (got.n, int(got.deviation)) == (n, deviation)
        assert got.identity_error <= 1e-9
        assert np.allclose(got.explained, values / trace, rtol=1e-9)
        given = np.array(got.whitened)
        assert given.shape == expect.shape
        if signs is None:
            first = np.array([rows[i][0].whitened for i in ids])
            signs = np.sign((first * white).sum(0))
        assert np.allclose(given * signs, expect, rtol=1e-6, atol=1e-7)


def test_whitening_of_the_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    given = table.collect()
    compare(whitening.whiten(table), [r.embedding for r in given], [r.vec_id for r in given])
    rows = queries.op11_whitening(spark, SF).collect()
    assert len(rows) == len(given) * 32 and {r.component for r in rows} == set(range(1, 33))
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error <= 1e-4


def test_odd_vectors_are_dropped(spark):
    deal = np.random.default_rng(3)
    good = deal.normal(0, 3, (40, 5)).astype(np.float32)
    good[:, 3] = 1.5  # no spread
    good[:, 4] = good[:, 0] * 2  # depends on another
    good[30:] = good[0]  # copies
    rows = [(i, v.tolist(), 0) for i, v in enumerate(good)]
    odd = [None, [], [1.0] * 4, [1.0] * 6, [1.0, None, 1.0, 1.0, 1.0], [float("nan")] * 5, [float("inf")] + [0.0] * 4,
           [float("-inf")] + [0.0] * 4, [3e38] + [0.0] * 4]
    table = spark.createDataFrame(rows + [(100 + i, v, 0) for i, v in enumerate(odd)], SCHEMA).repartition(4)
    names = "x n s at of task block body d count whitened deviation"
    compare(whitening.whiten(table), good, range(40))
    compare(whitening.whiten(table.withColumns({c: F.lit(1) for c in names.split()})), good, range(40))


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [0.0, 2.0], 0), (None, [0.5, 2.0], 0)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(str(r.vec_id) for r in found) == ["1", "1", "None", "None"] and {r.n for r in found} == {4}
    assert len({tuple(r.whitened) for r in found if r.vec_id == 1}) == 1


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [], 0), (2, [], 0)], [(1, [2.0, 3.0], 0)], [(1, [2.0], 0), (2, [2.0], 0)]])
def test_nothing_to_whiten(spark, rows):
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    got = [(r.vec_id, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in found.collect()]
    usable = [i for i, v, _ in rows if v is not None]
    assert sorted(got) == [(i, len(usable), 0, [], [], 0.0) for i in usable]
    assert whitening.by_component(found).count() == 0


def test_large_entries_stay_exact(spark):
    big = [[1e12, 5.0], [-3e12, 7.0], [2e16, -1.0]]
    table = spark.createDataFrame([(i, v, 0) for i, v in enumerate(big)], SCHEMA)
    n, far, *_ = plain(big)
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(table).collect()}
    assert got == dict(enumerate(far))
    assert {r.deviation for r in whitening.by_component(whitening.whiten(table)).collect()} == {None}


def test_long_vectors_are_refused(spark):
    table = spark.createDataFrame([(1, [0.0] * 2049, 0)], SCHEMA)
    with pytest.raises(ValueError):
        whitening.whiten(table)


@pytest.mark.parametrize("kind", ["random", "repeated", "close", "diagonal", "low rank", "graded", "one"])
def test_components_of_hard_matrices(kind):
    deal = np.random.default_rng(5)
    n = 1 if kind == "one" else 50
    basis = np.linalg.qr(deal.normal(size=(n, n)))[0]
    values = {
        "random": deal.uniform(1, 9, n), "repeated": np.repeat([5.0, 3.0, 1.0, 0.5, 0.1], 10), "diagonal": np.arange(1.0, n + 1),
        "close": 1 + 1e-9 * np.arange(n), "low rank": np.where(np.arange(n) < 7, 2.0, 0.0), "graded": 10.0 ** -np.linspace(0, 9, n),
        "one": np.array([4.0]),
    }[kind]
    if kind == "diagonal":
        basis = np.eye(n)
    matrix = basis @ np.diag(values) @ basis.T
    matrix = (matrix + matrix.T) / 2
    got, vectors = whitening.leading_components(matrix, 32)
    want = np.sort(values)[::-1][:32]
    want = want[want > 1e-11]
    assert np.allclose(got, want, rtol=1e-9, atol=1e-14)
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * got).max() < 1e-13 * max(1, values.max()) * n
