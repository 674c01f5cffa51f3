"""Whitening of embeddings by the leading components of their covariance.

The sums and the centred covariance are gathered over the tasks; the symmetric matrix, whose
size the vectors' length bounds, is reduced to a tridiagonal one by Householder reflections.
Its leading eigenvalues are bracketed by Sturm counts and bisection, the vectors found by inverse
iteration, reorthogonalised within clusters of close eigenvalues, and turned back.  The
components are then sent to the tasks, which project their rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldgauge.llm.text import importable
from fieldgauge.llm.vectors import SCHEMA as PARTS
from fieldgauge.llm.vectors import blocks, tree_sum

COMPONENTS = 32
#: entries become whole numbers of 1 / SCALE, moved above zero
SCALE, SHIFT = 64, 1_000_000
#: longer vectors are refused, as their covariance would not fit the driver and the tasks
MOST_DIMENSIONS = 2048
#: rows that a task multiplies at once
_ROWS = 4096
_EPS = np.finfo(float).eps


# -- the symmetric eigenproblem ---------------------------------------------------------------------


def tridiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and unit reflection vectors of a symmetric matrix.

    With H the product of the reflections in order, H T H' is the matrix.
    """
    a = np.array(matrix, float)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        column = a[k + 1 :, k]
        v = column.copy()
        v[0] += np.copysign(np.linalg.norm(column), column[0])
        size = np.linalg.norm(v)
        v = v / size if size > 0 else np.zeros_like(v)
        reflections.append(v)
        below = a[k + 1 :, k + 1 :]
        p = below @ v
        w = 2 * (p - (v @ p) * v)
        below -= np.outer(v, w) + np.outer(w, v)
        column -= 2 * v * (v @ column)
        a[k, k + 1 :] = column
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def turn_back(reflections: list[np.ndarray], vectors: np.ndarray) -> np.ndarray:
    """Columns of the tridiagonal problem as columns of the full one."""
    out = vectors.copy()
    for k in range(len(reflections) - 1, -1, -1):
        v = reflections[k]
        out[k + 1 :] -= 2 * np.outer(v, v @ out[k + 1 :])
    return out


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eigenvalues of the tridiagonal matrix below each of the points."""
    tiny = _EPS * max(1e-300, np.abs(diagonal).max(initial=0) + np.abs(off).max(initial=0)) * _EPS
    squares = off * off
    q = diagonal[0] - at
    below = (q < 0).astype(np.int64)
    for d, e in zip(diagonal[1:], squares):
        q = np.where(np.abs(q) < tiny, np.copysign(tiny, q), q)
        q = d - at - e / q
        below += q < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, most: int) -> np.ndarray:
    """The largest ``most`` eigenvalues, falling, by bisection of all of them side by side."""
    n = len(diagonal)
    reach = np.zeros(n)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    count = min(most, n)
    low = np.full(count, (diagonal - reach).min())
    high = np.full(count, (diagonal + reach).max())
    wanted = n - 1 - np.arange(count)  # so many eigenvalues lie below the one sought
    span = max(np.abs(low).max(), np.abs(high).max())
    low, high = low - 2 * _EPS * span, high + 2 * _EPS * span
    for _ in range(120):
        middle = (low + high) / 2
        above = sturm_counts(diagonal, off, middle) <= wanted
        low, high = np.where(above, middle, low), np.where(above, high, middle)
        if ((high - low) <= 2 * _EPS * np.maximum(np.abs(low), np.abs(high)) + _EPS * _EPS * span).all():
            break
    return (low + high) / 2


def _solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, tiny: float) -> np.ndarray:
    """(T - shift) x = right, by elimination with row exchanges."""
    n = len(diagonal)
    d = (diagonal - shift).tolist()
    up, low = [*off.tolist(), 0.0], [*off.tolist(), 0.0]
    second = [0.0] * n
    x = right.tolist()
    for i in range(n - 1):
        if abs(low[i]) > abs(d[i]):
            # the next row comes first
            d[i], low_i = low[i], d[i]
            up[i], d[i + 1] = d[i + 1], up[i]
            second[i], up[i + 1] = up[i + 1], 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        else:
            low_i = low[i]
        if d[i] == 0.0:
            d[i] = tiny
        factor = low_i / d[i]
        d[i + 1] -= factor * up[i]
        up[i + 1] -= factor * second[i]
        x[i + 1] -= factor * x[i]
    if abs(d[n - 1]) < tiny:
        d[n - 1] = tiny
    for i in range(n - 1, -1, -1):
        total = x[i]
        if i + 1 < n:
            total -= up[i] * x[i + 1]
        if i + 2 < n:
            total -= second[i] * x[i + 2]
        x[i] = total / d[i]
    return np.array(x)


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, as columns, of falling eigenvalues of the tridiagonal matrix.

    Vectors of eigenvalues closer than a thousandth of the norm are made orthogonal to each
    other in every step; equal values are pulled apart a little first.
    """
    n = len(diagonal)
    norm = max(np.abs(diagonal).max(initial=0) + 2 * np.abs(off).max(initial=0), np.finfo(float).tiny)
    out = np.zeros((n, len(values)))
    cluster, shift = 0, np.inf
    deal = np.random.default_rng(1)
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            cluster, shift = k, np.inf
        shift = min(value, shift - 10 * _EPS * norm)
        x = deal.uniform(-1, 1, n)
        for _ in range(6):
            for _ in range(2):
                x -= out[:, cluster:k] @ (out[:, cluster:k].T @ x)
            x /= np.linalg.norm(x)
            x = _solve_shifted(diagonal, off, shift, x, _EPS * norm)
            x /= np.abs(x).max()
        for _ in range(2):
            x -= out[:, cluster:k] @ (out[:, cluster:k].T @ x)
        out[:, k] = x / np.linalg.norm(x)
    return out


def leading_components(covariance: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors (columns) of a covariance, ``most`` at most.

    Eigenvalues that rounding cannot tell from zero are left out.  The largest entry of each
    vector is positive, the first of equal ones.
    """
    n = len(covariance)
    scale = np.abs(covariance).max(initial=0)
    if not n or scale == 0:
        return np.empty(0), np.empty((n, 0))
    diagonal, off, reflections = tridiagonalise(covariance / scale)
    values = leading_eigenvalues(diagonal, off, most)
    values = values[values > 64 * n * _EPS * values[0]]
    vectors = turn_back(reflections, inverse_iteration(diagonal, off, values))
    # the quotient is good to twice the digits of the vector
    values = np.einsum("ik,ij,jk->k", vectors, covariance, vectors)
    largest = np.abs(vectors).argmax(0)
    vectors *= np.where(vectors[largest, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return values, vectors


# -- the passes over the rows -------------------------------------------------------------------


def _is_usable(embedding: str, scale: int) -> Column:
    # nothing compares with NaN, and a comparison with a null entry is null
    fits = lambda c: F.coalesce(F.abs(c.cast("double") * scale) < F.lit(2.0**62), F.lit(False))
    return F.col(embedding).isNotNull() & F.coalesce(F.forall(embedding, fits), F.lit(False))


def usable_rows(embeddings: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id and x, the vector in longs, of the rows with only finite entries that a long can hold."""
    whole = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale) + F.lit(shift).cast("long"))
    # inside the condition, so that no filter is put before it
    return embeddings.select("vec_id", F.when(_is_usable("embedding", scale), whole).alias("x")).where("x IS NOT NULL")


def _matrix(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dimensions)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _apart(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: in longs where they hold it, in unbounded whole numbers elsewhere."""
    if len(x) and n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums)) >= 1 << 62:
        return n * x.astype(object) - np.array(sums, object)
    return n * x - np.array(sums, np.int64)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_apart(x, n, sums) / n).astype(float)


def _deviations(apart: np.ndarray) -> list[int]:
    """The sum of squares of each row, exact; floats tell first whether longs hold them."""
    if apart.dtype != object and np.square(apart.astype(float)).sum(1).max(initial=0) < 2.0**62:
        return np.square(apart).sum(1).tolist()
    return [sum(int(v) ** 2 for v in row) for row in apart]


def _scatter(rows: DataFrame, dimensions: int, make, width: int) -> np.ndarray:
    """Sum over the rows of y y' of their ``width`` values y = make(x), one matrix a task, in a tree."""
    importable(rows.sparkSession)
    tasks = 16 * max(1, rows.sparkSession.sparkContext.defaultParallelism)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in _slices(batches):
            y = make(_matrix(batch, dimensions))
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield from blocks(total.ravel(), TaskContext.get().partitionId())

    # each task makes a whole matrix
    parts = rows.select("x").coalesce(tasks).mapInArrow(run, PARTS)
    return tree_sum(parts, tasks, width * width, "float64").reshape(width, width)


def exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and the sum of each entry, in whole numbers."""
    each = rows.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s")
    )
    found = sorted(each.collect())
    return (found[0]["n"], [int(r["s"]) for r in found]) if found else (0, [])


def fit_length(rows: DataFrame) -> int:
    """The length of most rows, of equally many the greatest; 0 without rows."""
    found = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return found["d"] if found else 0


def whiten(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id, n, deviation, whitened, explained, identity_error of every usable row.

    Rows whose vector is null or has null or non-finite entries, or entries too large for a long,
    are dropped; each other entry c counts as floor(scale * c) + shift, a long.  The fit takes all rows left, n of them: with S
    the sums by dimension and V the covariance of the vectors (divisor n, centred first),
    whitened holds the projections of x - S / n on the leading unit eigenvectors of V over the
    roots of their eigenvalues, largest first, explained their eigenvalues over the trace of V.
    deviation is the sum over dimensions of (n * x - S) ** 2, exact, null above 38 digits.  identity_error is the
    largest absolute entry of the covariance of all whitened vectors less the identity.

    No more components are given than V has eigenvalues that differ from zero; without any
    (no spread, one row, empty vectors) whitened and explained are empty and identity_error 0.
    Vectors of a length other than that of most rows (of equally many, the greatest) do not
    compare and are dropped too.  Rows that repeat are rows of their own; a null vec_id stays
    null.  Vectors of more than 2,048 entries are refused: their covariance is held whole.
    """
    spark = embeddings.sparkSession
    rows = usable_rows(embeddings, scale, shift)
    dimensions = fit_length(rows)
    if dimensions > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {dimensions} entries are too long for one covariance")
    rows = rows.where(F.size("x") == dimensions)
    id_type = dict(embeddings.dtypes)["vec_id"]
    schema = (f"vec_id {id_type}, n bigint, deviation decimal(38,0), whitened array<double>, explained array<double>, "
              "identity_error double")
    if not dimensions:
        n = rows.count()
        return rows.select("vec_id", F.lit(n).cast("long").alias("n"), F.lit(0).cast("decimal(38,0)").alias("deviation"),
                           F.array().cast("array<double>").alias("whitened"), F.array().cast("array<double>").alias("explained"),
                           F.lit(0.0).alias("identity_error"))
    n, total = exact_sums(rows)
    covariance = _scatter(rows, dimensions, lambda x: _centred(x, n, total), dimensions) / n
    values, vectors = leading_components((covariance + covariance.T) / 2, components)
    trace = float(np.trace(covariance))
    held = spark.sparkContext.broadcast((n, total, vectors / np.sqrt(values)))

    def project(x: np.ndarray) -> np.ndarray:
        n, sums, turned = held.value
        return _centred(x, n, sums) @ turned

    error = 0.0
    if len(values):
        # the whitened vectors have mean 0; the measured mean is taken off all the same
        k = len(values)
        with_one = lambda x: np.column_stack([project(x), np.ones(len(x))])
        moments = _scatter(rows, dimensions, with_one, k + 1) / n
        spread = moments[:k, :k] - np.outer(moments[k, :k], moments[k, :k])
        error = float(np.abs(spread - np.eye(k)).max())
    explained = (values / trace).tolist() if len(values) else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            x = _matrix(batch, dimensions)
            y = project(x)
            far = [Decimal(v) if v < 10**38 else None for v in _deviations(_apart(x, n, total))]
            m = len(x)
            column = lambda a: pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * a.shape[1]), pa.array(a.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(np.full(m, n, np.int64)), pa.array(far, pa.decimal128(38, 0)),
                 column(y), column(np.tile(np.array(explained, float), (m, 1))), pa.array(np.full(m, error))],
                ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)


def by_component(found: DataFrame) -> DataFrame:
    """One row per vector and component of ``whiten``'s rows, components numbered from 1.

    deviation is a long, null where a long does not hold it.
    """
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "of")
    return found.select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        "of.whitened", "of.explained", "identity_error",
    )
