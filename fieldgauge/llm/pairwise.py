"""Weights that minimise the logistic loss over every pair of a good and a bad row.

With s = w'z a pair costs softplus(s_bad - s_good).  The pairs are as many as the product of the
classes, so they are summed by bins of the scores: around the centres of two bins softplus is its
Taylor series in the rows' distances from them, and the sum over all pairs of the two bins is a
sum of products of their power sums.  The series converges within pi and two rows are at most
``STEP`` off, so ``TERMS`` terms give each pair to rounding; no pair is left out and none is
formed.  A step is Newton's, from two passes over the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row

from fieldgauge.llm.text import importable

#: width of a bin of scores, and derivatives used around its centre
STEP = 0.25
TERMS = 10
#: weight of the squared weights, halved, beside the mean loss of a pair
RIDGE = 1e-4
#: largest entry of the gradient at which the weights count as found, and steps at most
FLAT = 1e-11
MOST_STEPS = 60

_FACTORIALS = np.array([factorial(k) for k in range(TERMS + 1)], float)
_SIGNS = (-1.0) ** np.arange(TERMS + 1)


def _derivatives(x: np.ndarray) -> np.ndarray:
    """softplus and its first ``TERMS`` + 1 derivatives at x, one row each."""
    low = np.exp(-np.abs(x))
    p = low / (1 + low)  # the logistic function at -|x|
    out = [np.maximum(x, 0) + np.log1p(low), np.where(x > 0, 1 - p, p)]
    form = np.array([0.0, 1.0])
    for n in range(1, TERMS + 1):
        form = np.polynomial.polynomial.polymul(np.polynomial.polynomial.polyder(form), [0.0, 1.0, -1.0])
        out.append(np.polynomial.polynomial.polyval(p, form) * np.where(x > 0, (-1.0) ** (n + 1), 1.0))
    return np.array(out)


class Pairs:
    """Sums over all pairs from the bins of the two classes.

    bins: numbers of the bins that hold rows, rising; powers: sums of the powers 0 to ``TERMS``
    of the rows' distances from the centres; z: sums of the rows' values.  Found are the summed
    loss, for each row the series of its summed slope, for each bin its summed curvature, and
    the mixed part of the curvature of all pairs.
    """

    def __init__(self, good: tuple[np.ndarray, ...], bad: tuple[np.ndarray, ...]):
        (g, g_powers, g_z), (b, b_powers, b_z) = good, bad
        lowest = b[0] - g[-1]
        table = _derivatives(np.arange(lowest, b[-1] - g[0] + 1) * STEP)
        mine, theirs = g_powers * _SIGNS / _FACTORIALS, b_powers / _FACTORIALS
        self.loss, self.mixed = 0.0, np.zeros((g_z.shape[1], b_z.shape[1]))
        self.g, self.b = g, b
        self.g_slopes, self.b_slopes = np.zeros((len(g), TERMS)), np.zeros((len(b), TERMS))
        self.g_curve, self.b_curve = np.zeros(len(g)), np.zeros(len(b))
        for start in range(0, len(g), 256):  # the driver holds a strip of the pairs of bins
            part = slice(start, start + 256)
            at = b[None, :] - g[part, None] - lowest
            for order in range(TERMS + 1):
                values = table[order][at]
                self.loss += sum(mine[part, order - k] @ values @ theirs[:, k] for k in range(order + 1))
                for k in range(order):
                    self.g_slopes[part, order - 1 - k] += values @ theirs[:, k]
                    self.b_slopes[:, k] += mine[part, order - 1 - k] @ values
                if order == 2:
                    self.g_curve[part] += values @ b_powers[:, 0]
                    self.b_curve += g_powers[part, 0] @ values
                    self.mixed += g_z[part].T @ values @ b_z
        self.g_slopes *= _SIGNS[:TERMS] / _FACTORIALS[:TERMS]
        self.b_slopes /= _FACTORIALS[:TERMS]


def _per_task(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> list[Row]:
    """The sums that each task makes of its rows; there are as many as two to a core."""
    importable(rows.sparkSession)
    tasks = 2 * max(1, rows.sparkSession.sparkContext.defaultParallelism)
    return rows.select("good", "x").coalesce(tasks).mapInArrow(run, schema).collect()


def _summed(rows: DataFrame, matrix: Callable[[pa.RecordBatch], np.ndarray], weights: np.ndarray) -> Pairs:
    """One pass: the sums of each class and bin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: dict[int, np.ndarray] = {}
        for batch in batches:
            z, good = matrix(batch), batch.column("good").to_numpy()
            s = z @ weights
            bins = np.rint(s / STEP).astype(np.int64)
            away = s - bins * STEP
            keys, cell = np.unique(bins * 2 + good, return_inverse=True)
            given = [*(away**k for k in range(TERMS + 1)), *z.T]
            sums = np.array([np.bincount(cell, v, len(keys)) for v in given]).T
            for key, one in zip(keys.tolist(), sums):
                cells[key] = cells[key] + one if key in cells else one
        keys = np.array(list(cells), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys % 2), pa.array(keys // 2), pa.array(list(cells.values()), pa.list_(pa.float64()))],
            ["good", "bin", "v"],
        )

    total: list[dict[int, np.ndarray]] = [{}, {}]
    for good, place, v in _per_task(rows, run, "good bigint, bin bigint, v array<double>"):
        total[good][place] = total[good].get(place, 0.0) + np.array(v)

    def side(cells: dict[int, np.ndarray]) -> tuple[np.ndarray, ...]:
        bins = sorted(cells)
        sums = np.array([cells[b] for b in bins])
        return np.array(bins), sums[:, : TERMS + 1], sums[:, TERMS + 1 :]

    return Pairs(side(total[1]), side(total[0]))


def _sloped(
    rows: DataFrame, matrix: Callable[[pa.RecordBatch], np.ndarray], weights: np.ndarray, pairs: Pairs
) -> tuple[np.ndarray, np.ndarray]:
    """Another pass: the gradient of the summed loss and its curvature, the latter by bins."""
    n = len(weights)
    sides = [(1, -1.0, pairs.g, pairs.g_slopes, pairs.g_curve), (0, 1.0, pairs.b, pairs.b_slopes, pairs.b_curve)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slope, curve = np.zeros(n), np.zeros((n, n))
        for batch in batches:
            every, good = matrix(batch), batch.column("good").to_numpy()
            for kind, sign, bins, series, bent in sides:
                z = every[good == kind]
                s = z @ weights
                # the nearest bin with rows: another processor may round a score over an edge
                at = np.searchsorted((bins[1:] + bins[:-1]) / 2, s / STEP)
                away = s - bins[at] * STEP
                each = np.zeros(len(s))
                for k in reversed(range(TERMS)):
                    each = each * away + series[at, k]
                slope += sign * (each @ z)
                curve += z.T @ (z * bent[at, None])
        body = np.concatenate([slope, curve.ravel()]).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], ["body"])

    total = sum(np.frombuffer(r["body"]) for r in _per_task(rows, run, "body binary"))
    return total[:n], total[n:].reshape(n, n) - pairs.mixed - pairs.mixed.T


def minimise(rows: DataFrame, matrix: Callable[[pa.RecordBatch], np.ndarray], width: int, n_pairs: int) -> np.ndarray:
    """The weights with the least mean loss of all pairs and ``RIDGE`` / 2 times their square.

    rows: good (1 or 0) and x, both classes present; ``matrix`` makes the ``width`` values z of
    each row of a batch; n_pairs: good rows times bad ones.
    """
    def mean(pairs: Pairs, weights: np.ndarray) -> float:
        return pairs.loss / n_pairs + RIDGE / 2 * float(weights @ weights)

    weights = np.zeros(width)
    pairs = _summed(rows, matrix, weights)
    for _ in range(MOST_STEPS):
        slope, curve = _sloped(rows, matrix, weights, pairs)
        slope = slope / n_pairs + RIDGE * weights
        if np.abs(slope).max() <= FLAT:
            break
        step = -np.linalg.solve(curve / n_pairs + RIDGE * np.eye(width), slope)
        here, size = mean(pairs, weights), 1.0
        while size > 1e-6:
            there = weights + size * step
            pairs_there = _summed(rows, matrix, there)
            # the last steps gain less than the sums' rounding
            if mean(pairs_there, there) <= here + 1e-4 * size * float(slope @ step) + 1e-12:
                break
            size /= 2
        else:
            break
        weights, pairs = there, pairs_there
    return weights
