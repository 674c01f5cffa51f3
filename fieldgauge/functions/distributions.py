"""Tail probabilities and normal quantiles as column functions.

Spark has no Student-t, F or chi-square functions.  These work on result rows
(one row per test), a whole Arrow batch at a time.  The normal quantile, which is
asked for of every row, is an expression.
"""

from __future__ import annotations

import sys
from math import lgamma

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

# ship these small functions with the task, so workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TINY = 1e-300


def _log_beta(a, b):
    g = np.vectorize(lgamma, otypes=[float])
    return g(a) + g(b) - g(a + b)


def _beta_tail(x, a, b):
    """Regularised incomplete beta I_x(a, b), arrays in, array out (Lentz's method)."""
    x, a, b = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (x, a, b)))
    flip = x > (a + 1) / (a + b + 2)
    p, q, z = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1 - x, x)
    inside = (z > 0) & (z < 1)
    zz = np.where(inside, z, 0.5)
    front = np.exp(p * np.log(zz) + q * np.log1p(-zz) - _log_beta(p, q)) / p
    c = np.ones_like(zz)
    d = 1 - (p + q) * zz / (p + 1)
    d = 1 / np.where(np.abs(d) < TINY, TINY, d)
    h = d.copy()
    for m in range(1, 400):
        for numerator in (
            m * (q - m) * zz / ((p + 2 * m - 1) * (p + 2 * m)),
            -(p + m) * (p + q + m) * zz / ((p + 2 * m) * (p + 2 * m + 1)),
        ):
            d = 1 + numerator * d
            d = 1 / np.where(np.abs(d) < TINY, TINY, d)
            c = 1 + numerator / c
            c = np.where(np.abs(c) < TINY, TINY, c)
            step = d * c
            h = h * step
        if np.all(np.abs(step - 1) < 1e-15):
            break
    value = np.where(inside, front * h, np.where(z <= 0, 0.0, 1.0))
    return np.where(flip, 1 - value, value)


def _gamma_tail(x, a):
    """Regularised upper incomplete gamma Q(a, x)."""
    x, a = np.broadcast_arrays(np.asarray(x, dtype=float), np.asarray(a, dtype=float))
    safe = np.maximum(x, TINY)
    front = np.exp(a * np.log(safe) - safe - np.vectorize(lgamma, otypes=[float])(a))
    small = np.minimum(safe, a + 1)  # the series is used below a + 1 only
    term = 1 / a
    series = term.copy()
    for n in range(1, 2000):
        term = term * small / (a + n)
        series = series + term
        if np.all(term <= series * 1e-16):
            break
    large = np.maximum(safe, a + 1)  # and the continued fraction above
    b = large + 1 - a
    c = np.full_like(safe, 1 / TINY)
    d = 1 / np.where(np.abs(b) < TINY, TINY, b)
    h = d.copy()
    for n in range(1, 2000):
        numerator = -n * (n - a)
        b = b + 2
        d = numerator * d + b
        d = 1 / np.where(np.abs(d) < TINY, TINY, d)
        c = b + numerator / c
        c = np.where(np.abs(c) < TINY, TINY, c)
        step = c * d
        h = h * step
        if np.all(np.abs(step - 1) < 1e-15):
            break
    q = np.where(safe < a + 1, 1 - front * series, front * h)
    return np.where(x <= 0, 1.0, q)


def _masked(fn, *args):
    """Apply to the rows where every argument is a number; NULL elsewhere."""
    cols = [np.asarray(a, dtype=float) for a in args]
    ok = np.logical_and.reduce([np.isfinite(c) for c in cols])
    out = np.full(len(cols[0]), np.nan)
    if ok.any():
        # the branch of a two-branch formula that is not used may overflow
        with np.errstate(all="ignore"):
            out[ok] = fn(*(c[ok] for c in cols))
    return pd.Series(out).where(ok, None).astype("float64")


@pandas_udf(DoubleType())
def _t_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    return _masked(lambda t, n: _beta_tail(n / (n + t * t), n / 2, 0.5), t, df)


@pandas_udf(DoubleType())
def _f_upper(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _masked(lambda f, m, n: _beta_tail(n / (n + m * f), n / 2, m / 2), f, d1, d2)


@pandas_udf(DoubleType())
def _chi2_upper(x: pd.Series, df: pd.Series) -> pd.Series:
    return _masked(lambda x, k: _gamma_tail(x / 2, k / 2), x, df)


@pandas_udf(DoubleType())
def _t_critical(p: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided critical value: bisection on the tail, vectorised over the batch."""

    def solve(p, n):
        low, high = np.zeros_like(p), np.full_like(p, 1e6)
        for _ in range(100):
            mid = (low + high) / 2
            above = _beta_tail(n / (n + mid * mid), n / 2, 0.5) > p
            low, high = np.where(above, mid, low), np.where(above, high, mid)
        return (low + high) / 2

    return _masked(solve, p, df)


def _double(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c if isinstance(c, Column) else F.lit(c)).cast("double")


def p_t(t, df) -> Column:
    """Two-sided Student-t p-value."""
    return _t_two_sided(_double(t), _double(df))


def p_f(f, d1, d2) -> Column:
    return _f_upper(_double(f), _double(d1), _double(d2))


def p_chi2(x, df) -> Column:
    return _chi2_upper(_double(x), _double(df))


def p_norm(z) -> Column:
    """Two-sided normal p-value: the square of a normal is chi-square with 1 df."""
    return _chi2_upper(_double(z) * _double(z), F.lit(1.0))


# fixed values: Wichura (1988), algorithm AS 241, numerators and denominators from the highest power
_CENTRE = (
    (2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4,
     1.3731693765509461125e4, 1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080e0),
    (5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4,
     5.3941960214247511077e3, 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0),
)
_MIDDLE = (
    (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e0,
     3.64784832476320460504e0, 5.76949722146069140550e0, 4.63033784615654529590e0, 1.42343711074968357734e0),
    (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
     6.89767334985100004550e-1, 1.67638483018380384940e0, 2.05319162663775882187e0, 1.0),
)
_TAIL = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
     2.96560571828504891230e-1, 1.78482653991729133580e0, 5.46378491116411436990e0, 6.65790464350110377720e0),
    (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
     1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0),
)


def _ratio(tables: tuple[tuple[float, ...], ...], r: Column) -> Column:
    def polynomial(coefficients: tuple[float, ...]) -> Column:
        total = F.lit(coefficients[0])
        for c in coefficients[1:]:
            total = total * r + F.lit(c)
        return total

    return polynomial(tables[0]) / polynomial(tables[1])


def norm_ppf(p) -> Column:
    """Quantile of the standard normal, to double precision; NULL outside of 0 < p < 1.

    Plain expressions, so that the scores of many rows stay in the JVM.
    """
    p = _double(p)
    q = p - 0.5
    far = F.sqrt(-F.log(F.least(p, 1 - p)))
    outer = F.when(far <= 5, _ratio(_MIDDLE, far - 1.6)).otherwise(_ratio(_TAIL, far - 5))
    value = F.when(F.abs(q) <= 0.425, q * _ratio(_CENTRE, 0.180625 - q * q)).otherwise(F.signum(q) * outer)
    return F.when((p > 0) & (p < 1), value)


def t_critical(p, df) -> Column:
    """Value whose two-sided tail probability is ``p``."""
    return _t_critical(_double(p), _double(df))
