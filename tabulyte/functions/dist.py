"""Tail probabilities and quantiles for result-sized columns.

Published numerics: continued fractions for the incomplete gamma and beta
functions, the complementary error function of the standard library, and
bisection for quantiles.  They run on one row per test, never on data rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

TINY = 1e-300
EPS = 1e-15


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * EPS:
            k += 1
            term *= x / k
            total += term
        return 1.0 - front * total
    b = x + 1 - a
    c, d = 1 / TINY, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or TINY)
        c = b + an / c or TINY
        h *= d * c
        if abs(d * c - 1) < EPS:
            return front * h
    return math.nan  # not converged


def _beta_fraction(a: float, b: float, x: float) -> float:
    c = 1.0
    d = 1 / (1 - (a + b) * x / (a + 1) or TINY)
    h = d
    for m in range(1, 100_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1 / (1 + even * d or TINY)
        c = 1 + even / c or TINY
        h *= d * c
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / (1 + odd * d or TINY)
        c = 1 + odd / c or TINY
        h *= d * c
        if abs(d * c - 1) < EPS:
            return h
    return math.nan  # not converged


def beta_lower(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1 - x) / b


def _bisect(f, lo: float, hi: float, target: float) -> float:
    for _ in range(200):
        mid = (lo + hi) / 2
        if f(mid) < target:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


def beta_quantile(q: float, a: float, b: float) -> float:
    return _bisect(lambda x: beta_lower(a, b, x), 0.0, 1.0, q)


def normal_upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def normal_quantile(q: float) -> float:
    if not 0 < q < 1:
        return math.nan
    return _bisect(lambda z: 0.5 * math.erfc(-z / math.sqrt(2)), -40.0, 40.0, q)


def kolmogorov_tail(x: float) -> float:
    if x < 0.2:
        return 1.0
    return min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101))))


def _raised(x, term) -> tuple[np.ndarray, np.ndarray]:
    """Arguments stepped up to 12 or more, and the sum of `term` over the steps."""
    x = np.asarray(x, float)
    shift = np.zeros_like(x)
    for _ in range(12):
        small = x < 12
        shift = shift + np.where(small, term(np.where(small, x, 1.0)), 0.0)
        x = np.where(small, x + 1, x)
    return x, shift


def digamma(x) -> np.ndarray:
    """Derivative of log Γ, of a number or an array."""
    x, shift = _raised(x, lambda v: -1 / v)
    u = 1 / (x * x)
    return shift + np.log(x) - 0.5 / x - u * (1 / 12 - u * (1 / 120 - u * (1 / 252 - u * (1 / 240 - u / 132))))


def trigamma(x) -> np.ndarray:
    x, shift = _raised(x, lambda v: 1 / (v * v))
    u = 1 / (x * x)
    return shift + 1 / x + u / 2 + u / x * (1 / 6 - u * (1 / 30 - u * (1 / 42 - u * (1 / 30 - u * 5 / 66))))


def _rows(f, *cols: pd.Series) -> pd.Series:
    def one(*args):
        return None if any(pd.isna(a) for a in args) else f(*[float(a) for a in args])

    return pd.Series([one(*r) for r in zip(*cols)], dtype="float64")


@F.pandas_udf(DoubleType())
def chi2_p(stat: pd.Series, df: pd.Series) -> pd.Series:
    return _rows(lambda s, k: gamma_upper(k / 2, s / 2), stat, df)


@F.pandas_udf(DoubleType())
def t_p(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p of Student's t."""
    return _rows(lambda v, k: beta_lower(k / 2, 0.5, k / (k + v * v)), t, df)


@F.pandas_udf(DoubleType())
def f_p(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _rows(lambda v, a, b: beta_lower(b / 2, a / 2, b / (b + a * v)), f, d1, d2)


@F.pandas_udf(DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    """Two-sided p of a standard normal value."""
    return _rows(lambda v: min(1.0, 2 * normal_upper(abs(v))), z)


@F.pandas_udf(DoubleType())
def kolmogorov_p(x: pd.Series) -> pd.Series:
    return _rows(kolmogorov_tail, x)


@F.pandas_udf(DoubleType())
def beta_ppf(q: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
    return _rows(beta_quantile, q, a, b)


@F.pandas_udf(DoubleType())
def normal_ppf(q: pd.Series) -> pd.Series:
    return _rows(normal_quantile, q)


@F.pandas_udf(DoubleType())
def log_beta(a: pd.Series, b: pd.Series) -> pd.Series:
    return _rows(lambda x, y: math.lgamma(x) + math.lgamma(y) - math.lgamma(x + y), a, b)
