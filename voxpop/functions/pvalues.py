"""Tail probabilities for the rank tests, as vectorised (Arrow) UDFs.

The statistics are computed in Spark; these UDFs only map a handful of
result rows (one per test) to p-values.  Algorithms: ``math.erfc`` for the
normal tail; series / continued fraction for the regularised incomplete gamma
(chi-square tail) and the continued fraction of the regularised incomplete
beta (Student t tail) — standard numerical recipes.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPS = 1e-15
_MAXIT = 500


def normal_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def _gamma_series(a: float, x: float) -> float:
    term = total = 1.0 / a
    ap = a
    for _ in range(_MAXIT):
        ap += 1.0
        term *= x / ap
        total += term
        if abs(term) < abs(total) * _EPS:
            break
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _gamma_cf(a: float, x: float) -> float:
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in range(1, _MAXIT):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def chi2_sf(x: float, df: float) -> float:
    """P(X > x) for chi-square with ``df`` degrees of freedom."""
    if x is None or df is None or math.isnan(x) or df <= 0:
        return float("nan")
    if x <= 0:
        return 1.0
    a, h = df / 2.0, x / 2.0
    if h < a + 1.0:
        return 1.0 - _gamma_series(a, h)
    return _gamma_cf(a, h)


def _beta_cf(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = tiny if abs(d) < tiny else d
    d = 1.0 / d
    h = d
    for m in range(1, _MAXIT):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = tiny if abs(d) < tiny else d
        c = 1.0 + aa / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = tiny if abs(d) < tiny else d
        c = 1.0 + aa / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return h


def betainc_reg(a: float, b: float, x: float) -> float:
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_cf(a, b, x) / a
    return 1.0 - front * _beta_cf(b, a, 1.0 - x) / b


# Above this the incomplete beta loses digits (log-gamma differences cancel) and
# the corrected normal tail, whose error is of order 1/df^2, is exact to them.
LARGE_DF = 1e6


def t_two_sided(t: float, df: float) -> float:
    if t is None or df is None or math.isnan(t) or df <= 0:
        return float("nan")
    if math.isinf(t):
        return 0.0
    if df > LARGE_DF:
        z = t * (1 - 1 / (4 * df)) / math.sqrt(1 + t * t / (2 * df))
        return min(1.0, 2.0 * normal_sf(abs(z)))
    return betainc_reg(df / 2.0, 0.5, df / (df + t * t))


def _vec(fn, *cols):
    out = np.empty(len(cols[0]), dtype="float64")
    for i, args in enumerate(zip(*cols)):
        if any(a is None or (isinstance(a, float) and math.isnan(a)) for a in args):
            out[i] = np.nan
        else:
            out[i] = fn(*[float(a) for a in args])
    return pd.Series(out)


@F.pandas_udf(T.DoubleType())
def normal_two_sided_udf(z: pd.Series) -> pd.Series:
    return _vec(lambda v: min(1.0, 2.0 * normal_sf(abs(v))), z)


@F.pandas_udf(T.DoubleType())
def chi2_sf_udf(x: pd.Series, df: pd.Series) -> pd.Series:
    return _vec(chi2_sf, x, df)


@F.pandas_udf(T.DoubleType())
def t_two_sided_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return _vec(t_two_sided, t, df)


@F.pandas_udf(T.DoubleType())
def inverse_normal_udf(p: pd.Series) -> pd.Series:
    from statistics import NormalDist
    nd = NormalDist()
    return _vec(lambda v: nd.inv_cdf(v) if 0 < v < 1 else float("nan"), p)


def mann_whitney_exact(u: float, n1: float, n2: float) -> float:
    """Two-sided exact p of the U statistic without ties.

    The counts of U are the coefficients of the Gaussian binomial
    prod (1 - q^(n2 + i)) / (1 - q^i), i = 1..n1: running sums of stride i, then
    one shifted difference for each i.  Only the lower tail is built."""
    n1, n2 = int(min(n1, n2)), int(max(n1, n2))
    low = int(round(min(u, n1 * n2 - u)))
    a = np.zeros(low + 1)
    a[0] = 1.0
    for i in range(1, n1 + 1):
        for r in range(min(i, low + 1)):
            a[r::i] = np.cumsum(a[r::i])
    for i in range(1, n1 + 1):
        if n2 + i <= low:
            a[n2 + i:] -= a[:low + 1 - n2 - i].copy()
    return min(1.0, 2.0 * float(a.sum()) / math.comb(n1 + n2, n1))


@F.pandas_udf(T.DoubleType())
def mann_whitney_exact_udf(u: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return _vec(mann_whitney_exact, u, n1, n2)


LISTED = 64  # normal scores listed one by one at either end


def score_sum(a: float, b: float, n: float, power: int = 1) -> float:
    """Sum over the ranks a < i <= b of n of the normal score to ``power`` (1 or 2):
    the inverse normal at (i - 0.3175) / (n + 0.365), at the first and last rank at
    1 - 0.5^(1/n) and 0.5^(1/n).

    Ranks near the ends are listed; between them the sum is the antiderivative
    (-density, or area less score times density) with midpoint corrections by the
    first and third derivative."""
    from statistics import NormalDist
    nd = NormalDist()

    def score(i):
        p = 0.5 ** (1 / n) if i == n else 1 - 0.5 ** (1 / n) if i == 1 else (i - 0.3175) / (n + 0.365)
        return nd.inv_cdf(p) ** power

    a, b, n = int(a), int(b), int(n)
    lo, hi = max(a, min(b, LISTED)), min(b, max(a, n - LISTED))
    total = sum(score(i) for i in range(a + 1, min(lo, b) + 1)) + sum(score(i) for i in range(max(hi, lo) + 1, b + 1))
    if hi <= lo:
        return total
    scale = n + 0.365

    def parts(x):  # antiderivative, first and third derivative at x
        p = (x - 0.3175) / scale
        z = nd.inv_cdf(p)
        d = nd.pdf(z)
        z1 = 1 / (scale * d)
        z2, z3 = z * z1 * z1, z1 ** 3 * (1 + 2 * z * z)
        if power == 1:
            return -d * scale, z1, z3
        return (p - z * d) * scale, 2 * z * z1, 6 * z1 * z2 + 2 * z * z3

    (s0, f0, t0), (s1, f1, t1) = parts(lo + 0.5), parts(hi + 0.5)
    return total + (s1 - s0) - (f1 - f0) / 24 + 7 * (t1 - t0) / 5760


@F.pandas_udf(T.DoubleType())
def score_sum_udf(a: pd.Series, b: pd.Series, n: pd.Series) -> pd.Series:
    return _vec(score_sum, a, b, n)


@F.pandas_udf(T.DoubleType())
def score_square_sum_udf(n: pd.Series) -> pd.Series:
    return _vec(lambda n: score_sum(0, n, n, 2), n)
