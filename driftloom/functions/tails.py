"""Tail probabilities of finished test statistics (one number per tested column, never per data row)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Up to this larger sample both sizes enter the p-value exactly; beyond it the larger one counts as the true distribution.
EXACT_LIMIT = 10_000
# Effective sizes up to which the one-sample tail is computed exactly.
MATRIX_SIZE = 2_000


def chi2_sf(x: float, df: float) -> float:
    """P(X > x) for chi-square: the regularised upper incomplete gamma function Q(df/2, x/2)."""
    if x <= 0 or df <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    a, z = df / 2.0, x / 2.0
    scale = math.exp(a * math.log(z) - z - math.lgamma(a))
    if z < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-17:
            k += 1
            term *= z / k
            total += term
        return max(0.0, 1.0 - scale * total)
    # Lentz's method for the continued fraction
    b = z + 1 - a
    c, d = 1e300, 1 / b
    h = d
    for i in range(1, 100_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return min(1.0, scale * h)


def one_sample_exact_sf(n: int, d: float) -> float:
    """P(D_n >= d) of the one-sample statistic, by the matrix power of Marsaglia, Tsang and Wang (2003).

    The matrix has 2 * ceil(n * d) - 1 rows; powers are scaled, so nothing overflows.
    """
    if d <= 0:
        return 1.0
    if d >= 1:
        return 0.0
    k = math.ceil(n * d)
    h, m = k - n * d, 2 * k - 1
    lag = np.arange(m)[:, None] - np.arange(m)[None, :] + 1
    matrix = (lag >= 0).astype(float)
    powers = h ** np.arange(1, m + 1)
    matrix[:, 0] -= powers
    matrix[-1, :] -= powers[::-1]
    matrix[-1, 0] += max(2 * h - 1, 0.0) ** m
    logs = np.array([math.lgamma(x + 1) for x in range(m + 1)])
    matrix *= np.where(lag > 0, np.exp(-logs[np.maximum(lag, 0)]), 1.0)
    total, scale = np.eye(m), 0.0  # the result is total * exp(scale)
    base, base_scale, left = matrix, 0.0, n
    while left:
        if left & 1:
            total, scale = total @ base, scale + base_scale
            peak = np.abs(total).max()
            total, scale = total / peak, scale + math.log(peak)
        base, base_scale, left = base @ base, 2 * base_scale, left >> 1
        peak = np.abs(base).max()
        base, base_scale = base / peak, base_scale + math.log(peak)
    inside = total[k - 1, k - 1]
    if inside <= 0:
        return 1.0
    return min(1.0, max(0.0, -math.expm1(math.log(inside) + scale + math.lgamma(n + 1) - n * math.log(n))))


def kolmogorov_sf(d: float, n: int) -> float:
    """Tail of the Kolmogorov statistic at sample size n.

    Exact up to MATRIX_SIZE; beyond, the limit law with Vrbik's (2018) finite-size shift, whose error is then under 1e-7.
    Tails below 1e-15 are given by the limit law as well.
    """
    if n <= MATRIX_SIZE and n * d * d < 18:
        return one_sample_exact_sf(n, d)
    root = math.sqrt(n)
    t = d * root
    if t <= 0:
        return 1.0
    t = t + 1 / (6 * root) + (t - 1) / (4 * n)
    if t < 1.0:
        terms = sum(math.exp(-((2 * k - 1) ** 2) * math.pi**2 / (8 * t * t)) for k in range(1, 20))
        return min(1.0, max(0.0, 1.0 - math.sqrt(2 * math.pi) / t * terms))
    return min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * t * t) for k in range(1, 20))))


def two_sample_exact_sf(n1: int, n2: int, d: float) -> float:
    """P(D >= d) for two samples, by counting lattice paths that stay strictly inside the band."""
    m, n = max(n1, n2), min(n1, n2)
    lcm = m * n // math.gcd(m, n)
    h = round(d * lcm)
    if h <= 0:
        return 1.0
    up, right = lcm // m, lcm // n
    columns = np.arange(n + 1)
    row = (columns * right < h).astype(float)
    inside = 0.0  # log of the factors taken out of the running row
    for i in range(1, m + 1):
        allowed = np.abs(i * up - columns * right) < h
        first = int(np.argmax(allowed))
        if not allowed[first]:
            return 1.0
        row = np.where(allowed, np.cumsum(np.where(allowed, row, 0.0)), 0.0)
        peak = row.max()
        if peak == 0:
            return 1.0
        row /= peak
        inside += math.log(peak)
    if row[-1] <= 0:
        return 1.0
    paths = math.lgamma(m + n + 1) - math.lgamma(m + 1) - math.lgamma(n + 1)
    return min(1.0, max(0.0, -math.expm1(inside + math.log(row[-1]) - paths)))


def two_sample_ks_sf(n1: int, n2: int, d: float) -> float:
    if n1 <= 0 or n2 <= 0:
        return 1.0
    if max(n1, n2) <= EXACT_LIMIT:
        return two_sample_exact_sf(int(n1), int(n2), d)
    return kolmogorov_sf(d, max(1, round(n1 * n2 / (n1 + n2))))


# A Python function is evaluated for every row, also where a `when` around it picks another branch, so both
# take missing input.
@F.pandas_udf(T.DoubleType())
def chi2_p(statistic: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([1.0 if pd.isna(x) or pd.isna(k) else chi2_sf(x, k) for x, k in zip(statistic, df)], dtype=float)


@F.pandas_udf(T.DoubleType())
def ks_p(n1: pd.Series, n2: pd.Series, d: pd.Series) -> pd.Series:
    rows = zip(n1.fillna(0), n2.fillna(0), d)
    return pd.Series([1.0 if pd.isna(x) else two_sample_ks_sf(int(a), int(b), x) for a, b, x in rows], dtype=float)
