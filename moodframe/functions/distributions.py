"""Distribution tails for test statistics (driver-side, on a handful of
numbers): Student t, F and chi-square with 2 degrees of freedom, plus the
normality-test z scores of D'Agostino (skew) and Anscombe-Glynn (kurtosis).
scipy is not assumed; the incomplete beta function is a continued fraction."""

from __future__ import annotations

import math


def _betacf(a: float, b: float, x: float) -> float:
    tiny, eps = 1e-300, 3e-16
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < eps:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def t_sf2(t: float, df: float) -> float:
    """Two-sided p value of a t statistic."""
    if t is None or math.isnan(t) or df <= 0:
        return float("nan")
    if math.isinf(t):
        return 0.0
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def t_ppf(q: float, df: float) -> float:
    """Quantile of the t distribution (bisection on the tail)."""
    target = 2.0 * (1.0 - q)
    lo, hi = 0.0, 1.0
    while t_sf2(hi, df) > target:
        hi *= 2.0
    for _ in range(200):
        mid = (lo + hi) / 2.0
        if t_sf2(mid, df) > target:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2.0


def f_sf(f: float, d1: float, d2: float) -> float:
    """Upper tail of the F distribution."""
    if f is None or math.isnan(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_2_sf(x: float) -> float:
    """Upper tail of chi-square with 2 degrees of freedom."""
    return math.exp(-x / 2.0)


def skew_z(skew: float, n: float) -> float:
    """D'Agostino's z for the sample skewness (biased estimator)."""
    y = skew * math.sqrt(((n + 1) * (n + 3)) / (6.0 * (n - 2)))
    beta2 = (3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3)) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + math.sqrt(2 * (beta2 - 1))
    delta = 1 / math.sqrt(0.5 * math.log(w2))
    alpha = math.sqrt(2.0 / (w2 - 1))
    y = 1.0 if y == 0 else y
    return delta * math.log(y / alpha + math.sqrt((y / alpha) ** 2 + 1))


def kurtosis_z(kurt: float, n: float) -> float:
    """Anscombe-Glynn z for the (non-excess) sample kurtosis."""
    e = 3.0 * (n - 1) / (n + 1)
    varb2 = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1.0) * (n + 3) * (n + 5))
    x = (kurt - e) / math.sqrt(varb2)
    sqrtbeta1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * math.sqrt(
        (6.0 * (n + 3) * (n + 5)) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / sqrtbeta1 * (2.0 / sqrtbeta1 + math.sqrt(1 + 4.0 / (sqrtbeta1 ** 2)))
    term1 = 1 - 2 / (9.0 * a)
    denom = 1 + x * math.sqrt(2 / (a - 4.0))
    if denom == 0:
        return float("nan")
    term2 = math.copysign(1.0, denom) * ((1 - 2.0 / a) / abs(denom)) ** (1 / 3.0)
    return (term1 - term2) / math.sqrt(2 / (9.0 * a))
