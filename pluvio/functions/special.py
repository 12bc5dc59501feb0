"""Gamma distribution and normal quantiles: vectorised over Arrow batches, as Spark has no such functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of Lanczos' approximation (g = 7, n = 9).
_LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)
# Coefficients of Acklam's rational approximation of the normal quantile.
_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0)


def log_gamma(a: np.ndarray) -> np.ndarray:
    x = np.asarray(a, float) - 1
    s = np.full_like(x, _LANCZOS[0])
    for i, c in enumerate(_LANCZOS[1:], 1):
        s = s + c / (x + i)
    t = x + 7.5
    return 0.5 * np.log(2 * np.pi) + (x + 0.5) * np.log(t) - t + np.log(s)


def gamma_cdf(x: np.ndarray, alpha: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Regularised lower incomplete gamma function of x / beta with shape alpha; NaN where undefined."""
    with np.errstate(all="ignore"):
        a, z = np.broadcast_arrays(np.asarray(alpha, float), np.asarray(x, float) / np.asarray(beta, float))
        ok = (a > 0) & (z > 0)
        aa, zz = np.where(ok, a, 1.0), np.where(ok, z, 1.0)
        scale = np.exp(aa * np.log(zz) - zz - log_gamma(aa))
        term = total = 1 / aa
        for n in range(1, 600):
            term = term * zz / (aa + n)
            total = total + term
            if not (term > 1e-16 * total).any():
                break
        b = zz + 1 - aa
        c, d = np.full_like(zz, 1e300), 1 / np.where(b == 0, 1e-300, b)
        h = d
        for i in range(1, 400):
            an = -i * (i - aa)
            b = b + 2
            d = an * d + b
            d = 1 / np.where(np.abs(d) < 1e-300, 1e-300, d)
            c = b + an / c
            c = np.where(np.abs(c) < 1e-300, 1e-300, c)
            h = h * d * c
            if not (np.abs(d * c - 1) > 1e-15).any():
                break
        out = np.where(zz < aa + 1, scale * total, 1 - scale * h)
        return np.where(ok, np.clip(out, 0, 1), np.where((a > 0) & (z == 0), 0.0, np.nan))


def normal_quantile(p: np.ndarray) -> np.ndarray:
    """Inverse of the standard normal distribution; -inf at 0, inf at 1."""
    p = np.asarray(p, float)
    with np.errstate(all="ignore"):
        q = np.sqrt(-2 * np.log(np.minimum(p, 1 - p)))
        tail = np.polyval(_C, q) / np.polyval(_D, q)
        r = (p - 0.5) ** 2
        centre = np.polyval(_A, r) * (p - 0.5) / np.polyval(_B, r)
        x = np.where(np.minimum(p, 1 - p) < 0.02425, np.where(p < 0.5, tail, -tail), centre)
        # One step of Halley's method, with the complementary error function from the incomplete gamma function.
        half = gamma_cdf(x * x / 2, np.full_like(x, 0.5), np.ones_like(x)) / 2
        e = np.where(x < 0, 0.5 - half, 0.5 + half) - p
        u = e * np.sqrt(2 * np.pi) * np.exp(x * x / 2)
        x = np.where((p > 0) & (p < 1), x - u / (1 + x * u / 2), x)
        return np.where(p == 0, -np.inf, np.where(p == 1, np.inf, np.where((p < 0) | (p > 1), np.nan, x)))


def gamma_quantile(p: np.ndarray, alpha: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Inverse of gamma_cdf, by bisection on a bracket that doubles."""
    p, a, b = np.broadcast_arrays(*(np.asarray(v, float) for v in (p, alpha, beta)))
    ok = (p >= 0) & (p < 1) & (a > 0) & (b > 0)
    aa = np.where(ok, a, 1.0)
    low, high = np.zeros_like(aa), aa + 10 * np.sqrt(aa) + 10
    while (grow := ok & (gamma_cdf(high, aa, 1.0) < p)).any():
        high = np.where(grow, high * 2, high)
    for _ in range(100):
        mid = (low + high) / 2
        under = gamma_cdf(mid, aa, 1.0) < p
        low, high = np.where(under, mid, low), np.where(under, high, mid)
    return np.where(ok, (low + high) / 2 * b, np.nan)


def digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of the logarithm of the gamma function, for x > 0."""
    x = np.asarray(x, float)
    y, below = x + 8, sum(1 / (x + i) for i in range(8))
    z = 1 / (y * y)
    return np.log(y) - 1 / (2 * y) - z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z / 240))) - below


def trigamma(x: np.ndarray) -> np.ndarray:
    """Derivative of digamma, for x > 0."""
    x = np.asarray(x, float)
    y, below = x + 8, sum(1 / (x + i) ** 2 for i in range(8))
    z = 1 / (y * y)
    return 1 / y + z / 2 + z / y * (1 / 6 - z * (1 / 30 - z * (1 / 42 - z / 30))) + below


def gamma_shape(s: np.ndarray) -> np.ndarray:
    """The shape a of the likeliest gamma distribution, with ln a - digamma(a) = s: s is the logarithm of the mean less the
    mean of logarithms. By Newton's method on 1 / a; NaN unless s > 0."""
    s = np.asarray(s, float)
    with np.errstate(all="ignore"):
        ok = s > 0
        t = np.where(ok, s, 1.0)
        a = (3 - t + np.sqrt((t - 3) ** 2 + 24 * t)) / (12 * t)
        for _ in range(60):
            step = 1 / a + (np.log(a) - digamma(a) - t) / (a * a * (1 / a - trigamma(a)))
            new = np.where(step > 0, 1 / step, 2 * a)
            near = np.abs(new - a) <= 1e-15 * a
            a = new
            if near.all():
                break
        return np.where(ok & np.isfinite(a), a, np.nan)


def _gamma_shape(s: pd.Series) -> pd.Series:
    out = gamma_shape(s.to_numpy(float))
    return pd.Series(out).where(~np.isnan(out))


def likeliest_shape(s) -> Column:
    """gamma_shape of a column; null where undefined."""
    return F.pandas_udf(_gamma_shape, "double")(s)


def beta_cdf(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function, by its continued fraction on the side where that is short; NaN where undefined."""
    with np.errstate(all="ignore"):
        x, a, b = np.broadcast_arrays(*(np.asarray(v, float) for v in (x, a, b)))
        ok = (a > 0) & (b > 0) & (x >= 0) & (x <= 1)
        turned = x > (a + 1) / (a + b + 2)
        z, p, q = np.where(turned, 1 - x, x), np.where(ok, np.where(turned, b, a), 1.0), np.where(ok, np.where(turned, a, b), 1.0)
        z = np.where(ok, z, 0.5)
        front = np.exp(log_gamma(p + q) - log_gamma(p) - log_gamma(q) + p * np.log(z) + q * np.log1p(-z)) / p
        tiny = 1e-300
        c, d = np.ones_like(z), 1 - (p + q) * z / (p + 1)
        d = 1 / np.where(np.abs(d) < tiny, tiny, d)
        h = d
        for m in range(1, 500):
            even = m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m))
            odd = -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))
            before = h
            for term in (even, odd):
                d, c = 1 + term * d, 1 + term / c
                d = 1 / np.where(np.abs(d) < tiny, tiny, d)
                c = np.where(np.abs(c) < tiny, tiny, c)
                h = h * c * d
            if not (np.abs(h - before) > 1e-15 * np.abs(h)).any():
                break
        part = np.where(z == 0, 0.0, front * h)
        return np.where(ok, np.where(turned, 1 - part, part), np.nan)


def correlation_p(r: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Two-sided p-value of a correlation r of n pairs that are not correlated, by Student's t with n - 2 degrees of
    freedom; NaN for fewer than three pairs."""
    r, n = np.broadcast_arrays(np.asarray(r, float), np.asarray(n, float))
    free = np.where(n > 2, n - 2, np.nan)
    return beta_cdf(np.clip(1 - r * r, 0, 1), free / 2, 0.5)


def _correlation_p(r: pd.Series, n: pd.Series) -> pd.Series:
    out = correlation_p(r.to_numpy(float), n.to_numpy(float))
    return pd.Series(out).where(r.notna() & ~np.isnan(out))


def p_of_correlation(r, n) -> Column:
    """correlation_p of columns; null where undefined."""
    return F.pandas_udf(_correlation_p, "double")(r, n)


def fisher_interval(r: Column, n: Column, level: float = 0.95) -> tuple[Column, Column]:
    """The ends of a correlation's confidence interval by Fisher's transformation; null for fewer than four pairs and for
    correlations of one."""
    half = float(normal_quantile(np.array([0.5 + level / 2]))[0]) / F.sqrt(n - 3)
    z = F.when((n > 3) & (F.abs(r) < 1), F.atanh(r))
    return F.tanh(z - half), F.tanh(z + half)


def _spi(x: pd.Series, alpha: pd.Series, beta: pd.Series) -> pd.Series:
    out = normal_quantile(gamma_cdf(x.to_numpy(float), alpha.to_numpy(float), beta.to_numpy(float)))
    return pd.Series(out).where(x.notna() & alpha.notna() & beta.notna() & ~np.isnan(out))


def _gamma_ppf(p: pd.Series, alpha: pd.Series, beta: pd.Series) -> pd.Series:
    out = gamma_quantile(p.to_numpy(float), alpha.to_numpy(float), beta.to_numpy(float))
    return pd.Series(out).where(~np.isnan(out))


def spi(x, alpha, beta) -> Column:
    """Standardised precipitation index; -inf for no rain, null where a parameter or the value is missing."""
    return F.pandas_udf(_spi, "double")(x, alpha, beta)


def gamma_ppf(p, alpha, beta) -> Column:
    """Quantiles of the gamma distribution; null where undefined."""
    return F.pandas_udf(_gamma_ppf, "double")(p, alpha, beta)
