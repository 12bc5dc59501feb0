"""Climatologies: means and exact quantiles by month or day of year, gamma parameters, anomalies, detrending."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from pluvio.functions import special
from pluvio.functions.calendar import doy

#: Quantile levels of the day-of-year climatology.
LEVELS = (0.02, 0.05, 0.1, 0.2, 0.25, 0.3, 0.3333, 0.4, 0.5, 0.6, 0.6666, 0.7, 0.75, 0.8, 0.9)
#: Quantile levels by scheme.
SCHEMES = {"tercile": (1 / 3, 2 / 3), "quartile": (0.25, 0.5, 0.75), "decile": tuple(i / 10 for i in range(1, 10)), "percentile": (0.02, *(i / 20 for i in range(1, 20)))}


def quantiles(value: str, levels, skipna: bool = True) -> Column:
    """Exact quantiles with linear interpolation as an array; with skipna off, null if a value is missing."""
    q = F.percentile(value, F.array(*[F.lit(float(x)) for x in levels]))
    return q if skipna else F.when(F.count(value) == F.count("*"), q)


def monthly_mean(df: DataFrame, by: list[str], time: str = "time", value: str = "precip") -> DataFrame:
    return df.groupBy(F.month(time).alias("month"), *by).agg(F.avg(value).alias(value))


def monthly_quantiles(df: DataFrame, by: list[str], levels, time: str = "time", value: str = "precip") -> DataFrame:
    """edges of each month and group, and the number of values."""
    return df.groupBy(F.month(time).alias("month"), *by).agg(quantiles(value, levels).alias("edges"), F.count(value).alias("n_instances"))


def quantiles_by(df: DataFrame, by: list[str], levels, value: str = "precip", skipna: bool = True) -> DataFrame:
    """edges and n_instances of each group, over all other dimensions at once."""
    return df.groupBy(*by).agg(quantiles(value, levels, skipna).alias("edges"), F.count("*").alias("n_instances"))


def exploded_edges(df: DataFrame, levels) -> DataFrame:
    """One row for each (quantile, edge) of packed edges."""
    named = F.arrays_zip(F.array(*[F.lit(float(x)) for x in levels]).alias("quantile"), F.col("edges").alias("edge"))
    return df.withColumn("_q", F.explode(named)).select(*[c for c in df.columns if c != "edges"], "_q.quantile", "_q.edge")


def days_of_year(df: DataFrame, half: int, time: str = "time", leap_mode: str = "reference") -> DataFrame:
    """Each row once for every day of year within `half` days of its own, on a circle of 365 days.

    Rows are expanded by a constant factor and then grouped by an equality key; there is no range join.
    """
    spread = F.transform(F.sequence(F.lit(-half), F.lit(half)), lambda i: F.pmod(doy(F.col(time), leap_mode) + i - 1, F.lit(365)) + 1)
    return df.withColumn("doy", F.explode(spread))


def doy_climatology(df: DataFrame, by: list[str], half: int = 7, levels=LEVELS, time: str = "time", value: str = "precip", leap_mode: str = "correct") -> DataFrame:
    """average, edges (null if a value is missing) and gamma parameters by day of year, from one grouping."""
    rows = days_of_year(df, half, time, leap_mode)
    alpha, beta = gamma_parameters(value)
    return rows.groupBy("doy", *by).agg(F.avg(value).alias("average"), quantiles(value, levels, False).alias("edges"), alpha.alias("alpha"), beta.alias("beta"))


def gamma_parameters(value: str) -> tuple[Column, Column]:
    """Thom's estimates (alpha, beta): zeros are in the mean but not in the mean of logarithms; null if undefined."""
    log = F.when(F.col(value) > 0, F.ln(value))
    mean = F.avg(value)
    a = F.when(mean > 0, F.ln(mean)) - F.avg(log)
    alpha = F.when(a > 0, (1 + F.sqrt(1 + 4 * a / 3)) / (4 * a))
    return alpha, F.try_divide(mean, alpha)


# Coefficients of Hosking's approximation of a gamma distribution's shape by its L-moments' ratio.
_LOW = (-0.3080, -0.05812, 0.01765)
_HIGH = (0.7213, -0.5947, -2.1817, 1.2113)
GAMMA_METHODS = ("thom", "pwm", "ml")


def shape_by_l_ratio(t: Column) -> Column:
    """The shape of a gamma distribution whose second L-moment is t times its mean; null unless 0 < t < 1."""
    z, y = math.pi * t * t, 1 - t
    low = (1 + _LOW[0] * z) / (z * (1 + z * (_LOW[1] + z * _LOW[2])))
    high = y * (_HIGH[0] + y * _HIGH[1]) / (1 + y * (_HIGH[2] + y * _HIGH[3]))
    return F.when((t > 0) & (t < 1), F.when(t < 0.5, low).otherwise(high))


def l_moments(df: DataFrame, by: list[str], value: str = "precip") -> DataFrame:
    """l1 and l2, the first two L-moments of each group, from probability-weighted moments; missing values are left out.

    Ranks come from one sort of each group, and the moments from an aggregation over the same partitions. l2 is null for a
    single value.
    """
    w = Window.partitionBy(*by)
    x = F.col(value).cast("double")
    ranked = df.where(x.isNotNull()).select(*by, x.alias("_x"), (F.row_number().over(w.orderBy(x)) - 1).alias("_below"))
    n, b0 = F.count("*"), F.avg("_x")
    b1 = F.try_divide(F.sum(F.col("_below") * F.col("_x")), n * (n - 1))
    return ranked.groupBy(*by).agg(n.alias("n"), b0.alias("l1"), (2 * b1 - b0).alias("l2"))


def gamma_fit(df: DataFrame, by: list[str], value: str = "precip", method: str = "thom") -> DataFrame:
    """alpha and beta (shape and scale) of each group's gamma distribution; null where a method has no answer.

    thom: Thom's estimates; zeros are in the mean but not in the mean of logarithms. pwm: by L-moments of all values, zeros
    included. ml: the likeliest parameters of the values above zero, with dry, the share of the others among all that are
    there.
    """
    if method not in GAMMA_METHODS:
        raise ValueError(f"method {method!r}; known are {', '.join(GAMMA_METHODS)}")
    if method == "thom":
        alpha, beta = gamma_parameters(value)
        return df.groupBy(*by).agg(alpha.alias("alpha"), beta.alias("beta"))
    if method == "pwm":
        fit = l_moments(df, by, value).withColumn("alpha", shape_by_l_ratio(F.try_divide(F.col("l2"), F.col("l1"))))
        return fit.select(*by, "alpha", (F.col("l1") / F.col("alpha")).alias("beta"))
    wet = F.when(F.col(value) > 0, F.col(value))
    mean = df.groupBy(*by).agg(F.avg(wet).alias("_mean"), (F.ln(F.avg(wet)) - F.avg(F.ln(wet))).alias("_s"), F.avg(F.when(F.col(value).isNotNull(), F.when(F.col(value) > 0, 0.0).otherwise(1.0))).alias("dry"))
    # Below this the values are alike but for rounding.
    fit = mean.withColumn("alpha", special.likeliest_shape(F.when(F.col("_s") > 1e-13, F.col("_s"))))
    return fit.select(*by, "alpha", (F.col("_mean") / F.col("alpha")).alias("beta"), "dry")


def gamma_quantiles(df: DataFrame, by: list[str], levels, value: str = "precip", method: str = "pwm") -> DataFrame:
    """(quantile, edge) of each group by its fitted gamma distribution; null without a fit. With "ml" the distribution is of
    the values above zero, and quantiles up to the share of the others are 0."""
    fit = gamma_fit(df, by, value, method)
    rows = fit.withColumn("quantile", F.explode(F.array(*[F.lit(float(x)) for x in levels])))
    if method != "ml":
        return rows.select(*by, "quantile", special.gamma_ppf("quantile", "alpha", "beta").alias("edge"))
    p = F.try_divide(F.col("quantile") - F.col("dry"), 1 - F.col("dry"))
    edge = special.gamma_ppf(F.greatest(p, F.lit(0.0)), "alpha", "beta")
    return rows.select(*by, "quantile", F.when(F.col("quantile") <= F.col("dry"), 0.0).otherwise(edge).alias("edge"))


def anomaly(value: str, by: list[str], time: str = "time", base: tuple[int, int] | None = None) -> Column:
    """Difference from the mean of the calendar month, over all years or those of a base period."""
    kept = F.col(value) if base is None else F.when(F.year(time).between(*base), F.col(value))
    return F.col(value) - F.avg(kept).over(Window.partitionBy(F.month(time), *by))


def standardised(value: Column, by: list[str], sample: bool = False) -> Column:
    """(x - mean) / standard deviation, of the population or of a sample."""
    w = Window.partitionBy(*by)
    return F.try_divide(value - F.avg(value).over(w), (F.stddev_samp if sample else F.stddev_pop)(value).over(w))


def detrended(value: str, x: str, by: list[str], add_average: bool = False) -> Column:
    """Residual of a straight line over x; the mean may be added back. Null x or value gives null."""
    w = Window.partitionBy(*by)
    y = F.col(value)
    line = F.regr_intercept(y, F.col(x)).over(w) + F.regr_slope(y, F.col(x)).over(w) * F.col(x)
    return y - line + (F.avg(y).over(w) if add_average else F.lit(0.0))


#: Degrees beyond this are past what power sums in double precision tell apart.
MOST_DEGREE = 8


@F.pandas_udf(ArrayType(DoubleType()))
def _solved(powers: pd.Series, products: pd.Series) -> pd.Series:
    """Coefficients from the sums of u^k and of y u^k, of all series of a batch at once; null where they are not determined."""
    if powers.empty:
        return pd.Series([], dtype=object)
    s, t = np.stack(powers.to_list()).astype(float), np.stack(products.to_list()).astype(float)
    n = t.shape[1]
    matrix = s[:, np.add.outer(np.arange(n), np.arange(n))]
    out = np.full(len(t), None, dtype=object)
    finite = np.flatnonzero(np.isfinite(matrix).all(axis=(1, 2)) & np.isfinite(t).all(axis=1))
    told = finite[np.linalg.matrix_rank(matrix[finite], tol=1e-11 * s[finite, :1].max(axis=1)) == n]
    for i, c in zip(told, np.linalg.solve(matrix[told], t[told, :, None])[:, :, 0], strict=True):
        out[i] = c
    return pd.Series(out)


def polynomial_fit(df: DataFrame, value: str, x: str, by: list[str], degree: int) -> DataFrame:
    """(by..., centre, half, coefficients): a polynomial of u = (x - centre) / half for each series, least squares.

    Rows without x or value take no part. Sums of powers are partial aggregates, so that a long series is no task of its
    own; u runs from -1 to 1, for their digits' sake. Coefficients are null where a series has no more distinct x than the
    degree, or values that are not finite.
    """
    if not 1 <= degree <= MOST_DEGREE:
        raise ValueError(f"a degree of {degree}, not 1 to {MOST_DEGREE}")
    told = df.where(F.col(value).isNotNull() & F.col(x).isNotNull()).select(*by, F.col(x).cast("double").alias("_x"), F.col(value).cast("double").alias("_y"))
    span = told.groupBy(*by).agg(((F.min("_x") + F.max("_x")) / 2).alias("centre"), ((F.max("_x") - F.min("_x")) / 2).alias("half"))
    placed = told.join(span, by).withColumn("_u", F.when(F.col("half") > 0, (F.col("_x") - F.col("centre")) / F.col("half")).otherwise(F.lit(0.0)))
    power = lambda k: F.pow("_u", F.lit(float(k)))
    powers = F.array(*[F.sum(power(k)) for k in range(2 * degree + 1)]).alias("_s")
    products = F.array(*[F.sum(F.col("_y") * power(k)) for k in range(degree + 1)]).alias("_t")
    return placed.groupBy(*by, "centre", "half").agg(powers, products).select(*by, "centre", "half", _solved("_s", "_t").alias("coefficients"))


def polynomial_detrended(df: DataFrame, value: str, x: str, by: list[str], degrees: tuple[int, ...] = (2,), add_average: bool = False) -> DataFrame:
    """df with residual_<degree> for each degree: the value less its polynomial over x; the mean may be added back.

    Null where the row has no x or value, a key is null, or the series does not determine the polynomial.
    """
    out = df
    if add_average:
        out = out.join(df.groupBy(*by).agg(F.avg(value).alias("_average")), by, "left")
    for d in degrees:
        out = out.join(polynomial_fit(df, value, x, by, d).withColumnsRenamed({c: f"_{c}" for c in ("centre", "half", "coefficients")}), by, "left")
        u = F.when(F.col("_half") > 0, (F.col(x) - F.col("_centre")) / F.col("_half")).otherwise(F.lit(0.0))
        curve = F.get("_coefficients", F.lit(d))
        for k in reversed(range(d)):
            curve = curve * u + F.get("_coefficients", F.lit(k))
        out = out.withColumn(f"residual_{d}", F.col(value) - curve + (F.col("_average") if add_average else F.lit(0.0))).drop("_centre", "_half", "_coefficients")
    return out.drop("_average")


def mask_outliers(value: str, by: list[str], k: float = 5.0, strict: bool = False) -> Column:
    """Null beyond k times the 99 % quantile of the series (strict: also at it)."""
    limit = F.percentile(value, F.lit(0.99)).over(Window.partitionBy(*by)) * k
    return F.when((F.col(value) < limit) if strict else (F.col(value) <= limit), F.col(value))
