"""The queries of the gamma distribution, held against sums of its series."""

import math
from collections import defaultdict
from statistics import NormalDist, fmean

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.functions import special
from pluvio.operators import classify as cls
from pluvio.operators import climatology as clim
from pluvio.plans import monitoring as mon
from pluvio.sources import tables as t


def lower_gamma(shape, x):
    """The regularised lower incomplete gamma function, by its power series."""
    if x <= 0:
        return 0.0
    term, total, k = 1.0, 1.0, 0
    while term > 1e-17 * total:
        k += 1
        term *= x / (shape + k)
        total += term
    return min(1.0, total * math.exp(shape * math.log(x) - x - math.lgamma(shape + 1)))


def thom(values):
    """Shape and scale by Thom's estimates; zeros count in the mean only."""
    mean = fmean(values)
    a = math.log(mean) - fmean(math.log(v) for v in values if v > 0)
    shape = (1 + math.sqrt(1 + 4 * a / 3)) / (4 * a)
    return shape, mean / shape


def test_spi_rows(spark, sf_dir):
    rain = {(r.iy, r.ix, r.time): r.precip for r in t.obs_daily(spark, sf_dir).collect() if r.precip is not None}
    by_cell = defaultdict(list)
    for (iy, ix, _), v in rain.items():
        by_cell[iy, ix].append(v)
    fit = {cell: thom(v) for cell, v in by_cell.items()}
    got = {(r.iy, r.ix, r.time): r for r in mon.sta3_spi(spark, sf_dir).collect()}
    assert got.keys() == rain.keys()
    held = 0
    for key, row in got.items():
        shape, scale = fit[key[:2]]
        p = lower_gamma(shape, rain[key] / scale)
        if p == 0:
            assert row.spi == -math.inf
        elif 1e-9 < p < 1 - 1e-9:
            held += 1
            assert row.spi == pytest.approx(NormalDist().inv_cdf(p), abs=1e-5)
        if all(abs(row.spi - level) > 1e-5 for level in cls.SPI_LEVELS):
            assert row.spi_class == sum(level <= row.spi for level in cls.SPI_LEVELS)
    assert held > len(got) / 2


def test_gamma_quantile_rows(spark, sf_dir):
    by_row = defaultdict(list)
    for r in t.obs_monthly(spark, sf_dir).collect():
        if r.precip is not None:
            by_row[r.iy].append(r.precip)
    got = mon.agg9_gamma_quantiles(spark, sf_dir).collect()
    assert {(r.iy, r["quantile"]) for r in got} == {(iy, q) for iy in by_row for q in (0.1, 0.5, 0.9)}
    for r in got:
        shape, scale = thom(by_row[r.iy])
        assert lower_gamma(shape, r.edge / scale) == pytest.approx(r["quantile"], abs=1e-5)


def test_digamma_and_trigamma():
    x = np.array([0.01, 0.3, 1.0, 2.5, 10.0, 1000.0])
    slope = lambda f, h: (f(x * (1 + h)) - f(x * (1 - h))) / (2 * h * x)
    logs = np.vectorize(math.lgamma)
    assert np.allclose(special.digamma(x), slope(logs, 1e-5), rtol=1e-7, atol=1e-7)
    assert special.digamma(np.array([1.0]))[0] == pytest.approx(-0.5772156649015329)
    assert special.trigamma(np.array([1.0]))[0] == pytest.approx(math.pi**2 / 6)
    assert np.allclose(special.trigamma(x), slope(special.digamma, 1e-5), rtol=1e-6)


def test_likeliest_shapes_over_many_sizes():
    a = np.array([1e-3, 0.05, 0.7, 1.0, 3.0, 80.0, 1e4, 1e6])
    s = np.log(a) - special.digamma(a)
    assert np.allclose(special.gamma_shape(s)[:7], a[:7], rtol=1e-6)
    assert np.isnan(special.gamma_shape(np.array([0.0, -1.0, np.nan]))).all()


def _samples():
    rng = np.random.default_rng(3)
    out = {k: rng.gamma(shape, scale, 400) for k, (shape, scale) in enumerate([(0.4, 5.0), (1.0, 2.0), (2.5, 1.5), (40.0, 0.1)])}
    out[4] = np.where(rng.random(400) < 0.3, 0.0, rng.gamma(2.0, 3.0, 400))
    return out


def _likelihood(x, a):
    """Of the shape a with its best scale."""
    return (a - 1) * np.log(x).mean() - math.lgamma(a) - a * math.log(x.mean() / a) - a


def test_fits_by_method(spark):
    samples = _samples()
    rows = [(k, float(v)) for k, x in samples.items() for v in x] + [(k, None) for k in samples] + [(9, 3.0), (9, 3.0), (10, 5.0), (11, 0.0), (11, 0.0), (12, None)]
    df = spark.createDataFrame(rows, "k int, precip double")
    got = {m: {r.k: r for r in clim.gamma_fit(df, ["k"], method=m).collect()} for m in clim.GAMMA_METHODS}
    for k, x in samples.items():
        wet = x[x > 0]
        r = got["ml"][k]
        assert r.dry == pytest.approx((x == 0).mean()) and r.alpha * r.beta == pytest.approx(wet.mean())
        best = _likelihood(wet, r.alpha)
        assert all(best >= _likelihood(wet, r.alpha * (1 + d)) for d in (-0.1, -1e-3, 1e-3, 0.1))
        y = np.sort(x)
        pairs = np.abs(y[:, None] - y[None]).sum() / (len(y) * (len(y) - 1)) / 2
        moments = {r.k: (r.l1, r.l2) for r in clim.l_moments(df, ["k"]).collect()}
        assert moments[k] == pytest.approx((y.mean(), pairs))
        r = got["pwm"][k]
        # Half the mean difference of two draws of the fitted distribution is the second L-moment: scale * G(a + 1/2) / (sqrt(pi) * G(a)).
        ratio = math.exp(math.lgamma(r.alpha + 0.5) - math.lgamma(r.alpha)) / math.sqrt(math.pi) / r.alpha
        assert ratio == pytest.approx(pairs / y.mean(), rel=2e-4) and r.alpha * r.beta == pytest.approx(y.mean())
    for k in (9, 10, 11, 12):
        assert all(k not in got[m] or got[m][k].alpha is None for m in ("pwm", "ml"))
    with pytest.raises(ValueError):
        clim.gamma_fit(df, ["k"], method="moments")


def test_quantiles_by_method(spark, sf_dir):
    groups = defaultdict(list)
    for r in t.obs_monthly(spark, sf_dir).collect():
        if r.precip is not None:
            groups[r.time.month, r.iy].append(r.precip)
    monthly = t.obs_monthly(spark, sf_dir).withColumn("month", F.month("time"))
    fits = {m: {(r.month, r.iy): r for r in clim.gamma_fit(monthly, ["month", "iy"], method=m).collect()} for m in clim.GAMMA_METHODS}
    got = mon.agg9_quantiles_by_method(spark, sf_dir).collect()
    assert len(got) == 6 * len(groups)
    for r in got:
        fit = fits[r.method][r.month, r.iy]
        p = r["quantile"]
        if r.method == "ml":
            p = (p - fit.dry) / (1 - fit.dry)
        if fit.alpha is None or p <= 0:
            assert r.edge in (None, 0.0)
        else:
            assert lower_gamma(fit.alpha, r.edge / fit.beta) == pytest.approx(p, abs=1e-5)


def test_dry_share_moves_quantiles(spark):
    df = spark.createDataFrame([(0, float(v)) for v in [0.0] * 50 + list(np.random.default_rng(1).gamma(2, 1, 50))], "k int, precip double")
    got = {r["quantile"]: r.edge for r in clim.gamma_quantiles(df, ["k"], [0.25, 0.5, 0.75], method="ml").collect()}
    fit = clim.gamma_fit(df, ["k"], method="ml").first()
    assert got[0.25] == got[0.5] == 0.0 and lower_gamma(fit.alpha, got[0.75] / fit.beta) == pytest.approx(0.5, abs=1e-6)
