"""Polynomials taken off series, against numpy."""

import numpy as np
import pytest

from pluvio.operators import climatology as clim


def test_residuals_are_those_of_a_fit_by_numpy(spark):
    rng = np.random.default_rng(3)
    rows, expected = [], {}
    for k in range(4):
        x = np.sort(rng.choice(20000, 60, replace=False)).astype(float)
        y = 3 + 1e-3 * x - 2e-7 * x**2 + rng.normal(size=60)
        rows += [(k, float(a), float(b)) for a, b in zip(x, y, strict=True)]
        for d in (1, 2, 5):
            expected[k, d] = y - np.polynomial.Polynomial.fit(x, y, d)(x)
    got = clim.polynomial_detrended(spark.createDataFrame(rows, "k int, x double, y double"), "y", "x", ["k"], (1, 2, 5)).collect()
    for (k, d), residual in expected.items():
        own = sorted((r["x"], r[f"residual_{d}"]) for r in got if r["k"] == k)
        np.testing.assert_allclose([v for _, v in own], residual, atol=1e-8)


def test_series_that_determine_no_curve(spark):
    rows = [
        *[("few", float(i), 1.0 * i) for i in range(2)],
        *[("same", 5.0, float(i)) for i in range(9)],
        *[("line", float(i), 2.0 * i) for i in range(6)],
        ("line", None, 1.0),
        ("line", 3.5, None),
        (None, 1.0, 1.0),
        *[("bad", float(i), float("nan") if i == 3 else 1.0) for i in range(6)],
    ]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    got = clim.polynomial_detrended(df, "y", "x", ["k"], (2,), add_average=True).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["k"] == "line" and r["x"] is not None and r["y"] is not None:
            # The mean is over the values of all rows, also that without x.
            assert r["residual_2"] == pytest.approx(31.0 / 7)
        else:
            assert r["residual_2"] is None
    assert clim.polynomial_detrended(df.limit(0), "y", "x", ["k"]).count() == 0
    with pytest.raises(ValueError, match="degree"):
        clim.polynomial_fit(df, "y", "x", ["k"], 0)
