"""Significance of correlations against printed tables and sums; the subtropical dipole over a base period."""

import datetime as dt
import math
import random
import statistics

import numpy as np
import pytest

from pluvio.functions import special
from pluvio.operators import indices as ind
from pluvio.plans import verification as v

# Two-sided 5 % and 1 % points of Student's t by degrees of freedom.
T = {1: (12.706, 63.657), 5: (2.571, 4.032), 10: (2.228, 3.169), 30: (2.042, 2.750), 120: (1.980, 2.617)}


def test_p_values_of_printed_tables():
    for free, (five, one) in T.items():
        for t, p in ((five, 0.05), (one, 0.01)):
            r = t / math.sqrt(free + t * t)
            assert special.correlation_p(np.array([r]), np.array([free + 2]))[0] == pytest.approx(p, rel=2e-3)
    assert special.correlation_p(np.array([0.0, 1.0, -1.0]), np.array([10.0] * 3)).tolist() == [1.0, 0.0, 0.0]
    assert np.isnan(special.correlation_p(np.array([0.5]), np.array([2.0])))


def test_beta_function_by_sums():
    for a, b in ((0.5, 0.5), (2.0, 3.5), (60.0, 0.5), (7.0, 1.0)):
        for x in (0.01, 0.3, 0.7, 0.99):
            n = 200_000
            # The substitution t = s ** (1 / a) takes the pole at 0 away; midpoints do not touch the one at 1.
            s = (np.arange(n) + 0.5) / n * x**a
            whole = math.exp(math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b))
            want = ((1 - s ** (1 / a)) ** (b - 1)).mean() * x**a / a / whole
            assert special.beta_cdf(np.array([x]), a, b)[0] == pytest.approx(want, rel=1e-5)


def test_rows_of_significance(spark, sf_dir):
    for r in v.ver14_significance(spark, sf_dir).collect():
        if r.corr is not None and r.n > 2:
            assert 0 <= r.p <= 1 and r.p == pytest.approx(special.correlation_p(np.array([r.corr]), np.array([r.n]))[0], abs=1e-4)


def test_dipole_is_standardised_on_its_base(spark):
    rng = random.Random(3)
    months = [dt.date(1978 + i // 12, i % 12 + 1, 1) for i in range(36 * 12)]
    places = [(180.0, -40.0), (185.0, -45.0), (230.0, -50.0), (100.0, 0.0)]
    rows = [(m, lon, lat, rng.gauss(m.month, 1) + (m.year > 2010) * 2) for m in months for lon, lat in places]
    df = spark.createDataFrame(rows, "time date, lon double, lat double, sst double")
    got = {r.time: r for r in ind.subtropical_dipole(df, (1981, 2010)).collect()}
    assert len(got) == len(months) and all((d + dt.timedelta(1)).day == 1 for d in got)
    inside = [r.spsd for d, r in got.items() if 1981 <= d.year <= 2010]
    assert statistics.mean(inside) == pytest.approx(0, abs=1e-9) and statistics.stdev(inside) == pytest.approx(1)
    ordered = [got[d] for d in sorted(got)]
    assert ordered[0].spsd_3 is ordered[1].spsd_3 is None
    assert ordered[5].spsd_3 == pytest.approx(statistics.mean(r.spsd for r in ordered[3:6]))
    empty = ind.subtropical_dipole(df.where("lon > 200"), (1981, 2010)).first()
    assert empty.spsd is None
