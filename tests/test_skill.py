"""Anomaly correlation: merged moments and alignments against plain sums."""

import datetime as dt
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.operators import skill as sk

PAIR = "gcm string, init date, step int, iy int, f double, o double"


def pairs(seed=1, years=6):
    rng = random.Random(seed)
    rows = []
    for gcm in "AB":
        for month in range(years * 12):
            for step in (1, 2, 3):
                for iy in range(4):
                    if rng.random() < 0.85:
                        f, o = rng.gauss(1e6, 1), rng.gauss(1e6, 1)
                        rows.append((gcm, dt.date(2000 + month // 12, month % 12 + 1, 1), step, iy, None if rng.random() < 0.05 else f, None if rng.random() < 0.05 else o))
    return rows


def plain(values):
    f, o = np.array(values).T
    return len(f), np.corrcoef(f, o)[0, 1] if len(f) > 2 else None, np.sqrt(((f - o) ** 2).mean()), f.mean() - o.mean()


def test_pooled_moments_are_those_of_the_rows(spark):
    """Values far from zero, so that moments that are not centred would lose their digits."""
    rows = pairs()
    df = spark.createDataFrame(rows, PAIR)
    got = {(r.gcm, r.step, r.dims, r.iy, r.init): r for r in sk.skill(df, ["gcm", "step"], ["iy"]).collect()}
    groups = defaultdict(list)
    for gcm, init, step, iy, f, o in rows:
        if f is not None and o is not None:
            for key in ((gcm, step, "init", iy, None), (gcm, step, "cell", None, init), (gcm, step, "init,cell", None, None)):
                groups[key].append((f, o))
    assert got.keys() == groups.keys()
    for key, values in groups.items():
        n, acc, rmse, bias = plain(values)
        r = got[key]
        assert r.n == n and r.rmse == pytest.approx(rmse) and r.bias == pytest.approx(bias, abs=1e-6)
        if acc is not None:
            f, o = np.array(values).T
            assert r.acc == pytest.approx(acc, abs=1e-7) and r.slope == pytest.approx(acc * o.std() / f.std(), abs=1e-6)
            assert r.msss == pytest.approx(1 - rmse**2 / o.var(), rel=1e-6)
        if n == 1:
            assert r.acc is None and r.slope is None and r.msss is None


def test_alignments(spark):
    rows = [r for r in pairs(2) if r[3] == 0]
    df = spark.createDataFrame(rows, PAIR)
    steps = {g: {r[2] for r in rows if r[0] == g} for g in "AB"}
    valid = lambda r: (r[1].year * 12 + r[1].month - 1 + r[2])
    for how, month in (("same_inits", lambda r: r[1]), ("same_verif", valid)):
        leads = defaultdict(set)
        for r in rows:
            leads[r[0], month(r)].add(r[2])
        want = [r[:3] for r in rows if leads[r[0], month(r)] == steps[r[0]]]
        got = sk.aligned(df, how, ["gcm"])
        assert sorted(tuple(r)[:3] for r in got.collect()) == sorted(want) and 0 < len(want) < len(rows)
        assert got.columns == df.columns
    both = sk.aligned(df.drop("gcm"), "same_inits", [])
    kept = {r.init for r in both.collect()}
    assert kept == {i for i in {r[1] for r in rows} if {r[2] for r in rows if r[1] == i} == {1, 2, 3}}
    assert sk.aligned(df, "maximize", ["gcm"]).count() == len(rows)
    with pytest.raises(ValueError):
        sk.aligned(df, "other", ["gcm"])


def test_multi_model_mean_and_empty_tables(spark):
    rows = [("A", dt.date(2000, 1, 1), 1, 0, 1.0, 5.0), ("B", dt.date(2000, 1, 1), 1, 0, 3.0, 5.0), ("A", dt.date(2000, 2, 1), 1, 0, None, 5.0)]
    df = spark.createDataFrame(rows, PAIR)
    got = {(r.gcm, r.init.month): (r.f, r.o) for r in sk.with_multi_model(df, ["init", "step", "iy"]).collect()}
    assert got["MME", 1] == (2.0, 5.0) and got["MME", 2] == (None, 5.0) and len(got) == 5
    none = df.where(F.lit(False))
    assert sk.skill(none, ["gcm"], ["iy"]).count() == sk.aligned(none, "same_verif", ["gcm"]).count() == 0
