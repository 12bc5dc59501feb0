"""Hand-made cubes: missing days, ties, edges, leap days."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.functions import calendar as cal
from pluvio.functions import special
from pluvio.functions import strings as st
from pluvio.operators import classify as cls
from pluvio.operators import climatology as clim
from pluvio.operators import windows as win


def cube(spark, values, first="2020-01-01", iy=0, ix=0):
    d = dt.date.fromisoformat(first)
    rows = [(iy, ix, d + dt.timedelta(i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "iy int, ix int, time date, precip double")


def test_rain_days_count_missing_as_dry(spark):
    row = win.rain_days(cube(spark, [0, 2, None, 0, 0]), "2020-01-05", 5).first()
    assert (row.wet_days, row.dry_days, row.days_since_rain) == (1, 4, 3)


def test_never_wet_gives_the_period_less_one(spark):
    assert win.rain_days(cube(spark, [0, 0, 0, 0]), "2020-01-04", 4).first().days_since_rain == 3


def test_accumulation_of_missing_days_is_zero(spark):
    assert win.accumulate(cube(spark, [None, None]), "2020-01-02", 2).first().precip == 0.0


def test_running_sum_needs_a_full_window(spark):
    rows = win.running_sums(cube(spark, [1, 2, None, 4, 5, 6]), (2,)).orderBy("time").collect()
    assert [r.sum_2d for r in rows] == [None, 3.0, None, None, 9.0, 11.0]


def test_construct_pads_the_ends(spark):
    rows = win.construct(cube(spark, [1, 2, 3]), 1).orderBy("time", "buffer").collect()
    assert [r.precip for r in rows] == [None, 1.0, 2.0, 1.0, 2.0, 3.0, 2.0, 3.0, None]


def test_percentile_score_is_weak(spark):
    values = spark.createDataFrame([(0, 0, 2.0)], "iy int, ix int, precip double")
    history = spark.createDataFrame([(0, 0, float(v)) for v in (1, 2, 2, 5)], "iy int, ix int, clim double")
    row = cls.scores(values, history, ["iy", "ix"]).first()
    assert row.pctscore == 75.0 and row.anomaly == -0.5


def test_digitize_has_edges_in_the_upper_class_and_keeps_null(spark):
    df = spark.createDataFrame([(9.9,), (10.0,), (20.0,), (25.0,), (None,)], "x double")
    got = [r[0] for r in df.select(cls.digitize(F.col("x"), F.array(F.lit(10.0), F.lit(20.0)))).collect()]
    assert got == [1, 2, 3, 3, None]


def test_quantiles_are_null_with_a_missing_value(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "precip double")
    row = df.agg(clim.quantiles("precip", [0.5], skipna=False).alias("a"), clim.quantiles("precip", [0.5]).alias("b")).first()
    assert row.a is None and row.b == [1.0]


def test_day_of_year_modes(spark):
    df = spark.createDataFrame([("2020-01-01",), ("2020-03-01",), ("2019-03-01",)], "d string").select(F.to_date("d").alias("d"))
    rows = df.select(cal.doy(F.col("d")).alias("a"), cal.doy(F.col("d"), "correct").alias("b")).collect()
    assert [(r.a, r.b) for r in rows] == [(0, 1), (60, 60), (60, 60)]
    with pytest.raises(ValueError):
        cal.doy(F.col("d"), "other")


def test_window_days_cross_the_year_and_mend_29_february(spark):
    df = spark.createDataFrame([("2020-01-01",), ("2020-02-29",)], "d string").select(F.to_date("d").alias("time"))
    rows = cal.around_days(df, 2, (2018, 2020)).collect()
    assert len(rows) == 30
    days = {r.day for r in rows if r.time == dt.date(2020, 1, 1)}
    assert dt.date(2017, 12, 30) in days and dt.date(2020, 1, 3) in days
    assert dt.date(2019, 2, 28) in {r.day for r in rows}


def test_file_names(spark):
    df = spark.createDataFrame([("x.v06.2020.02.29.nc", "dir/2020060.nc"), ("x.nc", "2020.nc")], "a string, b string")
    rows = df.select(st.date_from_dotted(F.col("a")).alias("a"), st.date_from_day_number(F.col("b")).alias("b")).collect()
    assert rows[0].a == rows[0].b == dt.date(2020, 2, 29) and rows[1].a is None and rows[1].b is None


def test_gamma_and_normal_functions():
    assert np.allclose(special.gamma_cdf(np.array([1.0, 2.0]), 1.0, 1.0), 1 - np.exp([-1.0, -2.0]), atol=1e-12)
    p = np.array([1e-6, 0.01, 0.3, 0.5, 0.7, 0.99, 1 - 1e-6])
    x = special.normal_quantile(p)
    assert np.allclose(x, -x[::-1], atol=1e-7) and abs(x[5] - 2.3263478740408408) < 1e-9
    q = special.gamma_quantile(np.array([0.1, 0.5, 0.9]), 2.5, 3.0)
    assert np.allclose(special.gamma_cdf(q, 2.5, 3.0), [0.1, 0.5, 0.9], atol=1e-10)
    assert special.normal_quantile(np.array([0.0]))[0] == -np.inf


def test_spi_without_rain(spark):
    df = spark.createDataFrame([(0.0, 2.0, 1.0), (None, 2.0, 1.0), (2.0, None, 1.0)], "x double, a double, b double")
    rows = [r[0] for r in df.select(special.spi("x", "a", "b")).collect()]
    assert rows == [float("-inf"), None, None]


def test_gamma_parameters_of_equal_values_are_null(spark):
    row = clim.gamma_fit(cube(spark, [3, 3, 3]), ["iy", "ix"]).first()
    assert row.alpha is None and row.beta is None


def test_detrending_leaves_nothing_of_a_line(spark):
    df = spark.createDataFrame([(1, float(i), 2.0 + 3 * i) for i in range(6)], "k int, x double, y double")
    rows = df.select(clim.detrended("y", "x", ["k"]).alias("r")).collect()
    assert all(abs(r.r) < 1e-9 for r in rows)
