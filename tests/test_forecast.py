"""Categories, probabilities, rounding, outlooks and scores on hand-made tables."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as s
from pyspark.sql import functions as F

from pluvio.operators import forecast as fc
from pluvio.operators import tables as tab
from pluvio.operators import verify as ver


def probs(spark, values):
    return spark.createDataFrame([(1, k + 1, float(v)) for k, v in enumerate(values)], "k int, category int, prob double")


def test_missing_members_stay_in_the_denominator(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 3), (1, None)], "k int, category int")
    rows = fc.probabilities(df, ["k"], 3).orderBy("category").collect()
    assert [r.prob for r in rows] == [50.0, 0.0, 25.0]


def test_unknown_number_of_categories(spark):
    with pytest.raises(ValueError):
        fc.probabilities(probs(spark, [1]), ["k"], 5)


def test_most_likely_is_the_first_on_ties(spark):
    assert probs(spark, [40, 40, 20]).groupBy("k").agg(fc.most_likely().alias("c")).first().c == 1


def test_largest_remainder(spark):
    rows = fc.rounded_to_100(probs(spark, [33.3, 33.3, 33.4]), ["k"]).orderBy("category").collect()
    assert [r.rounded for r in rows] == [33.0, 33.0, 34.0]


@settings(max_examples=8, deadline=None)
@given(s.lists(s.integers(1, 1000), min_size=1, max_size=12))
def test_rounded_shares_add_up(spark, values):
    total = fc.rounded_to_100(probs(spark, values), ["k"], digits=1).agg(F.sum("rounded")).first()[0]
    assert abs(total - 100) < 1e-9


def test_outlook_rules(spark):
    grid = [(20, 60, 40, 1), (30, 60, 40, 2), (20, 40, 60, 3), (20, 50, 50, 3), (60, 90, 10, None)]
    df = spark.createDataFrame([tuple(map(float, x[:3])) for x in grid], "s double, b double, a double")
    assert [r[0] for r in df.select(fc.outlook(F.col("s"), F.col("b"), F.col("a"))).collect()] == [x[3] for x in grid]


def test_contingency_adds_up_and_scores(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 2), (None, 1)], "f int, o int").withColumn("k", F.lit(0))
    c = ver.contingency(df, ["k"], 1).withColumns(ver.scores()).first()
    assert (c.tp, c.fp, c.fn, c.tn) == (1, 1, 2, 1) and c.precision == 0.5 and abs(c.iou - 0.25) < 1e-12


def test_confusion_has_zero_cells(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (3, 1)], "f int, o int")
    assert [tuple(r) for r in ver.confusion(df, 3).orderBy("f").collect()] == [(1, 2, 0, 0), (2, 0, 0, 0), (3, 1, 0, 0)]


def test_heidke_of_a_perfect_and_a_constant_forecast(spark):
    df = spark.createDataFrame([("p", 1, 1), ("p", 2, 2), ("c", 1, 1), ("c", 1, 2)], "k string, f int, o int")
    got = {r.k: r.hss for r in ver.heidke(df, ["k"], 2).collect()}
    assert got == {"p": 1.0, "c": 0.0}


def test_wide_and_long_are_inverse(spark):
    df = spark.createDataFrame([(1, 1, 1, 10.0), (1, 1, 2, 90.0)], "k int, step int, category int, prob double")
    back = tab.long(tab.wide(df, ["k"], [1], [1, 2]), ["k"], [1], [1, 2])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
