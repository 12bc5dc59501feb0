"""Distances to outlines, buffered masks, refined grids and zonal means by shares."""

import math
import random

import pytest
from pyspark.sql import functions as F

from pluvio.operators import coast
from pluvio.operators import grid as g

RING = "region string, ring array<struct<lon:double,lat:double>>"
SHAPES = [
    ("L", [(0.0, 0.0), (4.0, 0.0), (4.0, 1.0), (1.0, 1.0), (1.0, 4.0), (0.0, 4.0), (0.0, 0.0)]),
    ("slope", [(-3.0, -20.0), (9.0, 3.0), (9.5, 3.0), (-3.0, -20.0)]),
    ("two", [(20.0, 0.0), (21.0, 0.0), (21.0, 1.0), (20.0, 0.0)]),
    ("two", [(23.0, 0.0), (24.0, 0.0), (24.0, 1.0), (23.0, 0.0)]),
    ("point", [(2.0, 2.0), (2.0, 2.0)]),
]


def plane(lon, lat):
    return math.radians(lon) * 6378137, 6378137 * math.log(math.tan(math.pi / 4 + math.radians(lat) / 2))


def away(p, ring):
    """By a fine walk along each edge, then exactly near its best step."""
    best, (x, y) = math.inf, plane(*p)
    for a, b in zip(ring, ring[1:], strict=False):
        (x1, y1), (x2, y2) = plane(*a), plane(*b)
        at = lambda t: math.hypot(x1 + t * (x2 - x1) - x, y1 + t * (y2 - y1) - y)  # noqa: E731, B023
        low, high = 0.0, 1.0
        for _ in range(200):
            m, n = low + (high - low) / 3, high - (high - low) / 3
            low, high = (low, n) if at(m) <= at(n) else (m, high)
        best = min(best, at(low)) if (x1, y1) != (x2, y2) else best
    return best / 1000


def test_cells_near_an_outline(spark):
    rng = random.Random(1)
    cells = [(i, 0, rng.uniform(-22, 6), rng.uniform(-5, 26)) for i in range(600)] + [(600, 0, 90.0, 0.0), (601, 0, 0.0, 0.0)]
    df, shapes = spark.createDataFrame(cells, "iy int, ix int, lat double, lon double"), spark.createDataFrame(SHAPES, RING)
    for km in (15.0, 300.0):
        got = {(r.region, r.iy): r.distance_km for r in coast.near_outline(df, shapes, km).collect()}
        want = {}
        for region, ring in SHAPES:
            for i, _, lat, lon in cells:
                if abs(lat) < 90 and (d := away((lon, lat), ring)) <= km:
                    want[region, i] = min(d, want.get((region, i), math.inf))
        assert got.keys() == want.keys() and len(got) > 5
        for key, d in want.items():
            assert got[key] == pytest.approx(d, abs=1e-3)
    with pytest.raises(ValueError):
        coast.near_outline(df, shapes, 0)
    assert coast.near_outline(df.limit(0), shapes, 10.0).count() == coast.near_outline(df, shapes.limit(0), 10.0).count() == 0


def test_inside_and_near_are_one_mask(spark):
    cells = coast.refined_cells(spark, g.target_axis([-2.0, 6.0], 9), g.target_axis([-2.0, 6.0], 9))
    shapes = spark.createDataFrame(SHAPES[:1], RING)
    got = {(r.iy, r.ix): r.inside for r in coast.buffered_mask(cells, shapes, 25.0).collect()}
    own = {(r.iy, r.ix) for r in g.mask(cells, shapes).collect()}
    near = {(r.iy, r.ix) for r in coast.near_outline(cells, shapes, 25.0).collect()}
    assert got.keys() == own | near and {k for k, v in got.items() if v} == own and near - own and own - near
    box = {(r.iy, r.ix) for r in coast.around(cells, shapes, 1.0).collect()}
    assert box == {(r.iy, r.ix) for r in cells.collect() if -1 <= r.lat <= 5 and -1 <= r.lon <= 5} and own < box
    two = coast.around(cells.withColumn("lon", F.col("lon") + 20), spark.createDataFrame(SHAPES[2:4], RING), 0.5)
    assert {r.region for r in two.collect()} == {"two"} and two.count() == two.distinct().count()


@pytest.mark.parametrize("factor", [2, 5])
def test_means_by_shares_are_those_of_refined_cells(spark, factor):
    rng = random.Random(2)
    axis = [0.0, 1.0, 2.0, 3.0, 4.0]
    fine = g.target_axis(axis, factor), g.target_axis(axis, factor)
    rows = [(t, y, x, rng.random()) for t in range(3) for y in range(5) for x in range(5)]
    cube = spark.createDataFrame(rows, "t int, iy int, ix int, precip double")
    cells = coast.refined_cells(spark, *fine)
    masked = coast.buffered_mask(cells, spark.createDataFrame([SHAPES[0], ("tri", [(1.5, 2.0), (4.0, 2.0), (4.0, 4.0), (1.5, 2.0)])], RING), 30.0)
    refined = g.regrid(cube, *fine, ["t"]).join(masked.select("region", F.col("iy").alias("jy"), F.col("ix").alias("jx")), ["jy", "jx"])
    want = {(r.region, r.t): r.m for r in refined.groupBy("region", "t").agg(F.avg("precip").alias("m")).collect()}
    shares = coast.cell_shares(masked, *fine)
    got = {(r.region, r.t): r for r in coast.weighted_zonal_mean(cube, shares, ["t"]).collect()}
    assert got.keys() == want.keys() and {r for r, _ in want} == {"L", "tri"}
    for key, mean in want.items():
        assert got[key].precip == pytest.approx(mean) and got[key].covered == pytest.approx(1.0)
    total = {r.region: r.w for r in shares.groupBy("region").agg(F.sum("weight").alias("w")).collect()}
    assert total == pytest.approx({r.region: r["count"] for r in masked.groupBy("region").count().collect()})


def test_missing_values_leave_their_share_to_others(spark):
    shares = spark.createDataFrame([("r", 0, 0, 3.0), ("r", 0, 1, 1.0)], "region string, iy int, ix int, weight double")
    cube = spark.createDataFrame([(0, 0, 0, 2.0), (0, 0, 1, 6.0), (1, 0, 0, None), (1, 0, 1, 6.0), (2, 0, 0, None), (2, 0, 1, None), (3, 0, 0, 1.0)], "t int, iy int, ix int, precip double")
    got = {r.t: (r.precip, r.covered) for r in coast.weighted_zonal_mean(cube, shares, ["t"]).collect()}
    assert got == {0: (3.0, 1.0), 1: (6.0, 0.25), 2: (None, 0.0), 3: (1.0, 0.75)}
