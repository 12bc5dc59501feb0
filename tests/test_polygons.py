"""Rings: cuts, splits, dissolved pieces and overlays, against grids and counts."""

import itertools
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from pluvio.operators import grid as g
from pluvio.operators import polygons as p
from pluvio.sources import steps

SCHEMA = "region string, ring array<struct<lon:double,lat:double>>"


def area(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in itertools.pairwise(ring)) / 2


def star(rng, x, y, points=9, least=0.3):
    """A concave ring around a point that does not cross itself."""
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(points))
    ring = [(x + r * math.cos(a), y + r * math.sin(a)) for a in turns for r in [rng.uniform(least, 3)]]
    return [*ring, ring[0]]


def holds(rings, x, y):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in itertools.pairwise(ring):
            if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
                odd = not odd
    return odd


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def points(row):
    return [(q["lon"], q["lat"]) for q in row["ring"]]


def test_overlays_hold_the_points_that_both_hold(spark):
    rng = random.Random(5)
    first = [(f"a{i}", star(rng, rng.uniform(-2, 2), rng.uniform(-2, 2))) for i in range(6)]
    second = [(f"b{i}", star(rng, rng.uniform(-2, 2), rng.uniform(-2, 2), 14)) for i in range(6)]
    # A hole is a further ring of its region.
    second.append(("b0", [(-0.1, -0.1), (0.1, -0.1), (0.0, 0.15), (-0.1, -0.1)]))
    got = {}
    for row in p.overlay_rings(frame(spark, first), frame(spark, second), band=1.5).collect():
        assert row["area"] == pytest.approx(area(points(row)), abs=1e-9)
        got.setdefault((row["region"], row["other"]), []).append(points(row))
    of = lambda rows, k: [r for n, r in rows if n == k]
    for a, b in itertools.product({n for n, _ in first}, {n for n, _ in second}):
        rings = got.get((a, b), [])
        for _ in range(300):
            x, y = rng.uniform(-5, 5), rng.uniform(-5, 5)
            assert holds(rings, x, y) == (holds(of(first, a), x, y) and holds(of(second, b), x, y)), (a, b, x, y)


def test_overlays_of_like_touching_and_enclosed_rings(spark):
    square = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]
    first = frame(spark, [("a", square(0.0, 0.0, 4.0)), ("empty", []), ("none", None)])
    second = frame(spark, [("same", square(0.0, 0.0, 4.0)), ("beside", square(4.0, 0.0, 4.0)), ("within", square(1.0, 1.0, 2.0)), ("holed", square(-1.0, -1.0, 8.0)), ("holed", square(1.0, 1.0, 1.0))])
    got = {}
    for row in p.overlay_rings(first, second, band=3.0).collect():
        got.setdefault((row["region"], row["other"]), []).append((row["area"], len(row["ring"])))
    assert {k: sorted(v) for k, v in got.items()} == {("a", "same"): [(16.0, 5)], ("a", "within"): [(4.0, 5)], ("a", "holed"): [(-1.0, 5), (16.0, 5)]}
    assert p.overlay_rings(first.limit(0), second).count() == 0


def test_crossings_beside_a_vertex(spark):
    """A corner that lies on the other's edge, but for the last digit of a double."""
    dart = [(182.0, -19.4), (178.39999999999998, -17.959999999999997), (179.66, -19.4), (178.39999999999998, -20.84), (182.0, -19.4)]
    box = [(170.0, -22.0), (182.0, -22.0), (182.0, -13.0), (170.0, -13.0), (170.0, -22.0)]
    (row,) = p.overlay_rings(frame(spark, [("a", dart)]), frame(spark, [("b", box)])).collect()
    assert row["area"] == pytest.approx(area(dart), abs=1e-7)


def test_outlines_of_random_pixels(spark):
    rng = random.Random(8)
    cells = [(k, float(x), float(y)) for k in range(5) for x in range(12) for y in range(12) if rng.random() < 0.6]
    df = spark.createDataFrame(cells, "k int, x double, y double").select("k", g.corners(F.col("x"), F.col("y"), 1.0).alias("ring"))
    rows = p.dissolved(df, ["k"]).collect()
    for k in range(5):
        own = {(x, y) for j, x, y in cells if j == k}
        rings = [points(r) for r in rows if r["k"] == k]
        assert sum(r["area"] for r in rows if r["k"] == k) == len(own)
        for x, y in itertools.product(range(-1, 13), range(-1, 13)):
            assert holds(rings, x + 1e-3, y + 1e-3) == ((x, y) in own)
        for ring in rings:
            edges = list(itertools.pairwise(ring))
            assert all((a[0] == b[0]) != (a[1] == b[1]) for a, b in edges), "edges along the axes"
            assert all((a[0] == b[0]) != (c[0] == d[0]) for (a, b), (c, d) in itertools.pairwise([*edges, edges[0]])), "corners only"


def test_pieces_of_other_sizes_and_senses_dissolve(spark):
    pieces = [("k", [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]), ("k", [(2.0, 0.0), (2.0, 1.0), (3.0, 1.0), (3.0, 0.0), (2.0, 0.0)]), ("k", [(0.0, 2.0), (2.0, 2.0), (1.0, 3.0), (0.0, 2.0)]), ("k", None), ("k", [])]
    (row,) = p.dissolved(frame(spark, pieces), ["region"]).collect()
    assert row["area"] == 6.0
    assert set(points(row)) == {(0.0, 0.0), (3.0, 0.0), (3.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 3.0), (0.0, 2.0)}


def test_rings_split_at_the_antimeridian(spark):
    rng = random.Random(2)
    whole = [(f"r{i}", star(rng, rng.uniform(178, 182), 0.0)) for i in range(20)] + [("west", star(rng, 170.0, 0.0)), ("none", None), ("empty", [])]
    rows = p.split_at_meridian(frame(spark, whole)).collect()
    assert {r["region"] for r in rows} == {n for n, ring in whole if ring}
    for name, ring in whole:
        parts = [r for r in rows if r["region"] == name]
        if not ring:
            continue
        assert sum(area(points(r)) for r in parts) == pytest.approx(area(ring), abs=1e-9)
        for r in parts:
            assert all(-180 <= x <= 180 for x, _ in points(r))
    assert [r["part"] for r in rows if r["region"] == "west"] == ["west"]
    # A concave ring that falls apart is one ring with edges along the seam until it is dissolved.
    fork = [(178.0, 0.0), (184.0, 0.0), (184.0, 1.0), (179.0, 1.5), (184.0, 2.0), (184.0, 3.0), (178.0, 3.0), (178.0, 0.0)]
    east = p.split_at_meridian(frame(spark, [("fork", fork)])).where("part = 'east'")
    apart = p.dissolved(east, ["region"]).collect()
    assert len(apart) == 2 and sum(r["area"] for r in apart) == pytest.approx(area(points(east.first())))


def test_a_cut_takes_time_in_proportion_to_the_ring(spark):
    """Each step of a cut is computed once, not anew for every edge."""
    n = 1500
    angles = [2 * math.pi * i / n for i in range(n)]
    ring = [(180.5 + math.cos(a), math.sin(a)) for a in angles]
    ring.append(ring[0])
    start = time.monotonic()
    rows = p.split_at_meridian(frame(spark, [("round", ring)])).select("part", p.signed_area(F.col("ring")).alias("area")).collect()
    assert time.monotonic() - start < 20
    assert {r["part"] for r in rows} == {"west", "east"}
    assert sum(r["area"] for r in rows) == pytest.approx(area(ring), abs=1e-9)


def test_the_rows_of_a_task_do_not_grow_with_the_input(spark, monkeypatch):
    many = spark.range(1000)
    dealt = steps.dealer(many, 20)(many, "id")
    assert dealt.rdd.getNumPartitions() == 50 and dealt.count() == 1000
    assert steps.dealer(many, 250)(many, "id") is many
    counted = []
    monkeypatch.setattr(p, "dealer", lambda df, rows: counted.append(df.count()) or steps.dealer(df, rows))
    monkeypatch.setattr(p, "ROWS", 4)
    square = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]
    first = frame(spark, [(f"a{i}", square(i * 3.0, 0.5, 2.0)) for i in range(20)])
    rows = p.overlay_rings(first, frame(spark, [("b", square(0.0, 0.0, 100.0))])).collect()
    assert len(rows) == 20 and all(r["area"] == pytest.approx(4.0) for r in rows)
    assert len(counted) == 4 and min(counted) > 4, "polygons, edges in bands, pieces, edges of outlines"
