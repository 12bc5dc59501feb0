"""Masks, regridding and infilling on small grids."""

from pyspark.sql import functions as F

from pluvio.operators import grid as g


def grid(spark, values):
    rows = [(0, y, x, v) for y, line in enumerate(values) for x, v in enumerate(line)]
    return spark.createDataFrame(rows, "t int, iy int, ix int, precip double")


def test_bilinear_values_and_missing_corners(spark):
    axis = g.target_axis([0.0, 1.0], 2)
    out = g.regrid(grid(spark, [[0.0, 1.0], [2.0, 3.0]]), axis, axis, ["t"]).orderBy("jy", "jx").collect()
    assert [round(r.precip, 6) for r in out[:4]] == [0.0, 0.333333, 0.666667, 1.0] and abs(out[5].precip - 1.0) < 1e-9
    lost = {(r.jy, r.jx): r.precip for r in g.regrid(grid(spark, [[0.0, 1.0], [2.0, None]]), axis, axis, ["t"]).collect()}
    assert lost[0, 0] == 0.0 and lost[1, 1] is None and abs(lost[0, 3] - 1.0) < 1e-9 and lost[3, 3] is None


def test_unit_axis_ends_like_a_half_open_range():
    assert [p[0] for p in g.unit_axis([0.0, 2.0, 4.0])] == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert g.unit_axis([0.0, 2.5])[-1][1] == -1 or g.unit_axis([0.0, 2.5])[-1][0] <= 2.5


def test_points_in_a_concave_polygon(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 1.0), (1.0, 1.0), (1.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    polygons = spark.createDataFrame([("L", ring)], "region string, ring array<struct<lon:double,lat:double>>")
    cells = spark.createDataFrame([(0, 0, 0.5, 0.5), (0, 3, 0.5, 3.5), (3, 0, 3.5, 0.5), (3, 3, 3.5, 3.5)], "iy int, ix int, lat double, lon double")
    assert sorted((r.iy, r.ix) for r in g.mask(cells, polygons).collect()) == [(0, 0), (0, 3), (3, 0)]


def test_infilling_takes_the_nearest_and_leaves_empty_slices(spark):
    df = grid(spark, [[1.0, None, None, None, 5.0]]).unionByName(spark.createDataFrame([(1, 0, 0, None)], "t int, iy int, ix int, precip double"))
    got = {(r.t, r.ix): r.precip for r in g.fill_nearest(df, ["t"], reach=1).collect()}
    assert [got[0, i] for i in range(5)] == [1.0, 1.0, 1.0, 5.0, 5.0] and got[1, 0] is None


def test_haversine_of_a_quarter(spark):
    km = spark.range(1).select(g.haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0))).first()[0]
    assert abs(km - 6372.8 * 3.141592653589793 / 2) < 1e-6
