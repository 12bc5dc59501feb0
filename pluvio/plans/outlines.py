"""Polygons as rings: overlays, outlines of classes, rings across the antimeridian."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pluvio.operators import grid as g
from pluvio.operators import polygons as p
from pluvio.sources import tables as t

from ._registry import query

#: Moves areas off rounding ties.
_OFF_TIES = 1e-9
#: The same for four digits of areas whose corners have nine.
_OFF_COARSE_TIES = 3.1e-6

# Corners of a dart, by its size, from the tip and turning left; the third is a notch.
DART = [(1.0, 0.0), (-1.0, 0.8), (-0.3, 0.0), (-1.0, -0.8)]


def darts(spark, sf_dir):
    """(region, ring): a concave ring for each customer around its nation's cell, as large as its balance says."""
    c = t.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("k"), F.col("c_acctbal").cast("double").alias("balance"))
    # A small file is read by one task, but each of its rows is much work.
    c = c.repartition("c_custkey")
    at = c.join(t.cells(spark, sf_dir).select("k", "lon", "lat"), "k")
    lon, lat = F.col("lon") + (F.col("c_custkey") % 11 - 5) / 10.0, F.col("lat") + (F.col("c_custkey") % 13 - 6) / 10.0
    size = F.floor(F.abs("balance")) % 40 / 10.0 + 1
    ring = F.array(*[F.struct((lon + x * size).alias("lon"), (lat + y * size).alias("lat")) for x, y in [*DART, DART[0]]])
    return at.select(F.col("c_custkey").alias("region"), ring.alias("ring"))


_DARTS = f"""c AS (SELECT c_custkey AS id, lon + (c_custkey % 11 - 5) / 10.0::DOUBLE AS x, lat + (c_custkey % 13 - 6) / 10.0::DOUBLE AS y, CAST(floor(abs(CAST(c_acctbal AS DOUBLE))) AS BIGINT) % 40 / 10.0::DOUBLE + 1 AS r FROM customer JOIN cells ON k = c_nationkey),
side(ax, ay, bx, "by") AS (VALUES {", ".join(f"({a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for a, b in zip(DART, [*DART[1:], DART[0]], strict=True))}),
e AS (SELECT id, x + ax * r AS x1, y + ay * r AS y1, x + bx * r AS x2, y + "by" * r AS y2 FROM c CROSS JOIN side)"""
# What an edge adds to the area that its ring has in common with a rectangle a..b by c..d: the integral of the edge's height
# above c, no more than d - c, over the rectangle's width.
_HEIGHT = "CASE WHEN {y} < c THEN 0 WHEN {y} < d THEN ({y} - c) * ({y} - c) / 2 ELSE (d - c) * (d - c) / 2 + (d - c) * ({y} - d) END"
_CLIPPED = f"""part AS (SELECT *, (y2 - y1) / (x2 - x1) AS m, greatest(least(x1, x2), a) AS xa, least(greatest(x1, x2), b) AS xb FROM e CROSS JOIN rect),
high AS (SELECT *, y1 + (xa - x1) * m AS ya, y1 + (xb - x1) * m AS yb FROM part WHERE xa < xb),
area AS (SELECT id, name, sum(sign(x1 - x2) * (({_HEIGHT.format(y="yb")}) - ({_HEIGHT.format(y="ya")})) / m) AS area FROM high GROUP BY id, name)"""


@query(f"""WITH {t.SQL_CELLS}, {_DARTS}, rect(name, a, b, c, d) AS (VALUES ('Box', 158.0::DOUBLE, 172.0::DOUBLE, -22.0::DOUBLE, -8.0::DOUBLE), ('Ell', 158, 182, -22, -13), ('Ell', 158, 168, -13, 2)),
{_CLIPPED} SELECT id, name AS other, round(area + {_OFF_COARSE_TIES}, 4) AS area FROM area WHERE area > 1e-6""")
def jn14_overlay_rings(spark, sf_dir):
    """The common area of every customer's dart and each region, from the rings of the overlay."""
    common = p.overlay_rings(darts(spark, sf_dir), t.polygons(spark))
    area = common.groupBy(F.col("region").alias("id"), "other").agg(F.sum("area").alias("area")).where("area > 1e-6")
    return area.select("id", "other", F.round(F.col("area") + _OFF_COARSE_TIES, 4).alias("area"))


@query(f"""WITH {t.SQL_CELLS}, {_DARTS}, rect(name, a, b, c, d) AS (VALUES ('west', -1000.0::DOUBLE, 180.0::DOUBLE, -90.0::DOUBLE, 90.0::DOUBLE), ('east', 180, 1000, -90, 90)),
{_CLIPPED}, box AS (SELECT id, min(x1) AS lo, max(x1) AS hi FROM e GROUP BY id)
SELECT id, name AS part, round(area + {_OFF_TIES}, 6) AS area, round(CASE WHEN name = 'west' THEN lo ELSE greatest(lo, 180) - 360 END, 6) AS lon_min, round(CASE WHEN name = 'west' THEN least(hi, 180) ELSE hi - 360 END, 6) AS lon_max
FROM area JOIN box USING (id) WHERE area > 1e-9""")
def geo7_split_rings(spark, sf_dir):
    """Every customer's dart, split where it crosses the antimeridian."""
    parts = p.split_at_meridian(darts(spark, sf_dir))
    b = g.bounds(F.col("ring"))
    told = parts.select(F.col("region").alias("id"), "part", p.signed_area(F.col("ring")).alias("area"), b["lon_min"].alias("lon_min"), b["lon_max"].alias("lon_max")).where("area > 1e-9")
    return told.select("id", "part", F.round(F.col("area") + _OFF_TIES, 6).alias("area"), *[F.round(c, 6).alias(c) for c in ("lon_min", "lon_max")])


@query(f"""WITH {t.SQL_MONTHLY}, s AS (SELECT time, iy, ix, precip > avg(precip) OVER (PARTITION BY iy, ix) AS wet FROM monthly),
corner AS (SELECT time, wet, iy, ix, unnest([iy, iy, iy + 1, iy + 1]) AS cy, unnest([ix, ix + 1, ix, ix + 1]) AS cx FROM s),
met AS (SELECT time, wet, cy, cx, count(*) AS n, sum((iy + ix) % 2) AS odd FROM corner GROUP BY time, wet, cy, cx),
turn AS (SELECT time, wet, sum(CASE WHEN n = 1 THEN 1 WHEN n = 2 AND odd <> 1 THEN 2 ELSE 0 END) AS convex, count(*) FILTER (n = 3) AS concave FROM met GROUP BY time, wet),
edge AS (SELECT time, wet, unnest([('h', iy, ix), ('h', iy + 1, ix), ('v', iy, ix), ('v', iy, ix + 1)]) AS e FROM s), once AS (SELECT time, wet, e FROM edge GROUP BY ALL HAVING count(*) = 1),
length AS (SELECT time, wet, count(*) * 5.0::DOUBLE AS perimeter FROM once GROUP BY time, wet), area AS (SELECT time, wet, count(*) * 25.0::DOUBLE AS area FROM s GROUP BY time, wet)
SELECT time, wet, area, perimeter, CAST(convex + concave AS BIGINT) AS corners, CAST((convex - concave) // 4 AS BIGINT) AS outlines_less_holes FROM area JOIN length USING (time, wet) JOIN turn USING (time, wet)""")
def geo8_class_outlines(spark, sf_dir):
    """The outlines of each month's wetter and drier cells, dissolved from pixels: area, length, corners, outlines less holes."""
    wet = F.col("precip") > F.avg("precip").over(Window.partitionBy("iy", "ix"))
    monthly = t.obs_monthly(spark, sf_dir).withColumn("wet", wet)
    pixels = monthly.join(t.cells(spark, sf_dir).select("iy", "ix", "lon", "lat"), ["iy", "ix"]).select("time", "wet", g.corners(F.col("lon"), F.col("lat"), 5.0).alias("ring"))
    out = p.dissolved(pixels, ["time", "wet"])
    return out.groupBy("time", "wet").agg(
        F.sum("area").alias("area"), F.sum(p.ring_length(F.col("ring"))).alias("perimeter"), F.sum(F.size("ring") - 1).alias("corners"), F.sum(F.signum("area")).cast("long").alias("outlines_less_holes")
    )
