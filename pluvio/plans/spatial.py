"""Grids and places: selections by box, masks, stations, distances, areas and regridding."""

from __future__ import annotations

from pyspark.sql import functions as F

from pluvio.operators import coast
from pluvio.operators import grid as g
from pluvio.operators import selection as sel
from pluvio.sources import tables as t

from ._registry import query

BOX = (165.0, 180.0, -15.0, 0.0)


def _monthly(spark, sf_dir):
    return t.obs_monthly(spark, sf_dir).join(t.cells(spark, sf_dir).select("iy", "ix", "lat", "lon"), ["iy", "ix"])


@query(f"WITH {t.SQL_MONTHLY} SELECT iy, ix, time, precip FROM monthly JOIN cells USING (iy, ix) WHERE lon BETWEEN 165 AND 180 AND lat BETWEEN -15 AND 0 AND year(time) BETWEEN 1996 AND 1998")
def sel1_sel4_domain_box(spark, sf_dir):
    return sel.between_years(sel.domain_box(_monthly(spark, sf_dir), BOX), 1996, 1998).select("iy", "ix", "time", "precip")


@query(f"WITH {t.SQL_CELLS} SELECT min(lon) - 2.5 AS lon_min, max(lon) + 2.5 AS lon_max, min(lat) - 2.5 AS lat_min, max(lat) + 2.5 AS lat_max FROM cells")
def sel2_sel13_bounding_domain(spark, sf_dir):
    b = sel.bounding_domain(t.cells(spark, sf_dir))
    grown = sel.expand_box(tuple(F.col(c) for c in b.columns), 2.5)
    return b.select(*[c.alias(n) for c, n in zip(grown, b.columns, strict=True)])


@query(f"""WITH {t.SQL_OBS} SELECT iy, ix, time, CASE WHEN precip >= 10 THEN precip END AS heavy, CASE WHEN precip >= 10 THEN precip ELSE 0 END AS heavy_or_zero,
  CASE WHEN precip IS NOT NULL THEN least(greatest(precip, 2), 8) END AS clipped FROM obs WHERE month(time) IN (12, 1, 2) AND NOT (month(time) = 2 AND day(time) = 29)""")
def sel5_sel7_sel10_sel16_selection(spark, sf_dir):
    from pluvio.functions.calendar import drop_leap_days

    o = drop_leap_days(sel.in_months(t.obs_daily(spark, sf_dir), [12, 1, 2]))
    p = F.col("precip")
    return o.select("iy", "ix", "time", sel.masked(p, p >= 10).alias("heavy"), sel.masked(p, p >= 10, 0.0).alias("heavy_or_zero"), sel.clipped(p, 2.0, 8.0).alias("clipped"))


@query(f"WITH {t.SQL_MONTHLY} SELECT iy, ix, time, precip FROM monthly WHERE iy NOT IN (1, 3) QUALIFY row_number() OVER (PARTITION BY iy, ix ORDER BY time) > 2")
def sel6_sel9_drop_first(spark, sf_dir):
    return sel.drop_first(sel.drop_labels(t.obs_monthly(spark, sf_dir), "iy", [1, 3]), 2, ["iy", "ix"])


@query("SELECT * FROM (VALUES " + ", ".join(f"('{k}', {', '.join(f'{x}::DOUBLE' for x in v)})" for k, v in sel.DOMAINS.items()) + ") AS d(name, lon_min, lon_max, lat_min, lat_max)")
def sel8_domains(spark, sf_dir):
    return sel.domains(spark)


@query(f"WITH {t.SQL_CELLS}, d(name, a, b, c, e) AS (VALUES {', '.join(f'''('{k}', {', '.join(f'{x}::DOUBLE' for x in v)})''' for k, v in sel.DOMAINS.items())}) SELECT name, iy, ix FROM cells JOIN d ON lon BETWEEN a AND b AND lat BETWEEN c AND e")
def geo16_region_extraction(spark, sf_dir):
    """Cells of every region at once: a range join with the few regions, sent to all executors."""
    d = sel.domains(spark)
    c = t.cells(spark, sf_dir)
    return c.join(F.broadcast(d), c.lon.between(d.lon_min, d.lon_max) & c.lat.between(d.lat_min, d.lat_max)).select("name", "iy", "ix")


_RING = "ring AS (SELECT a.region, a.lon AS x1, a.lat AS y1, b.lon AS x2, b.lat AS y2 FROM edges a JOIN edges b ON a.region = b.region AND b.n = a.n + 1)"
_MASK = f"""{t.SQL_EDGES}, {_RING}, mask AS (SELECT region, iy, ix FROM (SELECT region, iy, ix, count(*) FILTER ((y1 > lat) <> (y2 > lat) AND lon < x1 + (lat - y1) * (x2 - x1) / nullif(y2 - y1, 0)) AS n
  FROM cells CROSS JOIN ring GROUP BY region, iy, ix) WHERE n % 2 = 1)"""


@query(f"WITH {t.SQL_CELLS}, {_MASK} SELECT * FROM mask")
def jn11_geo2_point_in_polygon(spark, sf_dir):
    return g.mask(t.cells(spark, sf_dir), t.polygons(spark))


@query(f"WITH {t.SQL_MONTHLY}, {_MASK} SELECT region, time, round(avg(precip), 6) AS precip, count(precip) AS cells FROM monthly JOIN mask USING (iy, ix) GROUP BY region, time")
def geo17_jn10_zonal_mean(spark, sf_dir):
    masks = g.mask(t.cells(spark, sf_dir), t.polygons(spark))
    return g.zonal_mean(t.obs_monthly(spark, sf_dir), masks, ["time"]).withColumn("precip", F.round("precip", 6))


@query(f"WITH {t.SQL_MONTHLY}, {_MASK} SELECT iy, ix, time, CASE WHEN m.iy IS NOT NULL THEN precip END AS precip FROM monthly LEFT JOIN (SELECT DISTINCT iy, ix FROM mask) m USING (iy, ix)")
def geo3_geo8_masked_cube(spark, sf_dir):
    """The union of the regions as one mask; cells outside keep their rows."""
    union = g.mask(t.cells(spark, sf_dir), t.polygons(spark)).select("iy", "ix", F.lit(1).alias("inside")).distinct()
    return t.obs_monthly(spark, sf_dir).join(union, ["iy", "ix"], "left").select("iy", "ix", "time", sel.masked(F.col("precip"), F.col("inside").isNotNull()).alias("precip"))


@query(f"WITH {t.SQL_CELLS}, {_MASK}, d(name, a, b, c, e) AS (VALUES {', '.join(f'''('{k}', {', '.join(f'{x}::DOUBLE' for x in v)})''' for k, v in sel.DOMAINS.items())}) SELECT region, name AS other, iy, ix FROM mask JOIN cells USING (iy, ix) JOIN d ON lon BETWEEN a AND b AND lat BETWEEN c AND e")
def jn14_overlay(spark, sf_dir):
    """Overlay of the polygons and the named domains, on the grid's cells."""
    domains = geo16_region_extraction(spark, sf_dir).withColumnRenamed("name", "region")
    return g.overlay(g.mask(t.cells(spark, sf_dir), t.polygons(spark)), domains)


_HAVERSINE = "2 * 6372.8 * asin(sqrt(pow(sin((radians({b}) - radians({a})) / 2), 2) + cos(radians({a})) * cos(radians({b})) * pow(sin(radians({d} - {c}) / 2), 2)))"
_NEAR = f"""{t.SQL_STATIONS}, ny AS (SELECT station_name, arg_min((grid_lat, iy), (abs(grid_lat - lat), grid_lat)) AS y FROM stations, (SELECT DISTINCT lat AS grid_lat, iy FROM cells) GROUP BY ALL),
nx AS (SELECT station_name, arg_min((grid_lon, ix), (abs(grid_lon - lon), grid_lon)) AS x FROM stations, (SELECT DISTINCT lon AS grid_lon, ix FROM cells) GROUP BY ALL),
near AS (SELECT stations.*, y[1] AS grid_lat, y[2] AS iy, x[1] AS grid_lon, x[2] AS ix FROM stations JOIN ny USING (station_name) JOIN nx USING (station_name))"""


@query(f"WITH {t.SQL_CELLS}, {_NEAR} SELECT station_name, grid_lat, grid_lon, iy, ix, round({_HAVERSINE.format(a='lat', b='grid_lat', c='lon', d='grid_lon')}, 6) AS distance_km FROM near")
def jn8_geo10_nearest_cells(spark, sf_dir):
    near = g.nearest_cells(t.stations(spark), t.cells(spark, sf_dir))
    return near.select("station_name", "grid_lat", "grid_lon", "iy", "ix", F.round("distance_km", 6).alias("distance_km"))


@query(f"""WITH {t.SQL_OBS}, {_NEAR}, s AS (SELECT station_name, country, time, precip FROM near JOIN obs USING (iy, ix)),
n AS (SELECT station_name, country, coalesce(sum(precip), 0) AS total FROM s WHERE time BETWEEN DATE '2001-06-30' - 89 AND DATE '2001-06-30' GROUP BY ALL), a AS (SELECT station_name, avg(precip) AS average FROM s GROUP BY ALL)
SELECT station_name || ', ' || country AS station, round(total, 6) AS total, round(100 * total / (90 * average), 6) AS normal_percent FROM n JOIN a USING (station_name)""")
def geo14_geo15_station_product(spark, sf_dir):
    from pluvio.functions.strings import place

    near = g.nearest_cells(t.stations(spark), t.cells(spark, sf_dir)).select("station_name", "country", "iy", "ix")
    s = t.obs_daily(spark, sf_dir).join(near, ["iy", "ix"])
    recent = F.col("time").between(F.lit("2001-04-02").cast("date"), F.lit("2001-06-30").cast("date"))
    one = s.groupBy("station_name", "country").agg(F.coalesce(F.sum(F.when(recent, F.col("precip"))), F.lit(0.0)).alias("total"), F.avg("precip").alias("average"))
    return one.select(place(F.col("station_name"), F.col("country")).alias("station"), F.round("total", 6).alias("total"), F.round(100 * F.col("total") / (90 * F.col("average")), 6).alias("normal_percent"))


@query(f"WITH {t.SQL_CELLS} SELECT iy, ix, round({_HAVERSINE.format(a='lat', b='-10.0', c='lon', d='170.0')}, 6) AS km FROM cells WHERE {_HAVERSINE.format(a='lat', b='-10.0', c='lon', d='170.0')} <= 1000")
def geo6_radius(spark, sf_dir):
    near = g.within_radius(t.cells(spark, sf_dir), 170.0, -10.0, 1000.0)
    return near.select("iy", "ix", F.round(g.haversine(F.col("lat"), F.col("lon"), F.lit(-10.0), F.lit(170.0)), 6).alias("km"))


_RADIUS = "sqrt((pow(pow(6378137.0, 2) * cos(radians(lat)), 2) + pow(pow(6356752.0, 2) * sin(radians(lat)), 2)) / (pow(6378137.0 * cos(radians(lat)), 2) + pow(6356752.0 * sin(radians(lat)), 2)))"


@query(f"WITH {t.SQL_CELLS} SELECT iy, ix, round({_RADIUS}, 3) AS radius_m, round(radians(5.0) * {_RADIUS} * radians(5.0) * {_RADIUS} * cos(radians(lat)) / 1e6, 3) AS area_km2, (lon - 200 + 360) % 360 AS rolled FROM cells")
def geo1_geo11_geo12_areas(spark, sf_dir):
    lat = F.col("lat")
    area = g.cell_area(lat, F.lit(5.0), F.lit(5.0)) / 1e6
    return t.cells(spark, sf_dir).select("iy", "ix", F.round(g.earth_radius(lat), 3).alias("radius_m"), F.round(area, 3).alias("area_km2"), g.roll_longitude(F.col("lon") - 200).alias("rolled"))


@query(f"""WITH {t.SQL_EDGES}, {_RING}, m AS (SELECT region, radians(x1) * 6378137 AS a, 6378137 * ln(tan(pi() / 4 + radians(y1) / 2)) AS b, radians(x2) * 6378137 AS c, 6378137 * ln(tan(pi() / 4 + radians(y2) / 2)) AS d, x1, y1 FROM ring)
SELECT region, round(abs(sum(a * d - c * b)) / 2 / 1e6, 1) AS area_km2, min(x1) AS lon_min, max(x1) AS lon_max, min(y1) AS lat_min, max(y1) AS lat_max FROM m GROUP BY region""")
def geo5_geo9_polygon_area(spark, sf_dir):
    b = g.bounds(F.col("ring"))
    return t.polygons(spark).select("region", F.round(g.ring_area_km2(F.col("ring")), 1).alias("area_km2"), *[b[c].alias(c) for c in ("lon_min", "lon_max", "lat_min", "lat_max")])


def _regrid_sql(factor_points: list, name: str) -> str:
    rows = ", ".join(f"({j}, {c!r}::DOUBLE, {i}, {m}, {w!r}::DOUBLE)" for j, (c, i, m, w) in enumerate(factor_points) if i >= 0)
    return f"{name}(j, c, lo, hi, w) AS (VALUES {rows})"


_LAT, _LON = [-20.0 + 5 * i for i in range(5)], [160.0 + 5 * i for i in range(5)]


def _bilinear_sql(y: list, x: list) -> str:
    corner = lambda dy, dx, wy, wx: f"(CASE WHEN {wy} * {wx} = 0 THEN 0 ELSE {wy} * {wx} * {dy}{dx}.precip END)"
    total = " + ".join(corner(a, b, "(1 - y.w)" if a == "l" else "y.w", "(1 - x.w)" if b == "l" else "x.w") for a in "lh" for b in "lh")
    joins = " ".join(f"LEFT JOIN s {a}{b} ON {a}{b}.time = t.time AND {a}{b}.iy = y.{'lo' if a == 'l' else 'hi'} AND {a}{b}.ix = x.{'lo' if b == 'l' else 'hi'}" for a in "lh" for b in "lh")
    return f"""WITH {t.SQL_OBS}, s AS (SELECT * FROM obs), {_regrid_sql(y, 'y')}, {_regrid_sql(x, 'x')},
t AS (SELECT DISTINCT time FROM s), r AS (SELECT t.time, y.j AS jy, x.j AS jx, y.c AS lat, x.c AS lon, {total} AS precip FROM t CROSS JOIN y CROSS JOIN x {joins})
SELECT time, CAST(jy AS INTEGER) AS jy, CAST(jx AS INTEGER) AS jx, round(lat, 6) AS lat, round(lon, 6) AS lon, round(precip, 6) AS precip FROM r WHERE precip IS NOT NULL"""


def _bilinear(spark, sf_dir, y, x):
    out = g.regrid(t.obs_daily(spark, sf_dir), y, x, ["time"]).where("precip is not null")
    return out.select("time", "jy", "jx", *[F.round(c, 6).alias(c) for c in ("lat", "lon", "precip")])


@query(_bilinear_sql(g.target_axis(_LAT, 3), g.target_axis(_LON, 3)))
def reg1_refine(spark, sf_dir):
    return _bilinear(spark, sf_dir, g.target_axis(_LAT, 3), g.target_axis(_LON, 3))


@query(_bilinear_sql(g.unit_axis(_LAT), g.unit_axis(_LON)))
def reg2_one_degree(spark, sf_dir):
    return _bilinear(spark, sf_dir, g.unit_axis(_LAT), g.unit_axis(_LON))


_OTHER = ([-18.0, -9.5, -3.0, 1.0], [158.0, 163.0, 171.25, 179.0])


@query(_bilinear_sql(g.brackets(_LAT, _OTHER[0]), g.brackets(_LON, _OTHER[1])))
def reg3_onto_other_grid(spark, sf_dir):
    return _bilinear(spark, sf_dir, g.brackets(_LAT, _OTHER[0]), g.brackets(_LON, _OTHER[1]))


@query("SELECT CAST(i AS INTEGER) AS ilat, -59.875::DOUBLE + i * 0.25 AS lat FROM (SELECT unnest(range(480)) AS i)")
def reg4_quarter_degree_axis(spark, sf_dir):
    return g.grid_axis(spark, -59.875, 0.25, 480, "lat")


@query(f"""WITH {t.SQL_OBS}, s AS (SELECT * FROM obs),
f AS (SELECT a.iy, a.ix, a.time, arg_min(b.precip, ((a.iy - b.iy) * (a.iy - b.iy) + (a.ix - b.ix) * (a.ix - b.ix), b.iy, b.ix)) AS v FROM s a JOIN s b ON a.time = b.time AND a.precip IS NULL AND b.precip IS NOT NULL GROUP BY ALL)
SELECT iy, ix, time, round(coalesce(precip, v), 6) AS precip FROM s LEFT JOIN f USING (iy, ix, time)""")
def reg5_fill_nearest(spark, sf_dir):
    return g.fill_nearest(t.obs_daily(spark, sf_dir), ["time"], reach=1).select("iy", "ix", "time", F.round("precip", 6).alias("precip"))


@query(f"WITH {t.SQL_CELLS} SELECT iy, ix, lon - 2.5 AS west, lon + 2.5 AS east, lat - 2.5 AS south, lat + 2.5 AS north FROM cells")
def geo4_geo13_pixel_squares(spark, sf_dir):
    ring = g.corners(F.col("lon"), F.col("lat"), 5.0)
    b = g.bounds(ring)
    return t.cells(spark, sf_dir).select("iy", "ix", b["lon_min"].alias("west"), b["lon_max"].alias("east"), b["lat_min"].alias("south"), b["lat_max"].alias("north"))


#: The grid five times as fine, and how far a coast reaches.
_FINE = g.target_axis(_LAT, 5), g.target_axis(_LON, 5)
_COAST_KM = 200.0
#: Weighted means of tenths lie halfway between two roundings now and then; this moves them off.
_OFF_TIES = 1e-9
_FINE_MASK = f"""{_regrid_sql(_FINE[0], 'y')}, {_regrid_sql(_FINE[1], 'x')}, fine AS (SELECT y.j AS iy, x.j AS ix, y.c AS lat, x.c AS lon FROM y CROSS JOIN x),
{t.SQL_EDGES}, {_RING}, own AS (SELECT region, iy, ix, count(*) FILTER ((y1 > lat) <> (y2 > lat) AND lon < x1 + (lat - y1) * (x2 - x1) / nullif(y2 - y1, 0)) % 2 = 1 AS inside FROM fine CROSS JOIN ring GROUP BY region, iy, ix),
plane AS (SELECT region, {", ".join(f"radians(x{i}) * 6378137 AS a{i}, 6378137 * ln(tan(pi() / 4 + radians(y{i}) / 2)) AS b{i}" for i in (1, 2))} FROM ring),
spot AS (SELECT region, iy, ix, a1, b1, a2 - a1 AS da, b2 - b1 AS db, radians(lon) * 6378137 AS a, 6378137 * ln(tan(pi() / 4 + radians(lat) / 2)) AS b FROM fine CROSS JOIN plane),
part AS (SELECT *, least(greatest(((a - a1) * da + (b - b1) * db) / (da * da + db * db), 0), 1) AS f FROM spot),
away AS (SELECT region, iy, ix, min(sqrt(pow(a - a1 - f * da, 2) + pow(b - b1 - f * db, 2))) / 1000 AS km FROM part GROUP BY region, iy, ix),
fm AS (SELECT region, iy, ix, inside, km FROM own JOIN away USING (region, iy, ix) WHERE inside OR km <= {_COAST_KM})"""


def _fine_mask(spark, sf_dir):
    return coast.buffered_mask(coast.refined_cells(spark, *_FINE), t.polygons(spark), _COAST_KM)


@query(f"""WITH {t.SQL_CELLS}, {_FINE_MASK}, box AS (SELECT region, min(lon) - 1 AS a, max(lon) + 1 AS b, min(lat) - 1 AS c, max(lat) + 1 AS d FROM edges GROUP BY region),
dom AS (SELECT box.region, iy, ix FROM fine JOIN box ON lon BETWEEN a AND b AND lat BETWEEN c AND d), n AS (SELECT n_nationkey AS k FROM nation)
SELECT region, CAST(iy AS INTEGER) AS iy, CAST(ix AS INTEGER) AS ix, coalesce(inside, false) AS inside, inside IS NOT NULL AS masked, CASE WHEN km <= {_COAST_KM} THEN round(km, 6) END AS distance_km,
  count(inside) OVER (PARTITION BY region) AS cells FROM dom LEFT JOIN fm USING (region, iy, ix) WHERE (iy // 5) * 5 + ix // 5 IN (SELECT k FROM n)""")
def geo3_coast_buffer(spark, sf_dir):
    """The domain of each region on the refined grid of the nations' cells: inside, near its outline, or neither."""
    from pyspark.sql import Window

    nations = t.cells(spark, sf_dir).select(F.col("iy").alias("_y"), F.col("ix").alias("_x"))
    fine = coast.refined_cells(spark, *_FINE)
    fine = fine.join(nations, (F.floor(fine["iy"] / 5) == F.col("_y")) & (F.floor(fine["ix"] / 5) == F.col("_x"))).drop("_y", "_x")
    masked = coast.buffered_mask(fine, t.polygons(spark), _COAST_KM)
    away = coast.near_outline(fine, t.polygons(spark), _COAST_KM)
    out = coast.around(fine, t.polygons(spark), 1.0).join(masked, ["region", "iy", "ix"], "left").join(away, ["region", "iy", "ix"], "left")
    cells = F.count("inside").over(Window.partitionBy("region"))
    return out.select("region", "iy", "ix", F.coalesce("inside", F.lit(False)).alias("inside"), F.col("inside").isNotNull().alias("masked"), F.round("distance_km", 6).alias("distance_km"), cells.alias("cells"))


_FINE_CUBE = _bilinear_sql(*_FINE).replace(t.SQL_OBS, t.SQL_MONTHLY).replace("FROM obs)", "FROM monthly)").removeprefix("WITH ")
_FINE_CUBE = _FINE_CUBE[: _FINE_CUBE.rindex("\nSELECT")] if "\nSELECT" in _FINE_CUBE else _FINE_CUBE[: _FINE_CUBE.rindex("SELECT time")]


@query(f"""WITH {_FINE_CUBE}, {_FINE_MASK.replace(_regrid_sql(_FINE[0], 'y') + ', ' + _regrid_sql(_FINE[1], 'x') + ', ', '')}
SELECT region, time, round(avg(precip) + {_OFF_TIES}, 6) AS precip, count(precip) AS valid, (SELECT count(*) FROM fm m WHERE m.region = fm.region) AS cells
FROM fm JOIN r ON r.jy = fm.iy AND r.jx = fm.ix WHERE precip IS NOT NULL GROUP BY region, time""")
def geo3_masked_refined(spark, sf_dir):
    """Monthly means over the refined cells of each region and its coast, with how many have a value."""
    fine = _fine_mask(spark, sf_dir).select("region", F.col("iy").alias("jy"), F.col("ix").alias("jx"))
    cells = fine.groupBy("region").agg(F.count("*").alias("cells"))
    cube = g.regrid(t.obs_monthly(spark, sf_dir), *_FINE, ["time"]).where("precip is not null")
    out = cube.join(fine, ["jy", "jx"]).groupBy("region", "time").agg(F.round(F.avg("precip") + _OFF_TIES, 6).alias("precip"), F.count("precip").alias("valid"))
    return out.join(cells, "region").select("region", "time", "precip", "valid", "cells")


@query(f"""WITH {t.SQL_MONTHLY}, {_FINE_MASK}, corner AS (SELECT region, fm.iy AS jy, fm.ix AS jx, unnest([[y.lo, x.lo], [y.lo, x.hi], [y.hi, x.lo], [y.hi, x.hi]]) AS c,
  unnest([(1 - y.w) * (1 - x.w), (1 - y.w) * x.w, y.w * (1 - x.w), y.w * x.w]) AS w FROM fm JOIN y ON y.j = fm.iy JOIN x ON x.j = fm.ix),
share AS (SELECT region, c[1] AS iy, c[2] AS ix, sum(w) AS w FROM corner WHERE w > 0 GROUP BY ALL), total AS (SELECT region, sum(w) AS total FROM share GROUP BY region)
SELECT region, time, round(sum(precip * w) / sum(w) + {_OFF_TIES}, 6) AS precip, round(sum(w) / any_value(total), 6) AS covered FROM monthly JOIN share USING (iy, ix) JOIN total USING (region) GROUP BY region, time""")
def geo17_share_mean(spark, sf_dir):
    """Zonal means by the shares that cells have in a region and its coast; no value is refined."""
    shares = coast.cell_shares(_fine_mask(spark, sf_dir), *_FINE)
    out = coast.weighted_zonal_mean(t.obs_monthly(spark, sf_dir), shares, ["time"])
    return out.withColumns({"precip": F.round(F.col("precip") + _OFF_TIES, 6), "covered": F.round("covered", 6)})
