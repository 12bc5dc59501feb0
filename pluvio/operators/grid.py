"""Grids and places: longitudes, distances, areas, polygon masks, nearest cells, bilinear regridding, infilling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EARTH_KM = 6372.8
EQUATOR_M, POLE_M = 6378137.0, 6356752.0
#: Rows of an axis or a station table that may be broadcast; larger ones are joined as Spark sees fit.
MOST_BROADCAST = 100_000


def roll_longitude(lon: Column) -> Column:
    """-180..180 to 0..360."""
    return F.pmod(lon, F.lit(360.0))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in km."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(h))


def earth_radius(lat: Column) -> Column:
    """Radius in metres at a geodetic latitude."""
    c, s = F.cos(F.radians(lat)), F.sin(F.radians(lat))
    a, b = EQUATOR_M, POLE_M
    top = F.pow(a * a * c, 2) + F.pow(b * b * s, 2)
    return F.sqrt(top / (F.pow(a * c, 2) + F.pow(b * s, 2)))


def cell_area(lat: Column, d_lat: Column, d_lon: Column) -> Column:
    """Area in square metres of a cell of these extents in degrees."""
    r = earth_radius(lat)
    return F.radians(d_lat) * r * F.radians(d_lon) * r * F.cos(F.radians(lat))


def corners(lon: Column, lat: Column, resolution: float) -> Column:
    """The ring of a pixel's square."""
    h = resolution / 2
    at = lambda x, y: F.struct((lon + x).alias("lon"), (lat + y).alias("lat"))
    return F.array(at(-h, -h), at(h, -h), at(h, h), at(-h, h), at(-h, -h))


def bounds(ring: Column) -> Column:
    lon, lat = F.transform(ring, lambda p: p["lon"]), F.transform(ring, lambda p: p["lat"])
    return F.struct(F.array_min(lon).alias("lon_min"), F.array_max(lon).alias("lon_max"), F.array_min(lat).alias("lat_min"), F.array_max(lat).alias("lat_max"))


def mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Metres on the spherical Mercator plane."""
    return F.radians(lon) * EQUATOR_M, EQUATOR_M * F.ln(F.tan(F.lit(0.7853981633974483) + F.radians(lat) / 2))


def ring_area_km2(ring: Column) -> Column:
    """Area of a ring on the Mercator plane, by the shoelace formula."""
    xy = F.transform(ring, lambda p: F.struct(mercator(p["lon"], p["lat"])[0].alias("x"), mercator(p["lon"], p["lat"])[1].alias("y")))
    turns = F.zip_with(F.slice(xy, 1, F.size(xy) - 1), F.slice(xy, 2, F.size(xy) - 1), lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.abs(F.aggregate(turns, F.lit(0.0), lambda s, v: s + v)) / 2 / 1e6


def inside(lon: Column, lat: Column, ring: Column) -> Column:
    """Even-odd rule: whether an odd number of the ring's edges is crossed to the east of the point."""
    edges = F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda p, q: F.struct(p.alias("p"), q.alias("q")))

    def crossed(e: Column) -> Column:
        p, q = e["p"], e["q"]
        straddles = (p["lat"] > lat) != (q["lat"] > lat)
        at = p["lon"] + F.try_divide((lat - p["lat"]) * (q["lon"] - p["lon"]), q["lat"] - p["lat"])
        return straddles & (lon < at)

    return F.size(F.filter(edges, crossed)) % 2 == 1


def mask(cells: DataFrame, polygons: DataFrame, tile: float = 5.0) -> DataFrame:
    """(region, iy, ix) of the cells whose centre is in a region's polygon; several polygons of a region are a union.

    Cells and the polygons' boxes meet by equality on square tiles of `tile` degrees; the crossings are counted for the
    cells in a box only.
    """
    on_tile = lambda v: F.floor(v / tile)
    spread = lambda low, high: F.explode(F.sequence(on_tile(F.col(low)), on_tile(F.col(high))))
    boxed = polygons.withColumn("box", bounds(F.col("ring")))
    tiled = boxed.withColumn("_tx", spread("box.lon_min", "box.lon_max")).withColumn("_ty", spread("box.lat_min", "box.lat_max"))
    placed = cells.withColumns({"_tx": on_tile(F.col("lon")), "_ty": on_tile(F.col("lat"))})
    near = F.col("lon").between(F.col("box.lon_min"), F.col("box.lon_max")) & F.col("lat").between(F.col("box.lat_min"), F.col("box.lat_max"))
    met = placed.join(tiled, ["_tx", "_ty"]).where(near & inside(F.col("lon"), F.col("lat"), F.col("ring")))
    return met.select("region", "iy", "ix").distinct()


def overlay(first: DataFrame, second: DataFrame) -> DataFrame:
    """(region, other, iy, ix): the cells that a region of each of two masks (region, iy, ix) has in common."""
    return first.join(second.withColumnRenamed("region", "other"), ["iy", "ix"]).select("region", "other", "iy", "ix").distinct()


def zonal_mean(facts: DataFrame, masks: DataFrame, by: list[str], value: str = "precip") -> DataFrame:
    return facts.join(masks, ["iy", "ix"]).groupBy("region", *by).agg(F.avg(value).alias(value), F.count(value).alias("cells"))


def nearest_cells(stations: DataFrame, cells: DataFrame) -> DataFrame:
    """Each station with its nearest cell, nearest in latitude and in longitude independently, and the distance in km.

    Only the two axes, the distinct rows and columns of the grid, meet the stations; the smaller coordinate wins ties.
    """
    def nearest(axis: str, index: str):
        return lambda p: F.struct(F.abs(p[f"grid_{axis}"] - F.col(axis)).alias("gap"), p[f"grid_{axis}"].alias(f"grid_{axis}"), p[index].alias(index))

    out = stations
    for axis, index in (("lat", "iy"), ("lon", "ix")):
        line = cells.select(F.col(axis).alias(f"grid_{axis}"), index).distinct()
        packed = line.agg(F.collect_list(F.struct(f"grid_{axis}", index)).alias("_axis"))
        best = F.array_min(F.transform("_axis", nearest(axis, index)))
        out = out.crossJoin(F.broadcast(packed)).withColumn("_best", best).withColumns({f"grid_{axis}": F.col(f"_best.grid_{axis}"), index: F.col(f"_best.{index}")}).drop("_axis", "_best")
    return out.withColumn("distance_km", haversine(F.col("lat"), F.col("lon"), F.col("grid_lat"), F.col("grid_lon")))


def within_radius(cells: DataFrame, lon: float, lat: float, km: float) -> DataFrame:
    """Cells within a radius in true kilometres."""
    return cells.where(haversine(F.col("lat"), F.col("lon"), F.lit(lat), F.lit(lon)) <= km)


def target_axis(axis: list[float], factor: int) -> list[tuple[float, int, int, float]]:
    """(coordinate, lower index, upper index, weight of the upper) of an axis made `factor` times as fine, ends included."""
    n = len(axis) * factor
    points = [axis[0] + (axis[-1] - axis[0]) * i / (n - 1) for i in range(n)] if n > 1 else list(axis)
    return brackets(axis, points)


def unit_axis(axis: list[float], step: float = 1.0) -> list[tuple[float, int, int, float]]:
    """The same for points one unit apart from the first; points beyond the last have no neighbours (-1)."""
    n = int((axis[-1] + step - axis[0]) / step + 1e-9)
    return brackets(axis, [axis[0] + step * i for i in range(n + (axis[0] + step * n < axis[-1] + step - 1e-9))])


def brackets(axis: list[float], points: list[float]) -> list[tuple[float, int, int, float]]:
    out = []
    for x in points:
        if x < axis[0] - 1e-9 or x > axis[-1] + 1e-9:
            out.append((x, -1, -1, 0.0))
            continue
        i = max((k for k, a in enumerate(axis) if a <= x + 1e-9), default=0)
        j = min(i + 1, len(axis) - 1)
        out.append((x, i, j, 0.0 if i == j else min(1.0, max(0.0, (x - axis[i]) / (axis[j] - axis[i])))))
    return out


def corner_tables(spark: SparkSession, y_axis: list[tuple], x_axis: list[tuple]) -> list[DataFrame]:
    """(jy, cy, iy, wy) and (jx, cx, ix, wx): a row for each corner and target coordinate that has a weight; small ones are
    broadcast."""
    sides = []
    for axis, name in ((y_axis, "y"), (x_axis, "x")):
        rows = [(j, float(c), k, w) for j, (c, i, m, up) in enumerate(axis) for k, w in ([(i, 1.0 - up), (m, up)] if m != i else [(i, 1.0)]) if i >= 0 and w > 0]
        side = spark.createDataFrame(rows, f"j{name} int, c{name} double, i{name} int, w{name} double")
        sides.append(F.broadcast(side) if len(rows) <= MOST_BROADCAST else side)
    return sides


def regrid(df: DataFrame, y_axis: list[tuple], x_axis: list[tuple], by: list[str], value: str = "precip") -> DataFrame:
    """Bilinear values (jy, jx, lat, lon) of every slice. No extrapolation; a missing corner that has a weight gives null.

    Every source value is sent to the target points that it is a corner of, and the corners meet in one aggregation; the
    axis tables hold a row for each corner and target coordinate, and their size is checked before they are broadcast.
    """
    sides = corner_tables(df.sparkSession, y_axis, x_axis)
    parts = df.join(sides[0], "iy").join(sides[1], "ix")
    weight = F.col("wy") * F.col("wx")
    total = F.sum(F.col(value) * weight)
    full = F.round(F.sum(F.when(F.col(value).isNotNull(), weight).otherwise(0.0)), 9) == 1.0
    return parts.groupBy(*by, "jy", "jx").agg(F.first("cy").alias("lat"), F.first("cx").alias("lon"), F.when(full, total).alias(value))


def grid_axis(spark: SparkSession, first: float, step: float, n: int, name: str) -> DataFrame:
    """An axis of n points, such as the 480 by 1440 quarter degrees of a satellite product."""
    return spark.range(n).select(F.col("id").cast("int").alias(f"i{name}"), (F.lit(first) + F.col("id") * step).alias(name))


def fill_nearest(df: DataFrame, by: list[str], value: str = "precip", reach: int = 2) -> DataFrame:
    """Missing values taken from the nearest valid cell of the slice in index space, by squares of growing half width.

    Ties go to the smaller row, then column. A missing cell is sent to the cells of a square around it, twice as wide in
    each round, and joined by equality; slices without any valid value stay missing.
    """
    valid = df.where(F.col(value).isNotNull()).select(*by, F.col("iy").alias("_vy"), F.col("ix").alias("_vx"), F.col(value).alias("_v"))
    full = df.groupBy(*by).agg(F.max("iy").alias("a"), F.max("ix").alias("b"), F.min("iy").alias("c"), F.min("ix").alias("d"))
    span = full.agg(F.max(F.greatest(F.col("a") - F.col("c"), F.col("b") - F.col("d")))).first()[0] or 0
    todo = df.where(F.col(value).isNull()).select(*by, "iy", "ix")
    found = None
    while True:
        square = F.sequence(F.lit(-reach), F.lit(reach))
        spread = todo.withColumn("_dy", F.explode(square)).withColumn("_dx", F.explode(square)).withColumns({"_vy": F.col("iy") + F.col("_dy"), "_vx": F.col("ix") + F.col("_dx")})
        gap = F.col("_dy") * F.col("_dy") + F.col("_dx") * F.col("_dx")
        hit = spread.join(valid, [*by, "_vy", "_vx"]).groupBy(*by, "iy", "ix").agg(F.min_by("_v", F.struct(gap, "_vy", "_vx")).alias("_v"), F.min(gap).alias("_gap"))
        # Within the square's half width nothing nearer can lie outside.
        sure = hit.where(F.col("_gap") <= reach * reach) if reach < span else hit
        found = sure.drop("_gap") if found is None else found.unionByName(sure.drop("_gap"))
        if reach >= span:
            break
        todo = todo.join(sure.select(*by, "iy", "ix"), [*by, "iy", "ix"], "left_anti")
        reach = min(span, reach * 2) or 1
    out = df.join(found, [*by, "iy", "ix"], "left")
    return out.withColumn(value, F.coalesce(value, "_v")).drop("_v")
