"""Masks with a coast: cells within a distance of a polygon's outline, refined grids, and zonal means by shares of cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .grid import bounds, corner_tables, mask, mercator

#: Latitudes beyond these are not on the Mercator plane.
MOST_LATITUDE = 89.0


def segments(polygons: DataFrame) -> DataFrame:
    """(region, x1, y1, x2, y2): the edges of every ring in metres on the Mercator plane; edges without length are left out."""
    ring = F.filter("ring", lambda p: F.abs(p["lat"]) <= MOST_LATITUDE)
    xy = F.transform(ring, lambda p: F.struct(mercator(p["lon"], p["lat"])[0].alias("x"), mercator(p["lon"], p["lat"])[1].alias("y")))
    told = polygons.select("region", xy.alias("_xy")).where(F.size("_xy") > 1)
    pairs = F.zip_with(F.slice("_xy", 1, F.size("_xy") - 1), F.slice("_xy", 2, F.size("_xy") - 1), lambda p, q: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2")))
    return told.select("region", F.inline(pairs)).where("x1 <> x2 or y1 <> y2")


def distance_to_segment(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance of a point to a segment that has a length, in the plane."""
    dx, dy = x2 - x1, y2 - y1
    along = ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy)
    t = F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0))
    return F.hypot(x - x1 - t * dx, y - y1 - t * dy)


def near_outline(cells: DataFrame, polygons: DataFrame, km: float) -> DataFrame:
    """(region, iy, ix, distance_km) of the cells whose centre is within `km` of a region's outline, on the Mercator plane.

    Edges are cut to pieces no longer than the distance, so that each piece and its surroundings lie on a few square tiles
    of that size; cells and pieces meet by equality of tiles. Of several edges the nearest counts.
    """
    if km <= 0:
        raise ValueError(f"a distance of {km} km")
    reach = km * 1000.0
    edge = segments(polygons).withColumn("_n", F.ceil(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")) / reach).cast("int"))
    piece = edge.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    at = lambda a, b, i: F.col(a) + (F.col(b) - F.col(a)) * i / F.col("_n")
    i, j = F.col("_i"), F.col("_i") + 1
    piece = piece.select("region", at("x1", "x2", i).alias("x1"), at("y1", "y2", i).alias("y1"), at("x1", "x2", j).alias("x2"), at("y1", "y2", j).alias("y2"))
    tile = lambda v: F.floor(v / reach)
    spread = lambda a, b: F.explode(F.sequence(tile(F.least(a, b) - reach), tile(F.greatest(a, b) + reach)))
    tiled = piece.withColumn("_tx", spread(F.col("x1"), F.col("x2"))).withColumn("_ty", spread(F.col("y1"), F.col("y2")))
    x, y = mercator(F.col("lon"), F.col("lat"))
    placed = cells.where(F.abs("lat") <= MOST_LATITUDE).select("iy", "ix", x.alias("_x"), y.alias("_y"))
    placed = placed.withColumns({"_tx": tile(F.col("_x")), "_ty": tile(F.col("_y"))})
    away = distance_to_segment(F.col("_x"), F.col("_y"), *map(F.col, ("x1", "y1", "x2", "y2"))) / 1000
    met = placed.join(tiled, ["_tx", "_ty"]).withColumn("distance_km", away).where(F.col("distance_km") <= km)
    return met.groupBy("region", "iy", "ix").agg(F.min("distance_km").alias("distance_km"))


def buffered_mask(cells: DataFrame, polygons: DataFrame, km: float) -> DataFrame:
    """(region, iy, ix, inside): the cells in a region's polygon, and those within `km` of its outline (inside false)."""
    own = mask(cells, polygons).withColumn("inside", F.lit(True))
    near = near_outline(cells, polygons, km).select("region", "iy", "ix", F.lit(False).alias("inside"))
    return own.unionByName(near).groupBy("region", "iy", "ix").agg(F.max("inside").alias("inside"))


def around(cells: DataFrame, polygons: DataFrame, degrees: float = 1.0, tile: float = 5.0) -> DataFrame:
    """(region, iy, ix): the cells in the box of a region's rings, grown by `degrees`; they meet by equality of tiles."""
    b = bounds(F.col("ring"))
    box = polygons.select("region", b.alias("b")).groupBy("region").agg(*[f(f"b.{c}").alias(c) for f, c in ((F.min, "lon_min"), (F.max, "lon_max"), (F.min, "lat_min"), (F.max, "lat_max"))])
    box = box.select("region", *[(F.col(c) + d * degrees).alias(c) for c, d in (("lon_min", -1), ("lon_max", 1), ("lat_min", -1), ("lat_max", 1))])
    on = lambda c: F.floor(F.col(c) / tile)
    tiled = box.withColumn("_tx", F.explode(F.sequence(on("lon_min"), on("lon_max")))).withColumn("_ty", F.explode(F.sequence(on("lat_min"), on("lat_max"))))
    met = cells.withColumns({"_tx": on("lon"), "_ty": on("lat")}).join(tiled, ["_tx", "_ty"])
    return met.where("lon between lon_min and lon_max and lat between lat_min and lat_max").select("region", "iy", "ix")


def refined_cells(spark: SparkSession, y_axis: list[tuple], x_axis: list[tuple]) -> DataFrame:
    """(iy, ix, lat, lon) of a target grid with evenly spaced axes, as `target_axis` and `unit_axis` make them."""
    step = lambda axis: (axis[-1][0] - axis[0][0]) / max(1, len(axis) - 1)
    ids = spark.range(len(y_axis) * len(x_axis))
    iy, ix = F.floor(F.col("id") / len(x_axis)).cast("int"), (F.col("id") % len(x_axis)).cast("int")
    return ids.select(iy.alias("iy"), ix.alias("ix"), (F.lit(y_axis[0][0]) + iy * step(y_axis)).alias("lat"), (F.lit(x_axis[0][0]) + ix * step(x_axis)).alias("lon"))


def cell_shares(refined_mask: DataFrame, y_axis: list[tuple], x_axis: list[tuple]) -> DataFrame:
    """(region, iy, ix, weight): what each cell of the coarse grid adds to a mean over the refined cells of a region.

    refined_mask: (region, iy, ix) on the grid that the axes refine. A refined cell's value is a mean of its corners, so
    that a region's mean over all its refined cells is one over coarse cells, with the sums of the corners' weights. Refined
    cells outside the coarse grid have no corners.
    """
    y, x = corner_tables(refined_mask.sparkSession, y_axis, x_axis)
    told = refined_mask.select("region", F.col("iy").alias("jy"), F.col("ix").alias("jx")).join(y, "jy").join(x, "jx")
    return told.groupBy("region", "iy", "ix").agg(F.sum(F.col("wy") * F.col("wx")).alias("weight"))


def weighted_zonal_mean(facts: DataFrame, shares: DataFrame, by: list[str], value: str = "precip") -> DataFrame:
    """The mean of each region by its cells' weights, at the cube's own resolution: the cube is read once and not refined.

    Equal to the mean over refined cells where no value is missing; a missing value's weight goes to the others, and
    `covered` is the share of the region's weight that has values.
    """
    # A row for each region.
    total = shares.groupBy("region").agg(F.sum("weight").alias("_all"))
    kept = F.when(F.col(value).isNotNull(), F.col("weight"))
    met = facts.join(shares, ["iy", "ix"]).groupBy("region", *by).agg(F.sum(F.col(value) * F.col("weight")).alias("_sum"), F.sum(kept).alias("_w"))
    out = met.join(total, "region")
    return out.select("region", *by, F.try_divide(F.col("_sum"), F.col("_w")).alias(value), (F.coalesce("_w", F.lit(0.0)) / F.col("_all")).alias("covered"))
