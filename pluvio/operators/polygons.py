"""Polygons as rings: cut by half-planes, split at a meridian, dissolved from touching pieces, and laid over each other.

A ring is an array of (lon, lat) whose last point is its first. All is done in the plane of degrees; areas are square degrees.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from pluvio.sources.steps import dealer, kept

from .grid import bounds

#: Digits of a degree that coordinates of overlays keep: a tenth of a millimetre.
DIGITS = 9
#: A vertex this near to the one before it, or to the line between its neighbours, in degrees, is not a corner.
STRAIGHT = 1e-8
#: Rows of a step that one task holds.
ROWS = 100_000


def _point(lon: Column, lat: Column) -> Column:
    return F.struct(lon.alias("lon"), lat.alias("lat"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, wherever the body names it, also in functions over arrays."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _edges(ring: Column) -> Column:
    """(p, q) for each edge; none for rings of fewer than two points."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(F.slice(ring, 1, n), F.slice(ring, 2, n), lambda p, q: F.struct(p.alias("p"), q.alias("q")))


def signed_area(ring: Column) -> Column:
    """Square degrees, above zero for rings that turn left; the first point is the origin, for the digits' sake."""

    def about(r: Column, o: Column) -> Column:
        def turn(e: Column) -> Column:
            p, q = e["p"], e["q"]
            return (p["lon"] - o["lon"]) * (q["lat"] - o["lat"]) - (q["lon"] - o["lon"]) * (p["lat"] - o["lat"])

        return F.aggregate(_edges(r), F.lit(0.0), lambda s, e: s + turn(e)) / 2

    return _let(ring, lambda r: _let(F.get(r, F.lit(0)), lambda o: about(r, o)))


def ring_length(ring: Column) -> Column:
    """The length of a ring's edges in degrees."""
    long = F.transform(_edges(ring), lambda e: F.hypot(e["q"]["lon"] - e["p"]["lon"], e["q"]["lat"] - e["p"]["lat"]))
    return F.aggregate(long, F.lit(0.0), lambda s, v: s + v)


def clip_half_plane(ring: Column, axis: str, limit: float, below: bool = True) -> Column:
    """The part of a ring with lon (or lat) of at most `limit`, or of at least it; an empty array if nothing has an extent.

    A concave ring that falls apart stays one ring, whose parts are joined by edges along the cut, there and back;
    `dissolved` takes these away. A null ring gives null.
    """
    other = {"lon": "lat", "lat": "lon"}[axis]
    at = F.lit(float(limit))
    within = (lambda p: p[axis] <= at) if below else (lambda p: p[axis] >= at)

    def left(e: Column) -> Column:
        p, q = e["p"], e["q"]
        there = p[other] + F.try_divide((at - p[axis]) * (q[other] - p[other]), q[axis] - p[axis])
        cut = _point(at, there) if axis == "lon" else _point(there, at)
        crosses = ((p[axis] < at) & (q[axis] > at)) | ((p[axis] > at) & (q[axis] < at))
        none = F.slice(F.array(q), 1, 0)
        return F.concat(F.when(crosses, F.array(cut)).otherwise(none), F.when(within(q), F.array(q)).otherwise(none))

    # Each step is bound to a name: an expression that is written out wherever it is used is computed anew for every edge.
    points = _let(ring, lambda r: F.flatten(F.transform(_edges(r), left)))
    closed = _let(points, lambda p: F.concat(p, F.slice(p, 1, 1)))
    return _let(closed, lambda c: F.when(F.abs(signed_area(c)) > 0, c).when(c.isNotNull(), F.slice(c, 1, 0)))


def split_at_meridian(polygons: DataFrame, seam: float = 180.0, turn: float = -360.0) -> DataFrame:
    """Each row with the part of its ring up to the seam, and a row with the part beyond it, moved by `turn` degrees.

    Columns as before, and `part` (west or east of the seam). Parts without an extent have no row; a null ring has none.
    """
    west = clip_half_plane(F.col("ring"), "lon", seam)
    east = F.transform(clip_half_plane(F.col("ring"), "lon", seam, below=False), lambda p: _point(p["lon"] + turn, p["lat"]))
    both = F.array(F.struct(F.lit("west").alias("part"), west.alias("ring")), F.struct(F.lit("east").alias("part"), east.alias("ring")))
    columns = [c for c in polygons.columns if c != "ring"]
    return polygons.where("ring is not null").select(*columns, F.inline(both)).where(F.size("ring") > 3)


def outline_edges(pieces: DataFrame, by: list[str]) -> DataFrame:
    """(by..., ax, ay, bx, by_): the directed edges of the union of touching pieces, the inside to their left.

    pieces: (by..., ring), rings of either sense that do not overlap. Edges that two pieces share run both ways and go:
    those along an axis by a running sum on their line, so that edges of other lengths cancel too and neighbours on a line
    become one, all others where their ends are alike.
    """
    # Both kinds of edges read the pieces.
    pieces = kept(pieces)
    dealt = dealer(pieces, ROWS // 2)
    sense = F.signum(signed_area(F.col("ring")))
    told = pieces.withColumn("_sense", sense).where("_sense <> 0").select(*by, "_sense", F.explode(_edges(F.col("ring"))).alias("_e"))
    p, q = F.col("_e.p"), F.col("_e.q")
    edge = told.select(*by, "_sense", *[v.alias(n) for n, v in (("ax", p["lon"]), ("ay", p["lat"]), ("bx", q["lon"]), ("by_", q["lat"]))])
    edge = edge.where("ax <> bx or ay <> by_")

    level = F.col("ay") == F.col("by_")
    flat = edge.where(level | (F.col("ax") == F.col("bx")))
    start, end = F.when(level, F.col("ax")).otherwise(F.col("ay")), F.when(level, F.col("bx")).otherwise(F.col("by_"))
    line = F.when(level, F.col("ay")).otherwise(F.col("ax"))
    step = lambda at, d: F.struct(at.alias("_at"), d.alias("_d"))
    steps = F.inline(F.array(step(start, F.col("_sense")), step(end, -F.col("_sense"))))
    # An edge that runs backwards starts at its far end: its steps are +sense there and -sense at the near one, so that the
    # running sum over its extent is -sense.
    sums = dealt(flat.select(*by, level.alias("_level"), line.alias("_line"), steps), *by, "_level", "_line").groupBy(*by, "_level", "_line", "_at").agg(F.sum("_d").alias("_d")).where("_d <> 0")
    w = Window.partitionBy(*by, "_level", "_line").orderBy("_at")
    runs = sums.select(*by, "_level", "_line", F.col("_at").alias("_a"), F.lead("_at").over(w).alias("_b"), F.sum("_d").over(w).alias("_net")).where("_net <> 0 and _b is not null")
    a, b = F.when(F.col("_net") > 0, F.col("_a")).otherwise(F.col("_b")), F.when(F.col("_net") > 0, F.col("_b")).otherwise(F.col("_a"))
    on = lambda v, is_level: F.when(F.col("_level") == F.lit(is_level), v).otherwise(F.col("_line"))
    along = runs.select(*by, on(a, True).alias("ax"), on(a, False).alias("ay"), on(b, True).alias("bx"), on(b, False).alias("by_"))

    forth = (F.col("ax") < F.col("bx")) == (F.col("_sense") > 0)
    low, high = (F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("ax", "ay"), ("bx", "by_")))
    swap = F.col("ax") > F.col("bx")
    ends = [F.when(swap, high).otherwise(low).alias("_l"), F.when(swap, low).otherwise(high).alias("_h")]
    slant = edge.where(~level & (F.col("ax") != F.col("bx"))).select(*by, *ends, F.when(forth, 1).otherwise(-1).alias("_d"))
    slant = dealt(slant, *by, "_l", "_h").groupBy(*by, "_l", "_h").agg(F.sum("_d").alias("_net")).where("_net <> 0")
    ahead = F.col("_net") > 0
    pick = lambda c, f: F.when(ahead if f else ~ahead, F.col(f"_l.{c}")).otherwise(F.col(f"_h.{c}"))
    return along.unionByName(slant.select(*by, pick("x", True).alias("ax"), pick("y", True).alias("ay"), pick("x", False).alias("bx"), pick("y", False).alias("by_")))


@F.pandas_udf(ArrayType(IntegerType()))
def _walk(edge: pd.Series, after: pd.Series) -> pd.Series:
    """The places of a ring's edges in the order in which they follow each other, from the first."""

    def order(edges, nexts):
        place = {e: i for i, e in enumerate(edges)}
        out = [0]
        while len(out) < len(edges):
            out.append(place[nexts[out[-1]]])
        return out

    return pd.Series([order(e, n) for e, n in zip(edge, after, strict=True)])


def _corners(points: Column) -> Column:
    """Points of an open ring without those at their forerunner, and then those on the line between their neighbours."""
    before = F.concat(F.slice(points, -1, 1), F.slice(points, 1, F.size(points) - 1))
    steps = F.filter(F.arrays_zip(before.alias("a"), points.alias("b")), lambda t: F.hypot(t["b"]["lon"] - t["a"]["lon"], t["b"]["lat"] - t["a"]["lat"]) > STRAIGHT)
    points = F.transform(steps, lambda t: t["b"])
    n = F.greatest(F.size(points), F.lit(1))
    before = F.concat(F.slice(points, F.greatest(F.size(points), F.lit(1)), 1), F.slice(points, 1, n - 1))
    behind = F.concat(F.slice(points, 2, n - 1), F.slice(points, 1, 1))
    three = F.arrays_zip(before.alias("a"), points.alias("b"), behind.alias("c"))

    def bends(t: Column) -> Column:
        ux, uy, vx, vy = t["b"]["lon"] - t["a"]["lon"], t["b"]["lat"] - t["a"]["lat"], t["c"]["lon"] - t["b"]["lon"], t["c"]["lat"] - t["b"]["lat"]
        return F.abs(ux * vy - uy * vx) > STRAIGHT * F.hypot(ux + vx, uy + vy)

    return F.transform(F.filter(three, bends), lambda t: t["b"])


def rings(edges: DataFrame, by: list[str]) -> DataFrame:
    """(by..., ring, area): closed rings from directed edges; outer rings turn left, holes right (their area is below zero).

    Where rings touch in a point, the leftmost turn is taken, so that parts which only touch stay apart. Each edge doubles
    its leap along the ring until the least number among the edges leapt over changes no more, which takes as many joins as
    the longest ring has binary digits; nothing but a single ring, which is a row in the end, is ever in one task.
    """
    numbered = kept(edges.withColumn("_e", F.monotonically_increasing_id()))
    # Rows of a few numbers, sorted once a step.
    dealt = dealer(numbered, 4 * ROWS)
    behind = numbered.select(*by, F.col("_e").alias("_next"), F.col("ax").alias("bx"), F.col("ay").alias("by_"), F.col("bx").alias("_cx"), F.col("by_").alias("_cy"))
    ux, uy, vx, vy = F.col("bx") - F.col("ax"), F.col("by_") - F.col("ay"), F.col("_cx") - F.col("bx"), F.col("_cy") - F.col("by_")
    turn = F.atan2(ux * vy - uy * vx, ux * vx + uy * vy)
    ends = [*by, "bx", "by_"]
    met = dealt(dealt(numbered, *ends).join(dealt(behind, *ends), ends).select("_e", "_next", turn.alias("_turn")), "_e").groupBy("_e").agg(F.max_by("_next", "_turn").alias("_next"))
    follow = kept(met)
    leap = follow.select("_e", F.col("_next").alias("_to"), F.least("_e", "_next").alias("_low"))
    changed = True
    while changed:
        target = leap.select(F.col("_e").alias("_to"), F.col("_to").alias("_far"), F.col("_low").alias("_other"))
        leap = kept(dealt(leap, "_to").join(dealt(target, "_to"), "_to").select("_e", F.col("_far").alias("_to"), F.least("_low", "_other").alias("_low"), (F.col("_other") < F.col("_low")).alias("_less")))
        changed = not leap.where("_less").isEmpty()
        leap = leap.drop("_less")
    whole = dealt(numbered, "_e").join(dealt(leap.select("_e", "_low"), "_e"), "_e").join(dealt(follow, "_e"), "_e")
    at = F.struct("_e", "_next", _point(F.col("ax"), F.col("ay")).alias("p"))
    ring = dealt(whole.select(*by, "_low", at.alias("_at")), *by, "_low").groupBy(*by, "_low").agg(F.sort_array(F.collect_list("_at")).alias("_m"))
    ring = ring.withColumn("_order", _walk(F.transform("_m", lambda m: m["_e"]), F.transform("_m", lambda m: m["_next"])))
    points = ring.withColumn("_p", F.transform("_order", lambda i: F.get(F.col("_m"), i)["p"]))
    bent = points.withColumn("_c", _corners(F.col("_p"))).where(F.size("_c") > 2)
    closed = bent.select(*by, F.concat(F.col("_c"), F.slice("_c", 1, 1)).alias("ring"))
    return closed.withColumn("area", signed_area(F.col("ring")))


def dissolved(pieces: DataFrame, by: list[str]) -> DataFrame:
    """(by..., ring, area): the outlines and holes of the union of a group's pieces, which may touch, but not overlap."""
    return rings(outline_edges(pieces, by), by)


def _boxes(polygons: DataFrame, name: str, tile: float) -> DataFrame:
    """(name, tile, box) of each polygon, a row for each tile of its box."""
    b = bounds(F.col("ring"))
    box = polygons.select(F.col("region").alias(name), b.alias("b")).groupBy(name)
    box = box.agg(*[f(f"b.{c}").alias(f"{name}_{c}") for f, c in ((F.min, "lon_min"), (F.max, "lon_max"), (F.min, "lat_min"), (F.max, "lat_max"))])
    on = lambda c: F.floor(F.col(f"{name}_{c}") / tile)
    tiled = box.withColumn("_tx", F.explode(F.sequence(on("lon_min"), on("lon_max"))))
    return tiled.withColumn("_ty", F.explode(F.sequence(on("lat_min"), on("lat_max"))))


def _banded(polygons: DataFrame, name: str, band: float) -> DataFrame:
    """(name, x1, y1, x2, y2, _band, _lo, _hi): edges from south to north, their ends to DIGITS, a row for each
    band of latitude that they cross."""
    e = polygons.select(F.col("region").alias(name), F.explode(_edges(F.col("ring"))).alias("e"))
    up = F.col("e.p.lat") < F.col("e.q.lat")
    ends = [F.round(F.when(up, F.col(f"e.{a}.{c}")).otherwise(F.col(f"e.{b}.{c}")), DIGITS).alias(n) for n, a, b, c in (("x1", "p", "q", "lon"), ("y1", "p", "q", "lat"), ("x2", "q", "p", "lon"), ("y2", "q", "p", "lat"))]
    edge = e.select(name, *ends).where("y1 < y2")
    banded = edge.withColumn("_band", F.explode(F.sequence(F.floor(F.col("y1") / band), F.ceil(F.col("y2") / band) - 1)))
    return banded.withColumns({"_lo": F.greatest("y1", F.col("_band") * band), "_hi": F.least("y2", (F.col("_band") + 1) * band)})


def _x_at(y: Column) -> Column:
    """An edge's lon at a latitude; at its ends the very ends."""
    x1, y1, x2, y2 = map(F.col, ("x1", "y1", "x2", "y2"))
    return F.when(y == y1, x1).when(y == y2, x2).otherwise(x1 + (y - y1) * (x2 - x1) / (y2 - y1))


def overlay_pieces(first: DataFrame, second: DataFrame, band: float = 5.0) -> DataFrame:
    """(region, other, ring): trapezoids that make up what each polygon of `first` has in common with each of `second`.

    Both: (region, ring); several rings of a region count by the even-odd rule, so that holes are rings as well; a ring must
    not cross itself or another of its region. Polygons meet by equality of the tiles of their boxes. In bands of `band`
    degrees, the latitudes of all vertices and crossings cut slabs within which no edges cross; in a slab's order of edges,
    what lies between an edge and the next is common if an odd number of each polygon's edges lies before. The work in a
    band is its edges times its slabs, so that bands should be narrow where outlines are fine. Each step is dealt over tasks by
    its rows.
    """
    ids = ["region", "other"]
    first = dealer(first, ROWS // 2)(first, "region")
    a, b = _boxes(first, "region", band), _boxes(second, "other", band)
    apart = " and ".join(f"region_{c}_min < other_{c}_max and other_{c}_min < region_{c}_max" for c in ("lon", "lat"))
    reach = [F.greatest("region_lat_min", "other_lat_min").alias("_south"), F.least("region_lat_max", "other_lat_max").alias("_north")]
    pairs = a.join(b, ["_tx", "_ty"]).where(apart).select(*ids, *reach).distinct()
    shared = (F.col("_hi") > F.col("_south")) & (F.col("_lo") < F.col("_north"))
    own = lambda df, name: pairs.join(_banded(df, name, band), name).where(shared).drop("_south", "_north")
    left, right = own(first, "region").withColumn("_side", F.lit(0)), own(second, "other").withColumn("_side", F.lit(1))
    edges = kept(left.unionByName(right))
    left, right = (edges.where(F.col("_side") == s) for s in (0, 1))

    group = [*ids, "_band"]
    dealt = dealer(edges, ROWS)
    slope = (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    lines = lambda df, s: df.select(*group, F.col("_lo").alias(f"_lo{s}"), F.col("_hi").alias(f"_hi{s}"), slope.alias(f"_m{s}"), (F.col("x1") - slope * F.col("y1")).alias(f"_k{s}"))
    # Slabs thinner than the digits would have pieces whose sense is not known.
    y = F.round(F.try_divide(F.col("_k1") - F.col("_k0"), F.col("_m0") - F.col("_m1")), DIGITS)
    crossings = dealt(lines(left, 0), *group).join(dealt(lines(right, 1), *group), group).select(*group, y.alias("_y"), F.greatest("_lo0", "_lo1").alias("_a"), F.least("_hi0", "_hi1").alias("_b")).where("_y > _a and _y < _b")
    cuts = dealt(edges.select(*group, F.explode(F.array("_lo", "_hi")).alias("_y")).unionByName(crossings.select(*group, "_y")), *group).distinct()
    slabs = cuts.select(*group, F.col("_y").alias("_s"), F.lead("_y").over(Window.partitionBy(*group).orderBy("_y")).alias("_n")).where("_n is not null")

    through = slabs.join(dealt(edges, *group), group).where("_lo <= _s and _hi >= _n")
    spans = through.select(*group, "_s", "_n", "_side", F.round(_x_at(F.col("_s")), DIGITS).alias("_xs"), F.round(_x_at(F.col("_n")), DIGITS).alias("_xn"))
    # Edges at one place are taken as one, those without a width between them part nothing.
    spots = spans.groupBy(*group, "_s", "_n", "_xs", "_xn").agg(*[F.count_if(F.col("_side") == s).alias(f"_n{s}") for s in (0, 1)])
    w = Window.partitionBy(*group, "_s").orderBy(F.col("_xs") + F.col("_xn"), "_xs")
    common = lambda s: F.sum(f"_n{s}").over(w) % 2 == 1
    # Where digits put edges that meet past each other, the further one counts, so that no piece is turned over.
    told = spots.withColumns({"_in": common(0) & common(1), "_es": F.max("_xs").over(w), "_en": F.max("_xn").over(w)}).withColumn("_was", F.lag("_in", 1, False).over(w)).where("_in <> _was")
    ends = told.withColumns({"_es2": F.lead("_es").over(w), "_en2": F.lead("_en").over(w)}).where("_in and _es2 is not null")
    at = lambda x, lat: _point(F.col(x), F.col(lat))
    return ends.select(*ids, F.array(at("_es", "_s"), at("_es2", "_s"), at("_en2", "_n"), at("_en", "_n"), at("_es", "_s")).alias("ring"))


def overlay_rings(first: DataFrame, second: DataFrame, band: float = 5.0) -> DataFrame:
    """(region, other, ring, area): the intersections of each polygon of `first` with each of `second` as rings; holes have an
    area below zero. Pairs without a common area have no row. See `overlay_pieces`."""
    return dissolved(overlay_pieces(first, second, band), ["region", "other"])
