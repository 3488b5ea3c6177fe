"""Spatial joins of points and roads as equi-joins on grid cells.

A road's segments are listed in the cells that they pass, grown by the radius; a
point lies in one cell. So the join meets each (point, segment) pair once, distances
are plain arithmetic in generated code, and Spark may broadcast the segments where
its own size check allows. The list of a segment grows with its length, not with its
box: what is longer than a cell is listed piece by piece.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfold.functions import geo, tile
from wayfold.shared import materialize

#: Degrees of a cell's side; a good deal more than the radius.
CELL = 0.0005
#: No two places are farther apart: where an unbounded search ends.
FARTHEST_M = 20_100_000.0
_ANY = -1_000_000_000


def _cell(x: Column, size: float | Column) -> Column:
    return F.floor(x / size).cast("long")


def _wide(cy: Column, cell: float) -> Column:
    """How many times as wide as a cell of the equator those of row cy are: about as many as metres of longitude are fewer.

    Told by comparing whole numbers, so that both sides of a join tell the same everywhere.
    """
    inner, out = F.when(cy >= 0, cy).otherwise(-cy - 1), F.lit(1.0)
    for k in range(1, 10):  # up to the latitude that listed_segments counts metres at
        out = F.when(inner >= math.ceil(math.degrees(math.acos(2.0**-k)) / cell), 2.0**k).otherwise(out)
    return out


def listed_segments(roads: DataFrame, radius_m: float, cell: float = CELL) -> DataFrame:
    """One row for each segment of a road and each cell (cx, cy) near it.

    Has geom_id, fwd_ref, back_ref, road_class, i, the segment's ends (ax, ay, bx, by),
    its direction, the metres of the road where it starts and that it has, and the road's.
    A segment takes the short way over the 180th meridian, and is listed on each side with
    the longitudes of that side, be they beyond 180 degrees: its points compare with it as they are.
    In each row of cells it has those along its part beside the row. Cells are counted
    from the 180th meridian; towards the poles they span more degrees of longitude, so that
    a radius reaches few cells at any latitude. Arrays are exploded as outer ones, none
    being empty: Spark would else filter by their size where roads are read, in few tasks.
    """
    rows = roads.where(F.size("geometry") >= 2).select("geom_id", "fwd_ref", "back_ref", "road_class", geo.plain_segments(F.col("geometry")).alias("segs"))
    last = F.element_at("segs", -1)
    rows = rows.withColumn("total_m", last["start_m"] + last["len_m"]).select("geom_id", "fwd_ref", "back_ref", "road_class", "total_m", F.posexplode_outer("segs").alias("i", "s"))
    direction = geo.azimuth(F.col("s.ax"), F.col("s.ay"), F.col("s.bx"), F.col("s.by"))
    bx = F.when(F.abs(F.col("s.bx") - F.col("s.ax")) > 180, F.col("s.bx") - 360 * F.signum(F.col("s.bx") - F.col("s.ax"))).otherwise(F.col("s.bx"))
    rows = rows.select("geom_id", "fwd_ref", "back_ref", "road_class", "i", "s.ax", "s.ay", bx.alias("bx"), "s.by", "s.start_m", "s.len_m", "total_m", direction.alias("direction")).dropna(subset=["ax", "ay", "bx", "by"])
    columns = rows.columns
    north = F.least(F.lit(89.9), F.greatest(F.abs("ay"), F.abs("by")) + radius_m / 110_000.0)
    rows = rows.withColumn("_north", north)
    kx, ky = geo.metres_per_degree(F.col("_north"))
    slack = 1e-9  # more than roundings
    rows = rows.withColumns({"_gx": F.least(F.lit(360.0), radius_m * 1.01 / kx) + slack, "_gy": F.least(F.lit(180.0), radius_m * 1.01 / ky) + slack})
    rows = rows.withColumn("cy", F.explode(F.sequence(_cell(F.least("ay", "by") - F.col("_gy"), cell), _cell(F.greatest("ay", "by") + F.col("_gy"), cell))))
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    clipped = lambda y: F.least(F.lit(1.0), F.greatest(F.lit(0.0), (y - F.col("ay")) / dy))
    one = F.when(dy == 0, 0.0).otherwise(clipped(F.col("cy") * cell - F.col("_gy")))
    two = F.when(dy == 0, 1.0).otherwise(clipped((F.col("cy") + 1) * cell + F.col("_gy")))
    rows = rows.withColumns({"_one": F.col("ax") + dx * one, "_two": F.col("ax") + dx * two, "_width": cell * _wide(F.col("cy"), cell)})
    rows = rows.withColumns({"_west": F.least("_one", "_two") - F.col("_gx"), "_east": F.greatest("_one", "_two") + F.col("_gx")})
    turn = lambda x: F.floor((F.col(x) + 180) / 360).cast("long")
    rows = rows.withColumn("_turn", F.explode(F.sequence(turn("_west"), turn("_east"))))
    west, east = F.greatest(F.lit(-180.0), F.col("_west") - 360 * F.col("_turn")), F.least(F.lit(180.0), F.col("_east") - 360 * F.col("_turn"))
    rows = rows.withColumn("cx", F.explode(F.sequence(_cell(west + 180, F.col("_width")), _cell(east + 180, F.col("_width")))))
    home = {c: F.when(F.col("_turn") == 0, F.col(c)).otherwise(F.col(c) - 360.0 * F.col("_turn")).alias(c) for c in ("ax", "bx")}
    return rows.select(*(home.get(c, c) for c in columns), "cx", "cy")


def roads_about(points: DataFrame, roads: DataFrame, radius_m: float, side: float = 0.1) -> DataFrame:
    """roads without those that lie in squares of side degrees which have no point within radius_m.

    A road whose box, grown by the radius, is longer than a square is judged by the other
    direction alone, and kept if that is longer too or has no number. So only roads that
    something may be near to are measured; points give a row for each square of theirs.
    """
    cell = lambda x: F.floor(x / side).cast("long")
    x = F.when(F.col("lon") >= 180, F.col("lon") - 360).otherwise(F.col("lon"))
    held = points.select(cell(x).alias("x"), cell(F.col("lat")).alias("y")).distinct().dropna()
    # a box begins in the square of a point in it or the one before; no number stands for any
    for c in ("x", "y"):
        held = held.withColumn(c, F.explode(F.array(F.col(c), F.col(c) - 1, F.lit(_ANY))))
    held = materialize(held.distinct(), "squares")  # its size is known to the join
    low, high = F.array_min("geometry.lat"), F.array_max("geometry.lat")
    kx, ky = geo.metres_per_degree(F.least(F.lit(89.9), F.greatest(F.abs(low), F.abs(high)) + radius_m / 110_000.0))
    gx, gy = F.least(F.lit(360.0), radius_m * 1.02 / kx) + 1e-8, F.least(F.lit(180.0), radius_m * 1.02 / ky) + 1e-8
    west, east = F.array_min("geometry.lon") - gx, F.array_max("geometry.lon") + gx
    begins = {"_x": F.when((east - west < side) & (west >= -180) & (east < 180), cell(west)), "_y": F.when(high - low + 2 * gy < side, cell(low - gy))}
    placed = roads.withColumns({c: F.coalesce(v, F.lit(_ANY)) for c, v in begins.items()})
    return placed.join(held, (F.col("_x") == F.col("x")) & (F.col("_y") == F.col("y")), "left_semi").drop(*begins)


def _foot(start: str = "a", step: str = "_d") -> Column:
    """Of a point (_x, _y) on a segment, told by its start and step: the fraction of the nearest position.

    _kx and _ky are the metres of a degree at the point. Operations come in the order of
    the SQL (fixtures.sql_candidates): at a road's end the last bit of the fraction decides
    the bin.
    """
    x, y = F.col("_x") - F.col(start + "x"), F.col("_y") - F.col(start + "y")
    dx, dy, kx, ky = F.col(step + "x"), F.col(step + "y"), F.col("_kx"), F.col("_ky")
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(x * dx * kx * kx + y * dy * ky * ky, (dx * kx) * (dx * kx) + (dy * ky) * (dy * ky)), F.lit(0.0))))


def _off(f: Column, start: str = "a", step: str = "_d") -> Column:
    """The planar distance squared of a point and the position at the fraction f."""
    x, y = F.col("_x") - F.col(start + "x"), F.col("_y") - F.col(start + "y")
    ox, oy = (x - f * F.col(step + "x")) * F.col("_kx"), (y - f * F.col(step + "y")) * F.col("_ky")
    return ox * ox + oy * oy


def _near(points: DataFrame, roads: DataFrame, radius_m: float, cell: float) -> DataFrame:
    """listed_segments of the roads about points, with the steps _dx and _dy from end to end."""
    if not points.isStreaming and radius_m < 5_000:  # a wider box has no square
        roads = roads_about(points, roads, radius_m)
    near = listed_segments(roads, radius_m, cell)
    return near.withColumns({"_dx": F.col("bx") - F.col("ax"), "_dy": F.col("by") - F.col("ay")}).drop("bx", "by")


def _met(points: DataFrame, near: DataFrame, radius_m: float, cell: float, how: str = "inner") -> DataFrame:
    """points, as _own, joined with the segments of their cells within radius_m; _f is the foot, _d2 how far it is."""
    x = F.when(F.col("lon") >= 180, F.col("lon") - 360).otherwise(F.col("lon"))
    own = points.select(F.struct(*points.columns).alias("_own"), x.alias("_x"), F.col("lat").alias("_y"), _cell(F.col("lat"), cell).alias("_cy"))
    kx, ky = geo.metres_per_degree(F.col("_y"))
    own = own.withColumns({"_cx": _cell(F.col("_x") + 180, cell * _wide(F.col("_cy"), cell)), "_kx": kx, "_ky": ky})
    most, same = (radius_m * 1.01) ** 2, (F.col("_cx") == F.col("cx")) & (F.col("_cy") == F.col("cy"))
    met = own.join(near, same if how == "inner" else same & (_off(_foot()) <= most), how).drop("_cx", "_cy", "cx", "cy")
    # explode of one item binds its value once; filters on what follows would else repeat it
    met = met.withColumn("_f", F.explode(F.array(_foot()))).withColumn("_d2", F.explode(F.array(_off(F.col("_f")))))
    return met.where(F.col("_d2") <= most) if how == "inner" else met


def _hit() -> list:
    """Columns of what _met gives: the road, the segment's place in order of nearness and the position on it."""
    return [
        "geom_id", "fwd_ref", "back_ref", "road_class", F.struct(_micro(F.col("_d2")).alias("d"), F.col("i").alias("i")).alias("place"), F.when(F.col("total_m") > 0, (F.col("start_m") + F.col("_f") * F.col("len_m")) / F.col("total_m")).otherwise(0.0).alias("along"),
        (F.col("ax") + F.col("_dx") * F.col("_f")).alias("road_lon"), (F.col("ay") + F.col("_dy") * F.col("_f")).alias("road_lat"), "direction",
    ]


def _micro(d2: Column) -> Column:
    return F.floor(d2 * 1e6)


def segment_hits(points: DataFrame, roads: DataFrame, radius_m: float, cell: float = CELL, how: str = "inner") -> DataFrame:
    """points (with lon and lat) joined with the segments within radius_m by the plane, a little more included.

    Points that meet several segments of one road have a row for each; road_lon is on the
    point's side of the 180th meridian, be it beyond 180 degrees; how="left"
    keeps points that meet none. One equi-join, nothing else is shuffled; the listed
    segments are written first, since Spark can't tell their number from that of the roads,
    and broadcasts them only if they are few. Adds
    geom_id, fwd_ref, back_ref, road_class, place (segments of a road in order of
    nearness), along (fraction of the road), road_lon, road_lat, direction.

    Expressions are kept small: the JVM doesn't compile generated methods beyond 8,000
    bytes, and interpreting them costs tens of times as much.
    """
    near = materialize(_near(points, roads, radius_m, cell), "segments")
    return _met(points, near, radius_m, cell, how).select("_own.*", *_hit())


def radius_join(points: DataFrame, roads: DataFrame, radius_m: float, cell: float = CELL, written: bool = False) -> DataFrame:
    """points joined with the directed road points within radius_m.

    points needs lon and lat; its other columns pass through. Adds geom_id, ref_id,
    is_forward, fraction (along the direction), distance_m, road_lon, road_lat,
    azimuth, road_class, length_m (of the road). A pair gives one row for each direction of the road. Points are
    read for their squares and for the join, so they are written first, unless the caller
    tells that reading them is all there is to do (written).
    """
    points = points if written else materialize(points, "points")
    return _directed(_pairs(points, roads, radius_m, cell))


def _pairs(points: DataFrame, roads: DataFrame, radius_m: float, cell: float) -> DataFrame:
    """Each point, as _wf_own, with each road within radius_m of it."""
    pairs = _nearest_segments(points, roads, radius_m, cell)
    return geo.measured(pairs, "distance_m", "lon", "lat", "road_lon", "road_lat").where(F.col("distance_m") <= radius_m)


def _back_ref() -> Column:
    return F.nullif(F.trim("back_ref"), F.lit(""))


def _directed(pairs: DataFrame) -> DataFrame:
    """A row for each direction of the road of each of _pairs."""
    along, direction = F.col("along"), F.col("direction")
    forward = F.struct(F.col("fwd_ref").alias("ref_id"), F.lit(True).alias("is_forward"), along.alias("fraction"), direction.alias("azimuth"))
    backward = F.struct(_back_ref().alias("ref_id"), F.lit(False).alias("is_forward"), (1 - along).alias("fraction"), F.pmod(direction + 180, F.lit(360.0)).alias("azimuth"))
    both = pairs.withColumn("way", F.explode(F.array(forward, backward))).where("way.ref_id IS NOT NULL")
    return both.select("_wf_own.*", "geom_id", "way.*", "distance_m", geo.short_way(F.col("road_lon")).alias("road_lon"), "road_lat", "road_class", F.col("total_m").alias("length_m"))


def _nearest_segments(points: DataFrame, roads: DataFrame, radius_m: float, cell: float) -> DataFrame:
    """points, as lon, lat and _wf_own, with the nearest segment of each road within radius_m.

    A point's cell lists all segments of a road that may be near it. One that has at most
    one other segment of its road beside it there carries that one's ends, and a pair is
    judged where it is met; only pairs with three or more segments in a cell are shuffled.
    """
    cells = W.partitionBy("cx", "cy", "geom_id")
    order = cells.orderBy("i", "ax", "ay")
    near = _near(points, roads, radius_m, cell).withColumn("_here", F.struct("ax", "ay", "_dx", "_dy"))
    near = near.withColumns({"_nth": F.row_number().over(order), "_of": F.count("*").over(cells), "_other": F.coalesce(F.lead("_here").over(order), F.lag("_here").over(order))})
    other = {"_ox": "ax", "_oy": "ay", "_odx": "_dx", "_ody": "_dy"}
    near = materialize(near.withColumns({c: F.when(F.col("_of") == 2, F.col("_other")[v]) for c, v in other.items()}).drop("_here", "_other"), "segments")
    own = points.select("lon", "lat", F.struct(*points.columns).alias("_wf_own"))
    told = ["_own.lon", "_own.lat", "_own._wf_own", "total_m"]
    few = _met(own, near.where("_of <= 2"), radius_m, cell)
    off = F.when(F.col("_of") == 2, _off(_foot("_o", "_od"), "_o", "_od"))
    few = few.withColumn("_off", F.explode(F.array(off)))
    nearer = (_micro(F.col("_off")) < _micro(F.col("_d2"))) | ((_micro(F.col("_off")) == _micro(F.col("_d2"))) & (F.col("_nth") == 2))
    found = few.where(~F.coalesce((F.col("_off") <= (radius_m * 1.01) ** 2) & nearer, F.lit(False))).select(*told, *_hit()).drop("place")
    several = near.where("_of > 2")
    if several.isEmpty():
        return found
    hits = _met(own.withColumn("_wf_row", F.monotonically_increasing_id()), several, radius_m, cell).select("_own._wf_row", *told, *_hit())
    best = hits.groupBy("_wf_row", "geom_id").agg(F.min_by(F.struct(*(c for c in hits.columns if c not in ("_wf_row", "place"))), "place").alias("hit"))
    return found.unionByName(best.select("hit.*"))


def _rounds(points: DataFrame, roads: DataFrame, key: str, radius_m: float, max_radius_m: float | None, cell: float, find) -> DataFrame:
    """What find(points, radius, cell) finds, with a radius that doubles for points without enough.

    find also tells in _enough whether a row's point is served. Each round's finds and the points that are left are written out, so that no round
    repeats an earlier one. Without a maximum, rounds go on until no point is left or
    the radius spans the Earth.
    """
    most = FARTHEST_M if max_radius_m is None else max_radius_m
    left, radius, done = materialize(points, "points"), radius_m, None
    while True:
        found = materialize(find(left, radius, max(cell, radius / 50_000.0)), "near")
        if radius >= most:
            ready = found.drop("_enough")
        else:
            served = found.where("_enough")
            ready = served.drop("_enough")
            left = materialize(left.join(served.select(key).distinct(), key, "left_anti"), "left")
        done = ready if done is None else done.unionByName(ready)
        if radius >= most or left.isEmpty() or (max_radius_m is None and roads.isEmpty()):
            return done
        radius = min(radius * 2, most)


def knn_join(points: DataFrame, roads: DataFrame, key: str, k: int, radius_m: float = 100.0, max_radius_m: float | None = None, cell: float = CELL) -> DataFrame:
    """The k nearest directed road points of each point, with their rank from 1.

    Starts with radius_m and doubles it for points that found fewer than k; the last
    round is at max_radius_m itself, and points beyond that keep what they have.
    Ties go to the smaller ref_id. Distances are planar: not meant for continents.
    """
    order = W.partitionBy(key).orderBy("distance_m", "ref_id")
    enough = (F.count("*").over(W.partitionBy(key)) >= k) & F.col(key).isNotNull()
    find = lambda left, radius, cell: radius_join(left, roads, radius, cell, written=True).withColumns({"rank": F.row_number().over(order), "_enough": enough}).where(F.col("rank") <= k)
    return _rounds(points, roads, key, radius_m, max_radius_m, cell, find)


def nearest_join(points: DataFrame, roads: DataFrame, key: str, radius_m: float = 100.0, max_radius_m: float | None = None, cell: float = CELL) -> DataFrame:
    """All directed road points at the least distance of each point; the radius doubles as in knn_join.

    Roads are compared before their directions are told, by a least distance that needs no order.
    """
    least = F.min("distance_m").over(W.partitionBy(F.col("_wf_own")[key]))

    def find(left, radius, cell):
        pairs = _pairs(left, roads, radius, cell).where(F.col("fwd_ref").isNotNull() | _back_ref().isNotNull())
        nearest = pairs.withColumn("_least", least).where(F.col("distance_m") == F.col("_least")).drop("_least")
        return _directed(nearest).withColumn("_enough", F.col(key).isNotNull())

    return _rounds(points, roads, key, radius_m, max_radius_m, cell, find)


def demanded_roads(points: DataFrame, roads: DataFrame, zoom: int = tile.DATA_ZOOM) -> DataFrame:
    """The roads with an end in a tile that some point lies in."""
    tiles = points.select(tile.tile_id(F.col("lon"), F.col("lat"), zoom).alias("tile")).distinct()
    placed = roads.withColumn("tile", F.explode(tile.record_tiles(F.col("geometry"), zoom)))
    return placed.join(tiles, "tile", "left_semi").drop("tile").dropDuplicates(["geom_id"])


def snap(points: DataFrame, roads: DataFrame, key: str, radius_m: float = 10.0, written: bool = False) -> DataFrame:
    """Each point's nearest eligible directed road point, at most one; no match, no row.

    A direction is eligible if the point lies on its driving side, as told by the
    azimuths from road to point (n) and of the road (a), compared to a millionth of
    a degree: (n > 90 and n - a >= 0) or (a - 360 + n <= 90).
    """
    found = radius_join(points, roads, radius_m, written=written)
    micro = lambda c: F.floor(c * 1e6 + 0.5) / 1e6
    n = micro(geo.azimuth(F.col("road_lon"), F.col("road_lat"), F.col("lon"), F.col("lat")))
    a = micro(F.col("azimuth"))
    found = found.withColumn("_turns", F.explode(F.array(F.struct(n.alias("n"), a.alias("a")))))  # bound once
    n, a = F.col("_turns.n"), F.col("_turns.a")
    eligible = ((n > 90) & (n - a >= 0)) | (a - 360 + n <= 90)
    millimetres = F.floor(F.col("distance_m") * 1000 + 0.5)  # what is nearer by less is equally near
    order = W.partitionBy(key).orderBy(millimetres, "ref_id")
    return found.where(eligible).withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn", "_turns")
