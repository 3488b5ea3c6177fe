"""The road network as frames: roads, directed edges, adjacency, components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.functions import geo, roads
from wayfold.shared import materialize


def dedup_roads(rows: DataFrame, order: str = "tile") -> DataFrame:
    """One row for each geometry: the one of the first tile by text; deterministic."""
    first = rows.groupBy("geom_id").agg(F.min_by(F.struct(*rows.columns), order).alias("r"))
    return first.select("r.*")


def filter_roads(rows: DataFrame, excluded_classes: list[int] = (), ring: list[tuple[float, float]] | None = None, within: bool = False) -> DataFrame:
    """Without classes, and with some part inside the ring (lon, lat) if one is given.

    A road counts if it lies in the ring or crosses it, a vertex inside or not; with
    within, only if it lies in it wholly. A box test on plain columns comes first.
    """
    if excluded_classes:
        rows = rows.where(~F.col("road_class").isin(list(excluded_classes)))
    if ring:
        lons, lats = F.transform("geometry", lambda p: p["lon"]), F.transform("geometry", lambda p: p["lat"])
        xs, ys = zip(*ring)
        near = (F.array_min(lons) <= max(xs)) & (F.array_max(lons) >= min(xs)) & (F.array_min(lats) <= max(ys)) & (F.array_max(lats) >= min(ys))
        inside = lambda p: geo.contains(ring, p["lon"], p["lat"])
        crossed = F.exists(F.arrays_zip(F.slice("geometry", 1, F.size("geometry") - 1).alias("a"), F.slice("geometry", 2, F.size("geometry") - 1).alias("b")), lambda s: geo.crosses(ring, s["a"], s["b"]))
        some = F.size("geometry") >= 2
        fits = F.forall("geometry", inside) & ~(some & crossed) if within else F.exists("geometry", inside) | (some & crossed)
        rows = rows.where(near & fits)
    return rows


def edges(rows: DataFrame) -> DataFrame:
    """Two directed edges for each road, one where there is no back reference.

    Lengths, speeds and priorities come from geometry and class. A back edge has its
    ends swapped and its geometry reversed.
    """
    back = F.nullif(F.trim("back_ref"), F.lit(""))
    measured = rows.withColumns({"priority": roads.priority(F.col("road_class")), "max_speed": roads.free_flow_kmh(F.col("road_class")), "length_m": geo.length(F.col("geometry"))})
    forward = F.struct(F.col("fwd_ref").alias("ref_id"), F.lit(True).alias("is_forward"), F.col("from_node").alias("src"), F.col("to_node").alias("dst"), F.col("geometry").alias("geometry"))
    backward = F.struct(back.alias("ref_id"), F.lit(False).alias("is_forward"), F.col("to_node").alias("src"), F.col("from_node").alias("dst"), geo.reverse(F.col("geometry")).alias("geometry"))
    both = measured.withColumn("e", F.explode(F.array(forward, backward))).where("e.ref_id IS NOT NULL")
    return both.select("e.ref_id", "geom_id", "e.is_forward", "e.src", "e.dst", "road_class", "priority", "max_speed", "length_m", "e.geometry")


def adjacency(edge_rows: DataFrame) -> DataFrame:
    """(ref_id, next_ref): edges that start where an edge ends.

    Ends are written first: Spark takes edges to be as few bytes as the table that they
    are made from, and would broadcast them all.
    """
    ends = materialize(edge_rows.select("ref_id", "src", "dst"), "ends")
    a = ends.select("ref_id", F.col("dst").alias("node"))
    b = ends.select(F.col("src").alias("node"), F.col("ref_id").alias("next_ref"))
    return a.join(b, "node").select("ref_id", "next_ref")


def minset(candidates: DataFrame, edge_rows: DataFrame, *keys: str) -> DataFrame:
    """candidates (keys, ref_id, fraction, ...) of each key without those that stand for one node again.

    First go those at the start of an edge that follows another candidate's; of the
    rest, those at the end of an edge all of whose successors are among the rest. An
    edge comes once a key. Joins are on the edge and on key and edge; nothing is gathered.
    """
    near, on = 1e-8, [*keys, "ref_id"]
    candidates = materialize(candidates, "candidates")
    steps = adjacency(edge_rows)
    at_start, at_end = F.abs("fraction") < near, F.abs(F.col("fraction") - 1) < near
    follows = candidates.select(on).join(steps, "ref_id").select(*keys, F.col("next_ref").alias("ref_id"))
    rest = candidates.where(~at_start).unionByName(candidates.where(at_start).join(follows, on, "left_anti").select(candidates.columns))
    rest = materialize(rest, "rest")
    ends, left = rest.where(at_end), rest.select(*keys, F.col("ref_id").alias("next_ref"))
    onward = ends.select(on).join(steps, "ref_id").join(left, [*keys, "next_ref"], "left_anti").select(on)
    return rest.where(~at_end).unionByName(ends.join(onward, on, "left_semi").select(candidates.columns))


def costs(edge_rows: DataFrame) -> DataFrame:
    m, v, p = F.col("length_m"), F.col("max_speed"), F.col("priority")
    return edge_rows.withColumns({"cost_distance": roads.cost_distance(m), "cost_time": roads.cost_time(m, v), "cost_time_priority": roads.cost_time_priority(m, v, p)})


def route_geometry(parts: DataFrame, edge_rows: DataFrame, *keys: str, order: str = "place") -> DataFrame:
    """(keys, geometry, length_m, time_s) of routes.

    parts has ref_id, start_fraction, end_fraction and its place in the route; the
    first edge counts from its start fraction, the last to its end fraction. Vertices
    that two edges share come once.
    """
    shapes = edge_rows.select("ref_id", geo.segments(F.col("geometry")).alias("_segs"), "length_m", "max_speed")
    share = F.col("end_fraction") - F.col("start_fraction")
    cut = parts.join(shapes, "ref_id").select(*keys, order, geo.part(F.col("_segs"), F.col("start_fraction"), F.col("end_fraction")).alias("g"), (F.col("length_m") * share).alias("m"), (roads.cost_time(F.col("length_m"), F.col("max_speed")) * share).alias("s"))
    whole = cut.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, "g"))).alias("p"), F.sum("m").alias("length_m"), F.sum("s").alias("time_s"))
    line = F.flatten(F.transform("p", lambda x: x["g"]))
    fresh = F.filter(line, lambda p, i: (i == 0) | (F.abs(p["lon"] - F.get(line, i - 1)["lon"]) > 1e-12) | (F.abs(p["lat"] - F.get(line, i - 1)["lat"]) > 1e-12))
    return whole.select(*keys, fresh.alias("geometry"), "length_m", "time_s")


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): each node that a link names, and the smallest node it reaches.

    Every round points each node to the neighbour (or itself) that comes first in an order
    drawn anew by hashing, follows the pointers once more, and contracts the graph to where
    they lead: a fixed order would have graphs that shrink by a few nodes a round, here
    rounds are about the logarithm of the nodes. Each round is written to the shared folder,
    and nothing but whether links remain reaches the driver. The smallest node of each
    component is found last. Links of a node with itself and nulls are ignored. A hub's
    links are minima and thus pre-aggregated.
    """
    left = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    left = materialize(left, "links")
    rounds = []
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        drawn = lambda c: F.struct(F.xxhash64(F.lit(len(rounds)), c).alias("h"), F.col(c).alias("node"))  # noqa: B023, E731
        near = both.groupBy("a").agg(F.min(drawn("b")).alias("to")).select("a", F.least(drawn("a"), "to")["node"].alias("to"))
        onward = near.select(F.col("a").alias("to"), F.col("to").alias("then"))
        step = materialize(near.join(onward, "to").select(F.col("a").alias("node"), F.col("then").alias("root")), "roots")
        rounds.append(step)
        ends = step.select(F.col("node").alias("a"), F.col("root").alias("ra")), step.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = left.join(ends[0], "a").join(ends[1], "b").where("ra <> rb")
        left = materialize(moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = rounds.pop()
    for step in reversed(rounds):  # from the few nodes of the last rounds to all
        onward = found.select(F.col("node").alias("root"), F.col("root").alias("then"))
        found = step.join(onward, "root", "left").select("node", F.coalesce("then", "root").alias("root"))
    found = materialize(found, "components")
    return found.join(found.groupBy("root").agg(F.min("node").alias("least")), "root").select("node", F.col("least").alias("root"))


def components(rows: DataFrame) -> DataFrame:
    """(node, component): nodes that roads join, whatever their direction."""
    links = rows.select(F.col("from_node").alias("a"), F.col("to_node").alias("b"))
    alone = rows.select(F.explode(F.array("from_node", "to_node")).alias("node")).distinct()
    return alone.join(connected_components(links), "node", "left").select("node", F.coalesce("root", "node").alias("component"))


def shortest_costs(edge_rows: DataFrame, sources: DataFrame, bound: float, cost: str = "length_m", delta: float | None = None) -> DataFrame:
    """(source, node, cost): cheapest costs from each node of sources (column node) within bound, however many edges that takes."""
    from wayfold.operators.routing import labels

    kind, none = sources.schema["node"].dataType, F.lit(None)
    starts = sources.select(F.col("node").alias("source"), "node", F.lit(0.0).alias("cost"), F.lit(0.0).alias("metres"), none.cast("string").alias("via"), none.cast(kind).alias("back")).distinct()
    return labels(edge_rows, starts, bound, cost, delta).select("source", "node", "cost")
