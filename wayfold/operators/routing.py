"""Routes between many positions at once, and routes as rows.

A position is a place on a directed edge: ref_id and fraction. The search is
delta-stepping on frames: a label is what a source pays to a node and the edge it came
by. Of each source's open labels those within delta of its cheapest are relaxed together,
by one join with the edges, one aggregate and one join with the labels known; what they
improve is open again. A round is written out, so plans stay short and a lost executor
costs a round at most; only whether labels are open reaches the driver. There is no limit
on edges of a route, only on its cost.

Such rounds send all labels known to and fro. Where edges have a geometry and no delta is
given, the network is written once by tile instead (graphstore), sources are dealt by the
tile they start in, and each is searched within its task, which opens the tiles that are
reached: what is shuffled are the edges, once, and the sources. A task holds the labels of
one source at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.operators import graphstore, network
from wayfold.shared import materialize

_LABEL = ["source", "node", "cost", "metres", "via", "back"]


def labels(edge_rows: DataFrame, starts: DataFrame, bound: float, cost: str = "length_m", delta: float | None = None) -> DataFrame:
    """(source, node, cost, metres, via, back): what each source pays at least to each node within bound.

    starts has source, node, cost, metres and via (the edge, or null) with back null. via
    is the edge that leads to the node and back the node before; ties go to the smaller
    via, then back. delta is how far labels of a source are relaxed in one round: much of
    bound means fewer rounds, and more labels that a later round improves.
    """
    if delta is None and "geometry" in edge_rows.columns:
        return searched(edge_rows, starts, bound, cost)
    delta = bound if delta is None else delta
    steps = edge_rows.where(F.col(cost) >= 0).select(F.col("src").alias("node"), F.col("dst"), F.col("ref_id"), F.col(cost).alias("_c"), F.col("length_m").alias("_m"))
    steps = materialize(steps, "steps")
    label = F.struct("cost", "via", "back", "metres")
    best = materialize(starts.where(F.col("cost") <= bound).groupBy("source", "node").agg(F.min(label).alias("l")).select("source", "node", "l.*").select(*_LABEL), "labels")
    left = best
    while not left.isEmpty():
        lowest = left.groupBy("source").agg(F.min("cost").alias("_from"))
        dealt = left.join(lowest, "source").withColumn("_now", F.col("cost") <= F.col("_from") + delta)
        now, later = dealt.where("_now"), dealt.where("NOT _now").select(*_LABEL)
        tried = now.join(steps, "node").select("source", F.col("dst").alias("node"), (F.col("cost") + F.col("_c")).alias("cost"), (F.col("metres") + F.col("_m")).alias("metres"), F.col("ref_id").alias("via"), F.col("node").alias("back"))
        tried = tried.where(F.col("cost") <= bound).groupBy("source", "node").agg(F.min(label).alias("l")).select("source", "node", "l.*")
        known = best.select("source", "node", F.col("cost").alias("_known"))
        better = tried.join(known, ["source", "node"], "left").where("_known IS NULL OR cost < _known").select(*_LABEL)
        better = materialize(better, "better")
        left = materialize(later.join(better.select("source", "node"), ["source", "node"], "left_anti").unionByName(better), "open")
        best = materialize(best.join(better.select("source", "node"), ["source", "node"], "left_anti").unionByName(better), "labels")
    return best


def searched(edge_rows: DataFrame, starts: DataFrame, bound: float, cost: str = "length_m", with_path: bool = False) -> DataFrame:
    """labels() by searches within tasks, with path (as paths() tells it) on demand: edges need a geometry."""
    path = graphstore.write_edges(edge_rows.where((F.col(cost) >= 0) & (F.size("geometry") > 0)), F.col(cost))
    spark = edge_rows.sparkSession
    tiles = spark.read.parquet(path).where("ref_id IS NOT NULL").groupBy(F.col("src").alias("node")).agg(F.min("tile").cast("long").alias("tile"))
    label = F.min(F.struct("cost", "via", "metres"))
    own = starts.where(F.col("cost") <= bound).groupBy("source", "node").agg(label.alias("l")).join(tiles, "node", "left")
    own = own.groupBy("source").agg(F.collect_list(F.struct("node", "tile", "l.cost", "l.metres", "l.via")).alias("starts"), F.min("tile").alias("tile"))
    # searching is work, however few the bytes
    own = own.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "tile", "source").select("source", "starts")
    source, node = (starts.schema[c].dataType.simpleString() for c in ("source", "node"))

    names, more = [*_LABEL, *(["path"] if with_path else [])], ", path array<string>" if with_path else ""

    def run(batches):
        import pyarrow as pa

        from wayfold.operators import kernel

        for batch in batches:
            of = {c: batch.schema.field("starts").type.value_type.field("node").type for c in ("node", "back")} | {"source": batch.schema.field("source").type, "via": pa.string(), "path": pa.list_(pa.string())}
            rows: list[tuple] = []
            graph = graphstore.opened(path)
            for k, (s, begun) in enumerate(zip(batch.column("source").to_pylist(), batch.column("starts").to_pylist()), 1):
                done = kernel.settled(graph, begun, bound)
                graph.make_room()
                led = [(p,) for p in kernel.settled_paths(done)] if with_path else [()] * len(done)
                rows += [(s, n, *told, *p) for (n, told), p in zip(done.items(), led)]
                if rows and (len(rows) >= 10_000 or k == batch.num_rows):
                    yield pa.RecordBatch.from_arrays([pa.array(c, of.get(name, pa.float64())) for c, name in zip(zip(*rows), names)], names=names)
                    rows = []

    return own.mapInArrow(run, f"source {source}, node {node}, cost double, metres double, via string, back {node}{more}")


def paths(found: DataFrame) -> DataFrame:
    """(source, node, path): the edges that lead to each label, from its source on, by pointer doubling."""
    out = found.select("source", "node", F.col("back").alias("up"), F.when(F.col("via").isNull(), F.array().cast("array<string>")).otherwise(F.array("via")).alias("path"))
    out = materialize(out, "paths")
    while not out.where("up IS NOT NULL").isEmpty():
        above = out.select("source", F.col("node").alias("up"), F.col("up").alias("_up"), F.col("path").alias("_path"))
        out = materialize(out.join(above, ["source", "up"], "left").select("source", "node", F.col("_up").alias("up"), F.concat(F.coalesce("_path", F.array().cast("array<string>")), "path").alias("path")), "paths")
    return out


def routes(edge_rows: DataFrame, sources: DataFrame, targets: DataFrame, bound: float, cost: str = "length_m", delta: float | None = None) -> DataFrame:
    """(source, target, cost, metres, path) of the cheapest route from each source to each target within bound.

    sources has source, ref_id, fraction; targets target, ref_id, fraction. A target
    ahead on the source's own edge is reached along it; one behind around a loop.
    edge_rows has the column cost, of which a route pays its share of the first and last edge.
    """
    edge = edge_rows.select("ref_id", "src", "dst", F.col(cost).alias("_c"), F.col("length_m").alias("_m"))
    begun = materialize(sources.select("source", "ref_id", "fraction").join(edge, "ref_id"), "sources")
    ended = materialize(targets.select("target", "ref_id", F.col("fraction").alias("to")).join(edge, "ref_id"), "targets")
    rest = 1 - F.col("fraction")
    starts = begun.select("source", F.col("dst").alias("node"), (F.col("_c") * rest).alias("cost"), (F.col("_m") * rest).alias("metres"), F.col("ref_id").alias("via"), F.lit(None).cast(edge.schema["src"].dataType).alias("back"))
    local = delta is None and "geometry" in edge_rows.columns
    found = materialize(searched(edge_rows, starts, bound, cost, with_path=True), "labels") if local else labels(edge_rows, starts, bound, cost, delta)
    around = found.join(ended, F.col("node") == F.col("src")).select("source", "target", (F.col("cost") + F.col("_c") * F.col("to")).alias("cost"), (F.col("metres") + F.col("_m") * F.col("to")).alias("metres"), "node", F.col("ref_id").alias("last"))
    share = F.col("to") - F.col("fraction")
    ahead = begun.join(ended.select("target", "ref_id", "to"), "ref_id").where(share >= 0).select("source", "target", (F.col("_c") * share).alias("cost"), (F.col("_m") * share).alias("metres"), F.lit(None).cast(edge.schema["src"].dataType).alias("node"), F.col("ref_id").alias("last"))
    every = ahead.unionByName(around).where(F.col("cost") <= bound)
    best = materialize(every.groupBy("source", "target").agg(F.min(F.struct("cost", "node", "last", "metres")).alias("b")).select("source", "target", "b.*"), "routes")
    led = best.join(found.select("source", "node", "path") if local else paths(found), ["source", "node"], "left")
    return led.select("source", "target", "cost", "metres", F.concat(F.coalesce("path", F.array().cast("array<string>")), F.array("last")).alias("path"))


def valid_routes(parts: DataFrame, edge_rows: DataFrame, *keys: str, order: str = "place") -> DataFrame:
    """(keys, valid): whether each edge of a route follows the one before; a lone edge is a route.

    parts has keys, ref_id and the place of an edge, a whole number; places that lack an
    edge between two make a route invalid. Pairs are judged by joins, none is gathered.
    """
    steps = network.adjacency(edge_rows).distinct().withColumn("_leads", F.lit(True))
    onward = parts.select(*keys, (F.col(order) - 1).alias(order), F.col("ref_id").alias("next_ref"))
    pairs = parts.select(*keys, order, "ref_id").join(onward, [*keys, order], "left").join(steps, ["ref_id", "next_ref"], "left")
    last = pairs.groupBy(*keys).agg(F.max(order).alias("_last"), F.sum((F.col("_leads").isNull()).cast("int")).alias("_broken"))
    return last.select(*keys, (F.col("_broken") == 1).alias("valid"))  # the last edge alone leads to none


def measured_routes(parts: DataFrame, edge_rows: DataFrame, *keys: str, cost: str = "cost_time_priority") -> DataFrame:
    """(keys, metres, cost) of routes whose parts have ref_id, start_fraction and end_fraction."""
    share = F.col("end_fraction") - F.col("start_fraction")
    own = parts.join(edge_rows.select("ref_id", "length_m", F.col(cost).alias("_c")), "ref_id")
    return own.groupBy(*keys).agg(F.sum(F.col("length_m") * share).alias("metres"), F.sum(F.col("_c") * share).alias("cost"))


def joined_routes(first: DataFrame, second: DataFrame, edge_rows: DataFrame, *keys: str, order: str = "place") -> DataFrame:
    """Parts of the routes of first continued by those of second with the same keys, where they meet.

    They meet at one point of an edge, or where an edge ends and a next one starts;
    others give no row. Both have keys, place, ref_id, start_fraction, end_fraction.
    """
    near = 1e-8
    place = F.struct("ref_id", "start_fraction", "end_fraction")
    ends = first.groupBy(*keys).agg(F.max_by(place, order).alias("a"), F.max(order).alias("_last"))
    begins = second.groupBy(*keys).agg(F.min_by(place, order).alias("b"), F.min(order).alias("_first"))
    steps = network.adjacency(edge_rows).distinct().select(F.col("ref_id").alias("_a"), F.col("next_ref").alias("_b"), F.lit(True).alias("_leads"))
    met = ends.join(begins, [*keys]).withColumns({"_a": F.col("a.ref_id"), "_b": F.col("b.ref_id")}).join(steps, ["_a", "_b"], "left")
    inside = (F.col("_a") == F.col("_b")) & (F.abs(F.col("a.end_fraction") - F.col("b.start_fraction")) < near)
    at_node = F.col("_leads").isNotNull() & (F.abs(F.col("a.end_fraction") - 1) < near) & (F.abs("b.start_fraction") < near)
    met = materialize(met.where(inside | at_node).select(*keys, inside.alias("_inside"), "_last", "_first", F.col("b.end_fraction").alias("_end")), "met")
    ahead = first.join(met, [*keys]).withColumn("end_fraction", F.when(F.col("_inside") & (F.col(order) == F.col("_last")), F.col("_end")).otherwise(F.col("end_fraction")))
    shift = F.col("_last") - F.col("_first") + F.when(F.col("_inside"), 0).otherwise(1)
    after = second.join(met, [*keys]).where(~F.col("_inside") | (F.col(order) > F.col("_first"))).withColumn(order, F.col(order) + shift)
    columns = [*keys, order, "ref_id", "start_fraction", "end_fraction"]
    return ahead.select(*columns).unionByName(after.select(*columns))
