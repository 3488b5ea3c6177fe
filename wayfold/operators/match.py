"""Map matching: candidates by a distributed join, the rest in one task per trace."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.config import MatchConfig
from wayfold.operators import graphstore, spatial
from wayfold.schema import MATCHED

#: Deals of traces for each task of the matching: some tasks have more of them than others.
DEALS = 2
_CANDIDATE = ["fwd_ref", "back_ref", "place", "along", "road_lon", "road_lat"]


def _samples(points: DataFrame, roads: DataFrame, config: MatchConfig, key: str) -> DataFrame:
    """One row for each sample and road segment near it, or with nulls where there is none.

    This is the candidate join alone: samples are put together by their trace's task,
    where _n tells repeated ones apart.
    """
    has = F.coalesce(F.size("event_data") > 0, F.lit(False)) if "event_data" in points.columns else F.lit(False)
    deal = ["_deal"] if "_deal" in points.columns else []
    own = points.where(F.col("time_ms").isNotNull()).select(F.monotonically_increasing_id().alias("_n"), F.col(key), "time_ms", "lon", "lat", has.alias("has_event"), *deal)
    return spatial.segment_hits(own, graphstore.named_roads(roads), config.radius_m, how="left").select(key, "time_ms", "lon", "lat", "has_event", "_n", "geom_id", *_CANDIDATE, *deal)


def sample_rows(group):
    """Rows of an Arrow group of _samples, as trace_of takes them; numbers go through numpy, in a tenth of the time that they take one by one.

    Where no road is near, numbers of the candidate are NaN, which nothing reads.
    """
    import pyarrow as pa

    def listed(values, of_candidate):
        number = pa.types.is_integer(values.type) or pa.types.is_floating(values.type)
        return values.to_numpy().tolist() if number and (of_candidate or not values.null_count) else values.to_pylist()

    columns = {c: listed(group.column(c), c in _CANDIDATE) for c in ("time_ms", "lon", "lat", "has_event", "_n", "geom_id", *_CANDIDATE) if c != "place"}
    d, i = (pa.chunked_array([c]) for c in group.column("place").combine_chunks().flatten())
    columns["place"] = [{"d": a, "i": b} for a, b in zip(listed(d, True), listed(i, True))]
    return zip(*(columns[c] for c in ("time_ms", "lon", "lat", "has_event", "_n", "geom_id", *_CANDIDATE)))


def trace_of(rows, graph, radius_m: float, numbered: bool = False) -> list[tuple]:
    """Samples (time_ms, lon, lat, has_event, candidates) in order, of rows as _samples gives them.

    Of several segments of a road near a sample the nearest counts; each direction of
    the road is a candidate (edge, fraction, metres, lon, lat). numbered adds _n at the end.
    """
    from wayfold.operators import kernel

    samples: dict[tuple, dict] = {}
    for *sample, geom, forward, backward, place, along, x, y in rows:
        found = samples.setdefault(tuple(sample), {})
        if geom is not None and (geom not in found or (place["d"], place["i"]) < found[geom][0]):
            found[geom] = ((place["d"], place["i"]), forward, backward, along, x, y)
    trace = []
    for (t, lon, lat, has, n), found in sorted(samples.items(), key=lambda s: (s[0][:3], s[0][4])):
        candidates = []
        for _, forward, backward, along, x, y in found.values():
            metres = kernel.planar_m(lon, lat, x, y)
            if metres <= radius_m:
                candidates += [(e, f, metres, x, y) for r, f in ((forward, along), (backward, 1 - along)) if r is not None and (e := graph.find(r)) is not None]
        trace.append((t, lon, lat, has, candidates, *([n] if numbered else [])))
    return trace


def dealt(points: DataFrame, key: str) -> DataFrame:
    """points with _deal: a number of traces whose first samples lie near each other.

    Traces are ranged by the tile of their first sample, so a city with most of them has
    many numbers; only one row for each trace is sorted for that.
    """
    known = points.where(F.col("time_ms").isNotNull())
    where = graphstore.tile_number(F.struct("lon", "lat"))
    first = known.groupBy(F.col(key).alias("_trace")).agg(F.min(F.struct("time_ms", where.alias("tile")))["tile"].alias("_tile"))
    n = DEALS * int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deals = first.repartitionByRange(n, "_tile", "_trace").select("_trace", F.spark_partition_id().alias("_deal"))
    return known.join(deals, F.col(key).eqNullSafe(F.col("_trace"))).drop("_trace")


def as_table(rows: list[dict], schema: str, **constant):
    """Rows of dicts as an Arrow table of a schema given as `name type, ...`."""
    import pyarrow as pa

    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.Table.from_arrays([pa.repeat(pa.scalar(constant[c], kinds[kind]), len(rows)) if c in constant else pa.array([r.get(c) for r in rows], kinds[kind]) for c, kind in fields], names=[c for c, _ in fields])


def match(points: DataFrame, roads: DataFrame, config: MatchConfig = MatchConfig(), key: str = "vehicle_id", graph: str | None = None) -> DataFrame:
    """Flat rows of schema MATCHED for all traces; see kernel.match_trace for kinds.

    points needs key, time_ms, lon, lat and may have event_data. graph is what
    graphstore.write gave for these roads; without it the graph is written first. Tasks
    open the tiles that their searches reach, and traces that begin near each other are
    dealt to one task, so that it has to open few. A trace is one group; match_trips and
    pieces.match_long cut it.
    """
    from wayfold.operators import kernel

    path = graph or graphstore.write(roads)
    samples = _samples(dealt(points, key), roads, config, key)
    schema = MATCHED.replace("vehicle_id", key, 1)

    def run(group):
        opened = graphstore.opened(path, config.connect)
        trace = trace_of(sample_rows(group), opened, config.radius_m)
        return as_table(kernel.match_trace(trace, opened, config), schema, **{key: group.column(key)[0].as_py()})

    # matching is work, however few the bytes
    samples = samples.repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_deal")
    return samples.groupBy("_deal", key).applyInArrow(run, schema)


def match_offline(points: DataFrame, roads: DataFrame, config: MatchConfig = MatchConfig(), min_distance_m: float = 10.0, min_interval_ms: int = 5000, key: str = "vehicle_id") -> DataFrame:
    """match() of whole traces after thinning by either distance or time; no sample is thinned out later."""
    from dataclasses import replace

    from wayfold.operators.traces import thin

    return match(thin(points, min_distance_m, min_interval_ms, key, either=True), roads, replace(config, min_distance_m=0.0, min_interval_ms=0), key)


def match_trips(points: DataFrame, roads: DataFrame, config: MatchConfig = MatchConfig(), gap_ms: int = 600_000, key: str = "vehicle_id") -> DataFrame:
    """match() with traces cut where no sample comes for gap_ms: a vehicle's years are many groups, not one. Adds trip."""
    from wayfold.operators.traces import split_traces

    cut = split_traces(points, gap_ms, key).withColumn("_trip", F.to_json(F.struct(F.col(key).alias("k"), "trip")))
    matched = match(cut, roads, config, "_trip")
    told = F.from_json("_trip", f"k {points.schema[key].dataType.simpleString()}, trip long")
    return matched.select(told["k"].alias(key), told["trip"].alias("trip"), *(c for c in matched.columns if c != "_trip"))


def speed_edges(matched: DataFrame) -> DataFrame:
    return matched.where("kind = 'speed'")


def snapped_events(matched: DataFrame) -> DataFrame:
    """Matched samples with event data: ref_id, fraction and time; the kind that binning takes."""
    return matched.where("kind = 'snapped'").withColumnRenamed("end_fraction", "fraction")


def failures(matched: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """Closed failure runs: (key, run, start_ref, end_ref, start_fraction, end_fraction, n_points, lonlats)."""
    points = F.array_sort(F.collect_list(F.struct(F.col("time_ms").alias("t"), "lon", "lat")))
    out = matched.where("kind = 'failure'").groupBy(key, F.col("seq").alias("run"), "start_ref", "end_ref", "start_fraction", "end_fraction").agg(F.count("*").alias("n_points"), points.alias("p"))
    return out.withColumn("lonlats", F.flatten(F.transform("p", lambda x: F.array(x["lon"], x["lat"])))).drop("p")


def align_error(truth: DataFrame, matched: DataFrame, edges: DataFrame, key: str = "vehicle_id", ref: str = "ref_id", seq: str = "seq") -> DataFrame:
    """(key, unmatched_m, error): how far the matched edge sequence is from the true one."""
    from wayfold.operators import kernel

    lengths = edges.select(ref, "length_m")
    both = [df.select(key, seq, ref, F.lit(side).alias("side")) for side, df in enumerate((truth, matched))]
    rows = both[0].unionByName(both[1]).join(lengths, ref)

    def compare(group):
        import pyarrow as pa

        listed = sorted(zip(*(group.column(c).to_pylist() for c in ("side", seq, ref, "length_m"))))
        sides = [[r[2] for r in listed if r[0] == side] for side in (0, 1)]
        metres, error = kernel.align(*sides, {r[2]: r[3] for r in listed})
        return pa.table({key: pa.array([group.column(key)[0].as_py()], pa.string()), "unmatched_m": [metres], "error": [error]})

    return rows.groupBy(key).applyInArrow(compare, f"{key} string, unmatched_m double, error double")


def align_pairs(truth: DataFrame, matched: DataFrame, edges: DataFrame, key: str = "vehicle_id", ref: str = "ref_id", seq: str = "seq") -> DataFrame:
    """(key, true_seq, matched_seq, ref): which edges of two sequences belong together, leaving least length unmatched.

    A trace is a group, in the space of its sequences: see kernel.aligned. Edges without
    a length are left out; a key that only one side has gives no row.
    """
    from wayfold.operators import kernel

    lengths = edges.select(ref, "length_m").dropDuplicates([ref])
    both = [df.select(key, F.col(seq).cast("long").alias("at"), ref, F.lit(side).alias("side")) for side, df in enumerate((truth, matched))]
    rows = both[0].unionByName(both[1]).join(lengths, ref).where(F.col("at").isNotNull())
    kind = rows.schema[key].dataType.simpleString()

    def pair(group):
        import pyarrow as pa

        listed = sorted(zip(*(group.column(c).to_pylist() for c in ("side", "at", ref))))
        sides = [[r[1:] for r in listed if r[0] == side] for side in (0, 1)]
        length = dict(zip(group.column(ref).to_pylist(), group.column("length_m").to_pylist()))
        pairs = kernel.aligned(*([r[1] for r in side] for side in sides), length)
        name = group.column(key)[0]
        return pa.table({key: pa.array([name.as_py()] * len(pairs), name.type), "true_seq": pa.array([sides[0][i][0] for i, _ in pairs], pa.int64()), "matched_seq": pa.array([sides[1][j][0] for _, j in pairs], pa.int64()), ref: pa.array([sides[0][i][1] for i, _ in pairs], pa.string())})

    return rows.groupBy(key).applyInArrow(pair, f"{key} {kind}, true_seq long, matched_seq long, {ref} string")
