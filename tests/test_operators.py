"""Expressions and plans on literals, and every query with SQL against DuckDB."""

import datetime
import glob
import json
import math
import os
import random
import time

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from wayfold.config import MatchConfig
from wayfold.functions import geo, roads, tile
from wayfold.functions import time as tm
from wayfold.operators import aggregate, match, network, spatial, traces
from wayfold.plans import batch, queries
from wayfold.schema import ROAD
from wayfold.sinks import tiles
from wayfold.streaming import replay


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_tiles_and_time(spark):
    assert one(spark, tile.tile_id(F.lit(-96.70976413), F.lit(32.981278)))[0] == "12-947-1650"
    assert one(spark, tile.tile_id(F.lit(-180.0), F.lit(90.0)), tile.tile_id(F.lit(180.0), F.lit(-90.0))) == ("12-0-0", "12-4095-4095")
    monday = 1704067200000  # 2024-01-01
    assert one(spark, tm.hour_of_week(F.lit(monday)), tm.hour_of_week(F.lit(monday - 3600000)), tm.week_text(F.lit(monday - 1))) == (0, 167, "2023-12-25")
    assert one(spark, tm.seconds_to_ms(F.lit(957139199)), tm.seconds_to_ms(F.lit(957139200))) == (957139199000, 957139200)
    assert one(spark, tm.hour_of_week(F.lit(-1)))[0] == 2 * 24 + 23


def test_speed_and_bins(spark):
    v = lambda x: F.lit(float(x))
    assert one(spark, roads.speed_bin(v(0)), roads.speed_bin(v(13.8889)), roads.segment_speed(v(10), F.lit(500), True), roads.segment_speed(v(10), F.lit(500))) == (0, 50, None, 20.0)
    for length, n in ((0, 1), (9.99, 1), (10, 2), (100, 11)):
        assert one(spark, roads.bins(v(length), 10.0))[0] == n
    assert one(spark, *(roads.bin_of(v(f), F.lit(4)) for f in (0, 0.25, 1.0, 1.0000001))) == (0, 1, 3, 3)
    assert one(spark, *(roads.colour_bin(v(x)) for x in (0, 7, 7.1, 99))) == (0, 0, 1, 7)
    with pytest.raises(Exception, match="no road class"):
        one(spark, roads.valid_class(F.lit(9)))


def test_geodesy(spark):
    # One degree along the equator and along the meridian from it; values of the ellipsoid.
    assert abs(one(spark, geo.distance(0, 0, 0.01, 0))[0] - 1113.1949079) < 1e-3
    assert abs(one(spark, geo.distance(0, 0, 0, 0.01))[0] - 1105.7427582) < 1e-3
    assert one(spark, geo.azimuth(0, 0, 0, 1), geo.azimuth(0, 0, 1, 0), geo.azimuth(0, 0, -1, 0)) == (0.0, 90.0, 270.0)
    same = F.lit(1.0)
    assert one(spark, geo.intercept(same, same, same, same, same, same), geo.distance(1, 1, 1, 1)) == (0.0, 0.0)


def test_long_geodesics(spark):
    """Arcs known in closed form or by quadrature, and the equations of geodesics integrated step by step."""
    import math

    from wayfold.functions.geo import E2, A

    def meridian(lat):
        n = 2000
        f = lambda x: A * (1 - E2) / (1 - E2 * math.sin(x) ** 2) ** 1.5
        h = math.radians(lat) / n
        return h / 3 * sum((1 if k in (0, n) else 4 if k % 2 else 2) * f(k * h) for k in range(n + 1))

    assert abs(one(spark, geo.inverse(10, 0, 10, 90))[0].metres - meridian(90)) < 1e-3 and abs(meridian(90) - 10001965.729) < 1e-3
    assert abs(one(spark, geo.inverse(-20, 0, 25, 0))[0].metres - A * math.radians(45)) < 1e-6
    over = one(spark, geo.inverse(179, 10, -179, 10), geo.inverse(-1, 10, 1, 10))
    assert abs(over[0].metres - over[1].metres) < 1e-6 and over[0].azimuth == pytest.approx(over[1].azimuth)
    assert tuple(one(spark, geo.inverse(5, 6, 5, 6))[0])[0] == 0.0 and one(spark, geo.inverse(0, 0.0, 179.9, 0.1))[0] is None

    def walk(lon, lat, azimuth, metres, n=4000):
        def slope(p):
            lat, _, az = p
            w = math.sqrt(1 - E2 * math.sin(lat) ** 2)
            return math.cos(az) * w**3 / (A * (1 - E2)), math.sin(az) * w / (A * math.cos(lat)), math.sin(az) * math.tan(lat) * w / A

        p, h = (math.radians(lat), math.radians(lon), math.radians(azimuth)), metres / n
        add = lambda p, k, s: tuple(x + s * d for x, d in zip(p, k))
        for _ in range(n):
            a = slope(p)
            b = slope(add(p, a, h / 2))
            c = slope(add(p, b, h / 2))
            d = slope(add(p, c, h))
            p = tuple(x + h / 6 * (i + 2 * j + 2 * k + m) for x, i, j, k, m in zip(p, a, b, c, d))
        return math.degrees(p[1]), math.degrees(p[0]), math.degrees(p[2])

    for lon, lat, azimuth, metres in ((-73.8, 40.6, 51.2, 5_000_000.0), (10.0, -55.0, 200.0, 3_000_000.0), (0.0, 0.0, 90.0, 1000.0), (30.0, 60.0, 300.0, 5_000_000.0)):
        x, y, arrival = walk(lon, lat, azimuth, metres)
        there, back = one(spark, geo.direct(lon, lat, azimuth, metres), geo.inverse(lon, lat, x, y))
        assert abs(there.lat - y) < 1e-8 and abs(there.lon - x) < 1e-8 and abs((there.arrival - arrival + 180) % 360 - 180) < 1e-8
        assert abs(back.metres - metres) < 1e-3 and abs((back.azimuth - azimuth + 180) % 360 - 180) < 1e-6 and abs((back.arrival - arrival + 180) % 360 - 180) < 1e-6


def test_replay_of_an_archive_reads_its_own_seconds(spark, tmp_path, monkeypatch):
    import pyarrow.parquet as pq

    from wayfold.streaming import clock

    monkeypatch.setattr(clock, "GROUP_BYTES", 20_000)
    rows = spark.range(20_000).selectExpr("concat('v', id % 7) AS vehicle_id", "if(id % 500 = 3, null, 1000000 + id * 10) AS time_ms", "1D AS lat", "2D AS lon", "map('e', double(id)) AS event_data")
    clock.write_archive(rows, str(tmp_path / "archive"))
    known = rows.where("time_ms IS NOT NULL").count()
    began = int(time.time() * 1000)
    stream = clock.replay(spark, f"file://{tmp_path}/archive", speed=20.0, began_ms=began)  # 200 s in 10
    seen: dict[int, tuple[int, int, int]] = {}  # by batch: one that was stopped halfway comes again

    def run(until):
        q = stream.writeStream.foreachBatch(lambda df, n: seen.update({n: (df.count(), *df.agg(F.min("time_ms"), F.max("time_ms")).first())})).option("checkpointLocation", str(tmp_path / "c")).start()
        while sum(s[0] for s in seen.values()) < until and time.time() * 1000 - began < 90_000:
            time.sleep(0.1)
        q.stop()

    run(1)
    run(known)  # from the checkpoint on
    spans = [s for _, s in sorted(seen.items()) if s[0]]
    assert sum(s[0] for s in spans) == known and all(a[2] < b[1] for a, b in zip(spans, spans[1:]))
    schema = spark.read.parquet(str(tmp_path / "archive/events")).schema
    reader = clock._Reader({"path": f"file://{tmp_path}/archive", "time": "time_ms", "began": "0", "speed": "1", "columns": json.dumps(schema.names)})
    (span,) = reader.partitions({"time": 1_050_000}, {"time": 1_050_100})
    assert sum(b.num_rows for b in reader.read(span)) == 9  # one of the ten has no time
    file = pq.ParquetFile(span.file.removeprefix("file://"))
    assert len(reader.groups(span, file)) == 1 < file.metadata.num_row_groups or file.metadata.num_rows < 6000
    assert reader.latestOffset() == {"time": reader.last} and reader.partitions({"time": 5}, {"time": 5}) == []


def test_histograms_merge_in_any_order(spark):
    h = spark.createDataFrame([("r", 5, 1), ("r", 5, 2), ("r", 6, 3)], "ref_id string, speed_bin int, n long")
    merged = aggregate.merge_histograms(h, "ref_id")
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, aggregate.merge_histograms(aggregate.merge_histograms(h.limit(2), "ref_id").union(h.where("speed_bin = 6")), "ref_id").collect()))


def test_components_of_a_long_chain(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert network.connected_components(links).agg(F.max("root"), F.count("*")).first() == (0, 201)
    assert network.connected_components(links.limit(0)).count() == 0


def test_all_outputs(spark, sf, tmp_path):
    points = queries._points(spark, sf)
    outputs = batch.match_all(points, queries.grid(spark, sf))
    assert outputs["matched"].where("kind = 'speed'").count() > 100
    assert outputs["matched"].where("start_fraction < 0 OR end_fraction > 1").count() == 0
    batch.write_all(outputs, queries.grid(spark, sf), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/speeds")).count() > 0
    assert {os.path.basename(p) for p in glob.glob(str(tmp_path / "out/*"))} == {"speeds", "events", "dust", "traces"}


def test_nearest_reaches_the_largest_radius(spark):
    line = [{"lon": 10.0, "lat": 0.0}, {"lon": 10.0, "lat": 0.01}]
    roads_ = spark.createDataFrame([("r", "a", "b", "r_f", None, 3, line)], ROAD)
    points = spark.createDataFrame([(1, 10.0005, 0.005), (2, 10.005, 0.005), (3, 10.007, 0.005)], "id long, lon double, lat double")  # 56, 557 and 779 m
    assert sorted(r.id for r in spatial.nearest_join(points, roads_, "id", 100.0, 700.0).collect()) == [1, 2]
    assert sorted(r.id for r in spatial.knn_join(points, roads_, "id", 1, 100.0, 700.0).collect()) == [1, 2]


def whole_graph(roads_, connect=True):
    """kernel.Graph of all roads, by the names that candidates have."""
    from wayfold.operators import graphstore, kernel

    e = network.costs(network.edges(roads_)).join(graphstore.named_roads(roads_).select(F.explode(F.array("fwd_ref", "back_ref")).alias("name")).where("name IS NOT NULL"), F.col("ref_id") == F.substring_index("name", ":", -1)).collect()
    graph = kernel.Graph(*([r[c] for r in e] for c in ("ref_id", "src", "dst", "length_m", "cost_time_priority")), [None] * len(e), connect)
    names = {r.name: r.ref_id for r in e}
    graph.find = lambda name: graph.number.get(names.get(name, name))
    return graph


def matched_by_one(points, roads_, config):
    """The kernel over the whole network, trace by trace, on the driver."""
    from wayfold.operators import kernel

    graph, traces_ = whole_graph(roads_, config.connect), {}
    for r in match._samples(points, roads_, config, "vehicle_id").collect():
        traces_.setdefault(r[0], []).append(r[1:])
    return [(name, row) for name, rows in traces_.items() for row in kernel.match_trace(match.trace_of(rows, graph, config.radius_m), graph, config)]


def as_rows(pairs):
    from wayfold.schema import MATCHED

    columns = [c.split()[0] for c in MATCHED.split(", ")][1:]
    told = lambda v: round(v, 7) if isinstance(v, float) else v
    return sorted(((name, *(told(row.get(c)) for c in columns)) for name, row in pairs), key=str)


def test_matching_by_stored_tiles_gives_the_rows_of_the_whole_network(spark):
    """Edges that start tiles away, routes through tiles without samples, the 180th meridian, a node told in two places."""
    road = lambda name, a, b, *line: (name, a, b, f"{name}_f", f"{name}_b", 3, [{"lon": x, "lat": y} for x, y in line])
    rows = [road("long", "l0", "l1", (10.0, 60.0), (11.0, 60.0)), road("west", "w", "m", (179.99, 60.0), (180.0, 60.0)), road("east", "m", "e", (-180.0, 60.0), (-179.99, 60.0))]
    rows += [road(f"c{i}", f"n{i}", f"n{i + 1}", (10 + 0.018 * i, 60.2), (10 + 0.018 * (i + 1), 60.2)) for i in range(20)]
    at = [("by the long edge", 0, 10.5, 60.0), ("by the long edge", 30_000, 10.505, 60.0), ("by the long edge", 60_000, 10.51, 60.0)]
    at += [("far apart", 0, 10.001, 60.2), ("far apart", 300_000, 10.33, 60.2)]
    at += [("meridian", 0, 179.995, 60.0), ("meridian", 30_000, -179.995, 60.0), ("nowhere", 0, 50.0, 0.0), (None, 0, 10.6, 60.0), (None, 30_000, 10.605, 60.0)]
    network_, points = spark.createDataFrame(rows, ROAD), spark.createDataFrame(at, "vehicle_id string, time_ms long, lon double, lat double")
    config = MatchConfig(max_distance_m=20_000.0, beta_lambda=0.001)
    got = [(r.vehicle_id, r.asDict()) for r in match.match(points, network_, config).collect()]
    assert {name for name, r in got if r["kind"] == "speed"} == {"by the long edge", "far apart", "meridian", None}
    assert as_rows(got) == as_rows(matched_by_one(points, network_, config))


def test_stored_graph(spark, sf):
    from wayfold.operators import graphstore

    roads_ = queries.grid(spark, sf)
    path = graphstore.write(roads_)
    stored, whole = graphstore.TileGraph(path), whole_graph(roads_)
    names = [r[0] for r in graphstore.named_roads(roads_).select(F.explode(F.array("fwd_ref", "back_ref"))).collect() if r[0]]
    assert len(names) == len(whole.refs) and stored.find("1:none") is None
    for name in names:
        ref = stored.find(name)
        n = whole.number[ref]
        assert stored.length[ref] == whole.length[n] and stored.cost[ref] == whole.cost[n] and stored.next[ref] == [whole.refs[x] for x in whole.next[n]]
        assert stored.find(stored.name(ref)) == ref
    fresh = graphstore.TileGraph(path)
    fresh.find(names[0])
    assert len(fresh.loaded) == 1 < len(stored.loaded)
    points = queries._points(spark, sf)
    one, two = (sorted(map(str, match.match(points, roads_, graph=g).collect())) for g in (path, None))
    assert one == two and one


def test_roads_over_the_180th_meridian(spark):
    line = lambda name, *ps: (name, "a", "b", f"{name}_f", None, 3, [{"lon": x, "lat": y} for x, y in ps])
    rows = spark.createDataFrame([line("ends", (179.99, 10.0), (179.99999, 10.0)), line("across", (179.9995, 11.0), (-179.9995, 11.0)), line("whole", (-180.0, 12.0), (-180.0, 12.01))], ROAD)
    at = [(1, -179.99999, 10.0), (2, 179.99999, 10.0), (3, 180.0, 11.0), (4, -180.0, 11.0), (5, -179.9999, 11.0), (6, 179.9999, 11.0), (7, 180.0, 12.005), (8, 179.99999, 12.005)]
    points = spark.createDataFrame(at, "id long, lon double, lat double")
    got = {r.id: r for r in spatial.radius_join(points, rows, 25.0).collect()}
    assert {i: r.geom_id for i, r in got.items()} == {1: "ends", 2: "ends", 3: "across", 4: "across", 5: "across", 6: "across", 7: "whole", 8: "whole"}
    assert all(r.distance_m < 2.5 and abs(r.road_lon) <= 180 for r in got.values()) and abs(got[3].fraction - 0.5) < 1e-6 and abs(got[5].fraction - 0.6) < 1e-6
    assert {r.id for r in spatial.nearest_join(points, rows, "id", 10.0, 100.0).where("geom_id = 'across'").collect()} == {3, 4, 5, 6}
    assert sorted(r.id for r in spatial.snap(points, rows, "id").collect()) == [1, 2, 3, 4, 5, 6, 7, 8]


def test_many_routes_like_dijkstra(spark):
    """A random graph against the kernel: loops, dead ends, targets behind their source, long routes; paths add up."""
    import random

    from wayfold.operators import kernel, routing

    rng = random.Random(11)
    rows = [(f"e{k:03}", f"n{rng.randrange(40)}", f"n{rng.randrange(40)}", rng.uniform(1, 50)) for k in range(110)] + [(f"chain{k:02}", f"c{k}", f"c{k + 1}", 1.0) for k in range(40)]
    edges_ = spark.createDataFrame(rows, "ref_id string, src string, dst string, length_m double")
    pick = lambda: rng.choice(rows)[0]
    sources = [(i, pick(), rng.random()) for i in range(15)] + [(99, "chain00", 0.0)]
    targets = [(i, pick(), rng.random()) for i in range(25)] + [(98, "chain39", 1.0), (97, sources[0][1], sources[0][2]), (96, sources[1][1], 0.0)]
    graph = kernel.Graph([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], [r[3] for r in rows], [r[3] for r in rows], [None] * len(rows))
    at = {i: (graph.number[e], f) for i, e, f in sources + targets}
    want = {(s[0], targets[k][0]): (c, m) for s in sources for k, (c, m, _) in kernel.routes(graph, at[s[0]] if s[0] == 99 else (graph.number[s[1]], s[2]), [(graph.number[e], f) for _, e, f in targets], 120.0).items()}
    frames = spark.createDataFrame(sources, "source long, ref_id string, fraction double"), spark.createDataFrame(targets, "target long, ref_id string, fraction double")
    for delta in (None, 15.0):
        got = {(r.source, r.target): r for r in routing.routes(edges_, *frames, 120.0, delta=delta).collect()}
        assert got.keys() == want.keys() and len(got) > 50
        for pair, r in got.items():
            assert abs(r.cost - want[pair][0]) < 1e-9
            s, t = next(x for x in sources if x[0] == pair[0]), next(x for x in targets if x[0] == pair[1])
            path, one, two = [graph.number[e] for e in r.path], (graph.number[s[1]], s[2]), (graph.number[t[1]], t[2])
            assert kernel.valid_path(graph, one, two, path) and abs(kernel.measured(graph, one, two, path)[0] - r.metres) < 1e-9
    assert got[99, 98].path == [f"chain{k:02}" for k in range(40)]
    assert routing.routes(edges_, frames[0].limit(0), frames[1], 120.0).count() == 0


def test_routes_that_meet_within_an_edge_are_joined(spark):
    from wayfold.operators import routing

    rows = [("a", "1", "2", 10.0), ("b", "2", "3", 10.0)]
    edges_ = spark.createDataFrame(rows, "ref_id string, src string, dst string, length_m double")
    ddl = "k int, place int, ref_id string, start_fraction double, end_fraction double"
    first = spark.createDataFrame([(1, 0, "a", 0.2, 1.0), (1, 1, "b", 0.0, 0.5), (2, 0, "a", 0.0, 0.4), (3, 7, "a", 0.0, 1.0)], ddl)
    second = spark.createDataFrame([(1, 0, "b", 0.5, 0.9), (2, 0, "b", 0.0, 1.0), (3, 3, "b", 0.0, 1.0)], ddl)
    got = sorted(map(tuple, routing.joined_routes(first, second, edges_, "k").collect()))
    assert got == [(1, 0, "a", 0.2, 1.0), (1, 1, "b", 0.0, 0.9), (3, 7, "a", 0.0, 1.0), (3, 8, "b", 0.0, 1.0)]


def test_edges_are_joined_by_their_own_size(spark):
    """Not by that of the table of parts that they are made from: 36,000 edges are more than 200 kB, though estimated as fewer."""
    edges_ = network.edges(queries.grid(spark, "/root/testdata/sf0.1"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200000")
    try:
        plan = network.adjacency(edges_)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_polygons_hold_what_crosses_them(spark):
    line = lambda name, *ps: (name, "a", "b", f"{name}_f", None, 3, [{"lon": x, "lat": y} for x, y in ps])
    rows = spark.createDataFrame([line("through", (-1.0, 0.5), (2.0, 0.5)), line("in", (0.2, 0.2), (0.8, 0.8)), line("out", (2.0, 0.0), (2.0, 1.0)), line("half", (0.5, 0.5), (3.0, 3.0))], ROAD)
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    assert sorted(r.geom_id for r in network.filter_roads(rows, [], ring).collect()) == ["half", "in", "through"]
    assert [r.geom_id for r in network.filter_roads(rows, [], ring, within=True).collect()] == ["in"]


def test_unbounded_nearest_long_segments_and_dense_cells(spark):
    line = lambda name, *ps: (name, "a", "b", f"{name}_f", None, 3, [{"lon": x, "lat": y} for x, y in ps])
    rows = spark.createDataFrame([line("far", (11.0, 0.0), (11.0, 0.01)), line("diagonal", (10.0, 0.2), (10.5, 0.7))], ROAD)
    points = spark.createDataFrame([(1, 10.9, 0.0), (2, 10.25, 0.4501)], "id long, lon double, lat double")
    assert sorted((r.id, r.geom_id) for r in spatial.nearest_join(points, rows, "id").collect()) == [(1, "far"), (2, "diagonal")]
    assert spatial.nearest_join(points, rows.limit(0), "id").count() == 0
    assert spatial.listed_segments(rows.where("geom_id = 'diagonal'"), 25.0).count() < 10_000  # its box has a million cells


def test_segments_near_the_poles_are_listed_in_few_cells_and_found(spark):
    places = [(x, y) for x in (-179.9995, 0.0, 179.9995) for y in (-89.7, -85.2, 0.0, 60.0, 82.9, 89.3)]
    lines = [(f"{x}_{y}", "a", "b", f"{x}_{y}_f", None, 3, [{"lon": x, "lat": y}, {"lon": x + 0.0004, "lat": y + 0.001}]) for x, y in places]
    rows = spark.createDataFrame([*lines, ("beyond", "a", "b", "beyond_f", None, 3, [{"lon": 0.0, "lat": 110.0}, {"lon": 0.0, "lat": 110.001}])], ROAD)
    counts = {r.geom_id: r["count"] for r in spatial.listed_segments(rows, 25.0).groupBy("geom_id").count().collect()}
    assert len(counts) == len(lines) + 1 and max(counts.values()) < 60
    shift = lambda y: 0.00015 / math.cos(math.radians(y))  # noqa: E731  16.7 metres
    points = [(k, ((x + 0.0002 + d * shift(y)) + 180) % 360 - 180, y + 0.0005, geom) for k, (d, ((x, y), geom)) in enumerate((d, (p, r[0])) for d in (-1, 1, 4) for p, r in zip(places, lines))]
    got = sorted((r.k, r.geom_id) for r in spatial.radius_join(spark.createDataFrame(points, "k long, lon double, lat double, own string"), rows, 25.0).collect())
    assert [g for g in got if g in {(p[0], p[3]) for p in points}] == [(p[0], p[3]) for p in points if p[0] < 2 * len(lines)]


def test_only_roads_about_the_points_are_listed(spark, monkeypatch):
    """A long band of roads and points at three of them: the rest isn't listed, and Spark knows how many segments are."""
    lines = [(f"r{k}", "a", "b", f"r{k}_f", None, 3, [{"lon": 10.0, "lat": -20.0 + k * 0.06}, {"lon": 10.0004, "lat": -20.0 + k * 0.06}]) for k in range(1900)]  # beyond a pole
    across = ("across", "a", "b", "across_f", None, 3, [{"lon": 9.0, "lat": 0.03}, {"lon": 11.0, "lat": 0.03}])
    rows, written, write = spark.createDataFrame([*lines, across], ROAD), {}, spatial.materialize
    monkeypatch.setattr(spatial, "materialize", lambda df, name: written.setdefault(name, write(df, name)))
    points = spark.createDataFrame([(1, 10.0002, -20.0), (2, 10.0002, 40.0), (3, 370.0002, 88.0), (4, 10.5, 0.0301), (5, None, None)], "id long, lon double, lat double")
    got = {(r.id, r.geom_id) for r in spatial.radius_join(points, rows, 25.0).collect()}
    assert got == {(1, "r0"), (2, "r1000"), (3, "r1800"), (4, "across")}
    assert {r.geom_id for r in written["segments"].select("geom_id").distinct().collect()} >= {g for _, g in got}
    assert written["segments"].where("geom_id <> 'across'").select("geom_id").distinct().count() < 20


def test_distances_in_steps_are_the_expression_to_the_bit(spark):
    rows = spark.createDataFrame([(-96.8, 32.9, -96.79, 32.91), (179.9, -60.0, -179.9, -60.1), (1.0, 1.0, 1.0, 1.0), (None, 1.0, 2.0, 3.0)], "a double, b double, c double, d double")
    told = geo.measured(rows, "m", "a", "b", "c", "d").select("m", geo.distance(*map(F.col, "abcd"))).collect()
    assert len(told) == 4 and all(r[0] == r[1] for r in told)


def test_a_band_of_roads_beyond_85_degrees_is_in_many_tiles(spark, monkeypatch):
    """No task holds it whole: tiles are forgotten from one source to the next."""
    from wayfold.operators import graphstore

    rows = [(f"r{k}", f"n{k}", f"n{k + 1}", f"r{k}_f", f"r{k}_b", 1, [{"lon": 10.0, "lat": y}, {"lon": 10.0, "lat": y + 0.002}]) for k in range(1000) for y in (86.0 + 0.002 * k,)]
    edges_ = network.edges(spark.createDataFrame(rows, ROAD))
    sources = edges_.select(F.col("src").alias("node")).distinct()
    assert 7 * 1000 < network.shortest_costs(edges_, sources, 1000.0).count() < 11 * 1001
    path = graphstore.write_edges(edges_, F.col("length_m"))
    assert spark.read.parquet(path).where("ref_id IS NOT NULL").groupBy("tile").count().agg(F.max("count")).first()[0] < 60
    monkeypatch.setattr(graphstore, "MOST_EDGES", 50)
    graph, tiles_of = graphstore.TileGraph(path), {r.src: r.tile for r in spark.read.parquet(path).select("src", "tile").collect()}
    for k in range(0, 1000, 10):
        graph.leaving(f"n{k}", tiles_of[f"n{k}"])
        graph.make_room()
        assert len(graph.length) < 200


def test_lengths_of_listed_segments_are_those_of_sql_to_the_bit(spark):
    """At the longitude -96.772 the JVM's cosine is another double than the C library's; vertices without numbers give no length."""
    from wayfold.plans.fixtures import sql_distance

    at = [(-96.8 + 0.002 * i + 0.001 * k, 32.9 + 0.002 * j) for j in range(40) for i in (13, 14) for k in (0, 1)] + [(-96.8, y) for y in (33.114, 33.114999999999995, 33.147, 33.148)]
    rows = [(f"g{k}", None, None, f"g{k}_f", None, 1, [{"lon": x, "lat": y} for x, y in (a, b, (-96.8, 32.9))]) for k, (a, b) in enumerate(zip(at, at[1:]))]
    told = {(r.ax, r.ay, r.bx, r.by): r.len_m for r in spatial.listed_segments(spark.createDataFrame(rows, ROAD), 25.0, 10.0).collect()}
    values = ", ".join(f"({', '.join(f'{v!r}::DOUBLE' for v in k)})" for k in told)
    want = {r[:4]: r[4] for r in duckdb.sql(f"SELECT *, {sql_distance('x0', 'y0', 'x1', 'y1')} FROM (VALUES {values}) t(x0, y0, x1, y1)").fetchall()}
    assert len(told) > 200 and told == want
    odd = [(1, None), (2, []), (3, [(0.0, 0.0)]), (4, [(0.0, 0.0), (None, 0.0), (0.0, 1.0), (0.0, 2.0), (0.0, 3.0)]), (5, [(0.0, 0.0), (float("inf"), 0.0)])]
    odd = spark.createDataFrame([(k, g and [{"lon": x, "lat": y} for x, y in g]) for k, g in odd], "k int, geometry array<struct<lon:double,lat:double>>")
    got = {r.k: [(s.start_m, s.len_m and round(s.len_m)) for s in r.s] for r in odd.select("k", geo.plain_segments(F.col("geometry")).alias("s")).collect()}
    assert got == {1: [], 2: [], 3: [], 4: [(0.0, None), (0.0, None), (0.0, 110575), (got[4][3][0], 110576)], 5: [(0.0, None)]} and round(got[4][3][0]) == 110575


def test_lengths_of_segments_are_the_expression_to_the_bit(spark):
    lines = [[(-96.8, 32.9), (-96.799, 32.9), (-96.798, 32.91)], [(179.9, 60.0), (-179.9, 60.1), (10.0, -80.0), (10.0, -80.0)], [(1.0, 2.0)], [], None]
    rows = spark.createDataFrame([(k, g) for k, g in enumerate(lines)], "k int, geometry array<struct<lon:double,lat:double>>")
    told = rows.select("k", F.posexplode(geo.segments(F.col("geometry"))).alias("i", "s")).select("k", "i", "s.*", geo.distance(*(F.col(f"s.{c}") for c in ("ax", "ay", "bx", "by"))).alias("want")).orderBy("k", "i").collect()
    assert [(r.k, r.i) for r in told] == [(0, 0), (0, 1), (1, 0), (1, 1), (1, 2)] and all(r.len_m == r.want for r in told)
    assert told[1].start_m == told[0].len_m and told[4].start_m == told[2].len_m + told[3].len_m and told[4].len_m == 0
    assert [r[0] for r in rows.orderBy("k").select(geo.length(F.col("geometry"))).collect()][2:] == [0.0, 0.0, 0.0]


def test_components_of_a_long_band_take_few_rounds(spark, monkeypatch):
    k = F.col("id")
    r, j = k % 31, F.floor(k / 31)
    east, i = r < 15, F.when(r < 15, r).otherwise(r - 15)
    node = lambda i, j: F.concat_ws("_", F.lit("n"), i.cast("string"), j.cast("string"))
    band = spark.range(6_200).select(node(i, j).alias("a"), node(i + east.cast("int"), j + (~east).cast("int")).alias("b"))
    written, plain = [], network.materialize
    monkeypatch.setattr(network, "materialize", lambda df, name: written.append(name) or plain(df, name))
    found = network.connected_components(band.union(spark.createDataFrame([("y", "x"), ("x", "z"), ("q", "q"), (None, "q")], "a string, b string"))).collect()
    assert {(r.root, r.node) for r in found if r.node in "xyz"} == {("x", c) for c in "xyz"}
    assert {r.root for r in found if r.node not in "xyz"} == {"n_0_0"} and len(found) == 16 * 201 + 3
    assert written.count("roots") <= 14


def test_route_geometry_and_intersection(spark, sf):
    e = network.edges(queries.grid(spark, sf))
    parts = spark.createDataFrame([("r", 0, "H_0_0_f", 0.25, 1.0), ("r", 1, "H_1_0_f", 0.0, 0.75)], "id string, place int, ref_id string, start_fraction double, end_fraction double")
    (r,) = network.route_geometry(parts, e, "id").collect()
    assert [round((p.lon + 96.8) / 0.002, 6) for p in r.geometry] == [0.25, 0.5, 1.0, 1.5, 1.75]
    length = e.where("ref_id = 'H_0_0_f'").first().length_m
    assert abs(r.length_m - 1.5 * length) < 1e-6 and r.time_s > 0
    x = one(spark, geo.intersect((10.0, 50.0), (10.01, 50.01), (10.0, 50.01), (10.01, 50.0)), geo.intersect((0, 0), (1, 0), (0, 0), (1, 0)))
    assert abs(x[0].lon - 10.005) < 1e-6 and abs(x[0].lat - 50.005) < 1e-6 and x[1] is None


def test_offline_trips_and_filter_estimates(spark, sf):
    points, network_ = queries._points(spark, sf), queries.grid(spark, sf)
    offline = match.match_offline(points, network_, MatchConfig(filter_estimates=True), 50.0, 20_000)
    kinds = {r.kind: r.n for r in offline.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert kinds["filtered"] > 50 and offline.where("kind = 'filtered' AND NOT probability BETWEEN 0.0 AND 1.000001").count() == 0
    whole = match.match(points, network_).where("kind = 'estimate'").count()
    trips = match.match_trips(points, network_, gap_ms=10**9).where("kind = 'estimate'")
    assert trips.count() == whole and trips.select("trip").distinct().count() == 1


def test_hmm_match_is_the_best_of_all_sequences(spark, sf):
    """Short traces against an enumeration of all candidate sequences, with routes by Floyd and Warshall."""
    import itertools
    import math

    import numpy as np

    from wayfold.operators import kernel

    roads_ = queries.grid(spark, "/root/testdata/sf0.01")  # has roads by all samples of the smaller table
    config, edge_rows = MatchConfig(), network.costs(network.edges(roads_)).collect()
    points = queries._points(spark, sf).where("time_ms <= 40000")
    nodes = sorted({n for e in edge_rows for n in (e.src, e.dst)})
    at = {n: i for i, n in enumerate(nodes)}
    away = np.full((len(nodes), len(nodes)), math.inf)
    np.fill_diagonal(away, 0.0)
    for e in edge_rows:
        away[at[e.src], at[e.dst]] = min(away[at[e.src], at[e.dst]], e.cost_time_priority)
    for k in range(len(nodes)):
        away = np.minimum(away, away[:, k, None] + away[None, k, :])
    graph = kernel.Graph(*map(list, zip(*((e.ref_id, e.src, e.dst, e.length_m, e.cost_time_priority) for e in edge_rows))), [None] * len(edge_rows))
    edge = {e.ref_id: e for e in edge_rows}

    def near(lon, lat):
        out = []
        for e in edge_rows:
            (ax, ay), (bx, by) = ((p.lon, p.lat) for p in (e.geometry[0], e.geometry[-1]))
            kx = math.cos(math.radians(lat))
            dx, dy = (bx - ax) * kx, by - ay
            f = min(1.0, max(0.0, ((lon - ax) * kx * dx + (lat - ay) * dy) / (dx * dx + dy * dy)))
            x, y = ax + f * (bx - ax), ay + f * (by - ay)
            if (m := kernel.chord_m(lon, lat, x, y)) <= config.radius_m:
                out.append((graph.number[e.ref_id], f, m))
        return kernel.minset(graph, sorted(out))

    def chance(sequence, samples):
        total = 0.0
        for i, (e, f, m) in enumerate(sequence):
            total += -0.5 * (m / config.sigma) ** 2
            if i:
                p, g, _ = sequence[i - 1]
                one, two = edge[graph.refs[p]], edge[graph.refs[e]]
                cost = one.cost_time_priority * (f - g) if e == p and f >= g else one.cost_time_priority * (1 - g) + away[at[one.dst], at[two.src]] + two.cost_time_priority * f
                base = kernel.chord_m(*samples[i - 1], *samples[i]) / 60
                total -= config.beta_lambda * max(0.0, cost - base)
        return total

    traces = {}
    for r in points.orderBy("vehicle_id", "time_ms").collect():
        traces.setdefault(r.vehicle_id, []).append((r.lon, r.lat))
    got = {}
    for r in match.match(points, roads_, config).where("kind = 'estimate'").orderBy("vehicle_id", "time_ms").collect():
        got.setdefault(r.vehicle_id, []).append(r.ref_id)
    checked = 0
    for name, samples in traces.items():
        if len(samples) == 5 and all(b[0] > a[0] for a, b in zip(samples, samples[1:])):
            best = max(itertools.product(*(near(*s) for s in samples)), key=lambda q: chance(q, samples))
            assert got[name] == [graph.refs[e] for e, _, _ in best[1:]], name
            checked += 1
    assert checked >= 8


def test_streams(spark, sf, tmp_path):
    points = queries._points(spark, sf).select("vehicle_id", F.col("true_ms").alias("time_ms"), "lat", "lon", "event_data")
    points.coalesce(1).write.parquet(str(tmp_path / "in"))
    speeds = replay.ordered_speeds(replay.replay(spark, str(tmp_path / "in")))
    q = speeds.writeStream.format("memory").queryName("speeds").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("speeds").count() == points.count() - points.select("vehicle_id").distinct().count()
    near = queries._points(spark, sf).select("vehicle_id", (F.col("time_ms") + 86_400_000).alias("time_ms"), "lat", "lon", "event_data")  # what is at time 0 is late
    near.coalesce(1).write.parquet(str(tmp_path / "near"))
    q = replay.matched(replay.replay(spark, str(tmp_path / "near")), queries.grid(spark, sf)).writeStream.format("memory").queryName("on_road").option("checkpointLocation", str(tmp_path / "c3")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    on_road = spatial.radius_join(near, queries.grid(spark, sf), MatchConfig().radius_m).select("vehicle_id", "time_ms").distinct().count()
    assert spark.table("on_road").count() == on_road > 100 and spark.table("on_road").where("ref_id IS NULL").count() == 0
    hours = replay.hourly_counts(replay.replay(spark, str(tmp_path / "in")))
    q = hours.writeStream.format("memory").queryName("hours").outputMode("complete").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("hours").agg(F.sum("n")).first()[0] == points.count()


def test_paced_replay_keeps_the_cadence(spark, tmp_path):
    rows = [("v", 1_000_000 + t, 1.0, 2.0) for t in (4000, 0, 900, 2100)] + [("v", None, 1.0, 2.0)]
    spark.createDataFrame(rows, "vehicle_id string, time_ms long, lat double, lon double").write.parquet(str(tmp_path / "drive"))
    stream = replay.paced(spark, spark.read.parquet(str(tmp_path / "drive")))
    came: list[tuple[int, float]] = []
    began = time.monotonic()
    q = stream.writeStream.foreachBatch(lambda df, _: came.extend((r.time_ms - 1_000_000, time.monotonic()) for r in df.collect())).option("checkpointLocation", str(tmp_path / "c")).start()
    while len(came) < 4 and time.monotonic() - began < 90:
        time.sleep(0.2)
    q.stop()
    assert sorted(t for t, _ in came) == [0, 900, 2100, 4000] and [t // 1000 for t, _ in came] == sorted(t // 1000 for t, _ in came)


def test_matching_on_streams_tells_all_candidates(spark, sf, tmp_path):
    near = queries._points(spark, sf).where("vehicle_id = 'v1'").select("vehicle_id", (F.col("time_ms") + 86_400_000).alias("time_ms"), "lat", "lon", "event_data")
    near.coalesce(1).write.parquet(str(tmp_path / "near"))
    q = replay.matched(replay.replay(spark, str(tmp_path / "near")), queries.grid(spark, sf), monitor=True).writeStream.format("memory").queryName("monitored").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    told = spark.table("monitored").collect()
    assert len(told) == near.count() > 0 and all(json.loads(r.monitor)["time"] == r.time_ms for r in told)


def test_dust_of_a_frequent_start_makes_several_messages(spark, monkeypatch):
    monkeypatch.setattr(tiles, "DUST_BYTES", 1000)
    rows = [("v", t, float(t), 1.0, t % 3 == 0, "e", t / 4000) for t in range(3001)]
    marked = spark.createDataFrame(rows, "vehicle_id string, time_ms long, lon double, lat double, good boolean, ref_id string, fraction double")
    runs = traces.failure_runs(marked, fraction="fraction")
    expected = sorted(("e", "e", t / 4000, (t + 3) / 4000, [t + 1.0, 1.0, t + 2.0, 1.0]) for t in range(0, 3000, 3))
    for failures in (runs, aggregate.failure_clusters(runs)):
        messages = tiles.encoded_dust(failures)
        sizes = [len(r.message) for r in messages.collect()]
        assert len(sizes) > 50 and max(sizes) < 1200
        assert sorted((*r[:4], list(r[4])) for r in tiles.decoded_dust(messages).collect()) == expected
    other = traces.failure_runs(marked.withColumns({"vehicle_id": F.lit("w"), "ref_id": F.lit("f")}).where("time_ms < 10"), fraction="fraction")
    whole, cut = (aggregate.failure_clusters(runs.unionByName(other), n).collect() for n in (2006, 100))
    assert sorted((r.start_ref, r.part, r.n_failures, len(r.failures)) for r in whole) == [("e", 0, 1000, 1000), ("f", 0, 3, 3)]
    parts = [r for r in cut if r.start_ref == "e"]
    assert 15 < len(parts) <= 20 and len(cut) == len(parts) + 1 and {r.n_failures for r in parts} == {1000}
    assert max(len(r.failures) for r in parts) < 100 and sorted(f for r in cut for f in r.failures) == sorted(f for r in whole for f in r.failures)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(df: pd.DataFrame) -> list[str]:
    df = df[sorted(df.columns)]
    text = lambda v: "-" if v is None or v is pd.NA or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted("|".join(text(float(v) if isinstance(v, int) and not isinstance(v, bool) else v) for v in row) for row in df.astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_against_sql(spark, sf, duck, name):
    ours, theirs = driver.queries()[name](spark, sf).toPandas(), duck.execute(driver.oracle_sql()[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert _rows(ours) == _rows(theirs)


def test_weekly_bins_of_odd_events_against_sql(spark, tmp_path):
    """Null, infinite and huge values, groups of nulls alone, events without type or time."""
    values = [None, 1.25, None, float("nan"), float("inf"), -float("inf"), 3e15, -3e15, -0.125, 2.0**52 / 1e4, None]
    start = datetime.datetime(2024, 1, 1)
    rows = [(i, None if i % 53 == 0 else start + datetime.timedelta(minutes=9 * i), i % 48, None if i % 7 == 0 else "abc"[i % 3], values[i % 11]) for i in range(4_000)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    spark.range(2000).selectExpr("id AS p_partkey").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    con = duckdb.connect()
    for table in ("events", "part"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    rows_of = lambda told: sorted(tuple(str(v) for v in r) for r in told)
    theirs = con.execute(driver.oracle_sql()["binned_events_weekly"])
    names = [c[0] for c in theirs.description]
    ours = driver.queries()["binned_events_weekly"](spark, str(tmp_path)).select(*names)
    theirs = rows_of(theirs.fetchall())
    assert rows_of(map(tuple, ours.collect())) == theirs
    assert {"None", "nan", "inf", "-inf", str(3e15)} <= {r[-1] for r in theirs} and {"None"} < {r[6] for r in theirs} and {"None"} < {r[1] for r in theirs}


def test_messages_of_binned_events_have_0_for_sums_of_nulls(spark):
    rows = [("r", 0.5, 100.0, 0, "a", None), ("r", 0.5, 100.0, 0, "b", 2.0)]
    binned = aggregate.weekly_binned_events(spark.createDataFrame(rows, "ref_id string, fraction double, length_m double, time_ms long, event_type string, event_value double"), 10.0)
    assert sorted((r.event_type, r["count"], r.value) for r in binned.collect()) == [("a", 1, None), ("b", 1, 2.0)]
    assert tiles.encoded_binned(binned).collect() == tiles.encoded_binned(binned.fillna(0.0, ["value"])).collect()


@pytest.mark.parametrize("name", ["snap_binned", "binned_events_weekly"])
def test_bins_at_the_ends_of_roads_against_sql(spark, tmp_path, name):
    """Five rows of nodes, met at each of their 3,000 longitudes: the last bit of a fraction decides the bin there."""
    rows = [(17 + 41 * i, datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=i), [2, 5, 6, 11, 12][i % 5], "view", 1.0) for i in range(15_000)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    spark.range(2000).selectExpr("id AS p_partkey").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    con = duckdb.connect()
    for table in ("events", "part"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    assert _rows(driver.queries()[name](spark, str(tmp_path)).toPandas()) == _rows(con.execute(driver.oracle_sql()[name]).fetchdf())


def test_searches_within_tasks_tell_what_rounds_tell(spark, sf, monkeypatch):
    from wayfold.operators import routing
    from wayfold.plans.fixtures import grid

    edges_ = network.edges(grid(spark, sf))
    nodes = edges_.select(F.col("src").alias("node")).union(edges_.select("dst")).distinct()  # dead ends too
    costs = lambda delta: sorted(map(tuple, network.shortest_costs(edges_, nodes, 700.0, delta=delta).collect()))
    places = edges_.where("is_forward").select("ref_id")
    sources_ = places.select(F.col("ref_id").alias("source"), "ref_id", F.lit(0.3).alias("fraction")).union(spark.createDataFrame([("none", "none", 0.5)], "source string, ref_id string, fraction double"))
    routes_ = lambda delta: sorted(map(tuple, routing.routes(edges_, sources_, places.select(F.col("ref_id").alias("target"), "ref_id", F.lit(0.6).alias("fraction")), 700.0, delta=delta).collect()))
    by_rounds = costs(700.0), routes_(700.0)
    assert len(by_rounds[0]) > 200 and len(by_rounds[1]) > 200
    written, plain = [], routing.materialize
    monkeypatch.setattr(routing, "materialize", lambda df, name: (written.append(name), plain(df, name))[1])
    assert costs(None) == by_rounds[0] and routes_(None) == by_rounds[1]
    assert "better" not in written and "open" not in written and "paths" not in written  # labels known aren't sent to and fro


def test_searches_from_several_starts_of_a_source(spark):
    from wayfold.operators import routing

    p = lambda x: (-96.8 + 0.05 * x, 32.9)  # a tile or more apart
    rows = [(f"e{k}", k, k + 1, 10.0, [p(k), p(k + 1)]) for k in range(6)] + [("far", 2, 9, None, [p(2), p(9)])]
    edges_ = spark.createDataFrame(rows, "ref_id string, src long, dst long, length_m double, geometry array<struct<lon: double, lat: double>>")
    starts = spark.createDataFrame([(1, 0, 0.0, 0.0, None), (1, 3, 5.0, 5.0, None), (1, 3, 7.0, 7.0, None), (2, 4, 99.0, 99.0, None), (3, 77, 1.0, 1.0, "x")], "source long, node long, cost double, metres double, via string").withColumn("back", F.lit(None).cast("long"))
    told = lambda df: sorted(map(tuple, df.select("source", "node", "cost", "metres", "via", "back").collect()), key=str)
    got = told(routing.labels(edges_, starts, 26.0))
    assert got == told(routing.labels(edges_, starts, 26.0, delta=26.0))
    assert (1, 5, 25.0, 25.0, "e4", 4) in got and (3, 77, 1.0, 1.0, "x", None) in got and not [r for r in got if r[0] == 2]


def test_the_nearest_segment_of_each_road_is_found_where_it_is_met(spark):
    """Roads with one, two and many segments in a cell; only the last kind is shuffled by point."""
    rng = random.Random(8)
    line = lambda name, lonlats: (name, "a", "b", name + "_f", name + "_b", 1, [{"lon": x, "lat": y} for x, y in lonlats])
    plain = [line(f"p{k}", [(0.002 * k, y) for y in (0.0, 0.0012, 0.0024)]) for k in range(4)] + [line("corner", [(0.0, 0.001), (0.001, 0.001), (0.001, 0.0)])]
    curved = [line("curve", [(0.0001 * k, 0.0016 + 0.0001 * rng.random()) for k in range(60)]), line("back", [(0.001, 0.002), (0.0011, 0.002), (0.001, 0.002)])]
    corners = [(0.001, 0.001), (0.00105, 0.00105), (0.00095, 0.00095), (0.0, 0.0012), (0.00105, 0.002)]
    places = corners + [(rng.uniform(-0.0003, 0.0065), rng.uniform(-0.0003, 0.0027)) for _ in range(600)]
    points = spark.createDataFrame([(k, x, y) for k, (x, y) in enumerate(places)], "id long, lon double, lat double")
    for roads_ in (plain, plain + curved):
        rows = spark.createDataFrame(roads_, ROAD)
        hits = spatial.segment_hits(points, rows, 25.0)
        best = hits.groupBy("id", "geom_id").agg(F.min_by(F.struct("along", "direction", "road_lon", "road_lat"), "place").alias("b")).select("id", "geom_id", "b.*")
        want = geo.measured(best.join(points, "id"), "distance_m", "lon", "lat", "road_lon", "road_lat").where("distance_m <= 25")
        want = {(r.id, r.geom_id): (r.along, r.direction, r.distance_m) for r in want.collect()}
        joined = spatial.radius_join(points, rows, 25.0).where("is_forward")
        got = joined.collect()
        assert len(got) == len(want) > 100
        assert {(r.id, r.geom_id): (r.fraction, r.azimuth, r.distance_m) for r in got} == want
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert ("Aggregate" in plan) == (roads_ is not plain)


def test_nearest_roads_are_ranked_once_and_need_a_direction(spark, monkeypatch):
    line = lambda name, y, forward, backward: (name, "a", "b", forward, backward, 3, [{"lon": 0.0, "lat": y}, {"lon": 0.002, "lat": y}])
    rows = spark.createDataFrame([line("none", 0.00001, None, " "), line("back", 0.00005, None, "back_b"), line("both", -0.00005, "both_f", "both_b"), line("far", 0.0003, "far_f", None)], ROAD)
    plans, write = [], spatial.materialize
    monkeypatch.setattr(spatial, "materialize", lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()) if name == "near" else None, write(df, name))[1])
    points = spark.createDataFrame([(1, 0.001, 0.0), (2, 0.001, 0.00045)], "id long, lon double, lat double")
    got = sorted((r.id, r.ref_id) for r in spatial.nearest_join(points, rows, "id", 10.0, 40.0).collect())
    assert got == [(1, "back_b"), (1, "both_b"), (1, "both_f"), (2, "far_f")]
    assert len(plans) == 2 and not any("WindowGroupLimit" in p or "row_number" in p for p in plans)


def test_samples_at_repeated_times_are_computed_once(spark, sf):
    plan = driver.queries()["events_at_repeated_times"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "user_id" not in plan  # nothing is left of the table that samples are made from


def test_snapped_points_know_the_length_of_their_road(spark, sf):
    rows = queries.grid(spark, sf)
    told = spatial.snap(queries._points(spark, sf), rows, "event_id").select("ref_id", "length_m")
    assert told.count() > 100
    assert told.join(network.edges(rows).select("ref_id", F.col("length_m").alias("m")), "ref_id", "left").where("m IS NULL OR m <> length_m").count() == 0
