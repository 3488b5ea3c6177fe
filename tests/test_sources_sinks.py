"""Readers and writers on small inputs of our own."""

import os
import json

import pytest
from pyspark.sql import functions as F

from wayfold.config import MatchConfig
from wayfold.sinks import geojson, tiles, wire
from wayfold.sources import events, requests
from wayfold.sources import roads as road_sources


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_csv(spark):
    df = events.parse_csv(lines(spark, "v,1000,1.5,2.5,speed,3", "v,2018-01-01T00:00:00Z,1,2,stop", "v,1,2", "v,5,1,2,,", "v,bad,1,2"))
    rows = sorted((r.time_ms, r.lat, r.lon, r.event_data) for r in df.collect())
    assert rows == [(5, 1.0, 2.0, {}), (1000, 1.5, 2.5, {"speed": 3.0}), (1514764800000, 1.0, 2.0, {"stop": 0.0})]
    with pytest.raises(Exception, match="bad event line"):
        events.parse_csv(lines(spark, "v,bad,1,2"), strict=True).collect()


def test_json_and_taxi(spark):
    good = json.dumps({"timestamp": 7, "longitude": "2.5", "latitude": "1.5", "id": "v", "more": 1})
    assert [tuple(r) for r in events.parse_json(lines(spark, good, "{", "{}")).collect()] == [("v", 7000, 1.5, 2.5, {})]
    cells = ["-"] * 26
    cells[5], cells[8], cells[21] = "2018-05-10 01:00:00", "2018-05-12 01:00:00", "cab"
    cells[18] = '"{""Latitude"":1.5,""Longitude"":2.5}"'
    cells[19] = '"{""Latitude"":null,""Longitude"":2.5}"'
    text = "\t".join(cells)
    assert [r.event_data for r in events.parse_taxi(lines(spark, text)).collect()] == [{"pickup": 0.0}]
    cells[19] = cells[18]
    assert events.parse_taxi(lines(spark, "\t".join(cells))).count() == 1
    assert events.parse_taxi(lines(spark, "\t".join(cells)), days=None).count() == 2


def test_gpx(spark, tmp_path):
    body = """<?xml version="1.0"?><gpx><metadata><time>2018-03-22T00:00:00Z</time></metadata>
    <wpt lat="1" lon="2"><time>2018-03-22T01:00:00Z</time><name>PICKUP</name></wpt>
    <trk><trkseg><trkpt lat="1.5" lon="2.5"><time>2018-03-22T01:00:01Z</time><speed>3.5</speed></trkpt>
    <trkpt lat="1.6" lon="2.6"><time>2018-03-22T01:00:02.500Z</time></trkpt></trkseg>
    <trkseg><trkpt lat="1.7" lon="2.7"></trkpt></trkseg></trk></gpx>"""
    (tmp_path / "car.gpx").write_text(body)
    rows = sorted((r.vehicle_id, r.time_ms % 100_000, r.event_data) for r in events.read_events(spark, str(tmp_path / "car.gpx")).collect())
    assert rows == [("car", 0, {"PICKUP": None}), ("car", 1000, {"gpsSpeed": 3.5}), ("car", 2500, {})]


def test_delimited_events_and_tiles(spark, tmp_path):
    told = [("v1", 1000, 1.5, 2.5, {"speed": 3.0}), ("v2", 2000, -1.5, 0.0, {})]
    (tmp_path / "events.pbf").write_bytes(b"".join(wire.delimited(wire.encode_event(*t)) for t in told))
    assert sorted(tuple(r) for r in events.read_events(spark, str(tmp_path / "events.pbf")).collect()) == told
    road = ("g", "a", "b", "f", "", 2, [(1.0, 2.0), (3.0, 4.0)])
    for tile in ("12-1-1", "12-1-2"):
        (tmp_path / f"{tile}.geometry.6.pbf").write_bytes(wire.delimited(wire.encode_geometry(*road)))
    rows = road_sources.read_tiles(spark, str(tmp_path)).collect()
    assert len(rows) == 1 and rows[0].tile == "12-1-1" and rows[0].road_class == 2 and rows[0].geometry[1].lat == 4.0
    with pytest.raises(ValueError):
        list(wire.frames(b"\x05ab"))


def test_fetch_tiles_once(tmp_path):
    calls = []
    for _ in range(2):
        paths = road_sources.fetch_tiles(["12-1-1"], str(tmp_path), lambda url: calls.append(url) or b"x")
    assert len(calls) == 1 and open(paths[0], "rb").read() == b"x"


def test_request_with_a_time_twice_fails(spark):
    df = spark.createDataFrame([("r", json.dumps([{"id": "a", "time": 1, "point": "POINT(1 2)"}] * 2))], "request_id string, value string")
    with pytest.raises(Exception, match="time twice"):
        requests.parse_requests(df).collect()


def test_messages_and_tiled_files(spark, tmp_path):
    cycle = spark.createDataFrame([("r", "2024-01-01", 5, 30, 2), ("r", "2024-01-01", 5, 31, 1)], "ref_id string, week string, period int, speed_bin int, n long")
    row = tiles.encoded_speeds(cycle).first()
    fields = list(wire.fields(next(wire.frames(bytes(row.message)))))
    assert fields[0][2] == b"r" and fields[1][2] == wire.PERIOD_SIZES.index("OneHour")
    inner = dict((f, v) for f, _, v in wire.fields(fields[2][2]))
    assert wire.unpack_numbers(inner[1]) == [5]
    assert [wire.unpack_numbers(v) for _, _, v in wire.fields(inner[2])] == [[30, 31], [2, 1]]
    placed = tiles.encoded_speeds(cycle).withColumn("tile", F.lit("12-1-1"))
    (told,) = tiles.write_pbf(placed, f"file://{tmp_path}/out", "speeds").collect()
    assert told.records == 1 and told.path.endswith("2024-01-01/speeds/12-1-1.speeds.pbf")
    assert open(told.path, "rb").read() == bytes(row.message)


def test_tiled_parquet_overwrites(spark, tmp_path):
    df = spark.createDataFrame([("r", "2024-01-01", "12-1-1", 3)], "ref_id string, week string, tile string, n int")
    for _ in range(2):
        tiles.write_parquet(df, str(tmp_path / "t"), "speeds")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_geojson(spark):
    df = spark.range(1).select(geojson.line(F.array(F.struct(F.lit(1.0).alias("lon"), F.lit(2.0).alias("lat"))), kmh=F.lit(3)).alias("f"))
    assert json.loads(df.first().f) == {"type": "Feature", "geometry": {"type": "LineString", "coordinates": [[1.0, 2.0]]}, "properties": {"kmh": 3}}


def test_properties():
    c = MatchConfig.from_properties("# a comment\nmatcher.sigma=5\nmatcher.interval.min = 1000\nother=1", radius_m=9.0)
    assert (c.sigma, c.min_interval_ms, c.radius_m, c.beta_lambda) == (5.0, 1000, 9.0, 3.0)


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        events.read_events(spark, "x.doc")


def test_models_go_to_json_lines_and_back(spark):
    schema = "ref_id string, n int, x double, geometry array<struct<lon:double,lat:double>>, at map<string,double>"
    rows = [("a", 1, 0.1 + 0.2, [(1.5, -2.25), (1e-12, 3.0)], {"k": 1.0}), ("b\n\"", None, float("inf"), [], None), (None, None, None, None, {})]
    told = geojson.as_lines(spark.createDataFrame(rows, schema))
    assert told.columns == ["value"] and '"n":null' in told.collect()[1].value
    assert [tuple(r) for r in requests.of_lines(told, schema).collect()] == rows
    with pytest.raises(Exception):
        requests.of_lines(lines(spark, "{"), schema).collect()


def test_states_with_roads_named_by_their_base_and_nodes(spark):
    matched = spark.createDataFrame([("v", "estimate", 2, 9, "e"), ("v", "estimate", 1, 5, "f"), ("v", "speed", 3, 9, "e")], "vehicle_id string, kind string, seq int, time_ms long, ref_id string")
    matched = matched.selectExpr("*", "0.5D AS end_fraction", "1D AS lon", "2D AS lat", "3D AS speed_mps")
    edges = spark.createDataFrame([("e", "g", "n1", "n2"), ("f", "g", "n2", "n1")], "ref_id string, geom_id string, src string, dst string")
    (row,) = geojson.render_states(matched, "osm", edges=edges).collect()
    assert [r["ref_id"] for r in json.loads(row.rendering)] == ["g:n2:n1", "g:n1:n2"]
    with pytest.raises(Exception, match="road not found in map: f"):
        geojson.render_states(matched, "osm", edges=edges.where("ref_id = 'e'")).collect()


def test_delimited_files_are_split_at_messages(spark, tmp_path):
    from wayfold.sources import delimited, events

    rows = [(f"v{i % 7}", 1000 + i, i / 10, -i / 10, {"kind": float(i), "x" * (i % 300): 1.0}) for i in range(3000)]
    df = spark.createDataFrame(rows, "vehicle_id string, time_ms long, lat double, lon double, event_data map<string,double>")
    path = f"file://{tmp_path}/events"
    delimited.write(df.coalesce(1), path, "event")
    (file,) = [f for f in os.listdir(tmp_path / "events")]
    index = spark.read.parquet(delimited.splits(spark, path, 20_000)).orderBy("start").collect()
    assert len(index) > 20 and [r.start for r in index[1:]] == [r.end for r in index[:-1]] and index[-1].end == os.path.getsize(tmp_path / "events" / file)
    told = lambda d: sorted((r.vehicle_id, r.time_ms, r.lat, r.lon, tuple(sorted(r.event_data.items()))) for r in d.collect())
    read = events.read_delimited(spark, path, split_bytes=20_000)
    assert told(read) == told(df) and read.rdd.getNumPartitions() > 20
    assert told(events.read_delimited(spark, path)) == told(df)  # one split
    with pytest.raises(FileExistsError):
        delimited.write(df, path, "event")
    delimited.write(df.limit(5), path, "event", overwrite=True)
    assert events.read_delimited(spark, path).count() == 5
    (tmp_path / "cut.pbf").write_bytes((tmp_path / "events" / os.listdir(tmp_path / "events")[0]).read_bytes()[:-3])
    with pytest.raises(Exception, match="cut short"):
        events.read_delimited(spark, str(tmp_path / "cut.pbf")).count()


def test_delimited_files_beyond_two_gigabytes(spark, tmp_path):
    """A sparse file: one message of 3 GB that no task reads, between two events."""
    from wayfold.sources import delimited

    size = 3 << 30
    first, last = (wire.delimited(wire.encode_event("v", t, 1.0, 2.0, {})) for t in (1, 2))
    with open(tmp_path / "big.pbf", "wb") as f:
        f.write(first + wire.varint(size))
        f.seek(size, 1)
        f.write(last)
    index = sorted(map(tuple, spark.read.parquet(delimited.splits(spark, str(tmp_path / "big.pbf"))).collect()))
    head, end = len(first), len(first) + len(wire.varint(size)) + size
    assert [r[1:] for r in index] == [(0, end), (end, end + len(last))]
    with open(tmp_path / "big.pbf", "rb") as f:
        assert [then for then, _ in delimited._walk(f, 0, end + len(last), False)] == [head, end, end + len(last)]
        assert [wire.decode_event(m)[1] for _, m in delimited._walk(f, end, end + len(last), True)] == [2]


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    from wayfold.sources import delimited

    df = spark.range(100).repartition(4).selectExpr("string(id) AS vehicle_id", "id AS time_ms", "if(id = 50, double(raise_error('no')), 1D) AS lat", "0D AS lon", "map('e', 1D) AS event_data")
    with pytest.raises(Exception, match="no"):
        delimited.write(df, f"file://{tmp_path}/out", "event")
    assert not (tmp_path / "out").exists() or os.listdir(tmp_path / "out") == []


def test_a_large_tile_is_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tiles, "PART_BYTES", 1000)
    rows = [("hot", bytes([i % 256]) * 50) for i in range(200)] + [("cold", b"x" * 50)]
    told = {os.path.relpath(r.path, str(tmp_path)): r.records for r in tiles.write_pbf(spark.createDataFrame(rows, "tile string, message binary"), f"file://{tmp_path}", "speeds").collect()}
    assert told["speeds/cold.speeds.pbf"] == 1 and sum(told.values()) == 201 and len(told) > 8
    assert sum(os.path.getsize(tmp_path / p) for p in told) == 201 * 50


def test_tiles_are_fetched_by_tasks_and_kept(spark, tmp_path):
    road = ("g", "a", "b", "g_f", None, 3, [(1.0, 2.0), (1.1, 2.0)])
    (tmp_path / "calls").mkdir()

    def fetch(address):
        import uuid

        (tmp_path / "calls" / uuid.uuid4().hex).write_text(address)
        return wire.delimited(wire.encode_geometry(*road))

    wanted = spark.createDataFrame([("12-1-1",), ("12-1-2",), ("12-1-1",), (None,)], "tile string")
    for _ in range(2):
        told = sorted(map(tuple, road_sources.fetched_tiles(wanted, f"file://{tmp_path}/cache", fetch, base="http://x/").collect()))
        assert told == [(t, f"{tmp_path}/cache/{t}.geometry.6.pbf") for t in ("12-1-1", "12-1-2")]
    assert sorted(p.read_text() for p in (tmp_path / "calls").iterdir()) == [f"http://x/osm/planet/12-1-{k}.geometry.6.pbf" for k in (1, 2)]
    assert sorted(os.listdir(tmp_path / "cache")) == ["12-1-1.geometry.6.pbf", "12-1-2.geometry.6.pbf"]
    assert [r.geom_id for r in road_sources.read_tiles(spark, f"file://{tmp_path}/cache").collect()] == ["g"]


def test_small_splits_of_a_large_file_are_few_tasks(spark, tmp_path):
    from wayfold.schema import ROAD
    from wayfold.sources import delimited

    line = [{"lon": 1.0, "lat": 2.0}, {"lon": 1.0, "lat": 2.001}]
    rows = spark.range(6000).selectExpr("concat('g', id) AS geom_id").collect()
    roads = spark.createDataFrame([(r.geom_id, "a", "b", r.geom_id, None, 1, line) for r in rows], ROAD).coalesce(1)
    path = f"file://{tmp_path}/roads"
    delimited.write(roads, path, "geometry")
    read = delimited.read(spark, path, "geometry", split_bytes=256)
    assert 100 < read.rdd.getNumPartitions() <= 2 * delimited.TASKS
    assert sorted(r.geom_id for r in read.select("geom_id").collect()) == sorted(r.geom_id for r in rows)
