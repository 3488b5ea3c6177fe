"""Matching on streams: restarts in the middle of traces, late samples, what the state holds and when it goes."""

import os
from collections import defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wayfold.config import MatchConfig
from wayfold.operators import graphstore, kernel, match, spatial
from wayfold.plans import queries
from wayfold.streaming import replay

DAY = 86_400_000


def arrive(folder, i, rows):
    """A file of samples (vehicle, time, lon, lat) that comes i-th."""
    os.makedirs(folder, exist_ok=True)
    told = [{"vehicle_id": v, "time_ms": t, "lon": x, "lat": y} for v, t, x, y in rows]
    kinds = pa.schema([("vehicle_id", pa.string()), ("time_ms", pa.int64()), ("lon", pa.float64()), ("lat", pa.float64())])
    pq.write_table(pa.Table.from_pylist(told, kinds), f"{folder}/{i}.parquet")
    os.utime(f"{folder}/{i}.parquet", (1e9 + i, 1e9 + i))


def run(spark, folder, roads, graph, out, **options):
    """Streams what has arrived in a folder, a file at a time, on from the checkpoint in out."""
    stream = replay.matched(replay.replay(spark, str(folder)), roads, graph=graph, **options)
    q = stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/c").trigger(availableNow=True).start()
    assert q.awaitTermination(300)
    return q


def rows_of(spark, out):
    return sorted(map(tuple, spark.read.parquet(f"{out}/rows").select("vehicle_id", "time_ms", "late", "ref_id", "fraction", "probability").collect()), key=str)


@pytest.fixture(scope="module")
def town(spark, sf):
    roads = queries.grid(spark, sf)
    return roads, graphstore.write(roads)


@pytest.fixture(scope="module")
def batches(spark, sf):
    """Samples by half-minutes, a tenth of the third batch with the fifth; one vehicle has no name."""
    samples = queries._points(spark, sf).select("vehicle_id", F.col("time_ms") + DAY, "lon", "lat").collect()
    first, last = min(s[1] for s in samples), max(s[1] for s in samples)
    out = [[] for _ in range(6)]
    for k, (v, t, x, y) in enumerate(sorted(samples)):
        i = min(5, (t - first) * 6 // (last - first + 1))
        out[4 if i == 2 and k % 10 == 0 else i].append((None if v == "v2" else v, t, x, y))
    return out


def folded(spark, batches, roads, graph, config, k, tau_ms):
    """The same by one kernel.Online a vehicle, without Spark's state."""
    opened, online, out = graphstore.opened(graph), {}, []
    points = spark.createDataFrame([(i, *s) for i, rows in enumerate(batches) for s in rows], "batch int, vehicle_id string, time_ms long, lon double, lat double")
    hits = spatial.segment_hits(points, graphstore.named_roads(roads), config.radius_m)
    by = defaultdict(list)
    for r in hits.select("batch", "vehicle_id", "time_ms", "lon", "lat", "geom_id", "fwd_ref", "back_ref", "place", "along", "road_lon", "road_lat").collect():
        by[r.batch, r.vehicle_id].append((r.time_ms, r.lon, r.lat, False, 0, *r[5:]))
    for (_, name), rows in sorted(by.items(), key=lambda b: b[0][0]):
        o = online.setdefault(name, kernel.Online(opened, config, k, tau_ms))
        for t, lon, lat, _, found in match.trace_of(rows, opened, config.radius_m):
            late = bool(o.steps) and t < o.steps[-1][0][0]
            c = o.add(t, lon, lat, found)
            if late or c is not None:
                out.append((name, t, late, *((None, None, None) if late else (c.edge, c.fraction, c.filt))))
    return sorted(out, key=str)


@pytest.mark.parametrize("k, tau_ms", [(10, 60_000), (-1, -1)])
def test_restart_in_the_middle_of_traces(spark, town, batches, tmp_path, k, tau_ms):
    roads, graph = town
    for i in range(3):
        arrive(tmp_path / "in", i, batches[i])
    run(spark, tmp_path / "in", roads, graph, tmp_path / "twice", k=k, tau_ms=tau_ms, late=True)
    for i in range(3, 6):
        arrive(tmp_path / "in", i, batches[i])
    run(spark, tmp_path / "in", roads, graph, tmp_path / "twice", k=k, tau_ms=tau_ms, late=True)
    want = folded(spark, batches, roads, graph, MatchConfig(), k, tau_ms)
    assert rows_of(spark, tmp_path / "twice") == want
    assert len(want) > 100 and 0 < sum(r[2] for r in want) < 50 and any(r[0] is None for r in want)
    if k == 10:
        run(spark, tmp_path / "in", roads, graph, tmp_path / "once", k=k, tau_ms=tau_ms, late=True)
        assert rows_of(spark, tmp_path / "once") == want

    # the state as tables: no more steps than told, and candidates of these alone
    state = lambda name: spark.read.format("statestore").option("stateVarName", name).load(f"{tmp_path}/twice/c")
    steps = state("steps").select(F.col("key.*"), F.col("list_element.n").alias("n"), F.col("list_element.time_ms").alias("t"))
    span = steps.groupBy("vehicle_id").agg(F.count("*").alias("n"), (F.max("t") - F.min("t")).alias("ms"))
    worst = span.agg(F.max("n"), F.max("ms")).first()
    assert k < 0 or (1 <= worst[0] <= k + 1 and (tau_ms < 0 or worst[1] <= tau_ms))
    held = state("candidates").select(F.col("key.*"), F.col("user_map_key.n").alias("n"))
    told = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert told(held) == told(steps.select("vehicle_id", "n"))


def test_state_of_silent_vehicles_goes(spark, town, batches, tmp_path):
    roads, graph = town
    (lon, lat) = next((x, y) for v, _, x, y in batches[0] if v == "v1")
    place = lambda v, t: [(v, DAY + t, lon, lat)]
    for i, rows in enumerate([place("a", 0), place("a", 10_000), place("b", 7_200_000), place("b", 7_210_000), place("a", 7_220_000) + place("a", 0)]):
        arrive(tmp_path / "in", i, rows)
    q = run(spark, tmp_path / "in", roads, graph, tmp_path / "out", late=True)
    rows = rows_of(spark, tmp_path / "out")
    assert [r[:3] for r in rows] == [("a", DAY, False), ("a", DAY + 10_000, False), ("a", DAY + 7_220_000, False), ("b", DAY + 7_200_000, False), ("b", DAY + 7_210_000, False)]
    steps = spark.read.format("statestore").option("stateVarName", "steps").load(f"{tmp_path}/out/c")
    assert sorted(map(tuple, steps.select("key.vehicle_id", "list_element.n", "list_element.time_ms").collect())) == [("a", 0, DAY + 7_220_000), ("b", 0, DAY + 7_200_000), ("b", 1, DAY + 7_210_000)]
    assert sum(o.numRowsDroppedByWatermark for p in q.recentProgress for o in p.stateOperators) > 0
