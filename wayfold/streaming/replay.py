"""Streams of samples: paced replay from files, and matching with bounded state."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.config import MatchConfig
from wayfold.functions import time as tm
from wayfold.schema import EVENT


def replay(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Event files as a stream, so many at a time."""
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def paced(spark: SparkSession, events: DataFrame, speed: int = 1) -> DataFrame:
    """Events as a stream in their own cadence, speed times as fast.

    A second of event time since the first event is a tick of Spark's clock; events
    come with their tick, so in order of time however they are stored. Every trigger
    looks through events: let it be a recorded drive, not an archive.
    """
    first = F.lit(events.agg(F.min("time_ms")).first()[0]).cast("long")
    ticks = spark.readStream.format("rate").option("rowsPerSecond", speed).load().select(F.col("value").alias("_tick"))
    return events.withColumn("_tick", F.floor((F.col("time_ms") - first) / 1000)).join(ticks, "_tick").drop("_tick")


def hourly_counts(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Events by tumbling hour and hour of the week; what comes later than the watermark is dropped."""
    stamped = events.withColumn("ts", F.timestamp_millis("time_ms")).withWatermark("ts", late)
    return stamped.groupBy(F.window("ts", "1 hour"), tm.hour_of_week(F.col("time_ms")).alias("period")).agg(F.count("*").alias("n")).select(F.col("window.start").alias("hour"), "period", "n")


def matched(events: DataFrame, roads: DataFrame, config: MatchConfig = MatchConfig(), k: int = 10, tau_ms: int = 60_000, max_age_ms: int = 3_600_000, key: str = "vehicle_id", monitor: bool = False, graph: str | None = None, late: bool = False) -> DataFrame:
    """(key, time_ms, lon, lat, ref_id, fraction, probability): each sample's likeliest road position so far.

    Candidates come from a join of the stream with the roads; a vehicle's state is
    that of state.Matcher, of at most k steps back and tau_ms, in RocksDB (the session's
    state store is set to it, if it is Spark's default). A vehicle silent for max_age_ms
    loses its state, by event time. The network is that of graphstore.write (graph, or
    written here) and opened by tile.

    Samples older than their vehicle's last one are dropped; with late they give a row
    without a position, where the column of that name is true. What is older than the
    watermark of ten minutes Spark drops and counts itself (numRowsDroppedByWatermark).
    With monitor, a column of that name has all candidates in JSON.
    """
    from wayfold.operators import graphstore, spatial
    from wayfold.streaming import state

    state.on_rocksdb(events.sparkSession)
    output = f"{key} {events.schema[key].dataType.simpleString()}, time_ms long, lon double, lat double, ref_id string, fraction double, probability double" + (", late boolean" if late else "") + (", monitor string" if monitor else "")
    columns = [key, "time_ms", "lon", "lat", "ref_id", "fraction", "probability", *(["late"] if late else []), *(["monitor"] if monitor else [])]
    matcher = state.Matcher(graph or graphstore.write(roads), config, k, tau_ms, max_age_ms, columns, late, monitor)
    stamped = events.where("time_ms IS NOT NULL").withColumn("ts", F.timestamp_millis("time_ms")).withWatermark("ts", "10 minutes").select(key, "time_ms", "lon", "lat", "ts")
    near = spatial.segment_hits(stamped, graphstore.named_roads(roads), config.radius_m).select(key, "time_ms", "lon", "lat", "ts", "geom_id", "fwd_ref", "back_ref", "place.d", "place.i", "along", "road_lon", "road_lat")
    return near.groupBy(key).transformWithStateInPandas(matcher, output, "append", "EventTime")


def ordered_speeds(events: DataFrame, max_age_ms: int = 3_600_000, key: str = "vehicle_id") -> DataFrame:
    """(key, time_ms, metres, dt_ms) between consecutive samples of a vehicle, across batches.

    The state is the last sample of each vehicle. Samples that are older than it are
    dropped; a vehicle silent for max_age_ms loses its state, by event time.
    """
    state, output = "t long, lon double, lat double", f"{key} string, time_ms long, metres double, dt_ms long"

    def step(name, frames: Iterator, held) -> Iterator:
        import pandas as pd

        from wayfold.operators.kernel import planar_m

        if held.hasTimedOut:
            held.remove()
            return
        rows = pd.concat(list(frames)).dropna(subset=["time_ms"]).sort_values("time_ms", kind="stable")
        last, out = (held.get if held.exists else None), []
        for t, lon, lat in zip(rows.time_ms, rows.lon, rows.lat):
            if last is not None:
                if t <= last[0]:
                    continue
                out.append((name[0], int(t), planar_m(last[1], last[2], lon, lat), int(t - last[0])))
            last = (int(t), float(lon), float(lat))
        if last is not None:
            held.update(last)
            held.setTimeoutTimestamp(max(last[0], held.getCurrentWatermarkMs()) + max_age_ms)
        yield pd.DataFrame(out, columns=[key, "time_ms", "metres", "dt_ms"])

    stamped = events.withColumn("ts", F.timestamp_millis("time_ms")).withWatermark("ts", "10 minutes")
    return stamped.groupBy(key).applyInPandasWithState(step, output, state, "append", "EventTimeTimeout")
