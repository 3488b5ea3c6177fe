"""The batch entry points: ingest, fast snap, and matching with all its outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.config import MatchConfig
from wayfold.functions import geo
from wayfold.operators import aggregate, match, network, spatial, traces
from wayfold.shared import materialize
from wayfold.sinks import geojson, tiles
from wayfold.sources.events import read_events


def ingest(spark: SparkSession, path: str, out: str, kind: str | None = None, tile_base: str | None = None, **options) -> DataFrame:
    """Normalises events of any format into Parquet under out; refuses what exists."""
    events = read_events(spark, path, kind, **options)
    tiles.write_events(events, f"{out}/event_data")
    written = spark.read.parquet(f"{out}/event_data")
    if tile_base is not None:
        tiles.tile_urls(written, tile_base).write.mode("errorifexists").text(f"{out}/tile_set")
    return written


def _with_lengths(snapped: DataFrame, roads: DataFrame) -> DataFrame:
    """Lengths of the snapped roads, looked up by id; they are written first, so that Spark knows how many there are."""
    lengths = materialize(network.edges(roads).select("ref_id", "length_m"), "lengths")
    return snapped.join(lengths, "ref_id")


def fast_snap(points: DataFrame, roads: DataFrame, key: str, config: MatchConfig = MatchConfig(), radius_m: float = 10.0) -> DataFrame:
    """Events binned on the roads that they are nearest to; no matching. One shuffle by point, one by bin."""
    events = spatial.snap(points, roads, key, radius_m).withColumn("e", F.explode(F.map_entries("event_data"))).select("ref_id", "fraction", "length_m", F.col("e.key").alias("event_type"), F.col("e.value").alias("event_value"))
    return aggregate.binned_events(events, config.bin_size_m)


def match_all(points: DataFrame, roads: DataFrame, config: MatchConfig = MatchConfig()) -> dict[str, DataFrame]:
    """Frames of the full path: matched rows, weekly speeds, weekly binned events, dust, traces as GeoJSON.

    Matching runs once: its rows are written to the shared folder, and the four
    outputs read only the columns and kinds they need.
    """
    matched = materialize(match.match(points, roads, config), "matched")
    edges = network.edges(roads)
    snapped = match.snapped_events(matched).select("vehicle_id", "time_ms", "ref_id", "fraction")
    events = _with_lengths(traces.with_event_data(snapped, points), roads)
    return {
        "matched": matched,
        "speeds": aggregate.weekly_speed_cycle(match.speed_edges(matched)),
        "events": aggregate.weekly_binned_events(events, config.bin_size_m),
        "dust": aggregate.failure_clusters(match.failures(matched)),
        "geojson": geojson.trace(matched, edges),
    }


def write_all(outputs: dict[str, DataFrame], roads: DataFrame, folder: str) -> None:
    """Speeds and events by week and tile, dust by tile, traces by vehicle."""
    edges = network.edges(roads)
    for kind in ("speeds", "events"):
        tiles.write_parquet(tiles.with_tiles(outputs[kind], edges), f"{folder}/{kind}", kind)
    dust = tiles.with_tiles(outputs["dust"], edges, "start_ref", last=False)
    tiles.write_parquet(dust, f"{folder}/dust", "dust", week=None)
    geojson.write_traces(outputs["geojson"], f"{folder}/traces")


def road_lengths(roads: DataFrame) -> DataFrame:
    return roads.select("geom_id", geo.length(F.col("geometry")).alias("length_m"))
