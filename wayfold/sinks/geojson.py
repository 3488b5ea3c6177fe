"""GeoJSON renderings of traces, polylines and match states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.functions import roads


def _text(c: Column) -> Column:
    return F.to_json(F.struct(c.alias("x")))


def _feature(kind: str, coordinates: Column, properties: Column) -> Column:
    """A feature whose geometry is text already in JSON."""
    return F.concat(F.lit('{"type":"Feature","geometry":{"type":"' + kind + '","coordinates":'), coordinates, F.lit('},"properties":'), F.to_json(properties), F.lit("}"))


def point(lon: Column, lat: Column, **properties: Column) -> Column:
    return _feature("Point", F.concat(F.lit("["), lon.cast("string"), F.lit(","), lat.cast("string"), F.lit("]")), F.struct(*(v.alias(k) for k, v in properties.items())))


def line(points: Column, **properties: Column) -> Column:
    """points is an array of struct(lon, lat)."""
    pairs = F.transform(points, lambda p: F.concat(F.lit("["), p["lon"].cast("string"), F.lit(","), p["lat"].cast("string"), F.lit("]")))
    return _feature("LineString", F.concat(F.lit("["), F.array_join(pairs, ","), F.lit("]")), F.struct(*(v.alias(k) for k, v in properties.items())))


def collection(rows: DataFrame, key: str, feature: str = "feature", order: str = "seq") -> DataFrame:
    """(key, geojson): a feature collection for each key, features in order."""
    listed = F.array_sort(F.collect_list(F.struct(order, feature)))
    joined = rows.groupBy(key).agg(listed.alias("f"))
    return joined.select(key, F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.transform("f", lambda f: f[feature]), ","), F.lit("]}")).alias("geojson"))


def trace(matched: DataFrame, edges: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """A collection for each trace: observed points to the road (blue, failed ones red), edges by speed, events."""
    from wayfold.functions.geo import position_at, segments

    shapes = edges.select("ref_id", segments(F.col("geometry")).alias("segs"), F.col("geometry").alias("shape"))
    placed = matched.where("kind IN ('estimate', 'snapped')").join(shapes, "ref_id").withColumn("on", F.explode(F.array(position_at(F.col("segs"), F.col("end_fraction")))))
    observed = F.struct(F.col("lon").alias("lon"), F.col("lat").alias("lat"))
    lines = placed.where("kind = 'estimate'").select(key, "seq", line(F.array(observed, F.col("on")), stroke=F.lit("#0000ff"), time=F.col("time_ms")).alias("feature"))
    failed = matched.where("kind = 'failed_point'").select(key, "seq", point(F.col("lon"), F.col("lat"), stroke=F.lit("#ff0000"), time=F.col("time_ms")).alias("feature"))
    speeds = matched.where("kind = 'speed'").join(shapes, "ref_id").select(key, "seq", line(F.col("shape"), stroke=roads.colour(F.col("speed_mps") * 3.6), kmh=F.col("speed_mps") * 3.6).alias("feature"))
    events = placed.where("kind = 'snapped'").select(key, "seq", point(F.col("on.lon"), F.col("on.lat"), time=F.col("time_ms"), matched=F.lit(True)).alias("feature"))
    return collection(lines.unionByName(failed).unionByName(speeds).unionByName(events), key)


def as_lines(rows: DataFrame) -> DataFrame:
    """(value): rows of any model (edges, candidates, routes, matches) as JSON objects, nulls named; sources.requests.of_lines reads them."""
    return rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_traces(collections: DataFrame, path: str, key: str = "vehicle_id") -> None:
    """Text files in a folder for each trace."""
    collections.write.mode("overwrite").partitionBy(key).text(path)


def render_states(matched: DataFrame, kind: str = "slimjson", key: str = "vehicle_id", edges: DataFrame | None = None) -> DataFrame:
    """(key, rendering) of matched samples: json and debug with all that is known, slimjson with road and fraction, geojson as points.

    osm is json with roads named base:source:target, by edges; a road that edges lack is an error.
    """
    rows = matched.where("kind = 'estimate'")
    if kind == "osm":
        named = edges.select("ref_id", F.concat_ws(":", "geom_id", "src", "dst").alias("_road"))
        missing = F.raise_error(F.concat(F.lit("road not found in map: "), "ref_id")).cast("string")
        rows, kind = rows.join(named, "ref_id", "left").withColumn("ref_id", F.coalesce("_road", missing)), "json"
    if kind == "geojson":
        return collection(rows.withColumn("feature", point(F.col("lon"), F.col("lat"), time=F.col("time_ms"), ref=F.col("ref_id"))), key).withColumnRenamed("geojson", "rendering")
    columns = {"slimjson": ["time_ms", "ref_id", "end_fraction"], "json": ["time_ms", "ref_id", "end_fraction", "lon", "lat", "speed_mps"], "debug": ["time_ms", "ref_id", "end_fraction", "lon", "lat", "speed_mps", "seqprob_delta"]}[kind]
    listed = F.array_sort(F.collect_list(F.struct("seq", *columns)))
    return rows.groupBy(key).agg(F.to_json(listed).alias("rendering"))
