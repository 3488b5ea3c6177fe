"""Event sources: CSV, JSON lines, taxi trips in TSV, GPX, delimited protobuf, Parquet.

Every reader gives the schema EVENT. Text is parsed by expressions on lines, so
lines that don't fit are dropped (or fail the query, where strict) row by row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.functions import time as tm


def _event_data(name: Column, value: Column) -> Column:
    """A map of one entry; empty where there is no name."""
    return F.when(F.coalesce(F.length(F.trim(name)), F.lit(0)) > 0, F.create_map(name, value)).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>")))


def _time(text: Column) -> Column:
    """Milliseconds of a number as it is, or of an ISO 8601 date and time."""
    return F.coalesce(text.try_cast("long"), tm.parse_ms(text))


def _once(value: Column) -> Column:
    """value as an explode of one item: the optimizer then computes it once for each row.

    Filters on what is parsed would otherwise repeat the parsing, and with many
    fields the generated code outgrows what the JVM compiles.
    """
    return F.explode(F.array(value))


def parse_csv(lines: DataFrame, column: str = "value", strict: bool = False) -> DataFrame:
    """vehicle,time,lat,lon[,event[,value]]; shorter lines are dropped, a missing value is 0.

    Trailing empty fields don't count. Bad times or numbers drop the line, or fail
    the query where strict.
    """
    parts = F.split(F.regexp_replace(F.col(column), ",+$", ""), ",")
    rows = lines.select(_once(parts).alias("p")).where(F.size("p") >= 4)
    value = F.coalesce(F.get("p", F.lit(5)).try_cast("double"), F.lit(0.0))
    row = F.struct(F.get("p", F.lit(0)).alias("vehicle_id"), _time(F.get("p", F.lit(1))).alias("time_ms"), F.get("p", F.lit(2)).try_cast("double").alias("lat"), F.get("p", F.lit(3)).try_cast("double").alias("lon"), _event_data(F.get("p", F.lit(4)), value).alias("event_data"), F.get("p", F.lit(1)).alias("_t"))
    rows = rows.select(_once(row).alias("r")).select("r.*")
    whole = F.col("time_ms").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull()
    if strict:
        checked = F.when(whole, F.col("time_ms")).otherwise(F.raise_error(F.concat(F.lit("bad event line, time "), F.coalesce("_t", F.lit("")))).cast("long"))
        return rows.withColumn("time_ms", checked).drop("_t")
    return rows.where(whole).drop("_t")


def parse_json(lines: DataFrame, column: str = "value") -> DataFrame:
    """Objects of timestamp (seconds), longitude and latitude (text), id, eventType, eventValue; other keys and bad lines are dropped."""
    schema = "timestamp long, longitude string, latitude string, id string, eventType string, eventValue double"
    rows = lines.select(_once(F.from_json(column, schema)).alias("j")).where("j.timestamp IS NOT NULL AND j.id IS NOT NULL")
    lat, lon = F.col("j.latitude").try_cast("double"), F.col("j.longitude").try_cast("double")
    return rows.select(F.col("j.id").alias("vehicle_id"), (F.col("j.timestamp") * 1000).alias("time_ms"), lat.alias("lat"), lon.alias("lon"), _event_data(F.col("j.eventType"), F.coalesce("j.eventValue", F.lit(0.0))).alias("event_data")).where("lat IS NOT NULL AND lon IS NOT NULL")


def parse_taxi(lines: DataFrame, column: str = "value", days: tuple[int, ...] = (10, 11)) -> DataFrame:
    """Trips of a tab-separated table: a pickup and a dropoff event for each.

    Start and end times are in columns 5 and 8, their places as JSON in 18 and 19,
    the vehicle in 21. Spreadsheet quotes are undone first. Only these days of the
    month (UTC) are kept; None keeps all. A place without latitude or longitude
    gives no event.
    """
    text = F.replace(F.replace(F.replace(F.col(column), F.lit('"""'), F.lit('"')), F.lit('""'), F.lit('"')), F.lit('"{'), F.lit("{"))
    p = F.split(F.replace(text, F.lit('}"'), F.lit("}")), "\t")
    rows = lines.select(_once(p).alias("p")).where((F.size("p") > 21) & (F.get("p", F.lit(5)) != "StartTime"))
    place = "Latitude double, Longitude double"

    def event(name: str, time: int, at: int) -> Column:
        where = F.from_json(F.get("p", F.lit(at)), place)
        return F.struct(F.lit(name).alias("name"), tm.parse_ms(F.get("p", F.lit(time))).alias("t"), where["Latitude"].alias("lat"), where["Longitude"].alias("lon"))

    both = rows.select(F.get("p", F.lit(21)).alias("vehicle_id"), F.explode(F.array(event("pickup", 5, 18), event("dropoff", 8, 19))).alias("e"))
    both = both.where("e.t IS NOT NULL AND e.lat IS NOT NULL AND e.lon IS NOT NULL")
    if days is not None:
        both = both.where(tm.day_of_month(F.col("e.t")).isin(list(days)))
    return both.select("vehicle_id", F.col("e.t").alias("time_ms"), "e.lat", "e.lon", _event_data(F.col("e.name"), F.lit(0.0)).alias("event_data"))


def read_gpx(spark: SparkSession, path: str, speeds: bool = True, compat_drop_last: bool = False) -> DataFrame:
    """All track points and waypoints of GPX files; a file is a vehicle, named by its stem.

    Files whose name has no single dot get a hash of their path. Points without time
    are dropped. Waypoints carry their name (child or attribute) as an event without
    value; track points their speed as `gpsSpeed`. compat_drop_last leaves out each
    file's last track point.
    """
    fields = "_lat double, _lon double, _name string, time string, speed double, name string"
    def read(tag):
        return spark.read.format("xml").option("rowTag", tag).schema(fields).load(path).select("*", F.col("_metadata.file_path").alias("file"))

    stem = F.regexp_extract("file", r"/([^/.]+)\.[^/.]*$", 1)
    vehicle = F.when(stem != "", stem).otherwise(F.sha2("file", 256)).alias("vehicle_id")
    rows = [(read("trkpt"), F.lit("gpsSpeed"), F.col("speed")), (read("wpt"), F.coalesce("name", "_name"), F.lit(None).cast("double"))]
    out = []
    for k, (df, name, value) in enumerate(rows):
        data = _event_data(F.when(F.lit(k == 1) | (F.lit(speeds) & value.isNotNull()), name), value)
        out.append(df.select(vehicle, tm.parse_ms(F.col("time")).alias("time_ms"), F.col("_lat").alias("lat"), F.col("_lon").alias("lon"), data.alias("event_data")).where("time_ms IS NOT NULL"))
    if compat_drop_last:
        last = out[0].groupBy("vehicle_id").agg(F.max("time_ms").alias("last"))
        out[0] = out[0].join(last, "vehicle_id").where("time_ms < last").drop("last")
    return out[0].unionByName(out[1])


def read_delimited(spark: SparkSession, path: str, **options) -> DataFrame:
    """Length-delimited event messages, of one or many files of any size."""
    from wayfold.sources import delimited

    return delimited.read(spark, path, "event", **options)


def _lines(parse):
    return lambda spark, path, **options: parse(spark.read.text(path), **options)


READERS: dict[str, Callable[..., DataFrame]] = {
    "CSV": _lines(parse_csv),
    "JSON": _lines(parse_json),
    "DCFHV": _lines(parse_taxi),
    "GPX": read_gpx,
    "PBF": read_delimited,
    "PARQUET": lambda spark, path: spark.read.parquet(path),
}


def read_events(spark: SparkSession, path: str, kind: str | None = None, **options) -> DataFrame:
    """Events of any format: by kind in any case, else by the path's extension."""
    kind = (kind or path.rsplit("/", 1)[-1].rpartition(".")[2] or path).upper()
    if kind not in READERS:
        raise ValueError(f"no reader for {kind}; there are {', '.join(READERS)}")
    return READERS[kind](spark, path, **options)
