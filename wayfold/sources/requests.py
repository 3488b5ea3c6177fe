"""Match requests: JSON arrays of samples, bare or inside {"request": ..., "format": ...}."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfold.functions.geo import normalise_azimuth
from wayfold.functions.time import parse_ms

_SAMPLE = "struct<id:string,time:string,point:string,azimuth:double>"
FORMATS = ["json", "slimjson", "geojson", "debug"]


def parse_requests(requests: DataFrame, column: str = "value", key: str = "request_id") -> DataFrame:
    """(key, format, sample_id, time_ms, lon, lat, azimuth) of each sample.

    Times are milliseconds or text like 2014-09-10 07:13:22+0200; points are WKT.
    A request that names a time twice is an error.
    """
    text = F.trim(F.col(column))
    array = F.from_json(F.when(text.startswith("["), text), f"array<{_SAMPLE}>")
    whole = F.from_json(F.when(~text.startswith("["), text), f"request array<{_SAMPLE}>, format string")
    rows = requests.select(key, F.coalesce(F.lower(whole["format"]), F.lit("slimjson")).alias("format"), F.coalesce(array, whole["request"]).alias("s"))
    times = F.transform("s", lambda s: s["time"])
    distinct = F.size(F.array_distinct(times)) == F.size(times)
    rows = rows.withColumn("s", F.when(distinct, F.col("s")).otherwise(F.raise_error("a request has a time twice").cast(f"array<{_SAMPLE}>")))
    rows = rows.select(key, "format", F.explode("s").alias("s"))
    zone = F.regexp_replace("s.time", r"([+-]\d\d)(\d\d)$", "$1:$2")
    time = F.coalesce(F.col("s.time").try_cast("long"), parse_ms(zone))
    number = lambda k: F.regexp_extract("s.point", r"(?i)point\s*\(\s*(-?[0-9.eE+-]+)\s+(-?[0-9.eE+-]+)\s*\)", k).try_cast("double")
    return rows.select(key, "format", F.col("s.id").alias("sample_id"), time.alias("time_ms"), number(1).alias("lon"), number(2).alias("lat"), normalise_azimuth(F.col("s.azimuth")).alias("azimuth"))


def of_lines(lines: DataFrame, schema: StructType | str) -> DataFrame:
    """Rows from JSON objects as sinks.geojson.as_lines writes them; what doesn't fit the schema fails."""
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
