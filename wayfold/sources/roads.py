"""Road sources: geometry tiles, whole maps, road types, JDBC, GeoJSON coordinates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.operators.network import dedup_roads, filter_roads


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    """Roads of delimited geometry messages in files named *.geometry.*, with their tile.

    A file of any other name can be read by naming it. Roads in several tiles come once.
    """
    from wayfold.sources import delimited

    named = ".geometry." in path.rsplit("/", 1)[-1] or "*" in path
    return dedup_roads(delimited.read(spark, path, "geometry", glob=None if named else "*.geometry.*"))


def read_roads(spark: SparkSession, path: str, excluded_classes: list[int] = (), ring: list[tuple[float, float]] | None = None) -> DataFrame:
    """A whole map, from tiles or from Parquet, without excluded classes and outside of the ring."""
    rows = spark.read.parquet(path) if path.endswith(".parquet") else read_tiles(spark, path)
    return filter_roads(rows, excluded_classes, ring)


def write_roads(rows: DataFrame, path: str) -> None:
    """Roads as Parquet, to be read by read_roads; refuses a path that exists."""
    rows.write.mode("errorifexists").parquet(path)


def _fetched(tile: str, folder: str, fetch: Callable[[str], bytes], address: str) -> str:
    """The path of a tile under folder, downloaded unless it is there; it gets its name when it is whole."""
    import uuid

    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    path = f"{root}/{tile}.geometry.6.pbf"
    if store.get_file_info(path).type == fs.FileType.NotFound:
        data, part = fetch(f"{address}/{tile}.geometry.6.pbf"), f"{path}.{uuid.uuid4().hex}.part"
        store.create_dir(root, recursive=True)
        with store.open_output_stream(part) as f:
            f.write(data)
        store.move(part, path)
    return path


def fetch_tiles(tiles: list[str], folder: str, fetch: Callable[[str], bytes], source: str = "osm/planet", base: str = "") -> list[str]:
    """Downloads tiles that folder lacks, by the given fetch; returns their paths.

    folder is a URI that all executors reach, or a path. Without a network, fetch can
    read a mirror; nothing here opens connections.
    """
    return [_fetched(tile, folder, fetch, f"{base}{source}") for tile in tiles]


def fetched_tiles(tiles: DataFrame, folder: str, fetch: Callable[[str], bytes], source: str = "osm/planet", base: str = "", column: str = "tile") -> DataFrame:
    """(tile, path) of the distinct tiles, each downloaded by a task unless folder has it; written out, so that it runs once."""
    from wayfold.shared import materialize

    def work(batches):
        import pyarrow as pa

        for batch in batches:
            names = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_fetched(t, folder, fetch, f"{base}{source}") for t in names], pa.string())], names=["tile", "path"])

    wanted = tiles.select(F.col(column).alias("tile")).where("tile IS NOT NULL").distinct()
    return materialize(wanted.mapInArrow(work, "tile string, path string"), "fetched")


def parse_road_types(documents: DataFrame, column: str = "value") -> DataFrame:
    """(tag, value, id, priority, maxspeed) of road type settings: {"tags": [{"tag", "values": [{"name", "id", ...}]}]}."""
    schema = "tags array<struct<tag:string,values:array<struct<name:string,id:int,priority:double,maxspeed:double>>>>"
    tags = documents.select(F.explode(F.from_json(column, schema)["tags"]).alias("t"))
    return tags.select("t.tag", F.explode("t.values").alias("v")).select("tag", F.col("v.name").alias("value"), "v.id", "v.priority", "v.maxspeed")


def decode_coordinates(text: Column) -> Column:
    """The polyline of a GeoJSON-like object's coordinates."""
    pairs = F.from_json(text, "coordinates array<array<double>>")["coordinates"]
    return F.transform(pairs, lambda p: F.struct(F.get(p, F.lit(0)).alias("lon"), F.get(p, F.lit(1)).alias("lat")))


def read_jdbc(spark: SparkSession, url: str, query: str, fetch_size: int = 100, **options) -> DataFrame:
    """Rows of a database query, by fetches of this size; options as Spark's JDBC source has them."""
    return spark.read.format("jdbc").options(url=url, query=query, fetchsize=fetch_size, **options).load()
