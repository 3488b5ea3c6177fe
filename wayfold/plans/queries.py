"""The queries over the test tables, and SQL that tells the same by its own formulas.

Numbers are rounded by floor(x + 0.5) at fixed digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.config import MatchConfig
from wayfold.functions import geo, hmm, roads, tile
from wayfold.functions import time as tm
from wayfold.operators import aggregate, markov, match, network, pieces, routing, spatial, traces
from wayfold.plans import batch
from wayfold.plans.fixtures import GPS_SQL, GRID_SQL, gps, grid, rounded_sql, sql_candidates, sql_direct, sql_distance, sql_inverse, sql_scales
from wayfold.plans.matching_sql import matched_ctes
from wayfold.shared import materialize, new_path
from wayfold.sinks import geojson, tiles
from wayfold.sources import events as sources
from wayfold.sources import delimited, requests
from wayfold.sources import roads as road_sources

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL where there is one."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def rounded(x: Column, digits: int) -> Column:
    return F.floor(x * float(10**digits) + 0.5) / float(10**digits)


def rounded_sum(x: Column, digits: int) -> Column:
    """rounded() of any double: floor gives a long, which infinities, NaN and sums beyond it don't fit; a double of 2^52 or more is whole."""
    scaled = x * float(10**digits) + 0.5
    return F.when(F.abs(scaled) < 2.0**52, F.floor(scaled)).otherwise(scaled) / float(10**digits)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


# Tiles and time



def sql_tile(zoom: int, lon: str = "lon", lat: str = "lat") -> str:
    size = float(256 << zoom)
    x = f"CAST(floor(trunc(least(greatest((least(greatest({lon}, -180), 180) + 180) / 360 * {size} + 0.5, 0), {size} - 1)) / 256) AS INTEGER)"
    s = f"sin(least(greatest({lat}, -85.05112878), 85.05112878) * pi() / 180)"
    y = f"CAST(floor(trunc(least(greatest((0.5 - ln((1 + {s}) / (1 - {s})) / (4 * pi())) * {size} + 0.5, 0), {size} - 1)) / 256) AS INTEGER)"
    return f"'{zoom}-' || {x} || '-' || {y}"


@query(f"WITH {GPS_SQL} SELECT {sql_tile(12)} AS tile, CAST((isodow(epoch_ms(true_ms)) - 1) * 24 + hour(epoch_ms(true_ms)) AS INTEGER) AS period, strftime(date_trunc('week', epoch_ms(true_ms)), '%Y-%m-%d') AS week, count(*) AS n FROM gps GROUP BY 1, 2, 3")
def tile_counts(spark, sf_dir):
    g = gps(spark, sf_dir)
    return g.groupBy(tile.tile_id(F.col("lon"), F.col("lat")).alias("tile"), tm.hour_of_week(F.col("true_ms")).alias("period"), tm.week_text(F.col("true_ms")).alias("week")).agg(F.count("*").alias("n"))


@query(f"WITH {GPS_SQL} SELECT DISTINCT 'https://tiles.example.org/' || {sql_tile(12)} || '.geometry.6.pbf' AS url FROM gps")
def tile_set_urls(spark, sf_dir):
    return tiles.tile_urls(gps(spark, sf_dir), "https://tiles.example.org/")


@query("WITH " + GPS_SQL + " SELECT zoom, tile, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT {z} AS zoom, {sql_tile(z)} AS tile FROM gps" for z in (0, 6, 12, 16, 20)) + ") GROUP BY 1, 2")
def multi_zoom_tiles(spark, sf_dir):
    g = gps(spark, sf_dir)
    each = F.array(*(F.struct(F.lit(z).alias("zoom"), tile.tile_id(F.col("lon"), F.col("lat"), z).alias("tile")) for z in (0, 6, 12, 16, 20)))
    return g.select(F.explode(each).alias("t")).groupBy("t.zoom", "t.tile").agg(F.count("*").alias("n"))


@query(f"WITH {GPS_SQL}, t AS (SELECT DISTINCT {sql_tile(16)} AS tile FROM gps) SELECT tile, row_number() OVER (ORDER BY CAST(split_part(tile, '-', 1) AS INTEGER), CAST(split_part(tile, '-', 2) AS INTEGER) DESC, CAST(split_part(tile, '-', 3) AS INTEGER) DESC) AS place FROM t")
def tile_order(spark, sf_dir):
    t = gps(spark, sf_dir).select(F.lit(16).alias("z"), tile.tile_x(F.col("lon"), 16).alias("x"), tile.tile_y(F.col("lat"), 16).alias("y")).distinct()
    return tiles.ranked(t).select(F.concat_ws("-", "z", "x", "y").alias("tile"), "place")


@query(f"WITH {GRID_SQL} SELECT geom_id, unnest(list_distinct([{sql_tile(16, 'x0', 'y0')}, {sql_tile(16, 'x2', 'y2')}])) AS tile FROM grid")
def record_tiles(spark, sf_dir):
    return grid(spark, sf_dir).select("geom_id", F.explode(tile.record_tiles(F.col("geometry"), 16)).alias("tile"))


@query("SELECT CAST((isodow(ts) - 1) * 24 + hour(ts) AS INTEGER) AS period, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def hour_of_week_counts(spark, sf_dir):
    return events(spark, sf_dir).groupBy(tm.hour_of_week(tm.to_ms("ts")).alias("period"), "event_type").agg(F.count("*").alias("n"))


@query("SELECT CAST(CAST(ts - INTERVAL 1 DAY * (isodow(ts) - 1) AS DATE) AS VARCHAR) AS week, count(*) AS n, count(DISTINCT user_id) AS vehicles FROM events GROUP BY 1")
def week_start_counts(spark, sf_dir):
    return events(spark, sf_dir).groupBy(tm.week_text(tm.to_ms("ts")).alias("week")).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("vehicles"))


@query("SELECT event_id, CASE WHEN t < 957139200 THEN t * 1000 ELSE t END AS time_ms, CAST(floor((CASE WHEN t < 957139200 THEN t * 1000 ELSE t END) / 3600000) AS BIGINT) AS epoch_hour FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 957139200 + (event_id % 7) - 3 ELSE epoch_us(ts) // 1000 END AS t FROM events)")
def seconds_normalise(spark, sf_dir):
    t = F.when(F.col("event_id") % 2 == 0, F.lit(957139200).cast("long") + (F.col("event_id") % 7) - 3).otherwise(tm.to_ms("ts"))
    e = events(spark, sf_dir).select("event_id", tm.seconds_to_ms(t).alias("time_ms"))
    return e.withColumn("epoch_hour", tm.epoch_hour(F.col("time_ms")))


# Sources, fed with lines made from events


def _csv_lines(spark, sf_dir):
    g = gps(spark, sf_dir)
    t = F.when(F.col("rn") % 2 == 0, F.col("true_ms").cast("string")).otherwise(F.date_format(tm.wall_clock("true_ms"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    base = F.concat_ws(",", "vehicle_id", t, F.col("lat").cast("string"), F.col("lon").cast("string"))
    k = F.col("event_id") % 5
    value = F.when(k == 0, F.concat_ws(",", base, "event_type", F.col("value").cast("string"))).when(k == 1, F.concat_ws(",", base, "event_type")).when(k == 2, F.concat(base, F.lit(",,"))).when(k == 3, F.concat_ws(",", "vehicle_id", t, F.col("lat").cast("string"))).otherwise(base)
    return g.select(value.alias("value"))


@query(f"WITH {GPS_SQL} SELECT vehicle_id, true_ms AS time_ms, lat, lon, CASE WHEN event_id % 5 < 2 THEN event_type END AS event_type, CASE WHEN event_id % 5 = 0 THEN value WHEN event_id % 5 = 1 THEN 0.0 END AS event_value FROM gps WHERE event_id % 5 <> 3")
def parse_csv(spark, sf_dir):
    parsed = sources.parse_csv(_csv_lines(spark, sf_dir))
    return parsed.select("vehicle_id", "time_ms", "lat", "lon", F.explode_outer("event_data").alias("event_type", "event_value"))


@query(f"WITH {GPS_SQL} SELECT vehicle_id, true_ms // 1000 * 1000 AS time_ms, lat, lon, CASE WHEN event_id % 3 <> 0 THEN event_type END AS event_type, CASE event_id % 3 WHEN 1 THEN value WHEN 2 THEN 0.0 END AS event_value FROM gps WHERE event_id % 7 <> 0")
def parse_json(spark, sf_dir):
    g, k = gps(spark, sf_dir), F.col("event_id") % 3
    line = F.to_json(F.struct(F.floor(F.col("true_ms") / 1000).alias("timestamp"), F.col("lon").cast("string").alias("longitude"), F.col("lat").cast("string").alias("latitude"), F.col("vehicle_id").alias("id"), F.when(k != 0, F.col("event_type")).alias("eventType"), F.when(k == 1, F.col("value")).alias("eventValue"), F.lit("x").alias("other")))
    lines = g.select(F.when(F.col("event_id") % 7 == 0, F.substring(line, 1, 20)).otherwise(line).alias("value"))
    return sources.parse_json(lines).select("vehicle_id", "time_ms", "lat", "lon", F.explode_outer("event_data").alias("event_type", "event_value"))


@query(f"""WITH {GPS_SQL}, trips AS (
  SELECT 'cab' || vehicle_id AS vehicle_id, true_ms // 1000 * 1000 AS time_ms, lat, lon, 'pickup' AS event_type, event_id FROM gps
  UNION ALL SELECT 'cab' || vehicle_id, true_ms // 1000 * 1000 + 600000, lat + 0.01, lon, 'dropoff', event_id FROM gps WHERE event_id % 4 <> 0)
SELECT vehicle_id, time_ms, lat, lon, event_type, CAST(0.0 AS DOUBLE) AS event_value FROM trips WHERE day(epoch_ms(time_ms)) IN (10, 11)""")
def parse_taxi(spark, sf_dir):
    g = gps(spark, sf_dir)
    stamp = lambda c: F.date_format(tm.wall_clock(c), "yyyy-MM-dd HH:mm:ss")
    start = F.floor(F.col("true_ms") / 1000) * 1000
    place = lambda lat: F.concat(F.lit('"{""Latitude"":'), F.coalesce(lat.cast("string"), F.lit("null")), F.lit(',""Longitude"":'), F.col("lon").cast("string"), F.lit('}"'))
    columns = [F.lit("-")] * 26
    columns[5], columns[8], columns[21] = stamp(start), stamp(start + 600000), F.concat(F.lit("cab"), F.col("vehicle_id"))
    columns[18], columns[19] = place(F.col("lat")), place(F.when(F.col("event_id") % 4 != 0, F.col("lat") + 0.01))
    lines = g.select(F.concat_ws("\t", *columns).alias("value"))
    return sources.parse_taxi(lines).select("vehicle_id", "time_ms", "lat", "lon", F.explode_outer("event_data").alias("event_type", "event_value"))


@query(f"WITH {GPS_SQL} SELECT vehicle_id AS request_id, CASE WHEN substr(vehicle_id, 2)::INT % 2 = 0 THEN 'geojson' ELSE 'slimjson' END AS format, 's' || event_id AS sample_id, true_ms // 1000 * 1000 AS time_ms, lon, lat, CAST((rn * 77 - 100) AS DOUBLE) - 360 * floor((rn * 77 - 100) / 360.0) AS azimuth FROM gps")
def parse_request(spark, sf_dir):
    g = gps(spark, sf_dir)
    second = F.floor(F.col("true_ms") / 1000) * 1000
    t = F.when(F.col("rn") % 2 == 0, second.cast("string")).otherwise(F.date_format(tm.wall_clock(second), "yyyy-MM-dd HH:mm:ss'+0000'"))
    sample = F.struct(F.concat(F.lit("s"), "event_id").alias("id"), t.alias("time"), F.concat(F.lit("POINT ("), F.col("lon").cast("string"), F.lit(" "), F.col("lat").cast("string"), F.lit(")")).alias("point"), (F.col("rn") * 77 - 100).cast("double").alias("azimuth"))
    listed = g.groupBy(F.col("vehicle_id").alias("request_id")).agg(F.collect_list(sample).alias("s"))
    even = F.substring("request_id", 2, 9).cast("int") % 2 == 0
    value = F.when(even, F.to_json(F.struct(F.col("s").alias("request"), F.lit("geojson").alias("format")))).otherwise(F.to_json("s"))
    return requests.parse_requests(listed.select("request_id", value.alias("value")))


@query(f"WITH {GRID_SQL} SELECT geom_id, CAST(k AS INTEGER) AS k, lon, lat FROM (SELECT geom_id, 0 AS k, x0 AS lon, y0 AS lat FROM grid UNION ALL SELECT geom_id, 1, (x0 + x2) / 2, (y0 + y2) / 2 FROM grid UNION ALL SELECT geom_id, 2, x2, y2 FROM grid)")
def decode_coordinates(spark, sf_dir):
    text = F.to_json(F.struct(F.transform("geometry", lambda p: F.array(p["lon"], p["lat"])).alias("coordinates")))
    lines = grid(spark, sf_dir).select("geom_id", text.alias("t"))
    return lines.select("geom_id", F.posexplode(road_sources.decode_coordinates(F.col("t"))).alias("k", "p")).select("geom_id", "k", "p.lon", "p.lat")


@query(f"WITH {GRID_SQL} SELECT DISTINCT 'highway' AS tag, 'class' || road_class AS value, road_class AS id, CAST(1 + road_class / 10.0 AS DOUBLE) AS priority, CAST(130 - 10 * road_class AS DOUBLE) AS maxspeed FROM grid")
def road_types(spark, sf_dir):
    """The document of the classes that the network has, written as JSON and read back."""
    i = F.col("road_class")
    value = F.struct(F.concat(F.lit("class"), i.cast("string")).alias("name"), i.alias("id"), (1 + i / 10.0).alias("priority"), (130 - 10 * i).cast("double").alias("maxspeed"))
    document = grid(spark, sf_dir).select("road_class").distinct().agg(F.collect_list(value).alias("values")).select(F.to_json(F.struct(F.array(F.struct(F.lit("highway").alias("tag"), "values")).alias("tags"))).alias("value"))
    return road_sources.parse_road_types(document)


@query(f"WITH {GPS_SQL} SELECT vehicle_id, true_ms AS time_ms, lat, lon, event_type, coalesce(value, 0) AS event_value FROM gps")
def delimited_events(spark, sf_dir):
    """Events written as delimited messages and read back by splits that begin inside of files."""
    path = new_path(spark, "delimited-events")
    tiles.write_delimited(gps(spark, sf_dir).withColumn("time_ms", F.col("true_ms")), path)
    read = sources.read_delimited(spark, path, split_bytes=65_536)
    return read.select("vehicle_id", "time_ms", "lat", "lon", F.explode("event_data").alias("event_type", "event_value"))


@query(f"WITH {GRID_SQL} SELECT geom_id, from_node, to_node, fwd_ref, back_ref, road_class, x0 AS first_lon, y2 AS last_lat FROM grid")
def delimited_roads(spark, sf_dir):
    """Roads written as geometry messages and read back."""
    path = new_path(spark, "delimited-roads")
    delimited.write(grid(spark, sf_dir), path, "geometry")
    read = delimited.read(spark, path, "geometry", split_bytes=16_384)
    return read.select("geom_id", "from_node", "to_node", "fwd_ref", "back_ref", "road_class", F.col("geometry")[0]["lon"].alias("first_lon"), F.element_at("geometry", -1)["lat"].alias("last_lat"))


# Roads and costs

_SPEED = "CASE road_class WHEN 0 THEN 130.0 WHEN 1 THEN 120.0 WHEN 2 THEN 110.0 ELSE 80.0 END"
_PRIORITY = "CASE road_class WHEN 0 THEN 0.9 WHEN 1 THEN 1.1 WHEN 2 THEN 1.2 WHEN 3 THEN 1.4 WHEN 4 THEN 1.6 WHEN 5 THEN 2.5 WHEN 6 THEN 3.0 ELSE 5.0 END"
_LENGTH = f"{sql_distance('x0', 'y0', '(x0 + x2) / 2', '(y0 + y2) / 2')} + {sql_distance('(x0 + x2) / 2', '(y0 + y2) / 2', 'x2', 'y2')}"
EDGES_SQL = f"""{GRID_SQL}, edges AS (
  SELECT fwd_ref AS ref_id, geom_id, true AS is_forward, from_node AS src, to_node AS dst, road_class, CAST({_PRIORITY} AS DOUBLE) AS priority, CAST({_SPEED} AS DOUBLE) AS max_speed, {_LENGTH} AS length_m, x0, y0, x2, y2 FROM grid
  UNION ALL SELECT back_ref, geom_id, false, to_node, from_node, road_class, CAST({_PRIORITY} AS DOUBLE), CAST({_SPEED} AS DOUBLE), {_LENGTH}, x2, y2, x0, y0 FROM grid WHERE back_ref IS NOT NULL)"""


@query(f"WITH {EDGES_SQL} SELECT ref_id, geom_id, is_forward, src, dst, road_class, priority, max_speed, {rounded_sql('length_m', 4)} AS length_m, x0 AS first_lon, y2 AS last_lat FROM edges")
def edges_from_roads(spark, sf_dir):
    e = network.edges(grid(spark, sf_dir))
    return e.select("ref_id", "geom_id", "is_forward", "src", "dst", roads.valid_class(F.col("road_class")).alias("road_class"), "priority", "max_speed", rounded(F.col("length_m"), 4).alias("length_m"), F.col("geometry")[0]["lon"].alias("first_lon"), F.element_at("geometry", -1)["lat"].alias("last_lat"))


@query(f"WITH {EDGES_SQL} SELECT a.ref_id, b.ref_id AS next_ref FROM edges a, edges b WHERE b.src = a.dst")
def adjacency(spark, sf_dir):
    return network.adjacency(network.edges(grid(spark, sf_dir)))


@query(f"WITH {EDGES_SQL} SELECT ref_id, {rounded_sql('length_m', 4)} AS cost_distance, {rounded_sql('3.6 * length_m / least(max_speed, 130)', 5)} AS cost_time, {rounded_sql('3.6 * length_m / least(max_speed, 130) * greatest(priority, 1)', 5)} AS cost_time_priority, {rounded_sql('length_m * 0.25', 4)} AS quarter FROM edges")
def road_costs(spark, sf_dir):
    c = network.costs(network.edges(grid(spark, sf_dir)))
    return c.select("ref_id", rounded(F.col("cost_distance"), 4).alias("cost_distance"), rounded(F.col("cost_time"), 5).alias("cost_time"), rounded(F.col("cost_time_priority"), 5).alias("cost_time_priority"), rounded(roads.fractional(F.col("cost_distance"), F.lit(0.25)), 4).alias("quarter"))


#: A ring between the nodes, so that no vertex lies on it.
RING = [(-96.7951, 32.9049), (-96.7849, 32.9049), (-96.7849, 32.9151), (-96.7951, 32.9151)]


@query(f"WITH {GRID_SQL} SELECT geom_id, road_class FROM grid WHERE road_class NOT IN (0, 8) AND greatest(x0, x2) >= -96.7951 AND least(x0, x2) <= -96.7849 AND greatest(y0, y2) >= 32.9049 AND least(y0, y2) <= 32.9151")
def roads_filtered(spark, sf_dir):
    return network.filter_roads(grid(spark, sf_dir), [0, 8], RING).select("geom_id", "road_class")


@query(f"WITH {GRID_SQL} SELECT geom_id FROM grid WHERE least(x0, x2) > -96.7951 AND greatest(x0, x2) < -96.7849 AND least(y0, y2) > 32.9049 AND greatest(y0, y2) < 32.9151")
def roads_within(spark, sf_dir):
    return network.filter_roads(grid(spark, sf_dir), [], RING, within=True).select("geom_id")


@query(f"WITH {GRID_SQL} SELECT geom_id, min(tile) AS tile FROM (SELECT geom_id, {sql_tile(16, 'x0', 'y0')} AS tile FROM grid UNION ALL SELECT geom_id, {sql_tile(16, 'x2', 'y2')} FROM grid) GROUP BY 1")
def roads_dedup(spark, sf_dir):
    placed = grid(spark, sf_dir).withColumn("tile", F.explode(tile.record_tiles(F.col("geometry"), 16)))
    return network.dedup_roads(placed).select("geom_id", "tile")


@query(f"WITH RECURSIVE {GRID_SQL}, both_ways AS (SELECT from_node AS a, to_node AS b FROM grid UNION SELECT to_node, from_node FROM grid), reach(a, b) AS (SELECT DISTINCT a, a FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a) SELECT a AS node, min(b) AS component FROM reach GROUP BY 1")
def components(spark, sf_dir):
    return network.components(grid(spark, sf_dir))


_REACH = f"""WITH RECURSIVE {EDGES_SQL}, reach(source, node, cost) AS (
  SELECT src, src, CAST(0 AS DOUBLE) FROM edges
  UNION SELECT r.source, e.dst, r.cost + e.length_m FROM reach r JOIN edges e ON e.src = r.node WHERE r.cost + e.length_m <= 900)
SELECT source, node, {rounded_sql('min(cost)', 3)} AS cost FROM reach GROUP BY 1, 2"""


@query(_REACH)
def shortest_path_costs(spark, sf_dir):
    e = network.edges(grid(spark, sf_dir))
    sources_ = e.select(F.col("src").alias("node")).distinct()
    return network.shortest_costs(e, sources_, 900.0).select("source", "node", rounded(F.col("cost"), 3).alias("cost"))


# Positions on roads: suppliers are sources, parts are targets in the middle of their road.
_PLACES = f"""{EDGES_SQL}, road_of AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 31 < 15 THEN 'H_' || p_partkey % 31 || '_' || p_partkey // 31 ELSE 'V_' || (p_partkey % 31 - 15) || '_' || p_partkey // 31 END || '_f' AS ref_id FROM part
), sources AS (SELECT s_suppkey AS source, ref_id, CAST(s_suppkey % 10 AS DOUBLE) / 10 AS fraction, src, dst, length_m FROM supplier JOIN road_of ON k = s_suppkey JOIN edges USING (ref_id)
), targets AS (SELECT k AS target, ref_id, CAST(0.5 AS DOUBLE) AS fraction, src, length_m FROM road_of JOIN edges USING (ref_id))"""


def _places(spark, sf_dir):
    named = grid(spark, sf_dir).select(F.col("fwd_ref").alias("ref_id"), F.split("geom_id", "_").alias("n"))
    number = F.col("n")[2].cast("long") * 31 + F.col("n")[1].cast("long") + F.when(F.col("n")[0] == "V", 15).otherwise(0)
    named = named.select("ref_id", number.alias("k"))
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey")
    sources_ = suppliers.join(named, F.col("k") == F.col("s_suppkey")).select(F.col("k").alias("source"), "ref_id", ((F.col("k") % 10).cast("double") / 10).alias("fraction"))
    return sources_, named.select(F.col("k").alias("target"), "ref_id", F.lit(0.5).alias("fraction"))


@query(f"""WITH RECURSIVE {_PLACES}, reach(source, node, cost) AS (
  SELECT source, dst, (1 - fraction) * length_m FROM sources
  UNION SELECT r.source, e.dst, r.cost + e.length_m FROM reach r JOIN edges e ON e.src = r.node WHERE r.cost + e.length_m <= 900)
SELECT source, target, {rounded_sql('min(cost)', 3)} AS cost FROM (
  SELECT source, target, r.cost + t.length_m * t.fraction AS cost FROM reach r JOIN targets t ON t.src = r.node
  UNION ALL SELECT source, target, s.length_m * (t.fraction - s.fraction) FROM sources s JOIN targets t USING (ref_id) WHERE t.fraction >= s.fraction) WHERE cost <= 900 GROUP BY 1, 2""")
def routes_many_to_many(spark, sf_dir):
    e = network.edges(grid(spark, sf_dir))
    return routing.routes(e, *_places(spark, sf_dir), 900.0).select("source", "target", rounded(F.col("cost"), 3).alias("cost"))


_DRIVEN = f"""{EDGES_SQL}, steps AS (SELECT DISTINCT a.ref_id, b.ref_id AS next_ref FROM edges a JOIN edges b ON b.src = a.dst
), parts AS (SELECT p_partkey // 4 AS route, p_partkey % 4 AS place, 'H_' || p_partkey % 31 || '_' || p_partkey // 31 || '_f' AS ref_id, CAST(p_size % 3 AS DOUBLE) / 4 AS start_fraction, CAST(1 AS DOUBLE) - CAST(p_size % 2 AS DOUBLE) / 8 AS end_fraction FROM part WHERE p_partkey % 31 < 15)"""


def _parts(spark, sf_dir):
    """Routes of up to four roads in a row of the grid; where a row of 15 ends there is a gap."""
    k, size = F.col("p_partkey"), F.col("p_size")
    ref = F.concat(F.lit("H_"), k % 31, F.lit("_"), F.floor(k / 31), F.lit("_f"))
    return spark.read.parquet(f"{sf_dir}/part.parquet").where(k % 31 < 15).select(F.floor(k / 4).alias("route"), (k % 4).alias("place"), ref.alias("ref_id"), ((size % 3).cast("double") / 4).alias("start_fraction"), (1 - (size % 2).cast("double") / 8).alias("end_fraction"))


@query(f"""WITH {_DRIVEN} SELECT p.route, count(*) FILTER (WHERE n.ref_id IS NULL OR steps.ref_id IS NULL) = 1 AS valid
FROM parts p LEFT JOIN parts n ON n.route = p.route AND n.place = p.place + 1 LEFT JOIN steps ON steps.ref_id = p.ref_id AND next_ref = n.ref_id GROUP BY 1""")
def routes_valid(spark, sf_dir):
    return routing.valid_routes(_parts(spark, sf_dir), network.edges(grid(spark, sf_dir)), "route")


@query(f"""WITH {_DRIVEN} SELECT route, {rounded_sql('sum(length_m * (end_fraction - start_fraction))', 4)} AS metres, {rounded_sql('sum(3.6 * length_m / least(max_speed, 130) * greatest(priority, 1) * (end_fraction - start_fraction))', 4)} AS cost FROM parts JOIN edges USING (ref_id) GROUP BY 1""")
def routes_measured(spark, sf_dir):
    told = routing.measured_routes(_parts(spark, sf_dir), network.costs(network.edges(grid(spark, sf_dir))), "route")
    return told.select("route", rounded(F.col("metres"), 4).alias("metres"), rounded(F.col("cost"), 4).alias("cost"))


@query(f"""WITH {_DRIVEN}, a AS (SELECT route // 2 AS pair, place, ref_id, start_fraction, CASE WHEN route % 3 = 0 THEN 1 ELSE end_fraction END AS end_fraction FROM parts WHERE route % 2 = 0
), b AS (SELECT route // 2 AS pair, place, ref_id, CASE WHEN route % 3 = 1 THEN 0 ELSE start_fraction END AS start_fraction, end_fraction FROM parts WHERE route % 2 = 1
), ends AS (SELECT pair, max_by(ref_id, place) AS ref_id, max_by(end_fraction, place) AS f, max(place) AS last FROM a GROUP BY 1), begins AS (SELECT pair, min_by(ref_id, place) AS ref_id, min_by(start_fraction, place) AS f, min(place) AS first FROM b GROUP BY 1
), met AS (SELECT pair, last, first FROM ends JOIN begins USING (pair) JOIN steps ON steps.ref_id = ends.ref_id AND next_ref = begins.ref_id WHERE abs(ends.f - 1) < 1e-8 AND abs(begins.f) < 1e-8)
SELECT pair, place, ref_id, CAST(start_fraction AS DOUBLE) AS start_fraction, CAST(end_fraction AS DOUBLE) AS end_fraction FROM a JOIN met USING (pair) UNION ALL SELECT pair, place + last - first + 1, ref_id, start_fraction, end_fraction FROM b JOIN met USING (pair)""")
def routes_joined(spark, sf_dir):
    """Each second route continues the one before where both end at one node."""
    p, pair = _parts(spark, sf_dir), F.floor(F.col("route") / 2).alias("pair")
    a = p.where("route % 2 = 0").select(pair, "place", "ref_id", "start_fraction", F.when(F.col("route") % 3 == 0, 1.0).otherwise(F.col("end_fraction")).alias("end_fraction"))
    b = p.where("route % 2 = 1").select(pair, "place", "ref_id", F.when(F.col("route") % 3 == 1, 0.0).otherwise(F.col("start_fraction")).alias("start_fraction"), "end_fraction")
    return routing.joined_routes(a, b, network.edges(grid(spark, sf_dir)), "pair")


@query(f"WITH {GPS_SQL}, {GRID_SQL} SELECT DISTINCT geom_id FROM (SELECT geom_id, {sql_tile(16, 'x0', 'y0')} AS tile FROM grid UNION SELECT geom_id, {sql_tile(16, 'x2', 'y2')} FROM grid) WHERE tile IN (SELECT {sql_tile(16)} FROM gps)")
def demand_tiles(spark, sf_dir):
    return spatial.demanded_roads(gps(spark, sf_dir), grid(spark, sf_dir), 16).select("geom_id")


# Geodesy

_NEXT = f"WITH {GPS_SQL}, pairs AS (SELECT event_id, lon, lat, lead(lon) OVER w AS lon2, lead(lat) OVER w AS lat2 FROM gps WINDOW w AS (PARTITION BY vehicle_id ORDER BY rn))"


def _pairs(spark, sf_dir):
    from pyspark.sql import Window as W

    w = W.partitionBy("vehicle_id").orderBy("rn")
    g = gps(spark, sf_dir)
    return g.select("event_id", "lon", "lat", F.lead("lon").over(w).alias("lon2"), F.lead("lat").over(w).alias("lat2")).where("lon2 IS NOT NULL")


@query(f"{_NEXT} SELECT event_id, {rounded_sql(sql_distance('lon', 'lat', 'lon2', 'lat2'), 4)} AS metres FROM pairs WHERE lon2 IS NOT NULL")
def geodesic_distance(spark, sf_dir):
    return _pairs(spark, sf_dir).select("event_id", rounded(geo.distance(*map(F.col, ("lon", "lat", "lon2", "lat2"))), 4).alias("metres"))


_KX, _KY = sql_scales("lat")


@query(f"{_NEXT} SELECT event_id, {rounded_sql(f'(degrees(atan2((lon2 - lon) * {_KX}, (lat2 - lat) * {_KY})) + 360) % 360', 5)} AS degrees FROM pairs WHERE lon2 IS NOT NULL")
def azimuth(spark, sf_dir):
    return _pairs(spark, sf_dir).select("event_id", rounded(geo.azimuth(*map(F.col, ("lon", "lat", "lon2", "lat2"))), 5).alias("degrees"))


@query(f"WITH {GRID_SQL} SELECT geom_id, {rounded_sql(_LENGTH, 4)} AS length_m FROM grid")
def polyline_length(spark, sf_dir):
    return batch.road_lengths(grid(spark, sf_dir)).select("geom_id", rounded(F.col("length_m"), 4).alias("length_m"))


@query(f"""WITH {GRID_SQL}, lens AS (SELECT *, {sql_distance('x0', 'y0', '(x0 + x2) / 2', '(y0 + y2) / 2')} AS a, {sql_distance('(x0 + x2) / 2', '(y0 + y2) / 2', 'x2', 'y2')} AS b FROM grid),
spots AS (SELECT geom_id, f, CASE WHEN f * (a + b) <= a THEN f * (a + b) / a / 2 ELSE 0.5 + (f * (a + b) - a) / b / 2 END AS g, x0, y0, x2, y2 FROM lens, (VALUES (CAST(0.0 AS DOUBLE)), (0.2), (0.7), (1.0)) t(f))
SELECT geom_id, CAST(f AS DOUBLE) AS f, {rounded_sql('x0 + g * (x2 - x0)', 8)} AS lon, {rounded_sql('y0 + g * (y2 - y0)', 8)} AS lat FROM spots""")
def interpolate(spark, sf_dir):
    g = grid(spark, sf_dir).select("geom_id", geo.segments(F.col("geometry")).alias("segs")).withColumn("f", F.explode(F.array(*map(F.lit, (0.0, 0.2, 0.7, 1.0)))))
    p = geo.position_at(F.col("segs"), F.col("f"))
    return g.select("geom_id", "f", rounded(p["lon"], 8).alias("lon"), rounded(p["lat"], 8).alias("lat"))


@query(f"WITH {GPS_SQL} SELECT event_id, {rounded_sql(f'lon - 25 / {_KX}', 8)} AS west, {rounded_sql(f'lat - 25 / {_KY}', 8)} AS south, {rounded_sql(f'lon + 25 / {_KX}', 8)} AS east, {rounded_sql(f'lat + 25 / {_KY}', 8)} AS north FROM gps")
def envelope(spark, sf_dir):
    e = geo.envelope(F.col("lon"), F.col("lat"), 25.0)
    return gps(spark, sf_dir).select("event_id", rounded(e["min_lon"], 8).alias("west"), rounded(e["min_lat"], 8).alias("south"), rounded(e["max_lon"], 8).alias("east"), rounded(e["max_lat"], 8).alias("north"))


@query(f"{_NEXT}, f AS (SELECT event_id, lon, lat, lon2, lat2, lat + 0.0001 AS clat, lon AS clon FROM pairs WHERE lon2 IS NOT NULL), k AS (SELECT *, {sql_scales('clat')[0]} AS kx, {sql_scales('clat')[1]} AS ky FROM f) SELECT event_id, {rounded_sql('((clon - lon) * (lon2 - lon) * kx * kx + (clat - lat) * (lat2 - lat) * ky * ky) / (pow((lon2 - lon) * kx, 2) + pow((lat2 - lat) * ky, 2))', 6)} AS fraction FROM k")
def intercept(spark, sf_dir):
    f = geo.intercept(F.col("lon"), F.col("lat"), F.col("lon2"), F.col("lat2"), F.col("lon"), F.col("lat") + 0.0001)
    return _pairs(spark, sf_dir).select("event_id", rounded(f, 6).alias("fraction"))


_WORLD = f"""{GPS_SQL}, far AS (SELECT event_id AS id, rn, CAST((event_id * 7919) % 36000 AS DOUBLE) / 100 - 180 AS lon1, CAST((event_id * 104729) % 17000 AS DOUBLE) / 100 - 85 AS lat1,
  CAST((event_id * 7919) % 36000 AS DOUBLE) / 100 - 180 + (CAST((event_id * 31) % 12000 AS DOUBLE) / 100 - 60) AS lon2, CAST((event_id * 15485863) % 17000 AS DOUBLE) / 100 - 85 AS lat2 FROM gps)"""


def _world(spark, sf_dir):
    """Two positions anywhere for each event, up to 60 degrees of longitude apart."""
    e = F.col("event_id")
    lon, lat = ((e * 7919) % 36000).cast("double") / 100 - 180, ((e * 104729) % 17000).cast("double") / 100 - 85
    return gps(spark, sf_dir).select("event_id", "rn", lon.alias("lon1"), lat.alias("lat1"), (lon + (((e * 31) % 12000).cast("double") / 100 - 60)).alias("lon2"), (((e * 15485863) % 17000).cast("double") / 100 - 85).alias("lat2"))


@query(f"WITH {_WORLD}, {sql_inverse('far', 10)} SELECT id AS event_id, {rounded_sql('metres', 3)} AS metres, {rounded_sql('azimuth', 6)} AS azimuth FROM geodesics")
def geodesic_inverse(spark, sf_dir):
    g = _world(spark, sf_dir).select("event_id", geo.inverse(*map(F.col, ("lon1", "lat1", "lon2", "lat2")), 10).alias("g"))
    return g.select("event_id", rounded(F.col("g.metres"), 3).alias("metres"), rounded(F.col("g.azimuth"), 6).alias("azimuth"))


@query(f"WITH {_WORLD}, sent AS (SELECT id, lon1 AS lon, lat1 AS lat, CAST((rn * 37) % 360 AS DOUBLE) AS azimuth, CAST((id * 7919) % 5000000 AS DOUBLE) AS metres FROM far), {sql_direct('sent', 8)} SELECT id AS event_id, {rounded_sql('far - 360 * floor((far + 180) / 360)', 8)} AS lon, {rounded_sql('lat', 8)} AS lat FROM reached")
def geodesic_direct(spark, sf_dir):
    g = _world(spark, sf_dir).select("event_id", geo.direct(F.col("lon1"), F.col("lat1"), ((F.col("rn") * 37) % 360).cast("double"), ((F.col("event_id") * 7919) % 5000000).cast("double"), 8).alias("g"))
    return g.select("event_id", rounded(F.col("g.lon"), 8).alias("lon"), rounded(F.col("g.lat"), 8).alias("lat"))


@query(f"WITH {GRID_SQL} SELECT geom_id, CASE k WHEN 0 THEN CAST(0.3 AS DOUBLE) ELSE 0.7 END AS f, {rounded_sql(f'(degrees(atan2((ex - sx) * {sql_scales("sy")[0]}, (ey - sy) * {sql_scales("sy")[1]})) + 360) % 360', 6)} AS degrees FROM segs")
def polyline_azimuth(spark, sf_dir):
    g = grid(spark, sf_dir).select("geom_id", geo.segments(F.col("geometry")).alias("segs")).withColumn("f", F.explode(F.array(F.lit(0.3), F.lit(0.7))))
    return g.select("geom_id", "f", rounded(geo.azimuth_at(F.col("segs"), F.col("f")), 6).alias("degrees"))


def _sql_unit(lon: str, lat: str) -> str:
    return f"[cos(radians({lat})) * cos(radians({lon})), cos(radians({lat})) * sin(radians({lon})), sin(radians({lat}))]"


def _sql_cross(p: str, q: str) -> str:
    return "[" + ", ".join(f"{p}[{a}] * {q}[{b}] - {p}[{b}] * {q}[{a}]" for a, b in ((2, 3), (3, 1), (1, 2))) + "]"


@query(f"""WITH {GRID_SQL}, v AS (SELECT geom_id, {_sql_unit('x0', 'y0')} AS a, {_sql_unit('x2', 'y2')} AS b, {_sql_unit('x0 + 0.0005', 'y0 - 0.001')} AS c, {_sql_unit('x0 + 0.0007', 'y0 + 0.001')} AS d FROM grid WHERE geom_id LIKE 'H%'
), n AS (SELECT geom_id, a, {_sql_cross('a', 'b')} AS m, {_sql_cross('c', 'd')} AS o FROM v), w AS (SELECT geom_id, a, {_sql_cross('m', 'o')} AS w FROM n
), s AS (SELECT geom_id, w, CASE WHEN w[1] * a[1] + w[2] * a[2] + w[3] * a[3] < 0 THEN -1 ELSE 1 END AS side FROM w)
SELECT geom_id, {rounded_sql('degrees(atan2(side * w[2], side * w[1]))', 6)} AS lon, {rounded_sql('degrees(asin(side * w[3] / sqrt(w[1] * w[1] + w[2] * w[2] + w[3] * w[3])))', 6)} AS lat FROM s""")
def roads_intersect(spark, sf_dir):
    """Where a line across each road that leads east meets it."""
    ends = grid(spark, sf_dir).where("geom_id LIKE 'H%'").select("geom_id", F.col("geometry")[0].alias("a"), F.element_at("geometry", -1).alias("b"))
    x, y = F.col("a.lon"), F.col("a.lat")
    met = ends.select("geom_id", geo.intersect((x, y), (F.col("b.lon"), F.col("b.lat")), (x + 0.0005, y - 0.001), (x + 0.0007, y + 0.001)).alias("p"))
    return met.select("geom_id", rounded(F.col("p.lon"), 6).alias("lon"), rounded(F.col("p.lat"), 6).alias("lat"))


@query(f"""WITH {_DRIVEN}, placed AS (SELECT route, place, x0 + start_fraction * (x2 - x0) AS first, x0 + end_fraction * (x2 - x0) AS last, length_m * (end_fraction - start_fraction) AS m, 3.6 * length_m / least(max_speed, 130) * (end_fraction - start_fraction) AS s FROM parts JOIN edges USING (ref_id))
SELECT route, {rounded_sql('min_by(first, place)', 6)} AS first_lon, {rounded_sql('max_by(last, place)', 6)} AS last_lon, {rounded_sql('sum(m)', 4)} AS length_m, {rounded_sql('sum(s)', 4)} AS time_s FROM placed GROUP BY 1""")
def route_shapes(spark, sf_dir):
    shapes = network.route_geometry(_parts(spark, sf_dir), network.edges(grid(spark, sf_dir)), "route")
    return shapes.select("route", rounded(F.col("geometry")[0]["lon"], 6).alias("first_lon"), rounded(F.element_at("geometry", -1)["lon"], 6).alias("last_lon"), rounded(F.col("length_m"), 4).alias("length_m"), rounded(F.col("time_s"), 4).alias("time_s"))


# Spatial joins


def _told(c: DataFrame) -> DataFrame:
    return c.select("event_id", "ref_id", "is_forward", rounded(F.col("fraction"), 6).alias("fraction"), rounded(F.col("distance_m"), 4).alias("distance_m"))


_TOLD = f"event_id, ref_id, is_forward, {rounded_sql('fraction', 6)} AS fraction, {rounded_sql('distance_m', 4)} AS distance_m"


def _points(spark, sf_dir) -> DataFrame:
    return gps(spark, sf_dir).select("event_id", "vehicle_id", "time_ms", "true_ms", "lon", "lat", "event_data")


@query(f"WITH {sql_candidates(25)} SELECT {_TOLD} FROM candidates")
def radius_candidates(spark, sf_dir):
    return _told(spatial.radius_join(_points(spark, sf_dir), grid(spark, sf_dir), 25.0))


@query(f"WITH {sql_candidates(60)}, r AS (SELECT *, rank() OVER (PARTITION BY event_id ORDER BY floor(distance_m * 1e6)) AS place FROM candidates) SELECT {_TOLD} FROM r WHERE place = 1")
def nearest_road(spark, sf_dir):
    return _told(spatial.nearest_join(_points(spark, sf_dir).select("event_id", "lon", "lat"), grid(spark, sf_dir), "event_id", 15.0, 60.0))


@query(f"WITH {sql_candidates(80)}, r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY distance_m, ref_id) AS place FROM candidates) SELECT event_id, CAST(place AS BIGINT) AS rank, {rounded_sql('distance_m', 3)} AS distance_m FROM r WHERE place <= 3")
def knn_roads(spark, sf_dir):
    found = spatial.knn_join(_points(spark, sf_dir), grid(spark, sf_dir), "event_id", 3, 20.0, 80.0)
    return found.select("event_id", F.col("rank").cast("long").alias("rank"), rounded(F.col("distance_m"), 3).alias("distance_m"))


_SNAP = f"""WITH {sql_candidates(10)}, facing AS (
  SELECT *, {rounded_sql('azimuth', 6)} AS a, {rounded_sql('(degrees(atan2((lon - road_lon) * rkx, (lat - road_lat) * rky)) + 360) % 360', 6)} AS n
  FROM (SELECT *, {sql_scales('road_lat')[0]} AS rkx, {sql_scales('road_lat')[1]} AS rky FROM candidates)
), snapped AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY floor(distance_m * 1000 + 0.5), ref_id) AS chosen FROM facing WHERE (n > 90 AND n - a >= 0) OR (a - 360 + n <= 90)) WHERE chosen = 1
)"""


@query(f"{_SNAP} SELECT {_TOLD} FROM snapped")
def snap_events(spark, sf_dir):
    return _told(spatial.snap(_points(spark, sf_dir), grid(spark, sf_dir), "event_id"))


_BINNED = "CAST(floor(length_m / 10) + 1 AS INTEGER)"


@query(f"""{_SNAP}, lens AS (SELECT geom_id, sum(len) AS length_m FROM seg_lens GROUP BY 1), binned AS (SELECT s.*, {_BINNED} AS n_bins FROM snapped s JOIN lens USING (geom_id))
SELECT ref_id, n_bins, CASE WHEN fraction >= 1 THEN n_bins - 1 ELSE CAST(floor(fraction / (CAST(1 AS DOUBLE) / n_bins)) AS INTEGER) END AS bin, event_type, count(*) AS count, {rounded_sql('sum(value)', 4)} AS value FROM binned GROUP BY 1, 2, 3, 4""")
def snap_binned(spark, sf_dir):
    binned = batch.fast_snap(_points(spark, sf_dir), grid(spark, sf_dir), "event_id")
    return binned.select("ref_id", "n_bins", "bin", "event_type", "count", rounded_sum(F.col("value"), 4).alias("value"))


# Traces

_SPEEDS = f"""WITH {GPS_SQL}, before AS (SELECT *, lag(lon) OVER w AS lon1, lag(lat) OVER w AS lat1, lag(time_ms) OVER w AS t1 FROM gps WINDOW w AS (PARTITION BY vehicle_id ORDER BY time_ms)
), speeds AS (SELECT event_id, vehicle_id, time_ms, true_ms, {sql_distance('lon1', 'lat1', 'lon', 'lat')} AS metres, time_ms - t1 AS dt_ms FROM before WHERE t1 IS NOT NULL
), binned AS (SELECT *, metres / (dt_ms / 1000.0) AS mps, CAST(floor(metres / (dt_ms / 1000.0) * 3.6 + 0.5) AS INTEGER) AS speed_bin FROM speeds)"""


def _speeds(spark, sf_dir):
    return traces.speed_pairs(gps(spark, sf_dir).select("event_id", "vehicle_id", "time_ms", "true_ms", "lon", "lat"))


@query(f"{_SPEEDS} SELECT event_id, {rounded_sql('metres', 4)} AS metres, dt_ms, {rounded_sql('mps', 5)} AS speed_mps, speed_bin, {rounded_sql('mps * 3.6 * 0.621371', 4)} AS mph FROM binned")
def speed_pairs(spark, sf_dir):
    mps = F.col("speed_mps")
    return _speeds(spark, sf_dir).select("event_id", rounded(F.col("metres"), 4).alias("metres"), "dt_ms", rounded(mps, 5).alias("speed_mps"), roads.speed_bin(mps).alias("speed_bin"), rounded(roads.mph_of_kmh(mps * 3.6), 4).alias("mph"))


@query(f"{_SPEEDS} SELECT vehicle_id, speed_bin, count(*) AS n FROM binned GROUP BY 1, 2")
def speed_histogram(spark, sf_dir):
    return aggregate.speed_histogram(_speeds(spark, sf_dir), "vehicle_id")


@query(f"{_SPEEDS} SELECT speed_bin, CAST(count(*) AS BIGINT) AS n FROM binned GROUP BY 1")
def hist_merge(spark, sf_dir):
    return aggregate.merge_histograms(aggregate.speed_histogram(_speeds(spark, sf_dir), "vehicle_id"))


@query(f"{_SPEEDS} SELECT vehicle_id, count(*) AS n, {rounded_sql('avg(speed_bin)', 6)} AS mean_kmh, {rounded_sql('var_pop(speed_bin)', 4)} AS var_kmh FROM binned GROUP BY 1")
def hist_mean_var(spark, sf_dir):
    m = aggregate.histogram_moments(aggregate.speed_histogram(_speeds(spark, sf_dir), "vehicle_id"), "vehicle_id")
    return m.select("vehicle_id", "n", rounded(F.col("mean_kmh"), 6).alias("mean_kmh"), rounded(F.col("var_kmh"), 4).alias("var_kmh"))


@query(f"{_SPEEDS}, h AS (SELECT vehicle_id, speed_bin, count(*) AS n FROM binned GROUP BY 1, 2) SELECT vehicle_id, speed_bin, n, CAST(floor(CAST(100 AS DOUBLE) * n / max(n) OVER (PARTITION BY vehicle_id) + 0.5) AS INTEGER) AS scaled FROM h")
def hist_scaled(spark, sf_dir):
    return aggregate.scaled_counts(aggregate.speed_histogram(_speeds(spark, sf_dir), "vehicle_id"), "vehicle_id")


@query(f"{_SPEEDS} SELECT vehicle_id, CAST(CAST(date_trunc('week', epoch_ms(true_ms)) AS DATE) AS VARCHAR) AS week, CAST((isodow(epoch_ms(true_ms)) - 1) * 24 + hour(epoch_ms(true_ms)) AS INTEGER) AS period, speed_bin, count(*) AS n FROM binned GROUP BY 1, 2, 3, 4")
def weekly_speed_cycle(spark, sf_dir):
    return aggregate.weekly_speed_cycle(_speeds(spark, sf_dir), "vehicle_id", "true_ms").withColumn("week", F.col("week").cast("string"))


@query(f"{_SPEEDS} SELECT event_id, CAST(greatest(0, least(7, ceil(mps * 3.6 / 7) - 1)) AS INTEGER) AS colour_bin FROM binned")
def speed_colors(spark, sf_dir):
    return _speeds(spark, sf_dir).select("event_id", roads.colour_bin(F.col("speed_mps") * 3.6).alias("colour_bin"))


def _thin_sql(keep: str) -> str:
    d = sql_distance("r.lon", "r.lat", "g.lon", "g.lat")
    return f"""WITH RECURSIVE {GPS_SQL}, walk AS (
  SELECT vehicle_id, rn, event_id, time_ms, lon, lat, true AS kept, event_id AS id FROM gps WHERE rn = 0
  UNION ALL SELECT g.vehicle_id, g.rn, CASE WHEN {keep.format(d=d)} THEN g.event_id ELSE r.event_id END, CASE WHEN {keep.format(d=d)} THEN g.time_ms ELSE r.time_ms END, CASE WHEN {keep.format(d=d)} THEN g.lon ELSE r.lon END, CASE WHEN {keep.format(d=d)} THEN g.lat ELSE r.lat END, {keep.format(d=d)}, g.event_id
  FROM walk r JOIN gps g ON g.vehicle_id = r.vehicle_id AND g.rn = r.rn + 1)
SELECT vehicle_id, id AS event_id FROM walk WHERE kept"""


@query(_thin_sql("({d} >= 50 AND g.time_ms - r.time_ms >= 20000)"))
def thin_distance_interval(spark, sf_dir):
    g = gps(spark, sf_dir).select("vehicle_id", "event_id", "time_ms", "lon", "lat")
    return traces.thin(g, 50.0, 20000).select("vehicle_id", "event_id")


@query(_thin_sql("({d} >= 80 OR g.time_ms - r.time_ms >= 30000)"))
def thin_either(spark, sf_dir):
    g = gps(spark, sf_dir).select("vehicle_id", "event_id", "time_ms", "lon", "lat")
    return traces.thin(g, 80.0, 30000, either=True).select("vehicle_id", "event_id")


@query(_thin_sql("({d} >= 50 AND g.time_ms - r.time_ms >= 20000)"))
def thin_by_pieces(spark, sf_dir):
    """thin_distance_interval with each five minutes of a trace in a task of its own."""
    g = gps(spark, sf_dir).select("vehicle_id", "event_id", "time_ms", "lon", "lat")
    return pieces.thin(g, 50.0, 20000, piece_ms=300_000).select("vehicle_id", "event_id")


@query(f"WITH {GPS_SQL}, w AS (SELECT *, min(time_ms) OVER (PARTITION BY vehicle_id) AS t0, max(time_ms) OVER (PARTITION BY vehicle_id) AS t9 FROM gps) SELECT vehicle_id, event_id FROM w WHERE time_ms IN (t0, t9) OR ((time_ms - t0) // 1000) % 60 = 0")
def subsample_interval(spark, sf_dir):
    return traces.subsample(gps(spark, sf_dir).select("vehicle_id", "event_id", "time_ms"), 60).select("vehicle_id", "event_id")


_STEPS = f"""WITH {GPS_SQL}, p AS (SELECT vehicle_id, event_id, time_ms, lon, lat, -CAST((rn * 5 + event_id * 13) % 40 AS DOUBLE) AS seqprob, 'e' || (event_id % 5) AS ref_id FROM gps
), steps AS (SELECT *, seqprob - CASE WHEN prev IS NULL OR prev < seqprob THEN 0 ELSE prev END AS delta FROM (SELECT *, lag(seqprob) OVER (PARTITION BY vehicle_id ORDER BY time_ms) AS prev FROM p)
), good AS (SELECT *, delta > -10 AS good FROM steps)"""


def _steps(spark, sf_dir):
    g = gps(spark, sf_dir)
    p = g.select("vehicle_id", "event_id", "time_ms", "lon", "lat", (-((F.col("rn") * 5 + F.col("event_id") * 13) % 40).cast("double")).alias("seqprob"), F.concat(F.lit("e"), (F.col("event_id") % 5).cast("string")).alias("ref_id"))
    return traces.probability_steps(p, -10.0)


@query(f"{_STEPS} SELECT event_id, delta, good FROM good")
def seqdelta_flags(spark, sf_dir):
    return _steps(spark, sf_dir).select("event_id", "delta", "good")


_RUNS = f"""{_STEPS}, marked AS (
  SELECT *, sum(CAST(good AS INTEGER)) OVER (PARTITION BY vehicle_id ORDER BY time_ms) AS run FROM good
), ends AS (SELECT vehicle_id, run, ref_id AS start_ref, lead(ref_id) OVER (PARTITION BY vehicle_id ORDER BY run) AS end_ref FROM marked WHERE good
), runs AS (SELECT m.vehicle_id, CAST(m.run AS BIGINT) AS run, e.start_ref, e.end_ref, count(*) AS n_points FROM marked m JOIN ends e USING (vehicle_id, run) WHERE NOT m.good AND e.end_ref IS NOT NULL GROUP BY 1, 2, 3, 4)"""


@query(f"{_RUNS} SELECT * FROM runs")
def failure_runs(spark, sf_dir):
    return traces.failure_runs(_steps(spark, sf_dir)).select("vehicle_id", "run", "start_ref", "end_ref", "n_points")


@query(f"{_RUNS} SELECT start_ref, count(*) AS n_failures, CAST(sum(n_points) AS BIGINT) AS n_points, min(end_ref) AS first_end FROM runs GROUP BY 1")
def dust_clusters(spark, sf_dir):
    c = aggregate.failure_clusters(traces.failure_runs(_steps(spark, sf_dir)))
    each = c.select("start_ref", "n_failures", F.explode("failures").alias("f"))
    return each.groupBy("start_ref").agg(F.first("n_failures").alias("n_failures"), F.sum("f.n_points").alias("n_points"), F.min("f.end_ref").alias("first_end"))


@query(f"""{_STEPS}, placed AS (SELECT *, CAST(event_id % 8 AS DOUBLE) / 8 AS fraction, sum(CAST(good AS INTEGER)) OVER (PARTITION BY vehicle_id ORDER BY time_ms) AS run FROM good
), ends AS (SELECT vehicle_id, run, ref_id, fraction, lead(ref_id) OVER w AS end_ref, lead(fraction) OVER w AS end_fraction FROM placed WHERE good WINDOW w AS (PARTITION BY vehicle_id ORDER BY run))
SELECT e.ref_id AS start_ref, e.end_ref, e.fraction AS start_fraction, e.end_fraction, count(*) AS n_points, min(m.time_ms) AS first_ms FROM placed m JOIN ends e USING (vehicle_id, run)
WHERE NOT m.good AND e.end_ref IS NOT NULL GROUP BY e.vehicle_id, run, 1, 2, 3, 4""".replace("min(m.time_ms) AS first_ms", f"{rounded_sql('sum(m.lon + m.lat)', 6)} AS coordinates"))
def dust_messages(spark, sf_dir):
    """Failures through the wire format and back: what a reader of the messages gets."""
    steps = _steps(spark, sf_dir).withColumn("fraction", (F.col("event_id") % 8).cast("double") / 8)
    messages = tiles.encoded_dust(traces.failure_runs(steps, fraction="fraction"))
    told = tiles.decoded_dust(messages).select("start_ref", "end_ref", "start_fraction", "end_fraction", (F.size("lonlats") / 2).cast("long").alias("n_points"), F.aggregate("lonlats", F.lit(0.0), lambda a, v: a + v).alias("coordinates"))
    return told.withColumn("coordinates", rounded(F.col("coordinates"), 6))


# Probabilities


@query(f"WITH {sql_candidates(25)} SELECT event_id, ref_id, {rounded_sql('exp(-0.5 * distance_m * distance_m / (4.07 * 4.07)) / sqrt(2 * pi() * 4.07 * 4.07)', 8)} AS emission, {rounded_sql('greatest(0.01, exp(-0.5 * least(abs(((rn * 37) % 360) - azimuth), 360 - abs(((rn * 37) % 360) - azimuth)) / 100) / sqrt(2 * pi() * 100))', 8)} AS facing FROM candidates")
def emission_prob(spark, sf_dir):
    c = spatial.radius_join(gps(spark, sf_dir).select("event_id", "rn", "lon", "lat"), grid(spark, sf_dir), 25.0)
    return c.select("event_id", "ref_id", rounded(hmm.emission(F.col("distance_m"), 4.07), 8).alias("emission"), rounded(hmm.azimuth_factor(((F.col("rn") * 37) % 360).cast("double"), F.col("azimuth")), 8).alias("facing"))


@query(f"{_SPEEDS} SELECT event_id, {rounded_sql('3.0 * exp(-3.0 * greatest(0, metres / 10 - metres / 60))', 8)} AS transition, {rounded_sql('exp(-greatest(0, metres / 10 - metres / 60) / (2.0 * greatest(1, dt_ms) / 1000)) / (2.0 * greatest(1, dt_ms) / 1000)', 8)} AS by_time FROM binned")
def transition_prob(spark, sf_dir):
    cost, m, dt = F.col("metres") / 10, F.col("metres"), F.col("dt_ms")
    return _speeds(spark, sf_dir).select("event_id", rounded(hmm.transition(cost, m, dt, 3.0), 8).alias("transition"), rounded(hmm.transition(cost, m, dt, 0.0), 8).alias("by_time"))


@query(f"WITH {GPS_SQL} SELECT event_id, CAST(greatest(1000, least(1500, coalesce((true_ms - lag(true_ms) OVER (PARTITION BY vehicle_id ORDER BY true_ms)) // 1000 % 30 * 100, 0))) AS DOUBLE) AS bound FROM gps")
def route_bound(spark, sf_dir):
    from pyspark.sql import Window as W

    g = gps(spark, sf_dir)
    dt = F.floor((F.col("true_ms") - F.lag("true_ms").over(W.partitionBy("vehicle_id").orderBy("true_ms"))) / 1000) % 30 * 1000
    return g.select("event_id", hmm.search_bound(F.coalesce(dt, F.lit(0)), 1500.0).alias("bound"))


@query(f"WITH {sql_candidates(25)} SELECT b.vehicle_id, b.rn AS seq, a.ref_id AS from_ref, b.ref_id FROM candidates a JOIN candidates b ON a.vehicle_id = b.vehicle_id AND a.rn + 1 = b.rn")
def consecutive_candidates(spark, sf_dir):
    c = spatial.radius_join(gps(spark, sf_dir).select("vehicle_id", F.col("rn").alias("seq"), "lon", "lat"), grid(spark, sf_dir), 25.0)
    return traces.consecutive_candidates(c).select("vehicle_id", "seq", "from_ref", "ref_id")


_CHAIN = f"""WITH RECURSIVE {sql_candidates(25)}, em AS (
  SELECT vehicle_id, CAST(dense_rank() OVER (PARTITION BY vehicle_id ORDER BY rn) AS BIGINT) AS k, ref_id AS state, exp(-0.5 * distance_m * distance_m / (4.07 * 4.07)) / sqrt(2 * pi() * 4.07 * 4.07) AS p, road_lon AS x, road_lat AS y FROM candidates
), far AS (SELECT b.vehicle_id, b.k, a.state AS from_state, b.state, {sql_distance('a.x', 'a.y', 'b.x', 'b.y')} AS d FROM em a JOIN em b ON a.vehicle_id = b.vehicle_id AND a.k + 1 = b.k
), tr AS (SELECT *, 1 / (1 + d / 50) AS p FROM far WHERE d <= 100
), chain(vehicle_id, k, state, log, filter) AS (
  SELECT vehicle_id, k, state, log10(p), p / sum(p) OVER (PARTITION BY vehicle_id) FROM em WHERE k = 1
  UNION ALL SELECT vehicle_id, k, state, CASE WHEN met THEN q ELSE 0 END + log10(p), CASE WHEN met THEN f ELSE 1 END * p / sum(CASE WHEN met THEN f ELSE 1 END * p) OVER (PARTITION BY vehicle_id) FROM (
    SELECT *, max(f) OVER (PARTITION BY vehicle_id) IS NOT NULL AS met FROM (
      SELECT e.vehicle_id, e.k, e.state, e.p, max(c.log + log10(tr.p)) AS q, sum(c.filter * tr.p) AS f
      FROM em e JOIN (SELECT DISTINCT vehicle_id, k + 1 AS k FROM chain) n ON n.vehicle_id = e.vehicle_id AND n.k = e.k LEFT JOIN tr ON tr.vehicle_id = e.vehicle_id AND tr.k = e.k AND tr.state = e.state
      LEFT JOIN chain c ON c.vehicle_id = tr.vehicle_id AND c.k + 1 = tr.k AND c.state = tr.from_state GROUP BY 1, 2, 3, 4)) WHERE NOT met OR f IS NOT NULL)"""


@query(f"{_CHAIN} SELECT vehicle_id, k, state, {rounded_sql('filter', 6)} AS filter, {rounded_sql('log', 5)} AS log FROM chain")
def chain_probabilities(spark, sf_dir):
    """Filter and sequence probabilities of roads along each trace, by pieces of 25 steps; jumps of 100 m break it."""
    from pyspark.sql import Window as W

    c = spatial.radius_join(gps(spark, sf_dir).select("vehicle_id", "rn", "lon", "lat"), grid(spark, sf_dir), 25.0)
    c = c.select("vehicle_id", "rn", F.struct(F.col("ref_id").alias("state"), hmm.emission(F.col("distance_m"), 4.07).alias("probability"), geo.placed(F.col("road_lon"), F.col("road_lat")).alias("at")).alias("c"))
    order = W.partitionBy("vehicle_id").orderBy("rn")
    steps = c.groupBy("vehicle_id", "rn").agg(F.sort_array(F.collect_list("c")).alias("found"))
    steps = steps.select("vehicle_id", F.row_number().over(order).cast("long").alias("k"), "found", F.lag("found").over(order).alias("before"))
    # pairs of a step stay in its row: they are many times as many as its candidates
    pair = lambda a: F.transform("found", lambda b: F.struct(a["state"].alias("from_state"), b["state"].alias("state"), geo.between(a["at"], b["at"]).alias("d")))
    near = F.filter(F.flatten(F.transform("before", pair)), lambda w: w["d"] <= 100)
    ways = F.transform(near, lambda w: F.struct(w["from_state"].alias("from_state"), w["state"].alias("state"), (1 / (1 + w["d"] / 50)).alias("probability")))
    told = markov.decode_steps(steps.select("vehicle_id", "k", "found", ways.alias("ways")), 25, "vehicle_id", "k")
    return told.select("vehicle_id", "k", "state", rounded(F.col("filter"), 6).alias("filter"), rounded(F.col("log"), 5).alias("log"))


# Events of matched points


@query(f"""{_SNAP}, places AS (SELECT vehicle_id, rn // 3 * 30000 AS time_ms, min(ref_id) AS ref_id FROM snapped GROUP BY 1, 2)
SELECT vehicle_id, time_ms, ref_id, event_type, value AS event_value FROM (SELECT * REPLACE (rn // 3 * 30000 AS time_ms) FROM gps) JOIN places USING (vehicle_id, time_ms)""")
def events_at_repeated_times(spark, sf_dir):
    """Three samples of a vehicle share a time: each of their events comes once."""
    g = gps(spark, sf_dir).select("event_id", "vehicle_id", (F.floor(F.col("rn") / 3) * 30000).alias("time_ms"), "lon", "lat", "event_data")
    g = materialize(g, "samples")  # to be snapped, and for their events
    snapped = spatial.snap(g.drop("event_data"), grid(spark, sf_dir), "event_id", written=True).select("vehicle_id", "time_ms", "ref_id", "fraction")
    return traces.with_event_data(snapped, g).select("vehicle_id", "time_ms", "ref_id", "event_type", "event_value")


_AT_NODES = f"""{GPS_SQL.replace('gps AS', 'events_gps AS', 1)}, gps AS (SELECT * REPLACE (
  CAST(-96.8 AS DOUBLE) + CAST(rn % 16 AS DOUBLE) * CAST(0.002 AS DOUBLE) + CAST(event_id % 3 AS DOUBLE) / CAST(50000.0 AS DOUBLE) AS lon, CAST(32.9 AS DOUBLE) + CAST(event_id % 6 AS DOUBLE) * CAST(0.002 AS DOUBLE) AS lat) FROM events_gps)"""


@query(f"""WITH {sql_candidates(25).replace(GPS_SQL, _AT_NODES, 1)}, {EDGES_SQL.removeprefix(GRID_SQL + ", ")}, steps AS (SELECT a.ref_id, b.ref_id AS next_ref FROM edges a JOIN edges b ON b.src = a.dst
), rest AS (SELECT event_id, ref_id, fraction FROM candidates c WHERE NOT (fraction < 1e-8 AND EXISTS (SELECT 1 FROM candidates o JOIN steps ON o.ref_id = steps.ref_id WHERE o.event_id = c.event_id AND next_ref = c.ref_id)))
SELECT event_id, ref_id, {rounded_sql('fraction', 6)} AS fraction FROM rest c WHERE fraction <= 1 - 1e-8 OR EXISTS (SELECT 1 FROM steps WHERE steps.ref_id = c.ref_id AND next_ref NOT IN (SELECT ref_id FROM rest o WHERE o.event_id = c.event_id))""")
def minset_candidates(spark, sf_dir):
    """Candidates of points at or beside nodes, where several stand for one place."""
    lon = F.lit(-96.8) + (F.col("rn") % 16).cast("double") * 0.002 + (F.col("event_id") % 3).cast("double") / 50000.0
    at = gps(spark, sf_dir).select("event_id", lon.alias("lon"), (F.lit(32.9) + (F.col("event_id") % 6).cast("double") * 0.002).alias("lat"))
    roads_ = grid(spark, sf_dir)
    left = network.minset(spatial.radius_join(at, roads_, 25.0).select("event_id", "ref_id", "fraction"), network.edges(roads_), "event_id")
    return left.select("event_id", "ref_id", rounded(F.col("fraction"), 6).alias("fraction"))


# Binned events on snapped points


@query(f"""{_SNAP}, lens AS (SELECT geom_id, sum(len) AS length_m FROM seg_lens GROUP BY 1), binned AS (SELECT s.*, {_BINNED} AS n_bins, CAST(floor(length_m * 100 + 0.5) AS BIGINT) AS length_cm FROM snapped s JOIN lens USING (geom_id))
SELECT ref_id, CAST(CAST(date_trunc('week', epoch_ms(true_ms)) AS DATE) AS VARCHAR) AS week, length_cm, CAST((isodow(epoch_ms(true_ms)) - 1) * 24 + hour(epoch_ms(true_ms)) AS INTEGER) AS period, n_bins, CASE WHEN fraction >= 1 THEN n_bins - 1 ELSE CAST(floor(fraction / (CAST(1 AS DOUBLE) / n_bins)) AS INTEGER) END AS bin, event_type, count(*) AS count, {rounded_sql('sum(value)', 4)} AS value FROM binned GROUP BY 1, 2, 3, 4, 5, 6, 7""")
def binned_events_weekly(spark, sf_dir):
    g = gps(spark, sf_dir).select("event_id", F.col("true_ms").alias("time_ms"), "lon", "lat", "event_type", F.col("value").alias("event_value"))
    snapped = spatial.snap(g, grid(spark, sf_dir), "event_id")
    e = snapped.select("ref_id", "fraction", "length_m", "time_ms", "event_type", "event_value")
    return aggregate.weekly_binned_events(e, 10.0).withColumns({"value": rounded_sum(F.col("value"), 4), "week": F.col("week").cast("string")})


@query(f"WITH {GPS_SQL} SELECT vehicle_id AS ref_id, CAST(11 AS INTEGER) AS n_bins, CAST(rn % 11 AS INTEGER) AS bin, event_type, count(*) AS count, {rounded_sql('sum(value)', 4)} AS value FROM gps GROUP BY 1, 2, 3, 4")
def binned_events_flat(spark, sf_dir):
    g = gps(spark, sf_dir)
    e = g.select(F.col("vehicle_id").alias("ref_id"), ((F.col("rn") % 11 + 0.5) / 11.0).alias("fraction"), F.lit(100.0).alias("length_m"), "event_type", F.col("value").alias("event_value"))
    return aggregate.binned_events(e, 10.0).withColumn("value", rounded_sum(F.col("value"), 4))


# Messages, written and read


@query(f"{_SPEEDS} SELECT vehicle_id AS ref_id, CAST(CAST(date_trunc('week', epoch_ms(true_ms)) AS DATE) AS VARCHAR) AS week, CAST((isodow(epoch_ms(true_ms)) - 1) * 24 + hour(epoch_ms(true_ms)) AS INTEGER) AS period, speed_bin, count(*) AS n FROM binned GROUP BY 1, 2, 3, 4")
def speed_messages_read(spark, sf_dir):
    """Weekly speeds as their messages tell them to a reader."""
    read = tiles.decoded_speeds(tiles.encoded_speeds(aggregate.weekly_speed_cycle(_speeds(spark, sf_dir), "vehicle_id", "true_ms"), "vehicle_id"))
    return read.withColumn("week", F.col("week").cast("string"))


@query(ORACLE_SQL["binned_events_weekly"].replace(rounded_sql("sum(value)", 4), f"coalesce({rounded_sql('sum(value)', 4)}, 0)"))
def event_messages_read(spark, sf_dir):
    """Weekly binned events as their messages tell them to a reader: sums of nulls alone are 0."""
    g = gps(spark, sf_dir).select("event_id", F.col("true_ms").alias("time_ms"), "lon", "lat", "event_type", F.col("value").alias("event_value"))
    snapped = spatial.snap(g, grid(spark, sf_dir), "event_id")
    binned = aggregate.weekly_binned_events(snapped.select("ref_id", "fraction", "length_m", "time_ms", "event_type", "event_value"), 10.0)
    read = tiles.decoded_binned(tiles.encoded_binned(binned))
    return read.withColumns({"value": rounded_sum(F.col("value"), 4), "week": F.col("week").cast("string")})


# Renderings


@query(f"""WITH {GPS_SQL} SELECT vehicle_id, '{{"type":"FeatureCollection","features":[' || string_agg('{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || (rn % 7) || ',' || (rn % 5) || ']}},"properties":{{"time":' || time_ms || ',"event":"' || event_type || '"}}}}', ',' ORDER BY rn) || ']}}' AS geojson FROM gps GROUP BY 1""")
def geojson_points(spark, sf_dir):
    g = gps(spark, sf_dir).withColumn("feature", geojson.point(F.col("rn") % 7, F.col("rn") % 5, time=F.col("time_ms"), event=F.col("event_type")))
    return geojson.collection(g, "vehicle_id", order="rn")


# Matching: no SQL tells it; tests hold the kernel against enumeration


def _matched(spark, sf_dir) -> DataFrame:
    return materialize(match.match(_points(spark, sf_dir), grid(spark, sf_dir), MatchConfig()), "matched")


def _matched_sql(least_delta: float) -> str:
    return f"WITH RECURSIVE {matched_ctes(EDGES_SQL, least_delta)}"


_ROUNDED = {"start_fraction": 6, "end_fraction": 6, "speed_mps": 5, "seqprob_delta": 4, "lon": 8, "lat": 8}
_MATCHED = f"{_matched_sql(-10.0)} SELECT vehicle_id, kind, seq, time_ms, ref_id, start_ref, end_ref, {', '.join(f'{rounded_sql(c, n)} AS {c}' for c, n in _ROUNDED.items())} FROM matched"


def _matched_told(m: DataFrame) -> DataFrame:
    return m.select("vehicle_id", "kind", "seq", "time_ms", "ref_id", "start_ref", "end_ref", *(rounded(F.col(c), n).alias(c) for c, n in _ROUNDED.items()))


@query(_MATCHED)
def hmm_match(spark, sf_dir):
    return _matched_told(match.match(_points(spark, sf_dir), grid(spark, sf_dir), MatchConfig()))


@query(_MATCHED)
def hmm_match_pieces(spark, sf_dir):
    """Matching with every five minutes of a trace in a task of its own."""
    return _matched_told(pieces.match_long(_points(spark, sf_dir), grid(spark, sf_dir), MatchConfig(), piece_ms=300_000))


_WEEK = "CAST(CAST(date_trunc('week', epoch_ms(time_ms)) AS DATE) AS VARCHAR) AS week"
_PERIOD = "CAST((isodow(epoch_ms(time_ms)) - 1) * 24 + hour(epoch_ms(time_ms)) AS INTEGER) AS period"


@query(f"{_matched_sql(-10.0)} SELECT ref_id, {_WEEK}, {_PERIOD}, CAST(floor(speed_mps * 3.6 + 0.5) AS INTEGER) AS speed_bin, count(*) AS n FROM matched WHERE kind = 'speed' GROUP BY 1, 2, 3, 4")
def hmm_weekly_speeds(spark, sf_dir):
    m = match.match(_points(spark, sf_dir), grid(spark, sf_dir), MatchConfig())
    return aggregate.weekly_speed_cycle(match.speed_edges(m)).withColumn("week", F.col("week").cast("string"))


@query(f"""{_matched_sql(-10.0)}, snapped AS (SELECT m.vehicle_id, m.time_ms, m.ref_id, m.end_fraction AS fraction, g.event_type, g.value, {_BINNED} AS n_bins, CAST(floor(length_m * 100 + 0.5) AS BIGINT) AS length_cm
  FROM matched m JOIN gps g USING (vehicle_id, time_ms) JOIN edges e ON e.ref_id = m.ref_id WHERE m.kind = 'snapped' AND g.event_type IS NOT NULL)
SELECT ref_id, {_WEEK}, {_PERIOD}, length_cm, n_bins, CASE WHEN fraction >= 1 THEN n_bins - 1 ELSE CAST(floor(fraction / (CAST(1 AS DOUBLE) / n_bins)) AS INTEGER) END AS bin, event_type, count(*) AS count, {rounded_sql('sum(value)', 4)} AS value FROM snapped GROUP BY 1, 2, 3, 4, 5, 6, 7""")
def hmm_weekly_events(spark, sf_dir):
    m = match.match(_points(spark, sf_dir), grid(spark, sf_dir), MatchConfig())
    snapped = match.snapped_events(m).select("vehicle_id", "time_ms", "ref_id", "fraction")
    binned = aggregate.weekly_binned_events(batch._with_lengths(traces.with_event_data(snapped, _points(spark, sf_dir)), grid(spark, sf_dir)), 10.0)
    return binned.withColumns({"value": rounded_sum(F.col("value"), 4), "week": F.col("week").cast("string")})


@query(f"""{_matched_sql(-2.0)}, runs AS (SELECT start_ref, end_ref, vehicle_id, seq AS run, {rounded_sql('start_fraction', 6)} AS start_fraction, {rounded_sql('end_fraction', 6)} AS end_fraction, count(*) AS n_points,
  string_agg(CAST(floor(lon * 1e6 + 0.5) AS BIGINT) || ' ' || CAST(floor(lat * 1e6 + 0.5) AS BIGINT), ' ' ORDER BY time_ms, lon, lat) AS micro_degrees FROM matched WHERE kind = 'failure' GROUP BY 1, 2, 3, 4, 5, 6)
SELECT *, count(*) OVER (PARTITION BY start_ref) AS n_failures FROM runs""")
def hmm_dust(spark, sf_dir):
    """Failed stretches by the edge they start from, one row each, with their points."""
    m = match.match(_points(spark, sf_dir), grid(spark, sf_dir), MatchConfig(seqprob_delta_min=-2.0))
    each = aggregate.failure_clusters(match.failures(m)).select("start_ref", "n_failures", F.explode("failures").alias("f"))
    places = F.array_join(F.transform("f.lonlats", lambda x: F.floor(x * 1e6 + 0.5).cast("long")), " ")
    return each.select("start_ref", "n_failures", "f.end_ref", "f.vehicle_id", "f.run", rounded(F.col("f.start_fraction"), 6).alias("start_fraction"), rounded(F.col("f.end_fraction"), 6).alias("end_fraction"), "f.n_points", places.alias("micro_degrees"))


@query()
def hmm_trace_geojson(spark, sf_dir):
    return geojson.trace(_matched(spark, sf_dir), network.edges(grid(spark, sf_dir)))


_ALIGNED = f"""WITH RECURSIVE {GPS_SQL}, lens AS (SELECT 'e' || i AS ref, CAST(10 * (1 + i) AS DOUBLE) AS len FROM range(5) t(i)
), a AS (SELECT vehicle_id, rn + 1 AS i, 'e' || event_id % 5 AS ref, len FROM gps JOIN lens ON ref = 'e' || event_id % 5
), b AS (SELECT vehicle_id, rn + 1 AS j, 'e' || (event_id * 3 + rn) % 5 AS ref, len FROM gps JOIN lens ON ref = 'e' || (event_id * 3 + rn) % 5
), ahead AS (SELECT vehicle_id, j, ref, sum(len) OVER (PARTITION BY vehicle_id ORDER BY j) AS r FROM b UNION ALL SELECT DISTINCT vehicle_id, 0, NULL, CAST(0 AS DOUBLE) FROM b
), rows_(vehicle_id, i, j, cost) AS (
  SELECT vehicle_id, CAST(0 AS BIGINT), j, r FROM ahead
  UNION ALL SELECT vehicle_id, i, j, r + min(best - r) OVER (PARTITION BY vehicle_id ORDER BY j) FROM (
    SELECT o.vehicle_id, a.i, o.j, h.r, least(o.cost + a.len, CASE WHEN h.ref = a.ref THEN lag(o.cost) OVER (PARTITION BY o.vehicle_id ORDER BY o.j) END) AS best
    FROM rows_ o JOIN a ON a.vehicle_id = o.vehicle_id AND a.i = o.i + 1 JOIN ahead h ON h.vehicle_id = o.vehicle_id AND h.j = o.j))"""


@query(f"{_ALIGNED}, ends AS (SELECT vehicle_id, max(i) AS n FROM a GROUP BY 1) SELECT r.vehicle_id, {rounded_sql('cost', 3)} AS unmatched_m FROM rows_ r JOIN ends e ON e.vehicle_id = r.vehicle_id AND r.i = n AND r.j = n")
def align_pairs(spark, sf_dir):
    """What is left unmatched by the pairs of two sequences for each vehicle, of five kinds of edges."""
    g = gps(spark, sf_dir)
    name = lambda k: F.concat(F.lit("e"), k % 5)
    one = g.select("vehicle_id", F.col("rn").alias("seq"), name(F.col("event_id")).alias("ref_id"))
    two = g.select("vehicle_id", F.col("rn").alias("seq"), name(F.col("event_id") * 3 + F.col("rn")).alias("ref_id"))
    length = lambda df: df.withColumn("m", 10.0 * (1 + F.substring("ref_id", 2, 1).cast("int")))
    kinds = length(one.select("ref_id").union(two.select("ref_id")).distinct()).withColumnRenamed("m", "length_m")
    pairs = match.align_pairs(one, two, kinds)
    sums = [length(df).groupBy("vehicle_id").agg(F.sum("m").alias(c)) for df, c in ((one, "a"), (two, "b"), (pairs, "p"))]
    told = sums[0].join(sums[1], "vehicle_id").join(sums[2], "vehicle_id", "left")
    return told.select("vehicle_id", rounded(F.col("a") + F.col("b") - 2 * F.coalesce("p", F.lit(0.0)), 3).alias("unmatched_m"))


_SNAPPED_25 = _SNAP.removeprefix(f"WITH {sql_candidates(10)}, ")


@query(f"""{_matched_sql(-10.0)}, {_SNAPPED_25}, a AS MATERIALIZED (SELECT s.vehicle_id, row_number() OVER (PARTITION BY s.vehicle_id ORDER BY s.time_ms, s.ref_id) AS i, s.ref_id AS ref, length_m AS len FROM snapped s JOIN edges e ON e.ref_id = s.ref_id
), b AS MATERIALIZED (SELECT m.vehicle_id, row_number() OVER (PARTITION BY m.vehicle_id ORDER BY m.time_ms, m.ref_id) AS j, m.ref_id AS ref, length_m AS len FROM matched m JOIN edges e ON e.ref_id = m.ref_id WHERE kind = 'estimate'
), ahead AS MATERIALIZED (SELECT vehicle_id, j, ref, sum(len) OVER (PARTITION BY vehicle_id ORDER BY j) AS r FROM b UNION ALL SELECT vehicle_id, 0, NULL, CAST(0 AS DOUBLE) FROM (SELECT vehicle_id FROM a UNION SELECT vehicle_id FROM b)
), rows_(vehicle_id, i, j, cost) AS (
  SELECT vehicle_id, CAST(0 AS BIGINT), j, r FROM ahead
  UNION ALL SELECT vehicle_id, i, j, r + min(best - r) OVER (PARTITION BY vehicle_id ORDER BY j) FROM (
    SELECT o.vehicle_id, a.i, o.j, h.r, least(o.cost + a.len, CASE WHEN h.ref = a.ref THEN lag(o.cost) OVER (PARTITION BY o.vehicle_id ORDER BY o.j) END) AS best
    FROM rows_ o JOIN a ON a.vehicle_id = o.vehicle_id AND a.i = o.i + 1 JOIN ahead h ON h.vehicle_id = o.vehicle_id AND h.j = o.j))
SELECT vehicle_id, {rounded_sql('arg_max(cost, (i, j))', 3)} AS unmatched_m, {rounded_sql('CASE WHEN max(i) = 0 THEN 0 ELSE arg_max(cost, (i, j)) / any_value(total) END', 6)} AS error
FROM rows_ LEFT JOIN (SELECT vehicle_id, sum(len) AS total FROM a GROUP BY 1) USING (vehicle_id) GROUP BY 1""")
def align_error(spark, sf_dir):
    """How far the matched roads are from those that samples are nearest to."""
    m = _matched(spark, sf_dir).where("kind = 'estimate'").select("vehicle_id", F.col("time_ms").alias("seq"), "ref_id")
    nearest = spatial.snap(_points(spark, sf_dir), grid(spark, sf_dir), "event_id", 25.0).select("vehicle_id", F.col("time_ms").alias("seq"), "ref_id")
    e = match.align_error(nearest, m, network.edges(grid(spark, sf_dir)))
    return e.select("vehicle_id", rounded(F.col("unmatched_m"), 3).alias("unmatched_m"), rounded(F.col("error"), 6).alias("error"))


@query()
def speed_messages(spark, sf_dir):
    return tiles.encoded_speeds(aggregate.weekly_speed_cycle(_speeds(spark, sf_dir), "vehicle_id", "true_ms"), "vehicle_id")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: events snapped to roads and binned along them."""
    return snap_binned(spark, sf_dir)
