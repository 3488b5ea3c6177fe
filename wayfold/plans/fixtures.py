"""Traces and a road network made from the test tables by integer arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wayfold.functions import time as tm

NODES = 16


def gps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vehicle_id, event_id, time_ms (a clock of 10 s steps), true_ms, lon, lat, event_data."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    rn = F.row_number().over(W.partitionBy("user_id").orderBy(F.asc_nulls_last("ts"), F.asc_nulls_last("event_id"))).cast("long") - 1
    e = e.withColumn("rn", rn)
    lon = F.lit(-96.8) + ((F.col("rn") * 37 + F.col("user_id") * 11) % 3000).cast("double") / 100000.0
    lat = F.lit(32.9) + (F.col("user_id") % 16).cast("double") * 0.002 + ((F.col("event_id") * 7919) % 41 - 20).cast("double") / 100000.0
    return e.select(F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("vehicle_id"), "event_id", (F.col("rn") * 10000).alias("time_ms"), tm.to_ms("ts").alias("true_ms"), lon.alias("lon"), lat.alias("lat"), F.create_map("event_type", "value").alias("event_data"), "event_type", "value", "rn")


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A road for each part, a fifth of them one-way; rows as in schema.ROAD.

    Part k lies in row k // 31 of a band 16 nodes wide: the first 15 of a row's roads
    lead east along it, the other 16 north to the next, so the band grows with the table.
    """
    k = F.col("p_partkey")
    j, r = F.floor(k / (2 * NODES - 1)).cast("int"), (k % (2 * NODES - 1)).cast("int")
    east = r < NODES - 1
    i = F.when(east, r).otherwise(r - (NODES - 1))
    # few bytes, but much work is done on each road
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    rows = parts.select(F.when(east, "H").otherwise("V").alias("d"), i.alias("i"), j.alias("j"), (i + east.cast("int")).alias("i2"), (j + (~east).cast("int")).alias("j2"))
    name = F.concat_ws("_", "d", "i", "j")
    x, y = (lambda i: F.lit(-96.8) + F.col(i).cast("double") * 0.002), (lambda j: F.lit(32.9) + F.col(j).cast("double") * 0.002)
    oneway = (F.col("i") * 7 + F.col("j") * 3) % 5 == 0
    p = lambda lon, lat: F.struct(lon.alias("lon"), lat.alias("lat"))
    middle = p((x("i") + x("i2")) / 2.0, (y("j") + y("j2")) / 2.0)
    return rows.select(
        name.alias("geom_id"), F.concat_ws("_", F.lit("n"), "i", "j").alias("from_node"), F.concat_ws("_", F.lit("n"), "i2", "j2").alias("to_node"),
        F.concat(name, F.lit("_f")).alias("fwd_ref"), F.when(~oneway, F.concat(name, F.lit("_b"))).alias("back_ref"),
        ((F.col("i") + 2 * F.col("j")) % 9).cast("int").alias("road_class"), F.array(p(x("i"), y("j")), middle, p(x("i2"), y("j2"))).alias("geometry"),
    )


GPS_SQL = """gps AS (
  SELECT 'v' || user_id AS vehicle_id, event_id, rn * 10000 AS time_ms, epoch_us(ts) // 1000 AS true_ms, event_type, value, rn,
    CAST(-96.8 AS DOUBLE) + CAST((rn * 37 + user_id * 11) % 3000 AS DOUBLE) / CAST(100000.0 AS DOUBLE) AS lon,
    CAST(32.9 AS DOUBLE) + CAST(user_id % 16 AS DOUBLE) * CAST(0.002 AS DOUBLE) + CAST((event_id * 7919) % 41 - 20 AS DOUBLE) / CAST(100000.0 AS DOUBLE) AS lat
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rn FROM events)
)"""

GRID_SQL = """grid AS (
  SELECT d || '_' || i || '_' || j AS geom_id, 'n_' || i || '_' || j AS from_node, 'n_' || i2 || '_' || j2 AS to_node,
    d || '_' || i || '_' || j || '_f' AS fwd_ref, CASE WHEN (i * 7 + j * 3) % 5 <> 0 THEN d || '_' || i || '_' || j || '_b' END AS back_ref,
    CAST((i + 2 * j) % 9 AS INTEGER) AS road_class,
    CAST(-96.8 AS DOUBLE) + CAST(i AS DOUBLE) * CAST(0.002 AS DOUBLE) AS x0, CAST(32.9 AS DOUBLE) + CAST(j AS DOUBLE) * CAST(0.002 AS DOUBLE) AS y0,
    CAST(-96.8 AS DOUBLE) + CAST(i2 AS DOUBLE) * CAST(0.002 AS DOUBLE) AS x2, CAST(32.9 AS DOUBLE) + CAST(j2 AS DOUBLE) * CAST(0.002 AS DOUBLE) AS y2
  FROM (SELECT 'H' AS d, p_partkey % 31 AS i, p_partkey // 31 AS j, p_partkey % 31 + 1 AS i2, p_partkey // 31 AS j2 FROM part WHERE p_partkey % 31 < 15
        UNION ALL SELECT 'V', p_partkey % 31 - 15, p_partkey // 31, p_partkey % 31 - 15, p_partkey // 31 + 1 FROM part WHERE p_partkey % 31 >= 15)
), segs AS (
  SELECT geom_id, 0 AS k, x0 AS sx, y0 AS sy, (x0 + x2) / 2 AS ex, (y0 + y2) / 2 AS ey FROM grid
  UNION ALL SELECT geom_id, 1, (x0 + x2) / 2, (y0 + y2) / 2, x2, y2 FROM grid
)"""


def sql_distance(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """Metres in SQL: the chord between two points of the ellipsoid, as an arc of the mean radius."""
    f = "(1 / CAST(298.257223563 AS DOUBLE))"
    e2 = f"({f} * (2 - {f}))"

    def n(lat):
        return f"(CAST(6378137.0 AS DOUBLE) / sqrt(1 - {e2} * sin(radians({lat})) * sin(radians({lat}))))"

    def xyz(lon, lat):
        return f"{n(lat)} * cos(radians({lat})) * cos(radians({lon}))", f"{n(lat)} * cos(radians({lat})) * sin(radians({lon}))", f"{n(lat)} * (1 - {e2}) * sin(radians({lat}))"

    chord = "sqrt(" + " + ".join(f"pow(({a}) - ({b}), 2)" for a, b in zip(xyz(lon1, lat1), xyz(lon2, lat2))) + ")"
    r2 = f"(2 * CAST(6378137.0 AS DOUBLE) * sqrt(1 - {e2}) / (1 - {e2} * sin(radians({lat1})) * sin(radians({lat1}))))"
    return f"({r2} * asin(least(1.0, {chord} / {r2})))"


def sql_scales(lat: str) -> tuple[str, str]:
    """Metres of a degree of longitude and of latitude in SQL."""
    f = "(1 / CAST(298.257223563 AS DOUBLE))"
    w = f"(1 - {f} * (2 - {f}) * pow(sin(radians({lat})), 2))"
    return f"(CAST(6378137.0 AS DOUBLE) / sqrt{w} * cos(radians({lat})) * pi() / 180)", f"(CAST(6378137.0 AS DOUBLE) * (1 - {f} * (2 - {f})) / ({w} * sqrt{w}) * pi() / 180)"


def rounded_sql(x: str, digits: int) -> str:
    return f"floor(({x}) * 1e{digits} + 0.5) / 1e{digits}"


def sql_candidates(radius: float) -> str:
    """CTEs that end in candidates: all directed road points within a radius of gps, ey comparing all pairs."""
    kx, ky = sql_scales("lat")
    return f"""{GPS_SQL}, {GRID_SQL}, seg_lens AS (SELECT *, {sql_distance('sx', 'sy', 'ex', 'ey')} AS len FROM segs
), scaled AS (SELECT *, {kx} AS kx, {ky} AS ky FROM gps
), feet AS (
  SELECT g.event_id, g.vehicle_id, g.time_ms, g.true_ms, g.rn, g.lon, g.lat, g.event_type, g.value, g.kx, g.ky, s.*,
    least(1, greatest(0, ((g.lon - s.sx) * (s.ex - s.sx) * g.kx * g.kx + (g.lat - s.sy) * (s.ey - s.sy) * g.ky * g.ky)
      / (pow((s.ex - s.sx) * g.kx, 2) + pow((s.ey - s.sy) * g.ky, 2)))) AS f
  FROM scaled g JOIN seg_lens s ON abs(g.lon - (s.sx + s.ex) / 2) < 0.003 AND abs(g.lat - (s.sy + s.ey) / 2) < 0.003
), offsets AS (SELECT *, pow((lon - sx - f * (ex - sx)) * kx, 2) + pow((lat - sy - f * (ey - sy)) * ky, 2) AS d2 FROM feet
), best AS (SELECT *, row_number() OVER (PARTITION BY event_id, geom_id ORDER BY floor(d2 * 1e6), k) AS pick FROM offsets
), along AS (
  SELECT b.*, ((CASE WHEN k = 1 THEN t.first ELSE 0 END) + f * len) / t.total AS fraction, sx + f * (ex - sx) AS road_lon, sy + f * (ey - sy) AS road_lat
  FROM best b JOIN (SELECT geom_id, sum(len) AS total, sum(CASE WHEN k = 0 THEN len END) AS first FROM seg_lens GROUP BY geom_id) t USING (geom_id) WHERE pick = 1
), near AS (SELECT *, {sql_distance('lon', 'lat', 'road_lon', 'road_lat')} AS distance_m, (degrees(atan2((ex - sx) * kx, (ey - sy) * ky)) + 360) % 360 AS azimuth FROM along
), candidates AS (
  SELECT n.*, g.fwd_ref AS ref_id, true AS is_forward, g.road_class FROM near n JOIN grid g USING (geom_id) WHERE distance_m <= {radius}
  UNION ALL SELECT n.* REPLACE (1 - fraction AS fraction, (azimuth + 180) % 360 AS azimuth), g.back_ref, false, g.road_class FROM near n JOIN grid g USING (geom_id) WHERE distance_m <= {radius} AND g.back_ref IS NOT NULL
)"""


_F = "(1 / CAST(298.257223563 AS DOUBLE))"
_E2 = f"({_F} * (2 - {_F}))"


def _sql_series(c2: str) -> tuple[str, str]:
    u = f"({c2} * {_E2} / (1 - {_E2}))"
    return f"(1 + {u} / 16384 * (4096 + {u} * (-768 + {u} * (320 - 175 * {u}))))", f"({u} / 1024 * (256 + {u} * (-128 + {u} * (74 - 47 * {u}))))"


def _sql_bend(b: str, s: str, c: str, m: str) -> str:
    return f"({b} * {s} * ({m} + {b} / 4 * ({c} * (2 * {m} * {m} - 1) - {b} / 6 * {m} * (4 * {s} * {s} - 3) * (4 * {m} * {m} - 3))))"


def _sql_turn(c2: str, sa: str, sigma: str, s: str, c: str, m: str) -> str:
    k = f"({_F} / 16 * {c2} * (4 + {_F} * (4 - 3 * {c2})))"
    return f"((1 - {k}) * {_F} * {sa} * ({sigma} + {k} * {s} * ({m} + {k} * {c} * (2 * {m} * {m} - 1))))"


def sql_inverse(points: str, rounds: int) -> str:
    """CTEs after points (id, lon1, lat1, lon2, lat2) that end in geodesics (id, metres, azimuth)."""
    u = [f"atan((1 - {_F}) * tan(radians(lat{k})))" for k in (1, 2)]
    out = f"r0 AS (SELECT id, sin({u[0]}) AS s1, cos({u[0]}) AS c1, sin({u[1]}) AS s2, cos({u[1]}) AS c2, radians(lon2 - lon1) AS l, radians(lon2 - lon1) AS lam FROM {points})"
    for k in range(rounds + 1):
        out += f""", a{k} AS (SELECT *, sqrt(pow(c2 * sin(lam), 2) + pow(c1 * s2 - s1 * c2 * cos(lam), 2)) AS ss, s1 * s2 + c1 * c2 * cos(lam) AS cs FROM r{k}
), b{k} AS (SELECT *, atan2(ss, cs) AS sigma, CASE WHEN ss = 0 THEN 0 ELSE c1 * c2 * sin(lam) / ss END AS sa FROM a{k}
), d{k} AS (SELECT *, 1 - sa * sa AS q, CASE WHEN 1 - sa * sa < 1e-15 THEN 0 ELSE cs - 2 * s1 * s2 / (1 - sa * sa) END AS m FROM b{k}
), r{k + 1} AS (SELECT id, s1, c1, s2, c2, l, l + {_sql_turn('q', 'sa', 'sigma', 'ss', 'cs', 'm')} AS lam FROM d{k})"""
    a, b = _sql_series("q")
    metres = f"CAST(6378137.0 AS DOUBLE) * (1 - {_F}) * {a} * (sigma - {_sql_bend(b, 'ss', 'cs', 'm')})"
    return out + f", geodesics AS (SELECT id, {metres} AS metres, (degrees(atan2(c2 * sin(lam), c1 * s2 - s1 * c2 * cos(lam))) + 360) % 360 AS azimuth FROM d{rounds})"


def sql_direct(points: str, rounds: int) -> str:
    """CTEs after points (id, lon, lat, azimuth, metres) that end in reached (id, lon, lat)."""
    u = f"atan((1 - {_F}) * tan(radians(lat)))"
    a, b = _sql_series("c2")
    out = f"""o0 AS (SELECT id, lon, metres, sin({u}) AS su, cos({u}) AS cu, sin(radians(azimuth)) AS s1, cos(radians(azimuth)) AS c1 FROM {points}
), o1 AS (SELECT *, cu * s1 AS sa, 1 - cu * s1 * cu * s1 AS c2, atan2(su, cu * c1) AS f FROM o0
), o2 AS (SELECT *, metres / (CAST(6378137.0 AS DOUBLE) * (1 - {_F}) * {a}) AS flat, {b} AS b FROM o1
), t0 AS (SELECT *, flat AS sigma FROM o2)"""
    for k in range(rounds):
        out += f", t{k + 1} AS (SELECT * REPLACE (flat + {_sql_bend('b', 'sin(sigma)', 'cos(sigma)', 'cos(2 * f + sigma)')} AS sigma) FROM t{k})"
    turn = _sql_turn("c2", "sa", "sigma", "sin(sigma)", "cos(sigma)", "cos(2 * f + sigma)")
    return out + f""", t AS (SELECT *, sin(sigma) AS s, cos(sigma) AS c FROM t{rounds}
), reached AS (SELECT id, lon + degrees(atan2(s * s1, cu * c - su * s * c1) - {turn}) AS far, degrees(atan2(su * c + cu * s * c1, (1 - {_F}) * sqrt(sa * sa + pow(su * s - cu * c * c1, 2)))) AS lat FROM t)"""
