"""Matching told in SQL: routes as walks, Viterbi and its way back as recursions.

For traces of at most max_inputs samples that all carry events, so that thinning never applies.
"""

from __future__ import annotations

from wayfold.plans.fixtures import GRID_SQL, sql_candidates, sql_scales

#: The shipped tuning values, as in config.MatchConfig.
SIGMA, LAMBDA, MOST_M = 4.07, 3.0, 1500


def sql_planar(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """Metres on the plane of the mean latitude."""
    kx, ky = sql_scales(f"(({lat1} + {lat2}) / 2)")
    return f"sqrt(pow(({lon2} - {lon1}) * {kx}, 2) + pow(({lat2} - {lat1}) * {ky}, 2))"


def matched_ctes(edges: str, least_delta: float) -> str:
    """CTEs (WITH RECURSIVE goes before) that end in matched, with the columns of schema.MATCHED that queries tell."""
    return f"""{sql_candidates(25)}, {edges.removeprefix(GRID_SQL + ", ")}, priced AS MATERIALIZED (SELECT ref_id, src, dst, length_m AS len, 3.6 * length_m / least(max_speed, 130) * greatest(priority, 1) AS cost FROM edges
), steps AS (SELECT a.ref_id, b.ref_id AS next_ref FROM priced a JOIN priced b ON b.src = a.dst
), told AS MATERIALIZED (SELECT event_id, vehicle_id, time_ms, lon, lat, ref_id, fraction, road_lon AS x, road_lat AS y, {sql_planar('lon', 'lat', 'road_lon', 'road_lat')} AS metres FROM candidates
), rest AS MATERIALIZED (SELECT * FROM told c WHERE NOT (fraction < 1e-8 AND EXISTS (SELECT 1 FROM told o JOIN steps ON o.ref_id = steps.ref_id WHERE o.event_id = c.event_id AND next_ref = c.ref_id))
), alone AS (SELECT * FROM rest c WHERE fraction <= 1 - 1e-8 OR EXISTS (SELECT 1 FROM steps WHERE steps.ref_id = c.ref_id AND next_ref NOT IN (SELECT ref_id FROM rest o WHERE o.event_id = c.event_id))
), kept AS (SELECT *, row_number() OVER w AS k, {sql_planar('lag(lon) OVER w', 'lag(lat) OVER w', 'lon', 'lat')} / 60 AS base, time_ms - lag(time_ms) OVER w AS dt_ms FROM (SELECT DISTINCT vehicle_id, event_id, time_ms, lon, lat FROM alone) WINDOW w AS (PARTITION BY vehicle_id ORDER BY time_ms)
), em AS MATERIALIZED (SELECT s.vehicle_id, s.k, s.time_ms, s.lon, s.lat, s.base, s.dt_ms, greatest(1000, least({MOST_M}, s.dt_ms // 1000 * 100)) AS bound, a.ref_id, a.fraction, a.x, a.y, a.metres, e.len, e.cost
  FROM kept s JOIN alone a USING (vehicle_id, event_id) JOIN priced e ON e.ref_id = a.ref_id
), pairs AS MATERIALIZED (SELECT DISTINCT a.ref_id AS from_ref, b.ref_id AS to_ref FROM em a JOIN em b ON a.vehicle_id = b.vehicle_id AND a.k + 1 = b.k
), walks(from_ref, node, cost, metres, path) AS (
  SELECT p.from_ref, e.dst, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST([] AS VARCHAR[]) FROM (SELECT DISTINCT from_ref FROM pairs) p JOIN priced e ON e.ref_id = p.from_ref
  UNION ALL SELECT from_ref, dst, min(c), arg_min(m, c), arg_min(p, c) FROM (
    SELECT w.from_ref, e.dst, w.cost + e.cost AS c, w.metres + e.len AS m, list_append(w.path, e.ref_id) AS p FROM walks w JOIN priced e ON e.src = w.node WHERE w.metres + e.len <= {MOST_M}) GROUP BY 1, 2
), between_ AS MATERIALIZED (SELECT p.from_ref, p.to_ref, min(w.cost) AS cost, arg_min(w.metres, w.cost) AS metres, arg_min(w.path, w.cost) AS path
  FROM pairs p JOIN priced e ON e.ref_id = p.to_ref JOIN walks w ON w.from_ref = p.from_ref AND w.node = e.src GROUP BY 1, 2
), chain(vehicle_id, k, time_ms, lon, lat, ref_id, fraction, x, y, len, cost, seq, filter, before, left_at, metres, path, dt_ms) AS (
  SELECT vehicle_id, k, time_ms, lon, lat, ref_id, fraction, x, y, len, cost, log10(p), p / sum(p) OVER (PARTITION BY vehicle_id), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR[]), dt_ms
  FROM (SELECT *, exp(-0.5 * metres * metres / ({SIGMA} * {SIGMA})) / sqrt(2 * pi() * {SIGMA} * {SIGMA}) AS p FROM em WHERE k = 1)
  UNION ALL
  SELECT vehicle_id, k, time_ms, lon, lat, ref_id, fraction, x, y, len, cost, CASE WHEN met THEN seq ELSE log10(p) END,
    CASE WHEN met THEN f ELSE 1 END * p / sum(CASE WHEN met THEN f ELSE 1 END * p) OVER (PARTITION BY vehicle_id), before, left_at, metres, path, dt_ms
  FROM (SELECT *, max(f) OVER (PARTITION BY vehicle_id) > 0 AS met FROM (
    SELECT vehicle_id, k, time_ms, lon, lat, ref_id, fraction, x, y, len, cost, p, dt_ms, coalesce(sum(chance * pfilter), 0) AS f,
      min(pref) FILTER (q >= most - 1e-8) AS before, arg_min(q, pref) FILTER (q >= most - 1e-8) AS seq, arg_min(pf, pref) FILTER (q >= most - 1e-8) AS left_at,
      arg_min(route_m, pref) FILTER (q >= most - 1e-8) AS metres, arg_min(path, pref) FILTER (q >= most - 1e-8) AS path
    FROM (SELECT *, max(q) OVER (PARTITION BY vehicle_id, ref_id) AS most FROM (
      SELECT *, CASE WHEN chance > 0 THEN pseq + log10(chance) + log10(p) END AS q FROM (
        SELECT *, CASE WHEN route_m <= bound AND (direct OR plen * (1 - pf) <= bound) THEN {LAMBDA} * exp(-{LAMBDA} * greatest(0, route_cost - base)) END AS chance FROM (
          SELECT m.*, exp(-0.5 * moved_m * moved_m / ({SIGMA} * {SIGMA})) / sqrt(2 * pi() * {SIGMA} * {SIGMA}) AS p,
            CASE WHEN direct THEN m.cost * (m.fraction - pf) ELSE pcost * (1 - pf) + b.cost + m.cost * m.fraction END AS route_cost,
            CASE WHEN direct THEN m.len * (m.fraction - pf) ELSE plen * (1 - pf) + b.metres + m.len * m.fraction END AS route_m,
            CASE WHEN direct THEN [pref] ELSE list_append(list_prepend(pref, b.path), m.ref_id) END AS path
          FROM (SELECT *, CASE WHEN back THEN {sql_planar('lon', 'lat', 'x', 'y')} ELSE metres END AS moved_m, pref = ref_id AND fraction >= pf AND len * (fraction - pf) <= bound AS direct FROM (
            SELECT * REPLACE (CASE WHEN back THEN kf ELSE fraction END AS fraction, CASE WHEN back THEN kx ELSE x END AS x, CASE WHEN back THEN ky ELSE y END AS y) FROM (
              SELECT *, kf IS NOT NULL AND fraction < kf AND {sql_planar('x', 'y', 'kx', 'ky')} < {SIGMA} AS back FROM (
                SELECT e.*, c.ref_id AS pref, c.fraction AS pf, c.seq AS pseq, c.filter AS pfilter, c.len AS plen, c.cost AS pcost,
                  max(CASE WHEN c.ref_id = e.ref_id THEN c.fraction END) OVER v AS kf, max(CASE WHEN c.ref_id = e.ref_id THEN c.x END) OVER v AS kx, max(CASE WHEN c.ref_id = e.ref_id THEN c.y END) OVER v AS ky
                FROM em e JOIN chain c ON c.vehicle_id = e.vehicle_id AND c.k + 1 = e.k WINDOW v AS (PARTITION BY e.vehicle_id, e.ref_id))))) m
          LEFT JOIN between_ b ON b.from_ref = m.pref AND b.to_ref = m.ref_id))))
    GROUP BY ALL)) WHERE NOT met OR f > 0
), firsts AS MATERIALIZED (SELECT vehicle_id, k, min(ref_id) AS ref_id FROM (SELECT *, max(seq) OVER (PARTITION BY vehicle_id, k) AS most FROM chain) WHERE seq >= most - 1e-8 GROUP BY 1, 2
), chosen(vehicle_id, k, ref_id) AS (
  SELECT vehicle_id, max(k), arg_max(ref_id, k) FROM firsts GROUP BY 1
  UNION ALL SELECT o.vehicle_id, o.k - 1, coalesce(c.before, b.ref_id) FROM chosen o JOIN chain c ON c.vehicle_id = o.vehicle_id AND c.k = o.k AND c.ref_id = o.ref_id JOIN firsts b ON b.vehicle_id = o.vehicle_id AND b.k + 1 = o.k
), sequence AS (SELECT c.*, CASE WHEN lag(c.k, 2) OVER w IS NULL THEN 0 ELSE lag(c.seq) OVER w END AS last FROM chosen JOIN chain c USING (vehicle_id, k, ref_id) WINDOW w AS (PARTITION BY c.vehicle_id ORDER BY c.k)
), led AS MATERIALIZED (SELECT vehicle_id, CAST(row_number() OVER (PARTITION BY vehicle_id ORDER BY k) AS INTEGER) AS seq, time_ms, lon, lat, ref_id, left_at, fraction, path, metres * 1000 / dt_ms AS mps, s.seq - CASE WHEN last < s.seq THEN 0 ELSE last END AS delta,
  s.seq - CASE WHEN last < s.seq THEN 0 ELSE last END > {least_delta} AS good FROM sequence s WHERE path IS NOT NULL AND k > 1
), driven AS MATERIALIZED (SELECT vehicle_id, seq, time_ms, path[i] AS ref_id, CASE WHEN i = 1 THEN left_at ELSE 0 END AS start_fraction, CASE WHEN i = len(path) THEN fraction ELSE 1 END AS end_fraction, mps, i, len(path) AS n
  FROM (SELECT *, unnest(range(1, len(path) + 1)) AS i FROM led WHERE good)
), closed AS (SELECT l.vehicle_id, l.time_ms, l.lon, l.lat, max(g.seq) FILTER (g.seq < l.seq) AS opened_at, min(g.seq) FILTER (g.seq > l.seq) AS closed_at FROM led l JOIN led g ON g.vehicle_id = l.vehicle_id AND g.good WHERE NOT l.good GROUP BY l.vehicle_id, l.seq, l.time_ms, l.lon, l.lat
), matched AS (
  SELECT vehicle_id, 'estimate' AS kind, seq, time_ms, ref_id, CAST(NULL AS DOUBLE) AS start_fraction, fraction AS end_fraction, mps AS speed_mps, delta AS seqprob_delta, lon, lat, CAST(NULL AS VARCHAR) AS start_ref, CAST(NULL AS VARCHAR) AS end_ref FROM led
  UNION ALL SELECT vehicle_id, 'snapped', seq, time_ms, ref_id, NULL, fraction, mps, delta, lon, lat, NULL, NULL FROM led
  UNION ALL SELECT vehicle_id, 'failed_point', seq, time_ms, NULL, NULL, NULL, NULL, NULL, lon, lat, NULL, NULL FROM led WHERE NOT good
  UNION ALL SELECT vehicle_id, 'speed', seq, time_ms, ref_id, start_fraction, end_fraction, mps, NULL, NULL, NULL, NULL, NULL FROM driven
  UNION ALL SELECT c.vehicle_id, 'failure', closed_at, c.time_ms, NULL, a.end_fraction, b.start_fraction, NULL, NULL, c.lon, c.lat, a.ref_id, b.ref_id
  FROM closed c JOIN driven a ON a.vehicle_id = c.vehicle_id AND a.seq = opened_at AND a.i = a.n JOIN driven b ON b.vehicle_id = c.vehicle_id AND b.seq = closed_at AND b.i = 1
)"""
