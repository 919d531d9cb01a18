"""SQL twins of the registered queries, for an independent engine.

The fixture derivation of ``sources/fixtures.py`` written once as common
table expressions, then one statement per query.  Routes are written the
plain way here (all routes of a graph, ranges and rank per request), so they
also cross-check the shared plan of ``operators/routes.py``.
"""

from __future__ import annotations

FIXTURE_CTES = """
n_places AS (SELECT COUNT(*) AS n FROM customer),
cities AS (
  SELECT CAST(n_nationkey AS INTEGER) AS city_id, n_name AS city_name, r_name AS country_code,
         CAST(45.0 AS DOUBLE) + CAST(n_nationkey % 5 AS DOUBLE) * 1.0 AS lat,
         CAST(5.0 AS DOUBLE) + CAST(n_nationkey // 5 AS DOUBLE) * 1.5 AS lon,
         CAST(60000 + ((n_nationkey * 7919) % 25) * 40000 AS BIGINT) AS population
  FROM nation JOIN region ON n_regionkey = r_regionkey),
places AS (
  SELECT CAST(c_custkey AS VARCHAR) AS place_id, c_name AS place_name,
         CASE WHEN c_custkey % 2 = 0 THEN 'FLIGHT' ELSE 'BUS' END AS provider,
         CAST(c_nationkey AS INTEGER) AS city_id,
         CASE WHEN c_custkey % 10 = 0 THEN 'STOC-' ELSE 'ARN-' END || CAST(c_custkey AS VARCHAR) AS place_code
  FROM customer),
trips_base AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
           || '-' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS leg_id,
         CAST(o_custkey AS VARCHAR) AS origin_place_id,
         CAST(((l_partkey * 7 + l_suppkey) % (np.n // 2)) * 2 + o_custkey % 2 AS VARCHAR) AS dest_place_id,
         CASE WHEN o_custkey % 2 = 0 THEN 'FLIGHT' ELSE 'BUS' END AS provider,
         DATE '2024-01-01' + CAST(l_linenumber % 7 AS INTEGER) AS departure_date,
         TRUE AS is_direct,
         ((CAST(ROUND(l_extendedprice * 100) AS BIGINT) * 2 + 500) // 1000) / 100.0 AS price,
         (l_orderkey % 24) * 60 + l_partkey % 60 AS dep_min,
         (l_orderkey % 24) * 60 + l_partkey % 60 + 30 + (l_suppkey * 13 + l_linenumber * 17) % 600 AS arr_min
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey CROSS JOIN n_places np),
trips_txt AS (
  SELECT *,
    CAST(departure_date AS VARCHAR) || 'T' || lpad(CAST(dep_min // 60 AS VARCHAR), 2, '0') || ':'
      || lpad(CAST(dep_min % 60 AS VARCHAR), 2, '0') || ':00.000Z' AS bus_dep,
    CAST(departure_date + CAST(arr_min // 1440 AS INTEGER) AS VARCHAR) || 'T'
      || lpad(CAST((arr_min % 1440) // 60 AS VARCHAR), 2, '0') || ':'
      || lpad(CAST((arr_min % 1440) % 60 AS VARCHAR), 2, '0') || ':00.000Z' AS bus_arr
  FROM trips_base),
trips_clock AS (
  SELECT *,
    CAST(split_part(split_part(bus_dep, 'T', 2), ':', 1) AS INTEGER) AS dh,
    CAST(split_part(split_part(bus_dep, 'T', 2), ':', 2) AS INTEGER) AS dm,
    CAST(split_part(split_part(bus_arr, 'T', 2), ':', 1) AS INTEGER) AS ah,
    CAST(split_part(split_part(bus_arr, 'T', 2), ':', 2) AS INTEGER) AS am
  FROM trips_txt),
trips AS (
  SELECT leg_id, origin_place_id, dest_place_id, provider, departure_date, is_direct, price,
    CASE WHEN provider = 'FLIGHT' THEN 0.0
         ELSE CAST(((CASE WHEN dh > ah THEN ah + 24 - dh ELSE ah - dh END) * 60 + am - dm) // 60 AS DOUBLE)
    END AS duration_h,
    CASE WHEN provider = 'FLIGHT' THEN CAST(departure_date AS VARCHAR) ELSE bus_dep END AS departure_dt,
    CASE WHEN provider = 'FLIGHT' THEN CAST(departure_date AS VARCHAR) ELSE bus_arr END AS arrival_dt
  FROM trips_clock),
requests AS (
  SELECT event_id AS request_id, CAST(user_id AS VARCHAR) AS user_id,
    '+' || CAST(CAST(45.0 + (user_id % 25) % 5 AS DECIMAL(8,4)) AS VARCHAR) || ',+'
        || CAST(CAST(5.0 + ((user_id % 25) // 5) * 1.5 AS DECIMAL(8,4)) AS VARCHAR) AS src,
    '+' || CAST(CAST(45.0 + ((event_id * 7 + 3) % 25) % 5 AS DECIMAL(8,4)) AS VARCHAR) || ',+'
        || CAST(CAST(5.0 + (((event_id * 7 + 3) % 25) // 5) * 1.5 AS DECIMAL(8,4)) AS VARCHAR) AS dst,
    DATE '2024-01-01' + CAST(event_id % 7 AS INTEGER) AS departure_date,
    CASE (event_id // 50) % 4 WHEN 0 THEN []::DOUBLE[] WHEN 1 THEN [0.0, 100.0]::DOUBLE[]
         WHEN 2 THEN [50.0, 250.0]::DOUBLE[] ELSE [100.0]::DOUBLE[] END AS price_range,
    CASE (event_id // 50) % 3 WHEN 0 THEN []::DOUBLE[] WHEN 1 THEN [0.0, 12.0]::DOUBLE[]
         ELSE [1.0, 24.0]::DOUBLE[] END AS time_range
  FROM events),
req AS (
  SELECT *,
    TRY_CAST(split_part(src, ',', 1) AS DOUBLE) AS src_lat, TRY_CAST(split_part(src, ',', 2) AS DOUBLE) AS src_lon,
    TRY_CAST(split_part(dst, ',', 1) AS DOUBLE) AS dst_lat, TRY_CAST(split_part(dst, ',', 2) AS DOUBLE) AS dst_lon
  FROM requests),
points AS (
  SELECT request_id, 'SRC' AS side, src_lat AS lat, src_lon AS lon FROM req
  UNION ALL SELECT request_id, 'DST', dst_lat, dst_lon FROM req),
near_all AS (
  SELECT p.request_id, p.side, c.city_id, c.city_name, c.country_code, c.population,
    2 * 6371.0 * asin(sqrt(pow(sin(radians(c.lat - p.lat) / 2), 2)
      + cos(radians(p.lat)) * cos(radians(c.lat)) * pow(sin(radians(c.lon - p.lon) / 2), 2))) AS distance_km
  FROM points p, cities c WHERE c.population >= 100000),
near AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY request_id, side ORDER BY population DESC, city_id) AS INTEGER) AS rank
    FROM near_all WHERE distance_km <= 200.0) WHERE rank <= 5),
roles AS (
  @ROLES@),
plan AS (
  SELECT r.*, o.city_id AS o_city, o.city_name AS o_name, d.city_id AS d_city, d.city_name AS d_name,
    CASE WHEN o.city_id IS NULL OR d.city_id IS NULL THEN 'NO_CITY' ELSE 'OK' END AS status
  FROM req r LEFT JOIN roles o ON o.request_id = r.request_id AND o.role = 'ORIGIN'
             LEFT JOIN roles d ON d.request_id = r.request_id AND d.role = 'DESTINATION'),
ok AS (SELECT * FROM plan WHERE status = 'OK'),
stops AS (
  SELECT DISTINCT t.request_id, t.city_id AS via, t.city_name AS via_name
  FROM roles t JOIN ok ON ok.request_id = t.request_id
  WHERE t.role = 'TRANSIT' AND t.city_id <> ok.o_city AND t.city_id <> ok.d_city),
ctrips AS (
  SELECT @TRIP@, po.place_name AS o_name, po.city_id AS o_city, pd.place_name AS d_name, pd.city_id AS d_city
  FROM trips t JOIN places po ON t.origin_place_id = po.place_id JOIN places pd ON t.dest_place_id = pd.place_id
  WHERE po.provider = pd.provider),
via_text AS (SELECT request_id, string_agg(CAST(via AS VARCHAR), ',' ORDER BY via) AS vias FROM stops GROUP BY request_id),
graph_of AS (
  SELECT ok.request_id, CAST(ok.o_city AS VARCHAR) || '|' || CAST(ok.d_city AS VARCHAR) || '|'
           || CAST(ok.departure_date AS VARCHAR) || '|' || COALESCE(v.vias, '') AS graph_id,
         ok.o_city, ok.d_city, ok.departure_date, ok.price_range, ok.time_range
  FROM ok LEFT JOIN via_text v ON v.request_id = ok.request_id),
graphs AS (SELECT DISTINCT graph_id, o_city, d_city, departure_date FROM graph_of),
graph_stops AS (SELECT DISTINCT g.graph_id, s.via FROM stops s JOIN graph_of g ON g.request_id = s.request_id),
pairs AS (
  SELECT graph_id, o_city AS from_city, d_city AS to_city, departure_date FROM graphs
  UNION SELECT g.graph_id, g.o_city, s.via, g.departure_date FROM graph_stops s JOIN graphs g ON g.graph_id = s.graph_id
  UNION SELECT g.graph_id, s.via, g.d_city, g.departure_date FROM graph_stops s JOIN graphs g ON g.graph_id = s.graph_id),
legs AS (
  SELECT p.graph_id, l.leg_id, l.origin_place_id, l.o_name, l.o_city, l.dest_place_id, l.d_name, l.d_city,
         l.provider, l.departure_date, l.price, l.duration_h, l.is_direct, l.departure_dt, l.arrival_dt
  FROM pairs p JOIN ctrips l ON l.o_city = p.from_city AND l.d_city = p.to_city AND l.departure_date = p.departure_date),
routes AS (
  SELECT g.graph_id, l.leg_id AS route_id, 1 AS n_legs, l.price AS total_price,
         l.duration_h AS total_time, l.o_name || ' => ' || l.d_name AS stops
  FROM graphs g JOIN legs l ON l.graph_id = g.graph_id AND l.o_city = g.o_city AND l.d_city = g.d_city
  UNION ALL
  SELECT g.graph_id, a.leg_id || '>' || b.leg_id, 2, a.price + b.price, a.duration_h + b.duration_h,
         a.o_name || ' => ' || a.d_name || ' => ' || b.d_name
  FROM graphs g JOIN legs a ON a.graph_id = g.graph_id AND a.o_city = g.o_city AND a.d_city <> g.d_city
          JOIN legs b ON b.graph_id = g.graph_id AND @MEET@ AND b.d_city = g.d_city),
in_range AS (
  SELECT g.request_id, r.* EXCLUDE (graph_id) FROM routes r JOIN graph_of g ON g.graph_id = r.graph_id
  WHERE (len(g.price_range) <> 2 OR r.total_price BETWEEN g.price_range[1] AND g.price_range[2])
    AND (len(g.time_range) <> 2 OR r.total_time BETWEEN g.time_range[1] AND g.time_range[2])),
top AS (
  SELECT request_id, route_id, n_legs, ROUND(total_price, 2) AS total_price, total_time, stops, rank FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY request_id ORDER BY total_price, total_time DESC, route_id) AS INTEGER) AS rank
    FROM in_range) WHERE rank <= 5)
"""


ROLES_BY_POPULATION = """
  SELECT *, CASE WHEN rank = 1 AND side = 'SRC' THEN 'ORIGIN' WHEN rank = 1 THEN 'DESTINATION' ELSE 'TRANSIT' END AS role
  FROM near"""

ROLES_BY_DISTANCE = """
  SELECT * EXCLUDE (far, pos) FROM (
    SELECT *, CASE WHEN far THEN 'TRANSIT' WHEN pos = 1 AND side = 'SRC' THEN 'ORIGIN'
                   WHEN pos = 1 THEN 'DESTINATION' END AS role
    FROM (SELECT *, row_number() OVER (PARTITION BY request_id, side, far ORDER BY rank) AS pos
          FROM (SELECT *, distance_km > MIN(distance_km) OVER (PARTITION BY request_id, side) + 50.0 AS far
                FROM near) a) b) c
  WHERE role IS NOT NULL"""


#: How the second leg follows the first (V3).
MEET = {"place": "b.origin_place_id = a.dest_place_id", "city": "b.o_city = a.d_city"}


def with_fixtures(body: str, roles_by: str = "population", trip: str = "t.*", connect_on: str = "place") -> str:
    """``trip``: the trip columns of ``ctrips``, for queries over changed trips."""
    roles = ROLES_BY_POPULATION if roles_by == "population" else ROLES_BY_DISTANCE
    return "WITH " + FIXTURE_CTES.strip().replace("@ROLES@", roles.strip()).replace("@TRIP@", trip).replace("@MEET@", MEET[connect_on]) + "\n" + body.strip()
