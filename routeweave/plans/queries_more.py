"""Registered queries, one or more per operator of the inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from routeweave.functions import codec
from routeweave.functions.timefmt import split_datetime
from routeweave.functions.ranges import lower_bound, upper_bound
from routeweave.operators import graph
from routeweave.operators.legs import (city_trips, distinct_graphs, leg_city_pairs, place_pairs, places_repeat,
                                       request_graphs, searched_legs)
from routeweave.operators.best_routes import n_best_routes
from routeweave.operators.shared_graphs import SharedGraphs
from routeweave.operators.routes import enumerate_routes, graph_routes
from routeweave.plans.registry import _search, register, register_sql
from routeweave.plans.search import SearchParams, plan_requests, plan_requests_full, search, top_route_rows
from routeweave.plans.sizing import materialize
from routeweave.sources import fixtures, payloads


def _pieces(spark, sf_dir, params=SearchParams()):
    cat = fixtures.catalogue(spark, sf_dir)
    plan, roles, stops = plan_requests(fixtures.requests(spark, sf_dir), cat.cities, params)
    return cat, plan, roles, stops


def _graphs(spark, sf_dir):
    """(catalogue, request -> graph, graphs)."""
    cat = fixtures.catalogue(spark, sf_dir)
    plan, _, _, pair_stops = plan_requests_full(fixtures.requests(spark, sf_dir), cat.cities)
    graph_of = materialize(request_graphs(plan, pair_stops))
    return cat, graph_of, distinct_graphs(graph_of)


def _shared(spark, sf_dir):
    cat, _, graphs = _graphs(spark, sf_dir)
    return SharedGraphs(graphs, city_trips(cat.trips, cat.places))


def _legs(spark, sf_dir):
    cat, _, graphs = _graphs(spark, sf_dir)
    return searched_legs(leg_city_pairs(graphs), cat.trips, cat.places)


# --- catalogues (S4 and the fixture derivation) ----------------------------------

@register("cities", "SELECT * FROM cities")
def q_cities(spark, sf_dir):
    return fixtures.cities(spark, sf_dir)


@register("places", "SELECT * FROM places")
def q_places(spark, sf_dir):
    return fixtures.places(spark, sf_dir)


@register("trips", "SELECT * FROM trips")
def q_trips(spark, sf_dir):
    """Trips with J7 hours for bus legs and J8 values for flight legs."""
    return fixtures.trips(spark, sf_dir)


@register("stored_catalogue", """
SELECT t.leg_id, o.city_name AS from_city, d.city_name AS to_city, t.departure_date, t.price
FROM ctrips t JOIN cities o ON o.city_id = t.o_city JOIN cities d ON d.city_id = t.d_city
""")
def q_stored_catalogue(spark, sf_dir):
    """The catalogue written, day by day, and read back with its readers."""
    import uuid

    from routeweave.session import ensure_checkpoint_dir
    from routeweave.sources import catalogue as store

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/routeweave-catalogue/{uuid.uuid4().hex}"
    store.write_catalogue(fixtures.catalogue(spark, sf_dir), path)
    cities = store.read_catalogue(spark, path).cities.select("city_id", "city_name")
    return (store.read_city_trips(spark, path)
            .join(cities.toDF("o_city", "from_city"), "o_city").join(cities.toDF("d_city", "to_city"), "d_city")
            .select("leg_id", "from_city", "to_city", "departure_date", "price"))


@register("bus_clock", """
SELECT leg_id, split_part(departure_dt, 'T', 1) AS dep_day,
       split_part(split_part(departure_dt, 'T', 2), '.', 1) AS dep_time,
       split_part(departure_dt, '.', 2) AS dep_offset, duration_h
FROM trips WHERE provider = 'BUS'
""")
def q_bus_clock(spark, sf_dir):
    """Day, time and offset parts of each bus departure, with J7 hours."""
    t = fixtures.trips(spark, sf_dir).filter(F.col("provider") == "BUS")
    parts = split_datetime(F.col("departure_dt"))
    return t.select("leg_id", F.get(parts, 0).alias("dep_day"), F.get(parts, 1).alias("dep_time"),
                    F.get(parts, 2).alias("dep_offset"), "duration_h")


@register("city_places", """
SELECT p.city_id, c.city_name, p.place_id, p.place_name, p.provider
FROM places p JOIN cities c ON c.city_id = p.city_id
""")
def q_city_places(spark, sf_dir):
    """Places attached to their city."""
    from routeweave.operators.legs import city_places
    cat = fixtures.catalogue(spark, sf_dir)
    return city_places(cat.cities, cat.places).select("city_id", "city_name", "place_id", "place_name",
                                                      "provider")


@register("drop_metro_groups", """
SELECT * FROM places WHERE NOT (provider = 'FLIGHT' AND length(split_part(place_code, '-', 1)) = 4)
""")
def q_drop_metro(spark, sf_dir):
    """F4."""
    return payloads.drop_metro_groups(fixtures.places(spark, sf_dir))


# --- payload readers (S5, S6, S7, S8, U2) ------------------------------------------

@register("flight_places", """
SELECT place_code AS place_id, place_name, provider, city_id, place_code FROM places
WHERE provider = 'FLIGHT' AND length(split_part(place_code, '-', 1)) <> 4
""")
def q_flight_places(spark, sf_dir):
    """S5 + F4 over one airport document per flight place."""
    return payloads.flight_places(payloads.airport_documents(fixtures.places(spark, sf_dir)))


@register("bus_places", """
SELECT place_id, place_name, provider, city_id FROM places WHERE provider = 'BUS'
""")
def q_bus_places(spark, sf_dir):
    """S6 over one region document per bus place."""
    return payloads.bus_places(payloads.bus_region_documents(fixtures.places(spark, sf_dir)))


_CLASH = "CASE WHEN CAST(place_id AS BIGINT) % 3 = 0 THEN 'ARN-' || CAST(CAST(place_id AS BIGINT) + 1 AS VARCHAR) ELSE place_id END"


@register("union_places", f"""
, air AS (
  SELECT place_code AS place_id, place_name, provider, city_id FROM places
  WHERE provider = 'FLIGHT' AND length(split_part(place_code, '-', 1)) <> 4),
bus AS (SELECT {_CLASH} AS place_id, place_name, provider, city_id FROM places WHERE provider = 'BUS')
SELECT * FROM air UNION ALL SELECT * FROM bus WHERE place_id NOT IN (SELECT place_id FROM air)
""")
def q_union_places(spark, sf_dir):
    """U2 over both services' documents (S5 with F4, S6): distinct by id.  A
    third of the bus ids are airport ids; there the airport stays."""
    p = fixtures.places(spark, sf_dir)
    air = payloads.flight_places(payloads.airport_documents(p))
    number = F.col("place_id").cast("long")
    clash = F.when(number % 3 == 0, F.concat(F.lit("ARN-"), (number + 1).cast("string"))).otherwise(F.col("place_id"))
    bus = payloads.bus_places(payloads.bus_region_documents(p.withColumn("place_id", clash)))
    return payloads.union_places(air, bus)


_FLIGHT_ID = """CAST(CAST(t.origin_place_id AS DOUBLE) AS VARCHAR) || '-' || CAST(CAST(t.dest_place_id AS DOUBLE) AS VARCHAR)
  || '-' || CAST(t.departure_date AS VARCHAR) || '-' || CAST(t.price AS VARCHAR) || '-true'"""
_BUS_ID = """t.origin_place_id || '-' || t.dest_place_id || '-' || t.departure_dt || '-' || t.arrival_dt || '-'
  || CAST(t.price AS VARCHAR) || '-true'"""
_CITY_IDS = "'-' || CAST(po.city_id AS VARCHAR) || '-' || CAST(pd.city_id AS VARCHAR)"
#: Trips as both services' documents give them.
_PAYLOAD_TRIP = f"""DISTINCT CASE WHEN t.provider = 'FLIGHT' THEN {_FLIGHT_ID} ELSE {_BUS_ID} END || {_CITY_IDS} AS leg_id,
  CASE WHEN t.provider = 'FLIGHT' THEN CAST(CAST(t.origin_place_id AS DOUBLE) AS VARCHAR) ELSE t.origin_place_id END AS origin_place_id,
  CASE WHEN t.provider = 'FLIGHT' THEN CAST(CAST(t.dest_place_id AS DOUBLE) AS VARCHAR) ELSE t.dest_place_id END AS dest_place_id,
  t.provider, t.departure_date, t.is_direct, t.price, t.duration_h, t.departure_dt, t.arrival_dt"""
_LEG_COLUMNS = """leg_id, origin_place_id, o_name, o_city, dest_place_id, d_name, d_city, provider, departure_date, is_direct,
  price, duration_h, departure_dt, arrival_dt"""


@register("flight_trips", f"SELECT {_LEG_COLUMNS} FROM ctrips WHERE provider = 'FLIGHT'",
          trip=_PAYLOAD_TRIP.replace("DISTINCT ", ""))
def q_flight_trips(spark, sf_dir):
    """S7 + F5 + T3 + J8 + J9 over one quote document per flight trip."""
    cat = fixtures.catalogue(spark, sf_dir)
    docs = payloads.flight_quote_documents(city_trips(cat.trips, cat.places))
    return payloads.flight_trips(docs)


@register("bus_trips", f"SELECT {_LEG_COLUMNS} FROM ctrips WHERE provider = 'BUS'", trip=_PAYLOAD_TRIP.replace("DISTINCT ", ""))
def q_bus_trips(spark, sf_dir):
    """S8 + J6 + J7 over one journey document per bus trip."""
    cat = fixtures.catalogue(spark, sf_dir)
    docs = payloads.bus_journey_documents(city_trips(cat.trips, cat.places))
    return payloads.bus_trips(docs)


_TOP = "SELECT request_id, rank, route_id, n_legs, total_price, total_time, stops FROM top"


def _payload_trips(cat):
    ctrips = city_trips(cat.trips, cat.places)
    quotes, journeys = payloads.flight_quote_documents(ctrips), payloads.bus_journey_documents(ctrips)
    # rate-limit replies among the documents give no legs
    reply = F.when(F.pmod(F.xxhash64("value"), F.lit(7)) == 0, F.lit('{"message":"slow down"}'))
    quotes = quotes.withColumn("value", F.explode(F.array_compact(F.array("value", reply))))
    return payloads.payload_trips(quotes, journeys)


@register("payload_top_routes", _TOP, trip=_PAYLOAD_TRIP)
def q_payload_top_routes(spark, sf_dir):
    """S7 + S8 + F6 + U4 into the search: top routes over the legs of stored
    documents."""
    cat = fixtures.catalogue(spark, sf_dir)
    return top_route_rows(search(fixtures.requests(spark, sf_dir), cat, ctrips=_payload_trips(cat)))


@register("rate_limited_searches", """
SELECT o_city, d_city, departure_date, COUNT(*) AS n_limited FROM ctrips
WHERE provider = 'FLIGHT' AND price < 50 GROUP BY o_city, d_city, departure_date
""")
def q_rate_limited(spark, sf_dir):
    """documents that are rate-limit replies, counted per search."""
    cat = fixtures.catalogue(spark, sf_dir)
    trips = city_trips(cat.trips, cat.places)
    cheap = payloads.flight_quote_documents(trips.filter("price < 50")).withColumn("value", F.lit('{"message":"slow down"}'))
    other = payloads.flight_quote_documents(trips.filter("price >= 50"))
    return payloads.rate_limited(cheap.unionByName(other))


@register("repeated_legs_top_routes", _TOP)
def q_repeated_legs(spark, sf_dir):
    """U4: every fifth trip is listed up to three times; routes are not."""
    cat = fixtures.catalogue(spark, sf_dir)
    ctrips = city_trips(cat.trips, cat.places)
    again = ctrips.filter(F.pmod(F.xxhash64("leg_id"), F.lit(5)) == 0)
    return top_route_rows(search(fixtures.requests(spark, sf_dir), cat, ctrips=ctrips.unionByName(again).unionByName(again)))


@register("fine_price_top_routes", _TOP, trip="t.* REPLACE (t.price + (CAST(length(t.leg_id) AS INTEGER) % 8) * 0.001953125 AS price)")
def q_fine_prices(spark, sf_dir):
    """F7 + F8 + R6 on raw totals: prices with more than two decimals."""
    cat = fixtures.catalogue(spark, sf_dir)
    ctrips = city_trips(cat.trips, cat.places)
    ctrips = ctrips.withColumn("price", F.col("price") + (F.length("leg_id") % 8) * F.lit(0.001953125))
    return top_route_rows(search(fixtures.requests(spark, sf_dir), cat, ctrips=ctrips))


@register("own_range_top_routes", """
, own AS (SELECT g.* REPLACE ([CAST(g.request_id % 211 AS DOUBLE) / 2, 20 + g.request_id % 307]::DOUBLE[] AS price_range) FROM graph_of g),
ranged AS (
  SELECT g.request_id, r.* EXCLUDE (graph_id) FROM routes r JOIN own g ON g.graph_id = r.graph_id
  WHERE r.total_price BETWEEN g.price_range[1] AND g.price_range[2]
    AND (len(g.time_range) <> 2 OR r.total_time BETWEEN g.time_range[1] AND g.time_range[2]))
SELECT request_id, rank, route_id, n_legs, ROUND(total_price, 2) AS total_price, total_time, stops FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY request_id ORDER BY total_price, total_time DESC, route_id) AS INTEGER) AS rank
  FROM ranged) WHERE rank <= 5
""")
def q_own_ranges(spark, sf_dir):
    """The search with a price range of its own for nearly every request."""
    cat = fixtures.catalogue(spark, sf_dir)
    own = F.array((F.col("request_id") % 211) / 2, (20 + F.col("request_id") % 307).cast("double"))
    return top_route_rows(search(fixtures.requests(spark, sf_dir).withColumn("price_range", own), cat))


@register("city_connected_top_routes", _TOP, connect_on="city")
def q_city_connected(spark, sf_dir):
    """V3: the search with legs that meet anywhere in the stop city."""
    return top_route_rows(search(fixtures.requests(spark, sf_dir), fixtures.catalogue(spark, sf_dir), SearchParams(connect_on="city")))


# --- messages (S9, J3, F1, J1, J2, J4, J5) -----------------------------------------

_REQ_JSON = """'{"src":"' || src || '","departureDate":"' || CAST(departure_date AS VARCHAR) || '","dst":"' || dst
  || '","priceRange":[' || array_to_string(list_transform(price_range, lambda x: CAST(x AS VARCHAR)), ',')
  || '],"timeTravelRange":[' || array_to_string(list_transform(time_range, lambda x: CAST(x AS VARCHAR)), ',') || ']}'"""


@register("request_messages", f"""
SELECT request_id, 'input-' || user_id AS key, {_REQ_JSON} AS value FROM requests
""")
def q_request_messages(spark, sf_dir):
    """S9 + J3: every request as the client publishes it."""
    return codec.encode_requests(fixtures.requests(spark, sf_dir))


@register("decoded_requests", """
SELECT request_id, user_id, src_lat, src_lon, dst_lat, dst_lon, departure_date,
       CAST(len(price_range) AS INTEGER) AS n_price, price_range[1] AS price_lo, price_range[2] AS price_hi,
       CAST(len(time_range) AS INTEGER) AS n_time, time_range[1] AS time_lo, time_range[2] AS time_hi,
       'OK' AS status
FROM req
""")
def q_decoded_requests(spark, sf_dir):
    """F1 + J1 + J2 + J4 + J5: decode the published messages again."""
    d = codec.decode_requests(codec.encode_requests(fixtures.requests(spark, sf_dir)))
    return d.select("request_id", "user_id", "src_lat", "src_lon", "dst_lat", "dst_lon", "departure_date",
                    F.size("price_range").alias("n_price"), F.get("price_range", 0).alias("price_lo"),
                    F.get("price_range", 1).alias("price_hi"), F.size("time_range").alias("n_time"),
                    F.get("time_range", 0).alias("time_lo"), F.get("time_range", 1).alias("time_hi"),
                    "status")


@register("request_statuses", """
SELECT request_id,
  CASE request_id % 8 WHEN 4 THEN 'input-' WHEN 5 THEN 'input' || user_id ELSE user_id END AS user_id,
  CASE request_id % 8 WHEN 0 THEN 'BAD_JSON' WHEN 1 THEN 'NOT_OBJECT' WHEN 2 THEN 'MISSING_FIELD' WHEN 3 THEN 'BAD_DATE'
    WHEN 4 THEN 'BAD_KEY' WHEN 5 THEN 'BAD_KEY' ELSE 'OK' END AS status,
  CASE request_id % 8 WHEN 4 THEN 'output-input-' WHEN 5 THEN 'output-input' || user_id ELSE 'output-' || user_id END AS reply
FROM requests
""")
def q_request_statuses(spark, sf_dir):
    """J2 + J4 + J12: messages with bad fields, their statuses and reply keys."""
    m = codec.encode_requests(fixtures.requests(spark, sf_dir))
    k = F.col("request_id") % 8
    value = (F.when(k == 0, F.concat(F.lit("{"), F.col("value"))).when(k == 1, F.lit("[1, 2]"))
             .when(k == 2, F.regexp_replace("value", '"dst"', '"to"'))
             .when(k == 3, F.regexp_replace("value", "[0-9]{4}-[0-9]{2}-[0-9]{2}", "29/10/2024")).otherwise(F.col("value")))
    key = F.when(k == 4, F.lit("input-")).when(k == 5, F.regexp_replace("key", "-", "")).otherwise(F.col("key"))
    d = codec.decode_requests(m.select("request_id", key.alias("key"), value.alias("value")))
    return d.select("request_id", "user_id", "status", codec.reply_key(F.col("user_id")).alias("reply"))


# --- cities and roles (G1, F3, W1, K1, W2, F9, U1) ---------------------------------

@register("nearby_cities", """
SELECT request_id, side, city_id, rank, ROUND(distance_km, 3) AS distance_km FROM near
""")
def q_nearby(spark, sf_dir):
    """G1 + F3 + W1 + K1: five most populous cities within 200 km."""
    _, _, roles, _ = _pieces(spark, sf_dir)
    return roles.select("request_id", "side", "city_id", "rank", F.round("distance_km", 3).alias("distance_km"))


@register("nearby_cities_dense")
def q_nearby_dense(spark, sf_dir):
    """G1 + K1 by the pyramid: every customer's place is a point, every order
    a city of a dense catalogue."""
    from routeweave.operators import pyramid

    k = F.col("o_orderkey")
    cities = fixtures.table(spark, sf_dir, "orders").select(
        k.alias("city_id"), F.concat(F.lit("C"), k.cast("string")).alias("city_name"), F.lit("X").alias("country_code"),
        (F.lit(43.0) + (k * 7919 % 10007) / 1000).alias("lat"), (F.lit(3.0) + (k * 104729 % 14009) / 1000).alias("lon"),
        (F.lit(50_000) + k * 31 % 9973 * 200).alias("population"))
    c = F.col("c_custkey")
    points = fixtures.table(spark, sf_dir, "customer").select(
        c.alias("point_id"), (F.lit(42.0) + (c * 37 % 12007) / 1000).alias("lat"), (F.lit(1.0) + (c * 101 % 18013) / 1000).alias("lon"))
    found = pyramid.nearby_cities(points, pyramid.city_pyramid(cities), key=("point_id",))
    return found.select("point_id", "city_id", "rank", F.round("distance_km", 3).alias("distance_km"))


register_sql({"nearby_cities_dense": """
WITH c AS (
  SELECT o_orderkey AS city_id, 43.0::DOUBLE + (o_orderkey * 7919 % 10007) / 1000 AS lat, 3.0::DOUBLE + (o_orderkey * 104729 % 14009) / 1000 AS lon,
         50000 + o_orderkey * 31 % 9973 * 200 AS population FROM orders),
p AS (
  SELECT c_custkey AS point_id, 42.0::DOUBLE + (c_custkey * 37 % 12007) / 1000 AS lat, 1.0::DOUBLE + (c_custkey * 101 % 18013) / 1000 AS lon FROM customer),
near AS (
  SELECT p.point_id, c.city_id, c.population, 2 * 6371.0 * asin(sqrt(pow(sin(radians(c.lat - p.lat) / 2), 2)
    + cos(radians(p.lat)) * cos(radians(c.lat)) * pow(sin(radians(c.lon - p.lon) / 2), 2))) AS distance_km
  FROM p JOIN c ON abs(c.lat - p.lat) < 2 WHERE c.population >= 100000)
SELECT point_id, city_id, rank, ROUND(distance_km, 3) AS distance_km FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY point_id ORDER BY population DESC, city_id) AS INTEGER) AS rank
  FROM near WHERE distance_km <= 200) WHERE rank <= 5
"""})


@register("city_roles", "SELECT request_id, side, city_id, rank, role FROM roles")
def q_roles(spark, sf_dir):
    """Rank 1 is the endpoint, the others are transit."""
    _, _, roles, _ = _pieces(spark, sf_dir)
    return roles.select("request_id", "side", "city_id", "rank", "role")


@register("request_plan", """
SELECT request_id, user_id, o_city, d_city, departure_date, status FROM plan
""")
def q_plan(spark, sf_dir):
    """endpoints per request, NO_CITY when one is missing."""
    _, plan, _, _ = _pieces(spark, sf_dir)
    return plan.select("request_id", "user_id", "o_city", "d_city", "departure_date", "status")


@register("transit_cities", "SELECT request_id, via, via_name FROM stops")
def q_transit(spark, sf_dir):
    """U1 + D6."""
    _, _, _, stops = _pieces(spark, sf_dir)
    return stops


# --- graphs and legs (U3, T1, T2, F10, U4) --------------------------------------------

@register("request_graphs", "SELECT request_id, graph_id FROM graph_of")
def q_request_graphs(spark, sf_dir):
    """The graph of every answerable request; the queries below are per graph."""
    _, graph_of, _ = _graphs(spark, sf_dir)
    return graph_of.select("request_id", "graph_id")


@register("leg_city_pairs", "SELECT graph_id, from_city, to_city, departure_date FROM pairs")
def q_pairs(spark, sf_dir):
    """U3."""
    return leg_city_pairs(_graphs(spark, sf_dir)[2])


@register("place_pairs", """
SELECT DISTINCT t.o_city AS from_city, t.d_city AS to_city, t.provider, t.origin_place_id AS src_place_id,
       t.dest_place_id AS dst_place_id
FROM ctrips t JOIN (SELECT DISTINCT from_city, to_city FROM pairs) p
  ON t.o_city = p.from_city AND t.d_city = p.to_city
""")
def q_place_pairs(spark, sf_dir):
    """T1 over the distinct searched city pairs: place pairs with a trip."""
    cat, _, graphs = _graphs(spark, sf_dir)
    return place_pairs(leg_city_pairs(graphs), city_trips(cat.trips, cat.places))


@register("request_legs", "SELECT graph_id, leg_id, o_city, d_city, price, duration_h FROM legs")
def q_request_legs(spark, sf_dir):
    """T2 + F10 + U4: the legs of every graph that requests search."""
    return _legs(spark, sf_dir).select("graph_id", "leg_id", "o_city", "d_city", "price", "duration_h")


# --- routes (R4, R5, A3, U6, F7, F8) --------------------------------------------------

@register("route_candidates", "SELECT graph_id, route_id, n_legs, total_price, total_time FROM routes")
def q_route_candidates(spark, sf_dir):
    """R4 + R5 + A3 + U6 on the graphs that requests search."""
    cat, _, graphs = _graphs(spark, sf_dir)
    return graph_routes(graphs, city_trips(cat.trips, cat.places), places_repeat(cat.places))


@register("routes_in_range", """
, searched AS (
  SELECT DISTINCT graph_id, CASE WHEN len(price_range) = 2 THEN price_range[1] END AS p_lo,
         CASE WHEN len(price_range) = 2 THEN price_range[2] END AS p_hi,
         CASE WHEN len(time_range) = 2 THEN time_range[1] END AS t_lo,
         CASE WHEN len(time_range) = 2 THEN time_range[2] END AS t_hi FROM graph_of)
SELECT s.*, r.route_id, r.total_price, r.total_time FROM searched s JOIN routes r ON r.graph_id = s.graph_id
WHERE (s.p_lo IS NULL OR r.total_price BETWEEN s.p_lo AND s.p_hi) AND (s.t_lo IS NULL OR r.total_time BETWEEN s.t_lo AND s.t_hi)
""")
def q_in_range(spark, sf_dir):
    """F7 + F8 on the enumerated routes, per graph and distinct ranges."""
    cat, graph_of, graphs = _graphs(spark, sf_dir)
    r = graph_routes(graphs, city_trips(cat.trips, cat.places), places_repeat(cat.places))
    asked = fixtures.requests(spark, sf_dir).select("request_id", "price_range", "time_range")
    # as few as graphs and ranges: written, its size lets the join leave the routes where they are
    searched = materialize(graph_of.select("request_id", "graph_id").join(asked, "request_id").select(
        "graph_id", lower_bound(F.col("price_range")).alias("p_lo"), upper_bound(F.col("price_range")).alias("p_hi"),
        lower_bound(F.col("time_range")).alias("t_lo"), upper_bound(F.col("time_range")).alias("t_hi")).distinct())
    found = searched.join(r, "graph_id").filter(F.col("total_price").between(F.col("p_lo"), F.col("p_hi"))
                                                & F.col("total_time").between(F.col("t_lo"), F.col("t_hi")))
    finite = [F.when(F.abs(c) != float("inf"), F.col(c)).alias(c) for c in ("p_lo", "p_hi", "t_lo", "t_hi")]
    return found.select("graph_id", *finite, "route_id", "total_price", "total_time")


# --- graph views (A1, A2, R2, R3, U5, A4) ---------------------------------------------

_GRAPH_PLACES = """
glegs AS MATERIALIZED (SELECT l.*, g.d_city AS target FROM legs l JOIN graphs g ON g.graph_id = l.graph_id),
gplaces AS (
  SELECT graph_id, origin_place_id AS place_id, o_name AS place_name, o_city AS city_id FROM glegs
  UNION SELECT graph_id, dest_place_id, d_name, d_city FROM glegs),
reach AS MATERIALIZED (
  SELECT graph_id, dest_place_id AS place_id FROM glegs WHERE d_city = target
  UNION SELECT graph_id, origin_place_id FROM glegs WHERE d_city = target
  UNION SELECT graph_id, origin_place_id FROM glegs WHERE o_city = target),
kept AS MATERIALIZED (
  SELECT l.* FROM glegs l JOIN reach r ON r.graph_id = l.graph_id AND r.place_id = l.dest_place_id),
pruned AS (
  SELECT g.graph_id, g.city_id, g.place_id FROM gplaces g JOIN graphs x ON x.graph_id = g.graph_id WHERE g.city_id = x.d_city
  UNION SELECT graph_id, o_city, origin_place_id FROM kept)
"""


def _graph_sql(body):
    return "," + _GRAPH_PLACES + body


@register("graph_places", _graph_sql("SELECT graph_id, place_id, place_name, city_id FROM gplaces"))
def q_graph_places(spark, sf_dir):
    """A2."""
    return _shared(spark, sf_dir).places()


@register("graph_nodes", _graph_sql("""
SELECT graph_id, city_id, COUNT(*) AS n_places FROM gplaces GROUP BY graph_id, city_id
"""))
def q_graph_nodes(spark, sf_dir):
    """A1."""
    return _shared(spark, sf_dir).city_nodes()


@register("reachable_legs", _graph_sql("SELECT graph_id, leg_id FROM kept"))
def q_reachable(spark, sf_dir):
    """R2: backward reachability from the destination city."""
    return _shared(spark, sf_dir).kept_legs().select("graph_id", "leg_id")


@register("pruned_nodes", _graph_sql("SELECT graph_id, city_id, place_id FROM pruned"))
def q_pruned_nodes(spark, sf_dir):
    """R3 + U5."""
    return _shared(spark, sf_dir).kept_places().select("graph_id", "city_id", "place_id")


@register("graph_report", _graph_sql("""
SELECT k.graph_id, k.o_city AS city_id, COUNT(*) AS n_legs, MIN(k.price) AS min_price, MAX(k.price) AS max_price,
       MIN(k.duration_h) AS min_hours, MAX(k.duration_h) AS max_hours
FROM kept k WHERE k.o_city <> k.target GROUP BY k.graph_id, k.o_city
"""))
def q_graph_report(spark, sf_dir):
    """A4 aggregates per node."""
    shared = _shared(spark, sf_dir)
    return graph.graph_report(shared.kept_legs(), shared.graphs)


@register("graph_report_nodes", _graph_sql("""
SELECT graph_id, city_id, COUNT(*) AS n_places, chr(9) || '*Outcoming routes from node ' || CAST(city_id AS VARCHAR) || '*' AS line
FROM pruned GROUP BY graph_id, city_id
"""))
def q_graph_report_nodes(spark, sf_dir):
    """A4, node section."""
    return graph.graph_report_nodes(_shared(spark, sf_dir).kept_places())


@register("graph_report_lines", _graph_sql("""
SELECT k.graph_id, k.leg_id,
  chr(9) || chr(9) || '(' || k.origin_place_id || ':' || k.o_name || ':' || k.provider || ':' || CAST(k.o_city AS VARCHAR)
  || ') ==(' || CAST(k.price AS VARCHAR) || '€:' || CAST(k.duration_h AS VARCHAR) || 'h)=> ('
  || k.dest_place_id || ':' || k.d_name || ':' || k.provider || ':' || CAST(k.d_city AS VARCHAR) || ')' AS line
FROM kept k WHERE k.o_city <> k.target
"""))
def q_graph_report_lines(spark, sf_dir):
    """A4 text: one line per kept leg leaving a node other than the destination."""
    shared = _shared(spark, sf_dir)
    return graph.graph_report_lines(shared.kept_legs(), shared.graphs)


# --- multi-leg, cyclic graphs derived from the orders (R2, R4, V2) ----------------------

#: One graph per customer: its orders are legs between nine places in five cities.
_ORDER_LEGS = """
olegs AS (
  SELECT CAST(o_custkey AS VARCHAR) AS graph_id, CAST(o_orderkey AS VARCHAR) AS leg_id,
         (o_orderkey * 7 + o_custkey) % 9 AS p, (o_orderkey * 5 + o_custkey * 3 + o_orderkey // 9 + 1) % 9 AS q,
         CASE WHEN o_orderkey % 3 = 0 THEN 'BUS' ELSE 'FLIGHT' END AS provider,
         CAST(o_orderkey % 97 AS DOUBLE) + CAST(o_orderkey % 8 AS DOUBLE) * 0.125 AS price,
         CAST(o_orderkey % 7 AS DOUBLE) AS duration_h
  FROM orders),
oplan AS (
  SELECT DISTINCT graph_id, CAST(graph_id AS BIGINT) % 5 AS o_city, CAST(graph_id AS BIGINT) // 5 % 5 AS d_city FROM olegs)"""

_ORDER_ROUTES = """WITH RECURSIVE""" + _ORDER_LEGS + """,
walk AS (
  SELECT g.graph_id, g.d_city, l.p AS start_p, l.q AS last_q, [l.p, l.q] AS visited, l.leg_id AS route_id, 1 AS n_legs,
         l.price AS total_price, l.duration_h AS total_time, l.provider = 'FLIGHT' AS all_flight
  FROM oplan g JOIN olegs l ON l.graph_id = g.graph_id AND l.p // 2 = g.o_city
  UNION ALL
  SELECT w.graph_id, w.d_city, w.start_p, l.q, list_append(w.visited, l.q), w.route_id || '>' || l.leg_id, w.n_legs + 1,
         w.total_price + l.price, w.total_time + l.duration_h, w.all_flight AND l.provider = 'FLIGHT'
  FROM walk w JOIN olegs l ON l.graph_id = w.graph_id AND l.p = w.last_q
  WHERE w.last_q // 2 <> w.d_city
    AND (NOT list_contains(w.visited, l.q) OR (l.q = w.start_p AND l.q // 2 = w.d_city)))
"""


def _order_graphs(spark, sf_dir):
    o = fixtures.table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    p, q = (k * 7 + c) % 9, (k * 5 + c * 3 + F.floor(k / 9) + 1) % 9
    legs = o.select(
        c.cast("string").alias("graph_id"), k.cast("string").alias("leg_id"), p.cast("string").alias("origin_place_id"),
        p.cast("string").alias("o_name"), F.floor(p / 2).cast("long").alias("o_city"), q.cast("string").alias("dest_place_id"),
        q.cast("string").alias("d_name"), F.floor(q / 2).cast("long").alias("d_city"),
        F.when(k % 3 == 0, F.lit("BUS")).otherwise(F.lit("FLIGHT")).alias("provider"),
        ((k % 97).cast("double") + (k % 8).cast("double") * 0.125).alias("price"), (k % 7).cast("double").alias("duration_h"))
    plan = legs.select("graph_id").distinct().select(
        "graph_id", (F.col("graph_id").cast("long") % 5).alias("o_city"),
        (F.floor(F.col("graph_id").cast("long") / 5) % 5).alias("d_city"))
    return plan, legs


@register("multi_leg_routes")
def q_multi_leg_routes(spark, sf_dir):
    """R4 + R5 + U6 on cyclic graphs with routes of any length."""
    plan, legs = _order_graphs(spark, sf_dir)
    return enumerate_routes(legs, plan).select("graph_id", "route_id", "n_legs", "total_price", "total_time")


@register("multi_leg_routes_capped")
def q_multi_leg_routes_capped(spark, sf_dir):
    """V2: at most 4 legs by air, 3 with a bus."""
    plan, legs = _order_graphs(spark, sf_dir)
    return enumerate_routes(legs, plan, max_legs=3, max_legs_flight=4).select("graph_id", "route_id", "n_legs")


@register("multi_leg_reachable")
def q_multi_leg_reachable(spark, sf_dir):
    """R2 on cyclic graphs."""
    plan, legs = _order_graphs(spark, sf_dir)
    return graph.prune_unreachable(legs, plan).select("graph_id", "leg_id")


_REFUND = 40.0


@register("multi_leg_top_routes")
def q_multi_leg_top(spark, sf_dir):
    """R4 + R6 + R7 best first: the five best routes of every cyclic graph."""
    plan, legs = _order_graphs(spark, sf_dir)
    return n_best_routes(legs, plan).select("graph_id", "rank", "route_id", "n_legs", "total_price", "total_time")


@register("multi_leg_refund_routes")
def q_multi_leg_refunds(spark, sf_dir):
    """The same within ranges and with legs of negative price."""
    plan, legs = _order_graphs(spark, sf_dir)
    legs = legs.withColumn("price", F.col("price") - _REFUND)
    plan = plan.withColumns({"p_lo": F.lit(-60.0), "p_hi": F.lit(50.0), "t_lo": F.lit(2.0), "t_hi": F.lit(None).cast("double")})
    return n_best_routes(legs, plan).select("graph_id", "rank", "route_id", "n_legs", "total_price", "total_time")


_BEST_OF = """
SELECT graph_id, rank, route_id, n_legs, total_price, total_time FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY graph_id ORDER BY total_price, total_time DESC, route_id) AS INTEGER) AS rank
  FROM walk WHERE last_q // 2 = d_city @RANGE@) WHERE rank <= 5"""


register_sql({
    "multi_leg_top_routes": _ORDER_ROUTES + _BEST_OF.replace("@RANGE@", ""),
    "multi_leg_refund_routes": _ORDER_ROUTES.replace("* 0.125 AS price", f"* 0.125 - {_REFUND} AS price")
    + _BEST_OF.replace("@RANGE@", "AND total_price BETWEEN -60 AND 50 AND total_time >= 2"),
    "multi_leg_routes": _ORDER_ROUTES + """
SELECT graph_id, route_id, n_legs, total_price, total_time FROM walk WHERE last_q // 2 = d_city""",
    "multi_leg_routes_capped": _ORDER_ROUTES + """
SELECT graph_id, route_id, n_legs FROM walk
WHERE last_q // 2 = d_city AND CASE WHEN all_flight THEN n_legs <= 4 ELSE n_legs <= 3 END""",
    "multi_leg_reachable": "WITH RECURSIVE" + _ORDER_LEGS + """,
reached AS (
  SELECT g.graph_id, l.p FROM oplan g JOIN olegs l ON l.graph_id = g.graph_id AND l.q // 2 = g.d_city
  UNION
  SELECT r.graph_id, l.p FROM reached r JOIN olegs l ON l.graph_id = r.graph_id AND l.q = r.p)
SELECT l.graph_id, l.leg_id FROM olegs l JOIN oplan g ON g.graph_id = l.graph_id
  LEFT JOIN reached r ON r.graph_id = l.graph_id AND r.p = l.q
WHERE l.q // 2 = g.d_city OR r.p IS NOT NULL""",
})


# --- replies (J10, J11, J12, W4, F2) ---------------------------------------------------

_RESPONSES = """
, lines AS (
  SELECT request_id, rank, chr(9) || 'Route ' || CAST(rank AS VARCHAR) || ' | Stops: ' || stops
         || ' | Total Price: ' || CAST(total_price AS VARCHAR) || ' EUR | Total Time: '
         || CAST(total_time AS VARCHAR) || ' hours' || chr(10) AS line
  FROM top),
texts AS (
  SELECT request_id, string_agg(line, '' ORDER BY rank) AS body FROM lines GROUP BY request_id),
responses AS (
  SELECT p.request_id, 'output-' || p.user_id AS key,
    CASE WHEN p.status <> 'OK' THEN 'Ups! There was some error in the query...'
         WHEN t.body IS NULL THEN 'Sorry, no routes were found for the received dates and configuration...'
         ELSE 'Routes found to travel from ' || p.o_name || ' to ' || p.d_name || ':' || chr(10) || t.body END AS value
  FROM plan p LEFT JOIN texts t USING (request_id))
"""


@register("responses", _RESPONSES + "SELECT request_id, key, value FROM responses")
def q_responses(spark, sf_dir):
    """J10 + J11 + J12 + W4: the reply of every request."""
    return _search(spark, sf_dir).responses


FOLLOWED_USER = "7"


@register("responses_for_user", _RESPONSES + f"""
SELECT request_id, key, value FROM responses WHERE key = 'output-{FOLLOWED_USER}'
""")
def q_responses_for(spark, sf_dir):
    """the replies one client reads from the shared topic."""
    return codec.responses_for(_search(spark, sf_dir).responses, FOLLOWED_USER)


@register("request_replies", """
SELECT request_id, 'output-' || user_id AS key FROM requests
""")
def q_reply_keys(spark, sf_dir):
    """J4 + J12: reply key from the request key of every message."""
    d = codec.decode_requests(codec.encode_requests(fixtures.requests(spark, sf_dir)))
    return d.select("request_id", codec.reply_key(F.col("user_id")).alias("key"))


# --- streaming (S1, S2, S3) --------------------------------------------------------------

@register("stream_responses", _RESPONSES + "SELECT request_id, key, value FROM responses")
def q_stream_responses(spark, sf_dir):
    """S1 + S3 + S2: the published request messages are replayed through
    the streaming service (file source, several micro-batches) and the
    replies read back from its sink; they must equal the batch replies."""
    import uuid

    from routeweave.session import ensure_checkpoint_dir
    from routeweave.streaming import serve as svc

    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/routeweave-stream/{uuid.uuid4().hex}"
    msgs = codec.encode_requests(fixtures.requests(spark, sf_dir))
    files = _files(msgs, 4)
    msgs.repartition(files, "request_id").write.parquet(f"{base}/in")
    stream = svc.read_messages(spark, "parquet", f"{base}/in", maxFilesPerTrigger=(files + 1) // 2)
    q = svc.serve(stream, fixtures.catalogue(spark, sf_dir), f"{base}/out", f"{base}/ckpt",
                  trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("request_id", "key", "value")


# --- clients and documents as streams (C1, S5-S8, U4) -------------------------------------

@register("client_replies", _RESPONSES + """
SELECT m.request_id, m.user_id, CASE WHEN r.request_id IS NULL THEN 'UNANSWERED' ELSE 'ANSWERED' END AS fate, r.value AS reply,
       CAST(r.request_id % 90 AS DOUBLE) AS waited_s
FROM requests m LEFT JOIN responses r ON r.request_id = m.request_id AND r.request_id % 90 <= 60 AND r.request_id % 7 <> 3
""")
def q_client_replies(spark, sf_dir):
    """C1 over all users: requests and replies as streams, joined with the
    60 s bound.  Replies take up to 89 s and every seventh is lost; a message
    of a later day on both topics ends the waiting."""
    from routeweave.streaming.client import follow_all

    sent_at = (F.timestamp_seconds(F.lit(1_704_067_200) + F.col("request_id") * 2)).alias("sent_at")
    late = F.timestamp_seconds(F.lit(4_000_000_000))
    replies = _search(spark, sf_dir).responses
    requests = codec.encode_requests(fixtures.requests(spark, sf_dir)).select("request_id", "key", sent_at)
    delay = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("request_id") * 2 + F.col("request_id") % 90)
    replies = replies.filter(F.col("request_id") % 7 != 3).select("request_id", "key", "value", delay.alias("replied_at"))
    end = spark.range(1).select(F.lit(-1).cast("long").alias("request_id"), F.lit("end").alias("key"))
    base = _scratch(spark, "clients")
    files = _files(requests, 3)
    requests.repartition(files, "request_id").write.parquet(f"{base}/requests")
    replies.repartition(files, "request_id").write.parquet(f"{base}/replies")
    # the last message is no request, but its time is seen before it is dropped
    end.select("request_id", F.lit("input-end").alias("key"), late.alias("sent_at")).write.mode("append").parquet(f"{base}/requests")
    end.select("request_id", "key", F.lit("").alias("value"), late.alias("replied_at")).write.mode("append").parquet(f"{base}/replies")
    stream = lambda name, schema: spark.readStream.schema(schema).parquet(f"{base}/{name}")
    found = follow_all(stream("requests", "request_id BIGINT, key STRING, sent_at TIMESTAMP"),
                       stream("replies", "request_id BIGINT, key STRING, value STRING, replied_at TIMESTAMP"))
    q = (found.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return (spark.read.schema(found.schema).parquet(f"{base}/out").filter("request_id >= 0")
            .select("request_id", "user_id", "fate", "reply", "waited_s"))


@register("payload_stream_trips", f"SELECT DISTINCT {_LEG_COLUMNS} FROM ctrips", trip=_PAYLOAD_TRIP.replace("DISTINCT ", ""))
def q_payload_stream(spark, sf_dir):
    """S5-S8 as a stream: documents arrive twice in several files, legs are
    appended once, and the stream is started anew half-way."""
    from routeweave.streaming import ingest

    ctrips = city_trips(*(lambda c: (c.trips, c.places))(fixtures.catalogue(spark, sf_dir)))
    base = _scratch(spark, "documents")
    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(F.xxhash64("value"), F.lit(3600))).alias("fetched_at")
    columns = ["value", "o_city", "d_city", "departure_date", at]
    # documents are stored where they are made: dealing them anew would move each text once more
    files = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for name, docs in (("quotes", payloads.flight_quote_documents(ctrips)), ("journeys", payloads.bus_journey_documents(ctrips))):
        docs.select(*columns).write.option("compression", "zstd").parquet(f"{base}/{name}/part=1")

    def run():
        read = lambda name: ingest.read_documents(spark, f"{base}/{name}", recursiveFileLookup="true", maxFilesPerTrigger=str(files))
        legs = ingest.fresh_legs(read("quotes"), read("journeys"))
        ingest.append_legs(legs, f"{base}/legs", f"{base}/ckpt", {"availableNow": True}).awaitTermination()
        return legs.schema

    run()
    for name in ("quotes", "journeys"):         # the same documents once more
        again = spark.read.schema(ingest.DOCUMENT_SCHEMA).parquet(f"{base}/{name}/part=1")
        again.write.option("compression", "zstd").parquet(f"{base}/{name}/part=2")
    schema = run()
    return ingest.read_legs(spark, f"{base}/legs", schema).drop("fetched_at").select(*_LEG_COLUMNS.replace("\n", " ").replace(" ", "").split(","))


MESSAGES_PER_FILE = 250_000


def _files(messages, least: int) -> int:
    """Files that a stream's messages are written into: a few, more where they are many."""
    return max(least, -(-messages.count() // MESSAGES_PER_FILE))


def _scratch(spark, name: str) -> str:
    """A new folder of a query's own in the shared folder."""
    import uuid

    from routeweave.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/routeweave-{name}/{uuid.uuid4().hex}"
