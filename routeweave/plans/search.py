"""One search plan for batch and stream: requests in, top routes and replies out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeweave.functions.codec import STATUS_OK, coordinate
from routeweave.operators import geo
from routeweave.operators.legs import city_trips
from routeweave.operators.render import build_responses
from routeweave.operators.routes import TOP_N, request_segments, shared_top_routes, top_routes
from routeweave.plans.sizing import materialize
from routeweave.sources.fixtures import Catalogue


@dataclass(frozen=True)
class SearchParams:
    radius_km: float = geo.RADIUS_KM
    min_population: int = geo.MIN_POPULATION
    city_limit: int = geo.CITY_LIMIT
    roles_by: str = "population"          # V1: "distance"
    threshold_km: float = geo.ROLE_THRESHOLD_KM
    top_n: int = TOP_N
    connect_on: str = "place"             # V3: "city"


@dataclass
class SearchResult:
    plan: DataFrame        # one row per request: cities, ranges, status
    roles: DataFrame       # nearby cities with their role
    stops: DataFrame       # transit cities per request
    top: DataFrame         # ranked routes
    responses: DataFrame   # request_id, key, value


def typed_requests(requests: DataFrame) -> DataFrame:
    """Accept decoded requests as they are; give table requests (text
    coordinates, no status) coordinates and ``status = OK``."""
    r = requests
    if "src_lat" not in r.columns:
        r = r.select("*", coordinate(F.col("src"), 0).alias("src_lat"),
                     coordinate(F.col("src"), 1).alias("src_lon"),
                     coordinate(F.col("dst"), 0).alias("dst_lat"),
                     coordinate(F.col("dst"), 1).alias("dst_lon"))
    if "status" not in r.columns:
        r = r.withColumn("status", F.lit(STATUS_OK))
    return r


def plan_requests(requests: DataFrame, cities: DataFrame, params: SearchParams = SearchParams()):
    """(plan, roles, stops) with stops per request; see ``plan_requests_full``."""
    plan, roles, stops, _ = plan_requests_full(requests, cities, params)
    return plan, roles, stops


def plan_requests_full(requests: DataFrame, cities: DataFrame, params: SearchParams = SearchParams()):
    """G1 -> W1/K1 -> W2 -> F9 -> U1: (plan, roles, stops, pair_stops).

    Nearby cities and roles are computed per distinct coordinate, origin,
    destination and stops per distinct coordinate pair, and joined back to
    the requests on the coordinates (small sides are broadcast by AQE), so
    no step shuffles all requests by id.  ``roles`` (per request) is lazy:
    only the role queries evaluate it.
    """
    req = typed_requests(requests)
    ok = req.filter(F.col("status") == STATUS_OK)
    per_coord = materialize(geo.coordinate_roles(ok, cities, params.radius_km, params.min_population,
                                                 params.city_limit, params.roles_by, params.threshold_km))
    roles = geo.name_roles(geo.request_points(ok).join(per_coord, ["lat", "lon"]).drop("lat", "lon"))
    ends, pair_stops = geo.pair_plan(req, per_coord)
    plan = materialize(geo.plan_from_pairs(req, ends))
    stops = geo.stops_from_pairs(plan, pair_stops)
    return plan, roles, stops, pair_stops


def search(requests: DataFrame, catalogue: Catalogue, params: SearchParams = SearchParams(),
           ctrips: DataFrame | None = None) -> SearchResult:
    """``ctrips``: trips already joined with their cities (a stored
    catalogue has them); derived from the catalogue when absent.  Routes are
    searched once for all requests with the same ends, day and ranges."""
    plan, roles, stops, pair_stops = plan_requests_full(requests, catalogue.cities, params)
    ok = plan.filter(F.col("status") == STATUS_OK)
    if ctrips is None:
        ctrips = city_trips(catalogue.trips, catalogue.places)
    # requests that ask the same share one search; the table is written once, so ids stay
    # (an upper price bound only ends the order of the routes, so it is left to the requests)
    asked = ["o_city", "d_city", "departure_date", "price_from", "time_range", *geo.PAIR_KEY]
    plan_, ok = (x.withColumn("price_from", _price_from()) for x in (plan, ok))
    searches = materialize(ok.select(*asked).distinct().withColumn("request_id", F.monotonically_increasing_id()))
    segments = materialize(request_segments(searches.withColumnRenamed("price_from", "price_range"), pair_stops))
    found = shared_top_routes(segments, ctrips, params.top_n, params.connect_on).withColumnRenamed("request_id", "search_id")
    return _answers(plan_, roles, stops, searches.withColumnRenamed("request_id", "search_id"), found, asked, params.top_n)


def _has_start() -> Column:
    """The request has a price range with a lower bound."""
    return F.coalesce(F.size("price_range") == 2, F.lit(False)) & F.coalesce(F.get("price_range", 0) != float("-inf"), F.lit(False))


def _price_from() -> Column:
    """The price range of a request without its upper bound."""
    return F.when(_has_start(), F.array(F.get("price_range", 0), F.lit(float("inf")))).otherwise(F.col("price_range"))


def _answers(plan: DataFrame, roles: DataFrame, stops: DataFrame, searches: DataFrame, found: DataFrame, asked: list[str], n: int) -> SearchResult:
    """Requests take the routes of their search.  Rows that share a
    ``request_id`` are one request, which has ``n`` routes in all."""
    s, p = searches.alias("s"), plan.alias("p")
    same = F.col("p.status") == STATUS_OK
    for c in asked:
        same = same & F.col(f"p.{c}").eqNullSafe(F.col(f"s.{c}"))
    # null: the search has the request's own bounds; no route is below a bound that is null itself
    most = F.when(_has_start(), F.coalesce(F.get("p.price_range", 1), F.lit(float("-inf"))))
    full = p.join(s, same, "left").select("p.*", "s.search_id", most.alias("most"))
    plan = plan.drop("price_from")
    repeated = materialize(plan.filter(F.col("status") == STATUS_OK).groupBy("request_id").count()
                           .filter("count > 1").select(F.col("request_id").alias("_id")))
    if repeated.isEmpty():
        one, more = full, None
    else:
        again = F.col("request_id").eqNullSafe(F.col("_id"))
        one, more = full.join(repeated, again, "left_anti"), full.join(repeated, again, "left_semi")

    def ranked(requests):
        return (requests.select("request_id", "search_id", "most").join(found, "search_id")
                .filter("most IS NULL OR total_price <= most").drop("search_id", "most"))
    top = ranked(one)
    # a request without an id has routes, but no reply can name it
    keyed = one.withColumn("search_id", F.when(F.col("request_id").isNotNull(), F.col("search_id")))
    responses = build_responses(keyed, found, "search_id")
    if more is not None:
        again = top_routes(ranked(more).drop("rank"), n).select(*top.columns)
        top, responses = top.unionByName(again), responses.unionByName(build_responses(more.drop("most"), again))
    return SearchResult(plan, roles, stops, top, responses)


def top_route_rows(result: SearchResult) -> DataFrame:
    """Flat view of the ranked routes (no nested itinerary); prices are
    rounded here, after filter and order."""
    from routeweave.operators.routes import stops_text
    return result.top.select("request_id", "rank", "route_id", "n_legs", F.round("total_price", 2).alias("total_price"),
                             "total_time", stops_text(F.col("itinerary")).alias("stops"))
