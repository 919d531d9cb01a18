"""Nearby cities and city roles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routeweave.functions.codec import STATUS_NO_CITY, STATUS_OK
from routeweave.functions.geo import haversine_km, lat_band, lon_cell, lon_cells

# Fixed values of the nearby-city search.
RADIUS_KM = 200.0
MIN_POPULATION = 100000
CITY_LIMIT = 5
ROLE_THRESHOLD_KM = 50.0
SRC, DST = "SRC", "DST"
ORIGIN, DESTINATION, TRANSIT = "ORIGIN", "DESTINATION", "TRANSIT"


def request_points(requests: DataFrame) -> DataFrame:
    """Both coordinates of each request as rows ``(request_id, side, lat, lon)``."""
    pt = F.explode(F.array(
        F.struct(F.lit(SRC).alias("side"), F.col("src_lat").alias("lat"), F.col("src_lon").alias("lon")),
        F.struct(F.lit(DST).alias("side"), F.col("dst_lat").alias("lat"), F.col("dst_lon").alias("lon"))))
    return requests.select("request_id", pt.alias("p")).select("request_id", "p.*")


def nearby_cities(points: DataFrame, cities: DataFrame, radius_km: float = RADIUS_KM,
                  min_population: int = MIN_POPULATION, limit: int = CITY_LIMIT,
                  key=("request_id", "side")) -> DataFrame:
    """G1 + F3 + W1 + K1: the ``limit`` most populous cities within
    ``radius_km`` of each point, ranked 1..limit.

    Range join as an equi-join on cells of a latitude/longitude grid (the
    point side is repeated for the cells around it) plus an exact haversine
    filter.
    """
    cat = (cities.filter(F.col("population") >= min_population)
           .select("city_id", "city_name", "country_code", "population",
                   F.col("lat").alias("c_lat"), F.col("lon").alias("c_lon"),
                   lat_band(F.col("lat"), radius_km).alias("band"))
           .withColumn("cell", lon_cell(F.col("c_lon"), lon_cells(F.col("band"), radius_km))))
    # one row per band around the point, then one per cell of that band
    own = lat_band(F.col("lat"), radius_km)
    probe = (points.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
             .withColumn("band", F.explode(F.array(own - 1, own, own + 1)))
             .withColumn("_n", lon_cells(F.col("band"), radius_km))
             .withColumn("_own", lon_cell(F.col("lon"), F.col("_n")))
             .withColumn("cell", F.explode(F.array_distinct(F.transform(
                 F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda s: F.pmod(F.col("_own") + s, F.col("_n"))))))
             .drop("_n", "_own"))
    dist = haversine_km(F.col("lat"), F.col("lon"), F.col("c_lat"), F.col("c_lon"))
    near = (probe.join(cat, ["band", "cell"]).withColumn("distance_km", dist)
            .filter(F.col("distance_km") <= radius_km))
    w = Window.partitionBy(*key).orderBy(F.col("population").desc(), F.col("city_id"))
    return (near.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= limit)
            .select(*key, "city_id", "city_name", "country_code", "population", "distance_km", "rank"))


def assign_roles(ranked: DataFrame, by: str = "population",
                 threshold_km: float = ROLE_THRESHOLD_KM, key=("request_id", "side")) -> DataFrame:
    """W2 (and V1 with ``by="distance"``): the endpoint city of each side
    and the transit cities.

    ``population``: rank 1 is the origin (SRC) or destination (DST), the
    rest are transit.  ``distance``: cities farther than the nearest one
    plus ``threshold_km`` are transit; among the others the first in rank
    order is the endpoint and the rest take no role.
    """
    if by == "population":
        return ranked.withColumn("endpoint", F.col("rank") == 1)
    if by != "distance":
        raise ValueError(f"unknown role rule {by!r}")
    side = Window.partitionBy(*key)
    near_first = Window.partitionBy(*key, "_far").orderBy("rank")
    t = (ranked.withColumn("_far", F.col("distance_km") > F.min("distance_km").over(side) + threshold_km)
         .withColumn("_pos", F.row_number().over(near_first)))
    endpoint = F.when(F.col("_far"), F.lit(False)).when(F.col("_pos") == 1, F.lit(True))
    return t.withColumn("endpoint", endpoint).filter(F.col("endpoint").isNotNull()).drop("_far", "_pos")


def name_roles(ranked: DataFrame) -> DataFrame:
    """Role text from the side and the endpoint flag."""
    role = (F.when(~F.col("endpoint"), F.lit(TRANSIT))
            .when(F.col("side") == SRC, F.lit(ORIGIN)).otherwise(F.lit(DESTINATION)))
    return ranked.withColumn("role", role).drop("endpoint")


# --- planning at the level of distinct coordinates ------------------------------------

PAIR_KEY = ["src_lat", "src_lon", "dst_lat", "dst_lon"]


def coordinate_roles(requests: DataFrame, cities: DataFrame, radius_km: float = RADIUS_KM,
                     min_population: int = MIN_POPULATION, limit: int = CITY_LIMIT,
                     by: str = "population", threshold_km: float = ROLE_THRESHOLD_KM) -> DataFrame:
    """G1 + W1 + K1 + W2 once per distinct coordinate of the requests:
    ``lat, lon, city_id, city_name, ..., rank, endpoint``."""
    coords = request_points(requests).select("lat", "lon").distinct()
    ranked = nearby_cities(coords, cities, radius_km, min_population, limit, key=("lat", "lon"))
    return assign_roles(ranked, by, threshold_km, key=("lat", "lon"))


def pair_plan(requests: DataFrame, per_coord: DataFrame):
    """F9 + U1 + D6 once per distinct (source, destination) coordinate pair:
    ``(ends, stops)`` keyed by the four coordinates.  Everything a request
    needs besides its ranges and day depends on this pair only."""
    pairs = (requests.filter(F.col("status") == STATUS_OK)
             .select(*PAIR_KEY).dropna().distinct())

    def side(prefix):
        return per_coord.select(F.col("lat").alias(f"{prefix}_lat"), F.col("lon").alias(f"{prefix}_lon"),
                                "city_id", "city_name", "population", "endpoint")
    src, dst = side("src"), side("dst")
    o = src.filter("endpoint").select("src_lat", "src_lon", F.col("city_id").alias("o_city"),
                                      F.col("city_name").alias("o_name"))
    d = dst.filter("endpoint").select("dst_lat", "dst_lon", F.col("city_id").alias("d_city"),
                                      F.col("city_name").alias("d_name"))
    ends = pairs.join(o, ["src_lat", "src_lon"]).join(d, ["dst_lat", "dst_lon"])
    transit = (pairs.join(src.filter(~F.col("endpoint")), ["src_lat", "src_lon"])
               .select(*PAIR_KEY, "city_id", "city_name", "population")
               .unionByName(pairs.join(dst.filter(~F.col("endpoint")), ["dst_lat", "dst_lon"])
                            .select(*PAIR_KEY, "city_id", "city_name", "population")))
    # of cities with one name the most populous stays, then the least id
    by_name = Window.partitionBy(*PAIR_KEY, "city_name").orderBy(F.col("population").desc(), "city_id")
    transit = transit.withColumn("_n", F.row_number().over(by_name)).filter("_n = 1")
    stops = (transit.join(ends.select(*PAIR_KEY, "o_city", "d_city"), PAIR_KEY)
             .filter((F.col("city_id") != F.col("o_city")) & (F.col("city_id") != F.col("d_city")))
             .select(*PAIR_KEY, F.col("city_id").alias("via"), F.col("city_name").alias("via_name")))
    return ends, stops


def plan_from_pairs(requests: DataFrame, ends: DataFrame) -> DataFrame:
    """each request with the endpoints of its coordinate pair;
    ``NO_CITY`` when the pair has none."""
    j = requests.join(ends, PAIR_KEY, "left")
    status = (F.when(F.col("status") != STATUS_OK, F.col("status"))
              .when(F.col("o_city").isNull() | F.col("d_city").isNull(), F.lit(STATUS_NO_CITY))
              .otherwise(F.lit(STATUS_OK)))
    return j.withColumn("status", status)


def stops_from_pairs(plan: DataFrame, stops: DataFrame) -> DataFrame:
    """Each answerable request with the transit cities of its pair."""
    ok = plan.filter(F.col("status") == STATUS_OK).select("request_id", *PAIR_KEY)
    return ok.join(stops, PAIR_KEY).select("request_id", "via", "via_name")
