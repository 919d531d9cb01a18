"""Travel tables derived from the TPC-H-style test tables.

The derivation is plain column arithmetic on whole tables (no sampling):
nations become cities, customers become places (airports and bus
stations), line items become priced trips and every event becomes a trip
request.  The same rules are written in SQL in ``plans/oracle.py``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routeweave.functions.timefmt import iso_datetime, with_journey_hours

# Fixed values of the fixture derivation.
BASE_DATE = "2024-01-01"
FLIGHT = "FLIGHT"
BUS = "BUS"
PRICE_RANGES = [[], [0.0, 100.0], [50.0, 250.0], [100.0]]
TIME_RANGES = [[], [0.0, 12.0], [1.0, 24.0]]


@dataclass
class Catalogue:
    cities: DataFrame
    places: DataFrame
    trips: DataFrame


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _city_lat(key):
    return (F.lit(45.0) + (key % 5).cast("double") * F.lit(1.0))


def _city_lon(key):
    return (F.lit(5.0) + (key / 5).cast("int").cast("double") * F.lit(1.5))


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 input: ``city_id, city_name, country_code, lat, lon, population``."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    k = F.col("n_nationkey")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(k.cast("int").alias("city_id"),
                    F.col("n_name").alias("city_name"),
                    F.col("r_name").alias("country_code"),
                    _city_lat(k).alias("lat"),
                    _city_lon(k).alias("lon"),
                    (F.lit(60000) + ((k * 7919) % 25) * 40000).cast("long").alias("population")))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``place_id, place_name, provider, city_id, place_code``."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(
        key.cast("string").alias("place_id"),
        F.col("c_name").alias("place_name"),
        F.when(key % 2 == 0, F.lit(FLIGHT)).otherwise(F.lit(BUS)).alias("provider"),
        F.col("c_nationkey").cast("int").alias("city_id"),
        F.concat(F.when(key % 10 == 0, F.lit("STOC-")).otherwise(F.lit("ARN-")),
                 key.cast("string")).alias("place_code"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priced trips between places, one per line item.

    ``leg_id, origin_place_id, dest_place_id, provider, departure_date,
    is_direct, price, duration_h, departure_dt, arrival_dt``
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    # number of places, as a scalar subquery inside the same plan
    n_places = table(spark, sf_dir, "customer").select(F.count(F.lit(1))).scalar()
    half = (n_places / 2).cast("long")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey)
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    dep_date = F.date_add(F.lit(BASE_DATE).cast("date"), (F.col("l_linenumber") % 7).cast("int"))
    dep_min = (F.col("l_orderkey") % 24) * 60 + F.col("l_partkey") % 60
    travel_min = F.lit(30) + (F.col("l_suppkey") * 13 + F.col("l_linenumber") * 17) % 600
    provider = F.when(F.col("o_custkey") % 2 == 0, F.lit(FLIGHT)).otherwise(F.lit(BUS))
    base = j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                    F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
                    cents.cast("string")).alias("leg_id"),
        F.col("o_custkey").cast("string").alias("origin_place_id"),
        (((F.col("l_partkey") * 7 + F.col("l_suppkey")) % half) * 2 + F.col("o_custkey") % 2)
        .cast("string").alias("dest_place_id"),
        provider.alias("provider"),
        dep_date.alias("departure_date"),
        F.lit(True).alias("is_direct"),
        # price = extended price / 500 rounded half-up to cents, in exact
        # integer arithmetic so every engine gets the same double
        (_half_up_div(cents * 2 + 500, 1000) / F.lit(100.0)).alias("price"),
        dep_min.alias("_dep_min"),
        (dep_min + travel_min).alias("_arr_min"))
    bus_dep = iso_datetime(F.col("departure_date"), F.col("_dep_min"))
    bus_arr = iso_datetime(F.date_add(F.col("departure_date"), (F.col("_arr_min") / 1440).cast("int")),
                           F.col("_arr_min") % 1440)
    # the clock texts are built in their own projection and referenced
    # by J7 below, so the optimizer keeps them computed once per row
    texts = with_journey_hours(base.select("*", bus_dep.alias("_bus_dep"), bus_arr.alias("_bus_arr")),
                               "_bus_dep", "_bus_arr", "_bus_hours")
    is_flight = F.col("provider") == FLIGHT
    # A flight leg takes 0 hours and departs and arrives on the requested day
    day = F.col("departure_date").cast("string")
    return texts.select(
        "leg_id", "origin_place_id", "dest_place_id", "provider", "departure_date", "is_direct",
        "price",
        F.when(is_flight, F.lit(0.0))
        .otherwise(F.col("_bus_hours").cast("double")).alias("duration_h"),
        F.when(is_flight, day).otherwise(F.col("_bus_dep")).alias("departure_dt"),
        F.when(is_flight, day).otherwise(F.col("_bus_arr")).alias("arrival_dt"))


def _half_up_div(num, den: int):
    """Integer quotient of non-negative ``num`` by ``den``."""
    return ((num - num % den) / den).cast("long")


def catalogue(spark: SparkSession, sf_dir: str) -> Catalogue:
    return Catalogue(cities(spark, sf_dir), places(spark, sf_dir), trips(spark, sf_dir))


def _coord_text(lat, lon):
    def one(v):
        return F.concat(F.lit("+"), v.cast("decimal(8,4)").cast("string"))
    return F.concat(one(lat), F.lit(","), one(lon))


def _pick(idx, options):
    expr = None
    for i, values in enumerate(options):
        arr = F.array(*[F.lit(float(v)) for v in values]).cast("array<double>")
        expr = F.when(idx == i, arr) if expr is None else expr.when(idx == i, arr)
    return expr


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a trip request: ``request_id, user_id, src, dst,
    departure_date, price_range, time_range``.

    Source city ``user_id % 25``, destination city ``(event_id*7+3) % 25``,
    date ``BASE_DATE + event_id % 7``; ranges cycle in blocks of 50 ids.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "user_id")
    src_key = F.col("user_id") % 25
    dst_key = (F.col("event_id") * 7 + 3) % 25
    block = (F.col("event_id") / 50).cast("long")
    return ev.select(
        F.col("event_id").alias("request_id"),
        F.col("user_id").cast("string").alias("user_id"),
        _coord_text(_city_lat(src_key), _city_lon(src_key)).alias("src"),
        _coord_text(_city_lat(dst_key), _city_lon(dst_key)).alias("dst"),
        F.date_add(F.lit(BASE_DATE).cast("date"), (F.col("event_id") % 7).cast("int"))
        .alias("departure_date"),
        _pick(block % 4, PRICE_RANGES).alias("price_range"),
        _pick(block % 3, TIME_RANGES).alias("time_range"))
