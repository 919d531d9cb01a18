"""Places, legs and graphs of requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeweave.functions.codec import STATUS_OK
from routeweave.operators.geo import PAIR_KEY
from routeweave.plans.sizing import materialize


def city_places(cities: DataFrame, places: DataFrame) -> DataFrame:
    """Places of every city (equi-join on ``city_id``)."""
    return places.join(cities.select("city_id", "city_name"), "city_id")


def distinct_legs(trips: DataFrame) -> DataFrame:
    """U4: equal legs count once.  ``leg_id`` covers all fields that tell
    legs apart, so of rows with one id the least by its fields is kept."""
    rest = [c for c in trips.columns if c != "leg_id"]
    # dealt by id first: the least row of an id is found by sorting, which
    # before the shuffle would sort (and spill) every row once more
    one = trips.repartition("leg_id").groupBy("leg_id").agg(F.min(F.struct(*rest)).alias("leg"))
    return one.select("leg_id", "leg.*").select(*trips.columns)


def written_legs(trips: DataFrame) -> DataFrame:
    """``distinct_legs`` of joined trips, written once.

    Equal rows are told apart where the trips lie after the join with their
    places, without another shuffle.  Only ids that are left with several rows
    are grouped; that there are any is seen from hashes of the ids."""
    return legs_once(materialize(trips.distinct()))


def _repeated(rows: DataFrame) -> DataFrame:
    """Hashes of the leg ids that come more than once, written."""
    return materialize(rows.groupBy(F.xxhash64("leg_id").alias("_h")).count().filter("count > 1").select("_h"))


def legs_repeat(rows: DataFrame) -> bool:
    """Some rows may share a leg id (by its hash)."""
    return not _repeated(rows).isEmpty()


def legs_once(rows: DataFrame) -> DataFrame:
    """``distinct_legs`` that deals and sorts only the rows whose id comes more
    than once; the others stay where they are.  Ids are counted by hashes."""
    again = _repeated(rows)
    if again.isEmpty():
        return rows
    hashed = rows.withColumn("_h", F.xxhash64("leg_id"))
    return (hashed.join(again, "_h", "left_anti").select(*rows.columns)
            .unionByName(distinct_legs(hashed.join(again, "_h", "left_semi").select(*rows.columns))))


def places_repeat(places: DataFrame) -> bool:
    """Some place id comes more than once, so a trip may meet several rows."""
    return not places.groupBy("place_id").count().filter("count > 1").isEmpty()


def city_trips(trips: DataFrame, places: DataFrame) -> DataFrame:
    """Trips with the city and name of both end places, same provider only
    (F10).  The optimizer broadcasts the places while they are small;
    otherwise both joins shuffle on the place id."""
    p = places.select("place_id", "place_name", "provider", "city_id")
    po = p.select(F.col("place_id").alias("origin_place_id"), F.col("place_name").alias("o_name"),
                  F.col("provider").alias("o_provider"), F.col("city_id").alias("o_city"))
    pd = p.select(F.col("place_id").alias("dest_place_id"), F.col("place_name").alias("d_name"),
                  F.col("provider").alias("d_provider"), F.col("city_id").alias("d_city"))
    return (trips.join(po, "origin_place_id").join(pd, "dest_place_id")
            .filter(F.col("o_provider") == F.col("d_provider"))
            .drop("o_provider", "d_provider"))


# --- graphs: what a request searches, shared by all requests that search the same ---

def request_graphs(plan: DataFrame, pair_stops: DataFrame) -> DataFrame:
    """``request_id, graph_id, o_city, d_city, departure_date, vias`` of every
    answerable request.  A graph is an origin city, a destination city, a
    day and a set of stop cities (at most twice the city limit); its id is
    their text, so requests that search the same share one graph."""
    vias = pair_stops.groupBy(*PAIR_KEY).agg(F.array_sort(F.collect_set("via")).alias("vias"))
    ok = plan.filter(F.col("status") == STATUS_OK).select("request_id", "o_city", "d_city", "departure_date", *PAIR_KEY)
    j = ok.join(vias, PAIR_KEY, "left").withColumn("vias", F.coalesce("vias", F.array().cast("array<int>")))
    graph_id = F.concat_ws("|", F.col("o_city").cast("string"), F.col("d_city").cast("string"),
                           F.col("departure_date").cast("string"),
                           F.array_join(F.transform("vias", lambda x: x.cast("string")), ","))
    return j.select("request_id", graph_id.alias("graph_id"), "o_city", "d_city", "departure_date", "vias")


def distinct_graphs(graph_of: DataFrame) -> DataFrame:
    """``graph_id, o_city, d_city, departure_date, vias``, one row a graph."""
    return graph_of.drop("request_id").distinct()


def leg_city_pairs(graphs: DataFrame) -> DataFrame:
    """City pairs to search per graph: origin->destination, origin->stop
    and stop->destination (no stop->stop), distinct."""
    pair = F.array(F.struct(F.col("o_city").alias("from_city"), F.col("d_city").alias("to_city")))
    out = F.transform("vias", lambda v: F.struct(F.col("o_city").alias("from_city"), v.alias("to_city")))
    back = F.transform("vias", lambda v: F.struct(v.alias("from_city"), F.col("d_city").alias("to_city")))
    pairs = F.array_distinct(F.concat(pair, out, back))
    return graphs.select("graph_id", "departure_date", F.explode(pairs).alias("p")).select(
        "graph_id", "p.from_city", "p.to_city", "departure_date")


def place_pairs(pairs: DataFrame, ctrips: DataFrame) -> DataFrame:
    """T1, re-aimed: the (source place, target place) pairs of the searched
    city pairs that some trip connects, same provider.  The reference asks
    the services about every place pair of a city pair; building that
    product would grow with the square of a city's places, so only pairs
    that trips actually connect are listed (the others return nothing)."""
    p = pairs.select("from_city", "to_city").distinct()
    t = ctrips.select(F.col("o_city").alias("from_city"), F.col("d_city").alias("to_city"), "provider",
                      F.col("origin_place_id").alias("src_place_id"),
                      F.col("dest_place_id").alias("dst_place_id"))
    return t.join(p, ["from_city", "to_city"], "left_semi").distinct()


# what is read of a leg; of rows with one id the least by these is kept
LEG_FIELDS = ["leg_id", "dest_place_id", "origin_place_id", "provider", "departure_date", "price", "duration_h",
              "o_name", "o_city", "d_name", "d_city"]


def shared_legs(pairs: DataFrame, ctrips: DataFrame) -> DataFrame:
    """T2 + U4 before any graph: the distinct trips between the city pairs and
    on the days that some graph searches, one row a leg, written once.  The
    trips are cut to these pairs first (few, as bounded by cities and days),
    so only what is searched is told apart."""
    need = materialize(pairs.select(F.col("from_city").alias("o_city"), F.col("to_city").alias("d_city"), "departure_date").distinct())
    return written_legs(ctrips.select(*LEG_FIELDS).join(need, ["o_city", "d_city", "departure_date"], "left_semi").select(*LEG_FIELDS))


def graph_legs(pairs: DataFrame, ctrips: DataFrame) -> DataFrame:
    """T2 + U4: the legs of each graph, i.e. the shared legs between the
    places of each of its city pairs on its day."""
    pairs = materialize(pairs)
    return graph_legs_of(pairs, shared_legs(pairs, ctrips))


def graph_legs_of(pairs: DataFrame, legs: DataFrame) -> DataFrame:
    """The legs of each graph from ``shared_legs``."""
    t = legs.withColumnRenamed("o_city", "from_city").withColumnRenamed("d_city", "to_city")
    return (pairs.join(t, ["from_city", "to_city", "departure_date"])
            .withColumnRenamed("from_city", "o_city").withColumnRenamed("to_city", "d_city"))


def searched_legs(pairs: DataFrame, trips: DataFrame, places: DataFrame) -> DataFrame:
    """The legs of ``graph_legs`` over ``city_trips(trips, places)``:
    ``graph_id, leg_id, o_city, d_city, price, duration_h``.

    Trips meet their places without the places' names, which only choose
    between rows of one leg where a place id repeats.  A leg takes the list
    of its graphs, so however the join is made, its rows come one after the
    other and take little room when they are written."""
    key = ["o_city", "d_city", "departure_date"]
    graphs = materialize(pairs.withColumnsRenamed({"from_city": "o_city", "to_city": "d_city"})
                         .groupBy(*key).agg(F.collect_list("graph_id").alias("graph_ids")))
    named = places_repeat(places)

    def ends(side: str) -> DataFrame:
        name = F.col("place_name") if named else F.lit(None).cast("string")
        return places.select(F.col("place_id").alias("origin_place_id" if side == "o" else "dest_place_id"), name.alias(f"{side}_name"),
                             F.col("provider").alias("_provider" if side == "o" else "_d_provider"), F.col("city_id").alias(f"{side}_city"))
    slim = trips.select("leg_id", "dest_place_id", "origin_place_id", "provider", "departure_date", "price", "duration_h")
    # the place's provider (F10) stays: it tells how the rows are dealt, so equal ones are found there
    met = (slim.join(ends("o"), "origin_place_id").join(ends("d"), "dest_place_id")
           .filter(F.col("_provider") == F.col("_d_provider")))
    legs = written_legs(met.join(graphs.select(*key), key, "left_semi").select(*LEG_FIELDS, "_provider"))
    return legs.select("leg_id", *key, "price", "duration_h").join(graphs, key).select(
        F.explode("graph_ids").alias("graph_id"), "leg_id", "o_city", "d_city", "price", "duration_h")
