"""Routes: enumeration, range filters, order and top-N.

Totals are raw sums everywhere in this module; only outputs round them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from routeweave.functions.ranges import in_range, lower_bound, upper_bound
from routeweave.operators.legs import written_legs
from routeweave.plans.sizing import materialize

# Answers per request and texts of routes.
TOP_N = 5
ROUTE_ID_SEP = ">"
STOP_SEP = " => "
FLIGHT = "FLIGHT"


def route_order() -> list:
    """R6 sort keys (columns are built lazily: they need a live session)."""
    return [F.col("total_price").asc(), F.col("total_time").desc(), F.col("route_id").asc()]


def leg_struct(alias: str = "") -> Column:
    """One itinerary element."""
    p = f"{alias}." if alias else ""
    return F.struct(
        F.col(f"{p}leg_id").alias("leg_id"), F.col(f"{p}origin_place_id").alias("origin_place_id"),
        F.col(f"{p}o_name").alias("origin_name"), F.col(f"{p}dest_place_id").alias("dest_place_id"),
        F.col(f"{p}d_name").alias("dest_name"), F.col(f"{p}provider").alias("provider"),
        F.col(f"{p}price").alias("price"), F.col(f"{p}duration_h").alias("duration_h"))


def stops_text(itinerary: Column) -> Column:
    """First leg shows both ends, later legs only their arrival."""
    parts = F.transform(itinerary, lambda x, i: F.when(
        i == 0, F.concat(x["origin_name"], F.lit(STOP_SEP), x["dest_name"])).otherwise(x["dest_name"]))
    return F.array_join(parts, STOP_SEP)


def filter_price_range(routes: DataFrame, col: str = "price_range") -> DataFrame:
    """inclusive price range, only when the list has two numbers."""
    return routes.filter(in_range(F.col("total_price"), F.col(col)))


def filter_time_range(routes: DataFrame, col: str = "time_range") -> DataFrame:
    """F8: inclusive travel-time range, same rule."""
    return routes.filter(in_range(F.col("total_time"), F.col(col)))


def top_routes(routes: DataFrame, n: int = TOP_N, key="request_id") -> DataFrame:
    """R7 + W3: rank by R6 inside each key and keep the first ``n``."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*route_order())
    return routes.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


# --- general enumeration over arbitrary leg graphs ---------------------------------

def enumerate_routes(legs: DataFrame, plan: DataFrame, max_legs: int | None = None,
                     max_legs_flight: int | None = None, key: str = "graph_id") -> DataFrame:
    """R4 + R5 + A3 + U6: every route of each graph from a place of its
    origin city to the first place of its destination city.

    ``legs``: key, leg_id, origin_place_id, o_name, o_city, dest_place_id,
    d_name, d_city, provider, price, duration_h (distinct by leg_id).
    ``plan``: key, o_city, d_city.

    Legs that do not lead to the destination are dropped first (R2).  Routes
    are leg ids and totals (``best_routes.itineraries`` gives the legs of the
    routes that are wanted).  Open routes are extended by an equi-join with the legs on (key, last
    place).  A route never passes a place twice; only its final arrival may
    equal its start (a round trip when origin and destination city are one
    city).  That bounds the loop, which ends when no open route is left.

    V2: ``max_legs`` keeps finished routes of at most so many legs, and
    ``max_legs_flight`` all-flight ones; both are off by default.  Open routes
    that could only finish with more legs than that, by the fewest legs from
    their last place on, are not written.
    """
    from routeweave.operators.graph import hop_labels
    ends = plan.select(key, F.col("o_city").alias("_o"), F.col("d_city").alias("_target"))
    reached = hop_labels(legs, plan, key).withColumnRenamed("place_id", "dest_place_id")
    lg = materialize(legs.join(reached, [key, "dest_place_id"]).select(
        key, "leg_id", "origin_place_id", "o_city", "dest_place_id", "d_city", "price", "duration_h", (F.col("provider") == FLIGHT).alias("flight"), "hops"))
    longest = None if max_legs is None else max(max_legs, max_legs_flight or 0)
    frontier = (lg.join(ends, key).filter(F.col("o_city") == F.col("_o"))
                .select(key, "_target", F.col("origin_place_id").alias("start_place"),
                        F.col("dest_place_id").alias("last_place"), F.col("d_city").alias("last_city"),
                        F.array(F.col("origin_place_id"), F.col("dest_place_id")).alias("visited"),
                        F.array("leg_id").alias("leg_ids"), F.lit(1).alias("n_legs"),
                        F.col("price").alias("total_price"), F.col("duration_h").alias("total_time"), F.col("flight").alias("all_flight"), "hops"))
    finished, step = [], 1
    while True:
        if max_legs is not None:
            still = F.when(F.col("last_city") == F.col("_target"), 0).otherwise(F.greatest("hops", F.lit(1)))
            frontier = frontier.filter(F.col("n_legs") + still <= F.when(F.col("all_flight"), F.lit(longest)).otherwise(F.lit(max_legs)))
        frontier = materialize(frontier.drop("hops"))
        finished.append(frontier.filter(F.col("last_city") == F.col("_target")))
        open_ = frontier.filter(F.col("last_city") != F.col("_target"))
        if step == longest or open_.isEmpty():
            break
        q = F.col("l.dest_place_id")
        final_return = (q == F.col("r.start_place")) & (F.col("l.d_city") == F.col("r._target"))
        frontier = (open_.alias("r").join(lg.alias("l"), (F.col(f"r.{key}") == F.col(f"l.{key}"))
                                          & (F.col("r.last_place") == F.col("l.origin_place_id")))
                    .filter(~F.array_contains(F.col("r.visited"), q) | final_return)
                    .select(F.col(f"r.{key}").alias(key), F.col("r._target").alias("_target"),
                            F.col("r.start_place").alias("start_place"),
                            q.alias("last_place"), F.col("l.d_city").alias("last_city"),
                            F.concat(F.col("r.visited"), F.array(q)).alias("visited"),
                            F.concat(F.col("r.leg_ids"), F.array("l.leg_id")).alias("leg_ids"),
                            (F.col("r.n_legs") + 1).alias("n_legs"),
                            (F.col("r.total_price") + F.col("l.price")).alias("total_price"),
                            (F.col("r.total_time") + F.col("l.duration_h")).alias("total_time"),
                            (F.col("r.all_flight") & F.col("l.flight")).alias("all_flight"), F.col("l.hops").alias("hops")))
        step += 1
    out = finished[0]
    for f in finished[1:]:
        out = out.unionByName(f)
    if max_legs is not None:
        out = out.filter(F.col("all_flight") | (F.col("n_legs") <= max_legs))
    flight_limit = max_legs_flight if max_legs_flight is not None else max_legs
    if flight_limit is not None:
        out = out.filter(~F.col("all_flight") | (F.col("n_legs") <= flight_limit))
    return out.select(key, F.array_join("leg_ids", ROUTE_ID_SEP).alias("route_id"), "leg_ids", "n_legs", "total_price",
                      F.col("total_time").cast("double").alias("total_time"))


# --- shared search for the origin/stop/destination topology ------------------------

FAMILY = ["o_city", "via", "d_city", "departure_date"]
BOUNDS = ["p_lo", "p_hi", "t_lo", "t_hi"]
START = ["p_lo", "t_lo", "t_hi"]    # the bounds that tell where the answer of a range begins
DIRECT = -1
PRICE_CELL = 25.0
MOST_TIMES = 64     # with more distinct time bounds, each travel time is a class of its own
OPEN = (float("-inf"), float("inf"))


def request_segments(plan_ok: DataFrame, pair_stops: DataFrame) -> DataFrame:
    """One row per request and route family: the direct family
    (``via = -1``) and one per stop city, with normalised range bounds.
    ``pair_stops`` is per coordinate pair, so requests meet their stops
    without a shuffle by id."""
    cols = ["request_id", "o_city", "d_city", "departure_date", "price_range", "time_range"]
    direct = plan_ok.select(*cols, F.lit(DIRECT).alias("via"))
    pair = ["src_lat", "src_lon", "dst_lat", "dst_lon"]
    via = plan_ok.select(*cols, *pair).join(pair_stops.select(*pair, "via"), pair).select(*cols, "via")
    return direct.unionByName(via).select(
        "request_id", *FAMILY,
        lower_bound(F.col("price_range")).alias("p_lo"), upper_bound(F.col("price_range")).alias("p_hi"),
        lower_bound(F.col("time_range")).alias("t_lo"), upper_bound(F.col("time_range")).alias("t_hi"))


def family_legs(families: DataFrame, ctrips: DataFrame) -> DataFrame:
    """The distinct trips that any family needs, written once.

    (city, city, day) triples are bounded by the catalogue, not by the
    number of requests; AQE broadcasts that side from its measured size."""
    direct, via = families.filter(F.col("via") == DIRECT), families.filter(F.col("via") != DIRECT)
    need = (direct.select(F.col("o_city").alias("a"), F.col("d_city").alias("b"), "departure_date")
            .unionByName(via.select(F.col("o_city").alias("a"), F.col("via").alias("b"), "departure_date"))
            .unionByName(via.select(F.col("via").alias("a"), F.col("d_city").alias("b"), "departure_date"))
            .distinct().withColumnRenamed("departure_date", "day"))
    need = materialize(need)    # small: its size on disk lets the join broadcast it
    legs = ctrips.join(need, (ctrips.o_city == F.col("a")) & (ctrips.d_city == F.col("b"))
                       & (ctrips.departure_date == F.col("day")), "left_semi")
    return written_legs(legs.select(
        "leg_id", "origin_place_id", "o_name", "o_city", "dest_place_id", "d_name", "d_city", "provider",
        "departure_date", "price", "duration_h"))


def best_rows(rows: DataFrame, keys: list[str], order: list, n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each key; ``rank`` names a column to keep."""
    w = Window.partitionBy(*keys).orderBy(*order)
    best = rows.withColumn(rank or "_rank", F.row_number().over(w)).filter(F.col(rank or "_rank") <= n)
    return best if rank else best.drop("_rank")


def family_routes(families: DataFrame, legs: DataFrame, best: int | None = None) -> DataFrame:
    """The routes of each family as ids and totals (no itinerary).

    Direct family: one leg origin city -> destination city.  Stop family:
    a leg origin -> stop joined on the arrival place with a leg stop ->
    destination (U3 has no stop->stop legs, so routes have 1 or 2 legs and
    the first arrival in the destination city ends them, R5).

    ``best``: for families that are searched without ranges, only the best
    ``best`` arrivals of a stop place are joined with only its best
    departures: any other pair has ``best`` pairs before it in R6's order,
    whatever the signs of prices and hours.
    """
    slim = legs.select("leg_id", "origin_place_id", "o_city", "dest_place_id", "d_city", "departure_date",
                       "price", "duration_h")
    direct = (slim.join(families.filter(F.col("via") == DIRECT), ["o_city", "d_city", "departure_date"])
              .select(*FAMILY, F.col("leg_id").alias("a_id"), F.lit(None).cast("string").alias("b_id"),
                      F.col("leg_id").alias("route_id"), F.col("price").alias("total_price"),
                      F.col("duration_h").alias("total_time")))
    # legs of stop families meet at their place and day first and take their
    # families last: those are few, while each leg lies in many of them
    stops = families.filter(F.col("via") != DIRECT)
    first = (slim.join(stops.select("o_city", F.col("via").alias("d_city"), "departure_date").distinct(), ["o_city", "d_city", "departure_date"], "left_semi")
             .select("o_city", F.col("d_city").alias("via"), "departure_date", F.col("dest_place_id").alias("mid_place"),
                     F.col("leg_id").alias("a_id"), F.col("price").alias("a_price"), F.col("duration_h").alias("a_time")))
    b = (slim.join(stops.select("d_city", "departure_date").distinct(), ["d_city", "departure_date"], "left_semi")
         .select(F.col("origin_place_id").alias("mid_place"), "d_city", "departure_date",
                 F.col("leg_id").alias("b_id"), F.col("price").alias("b_price"), F.col("duration_h").alias("b_time")))
    if best is not None:
        # ids end in the separator here, as they do inside a route id
        first = best_rows(first, ["o_city", "via", "departure_date", "mid_place"], [F.col("a_price"), F.col("a_time").desc(),
                                                                             F.concat("a_id", F.lit(ROUTE_ID_SEP))], best)
        b = best_rows(b, ["mid_place", "d_city", "departure_date"], [F.col("b_price"), F.col("b_time").desc(), F.col("b_id")], best)
    two = first.join(b, ["mid_place", "departure_date"]).join(stops, FAMILY).select(
        *FAMILY, "a_id", "b_id", F.concat("a_id", F.lit(ROUTE_ID_SEP), "b_id").alias("route_id"),
        (F.col("a_price") + F.col("b_price")).alias("total_price"), (F.col("a_time") + F.col("b_time")).alias("total_time"))
    return direct.unionByName(two)


def graph_routes(graphs: DataFrame, ctrips: DataFrame, named: bool = True) -> DataFrame:
    """R4 + R5 + A3 + U6 on the graphs of U3: ``graph_id, route_id, n_legs,
    total_price, total_time``.

    In these graphs a route goes directly or over one stop city, so it belongs
    to a family, which many graphs share.  Each leg is read once, each family's
    routes are built once, as ids and totals, and graphs take the routes of
    their families.  (``enumerate_routes`` is for graphs of any other form.)

    ``named``: names of places may choose between rows of one leg (a place id
    repeats); otherwise they are not read."""
    vias = F.concat(F.array(F.lit(DIRECT)), F.col("vias").cast("array<int>"))
    # small: its size on disk lets the last join leave the routes where they are
    of = materialize(graphs.select("graph_id", "o_city", "d_city", "departure_date", F.explode(vias).alias("via")))
    if not named:
        ctrips = ctrips.withColumns({c: F.lit(None).cast("string") for c in ("o_name", "d_name")})
    families = materialize(of.select(*FAMILY).distinct())
    routes = family_routes(families, family_legs(families, ctrips))
    return of.join(routes, FAMILY).select(
        "graph_id", "route_id", F.when(F.col("b_id").isNull(), F.lit(1)).otherwise(F.lit(2)).alias("n_legs"), "total_price",
        F.col("total_time").cast("double").alias("total_time"))


def price_cell(price: Column) -> Column:
    return F.floor(price / PRICE_CELL).cast("double")


def time_class(starts: DataFrame) -> Column:
    """Travel times that no time bound tells apart are one class."""
    found = starts.select(F.explode(F.array("t_lo", "t_hi")).alias("t")).distinct().limit(MOST_TIMES + 1).collect()
    points = sorted(r.t for r in found if r.t is not None and r.t not in OPEN and r.t == r.t)
    if len(found) > MOST_TIMES:
        return F.col("total_time")
    code = F.lit(0.0)
    for p in points:
        code = code + F.when(F.col("total_time") > p, 2.0).when(F.col("total_time") == p, 1.0).otherwise(0.0)
    return code


def slot_routes(starts: DataFrame, routes: DataFrame, n: int) -> DataFrame:
    """The ``n`` best routes of every family, time class and slot: the prices
    of a price cell from one of the family's lower bounds (``mark``) up to the
    next, so that a bound cuts no slot.

    Bounds and routes meet in one order by price, so each is read once."""
    none = [F.lit(None).cast(t).alias(c) for c, t in (("a_id", "string"), ("b_id", "string"), ("route_id", "string"))]
    marks = starts.filter(F.col("p_lo") != OPEN[0]).select(*FAMILY, "p_lo").distinct().select(
        *FAMILY, *none, F.col("p_lo").alias("total_price"), F.lit(None).cast("double").alias("total_time"),
        price_cell(F.col("p_lo")).alias("cell"), F.lit(None).cast("double").alias("t_class"), F.col("p_lo").alias("mark"), F.lit(True).alias("bound"))
    rows = routes.select(*FAMILY, "a_id", "b_id", "route_id", "total_price", F.col("total_time").cast("double").alias("total_time"),
                         price_cell(F.col("total_price")).alias("cell"), time_class(starts).cast("double").alias("t_class"),
                         F.lit(None).cast("double").alias("mark"), F.lit(False).alias("bound"))
    so_far = (Window.partitionBy(*FAMILY, "cell").orderBy(F.col("total_price"), F.col("bound").desc())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    slots = rows.unionByName(marks).withColumn("mark", F.last("mark", ignorenulls=True).over(so_far)).filter("NOT bound").drop("bound")
    return top_routes(slots, n, [*FAMILY, "cell", "mark", "t_class"]).drop("rank")


def start_routes(starts: DataFrame, slots: DataFrame, n: int) -> DataFrame:
    """The ``n`` best routes of each family from each lower price bound on and
    within each time range: FAMILY, START and the route.

    Slots follow each other by price, and each holds a route: the best from a
    slot on are among those of ``n`` slots.  A bound takes the next slot of
    each time class, whatever the number of slots above."""
    route = F.struct("total_price", (-F.col("total_time")).alias("_back"), "route_id", "total_time", "a_id", "b_id")
    by = [*FAMILY, "t_class"]
    told = slots.filter("total_price IS NOT NULL AND NOT isnan(total_price) AND total_time IS NOT NULL AND NOT isnan(total_time)")
    lists = told.groupBy(*by, "cell", "mark").agg(F.array_sort(F.collect_list(route)).alias("routes"))
    on = Window.partitionBy(*by).orderBy(F.col("cell"), F.col("mark").asc_nulls_first()).rowsBetween(0, n - 1)
    lists = lists.select(*by, "cell", "mark", F.slice(F.flatten(F.collect_list("routes").over(on)), 1, n).alias("routes"))
    # any travel time of a class tells whether a range has the whole class
    classes = told.groupBy(*by).agg(F.min("total_time").alias("_t"))
    asked = (starts.join(classes, FAMILY).filter(F.col("_t").between(F.col("t_lo"), F.col("t_hi")))
             .select(*by, *START, price_cell(F.col("p_lo")).alias("cell"), F.col("p_lo").alias("mark"), F.lit(True).alias("ask")))
    rows = asked.unionByName(lists.withColumn("ask", F.lit(False)), allowMissingColumns=True)
    above = (Window.partitionBy(*by).orderBy(F.col("cell").desc(), F.col("mark").desc_nulls_last(), F.col("ask"))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = rows.withColumn("routes", F.last("routes", ignorenulls=True).over(above)).filter("ask AND routes IS NOT NULL")
    best = met.groupBy(*FAMILY, *START).agg(F.slice(F.array_sort(F.flatten(F.collect_list("routes"))), 1, n).alias("routes"))
    return best.select(*FAMILY, *START, F.explode("routes").alias("r")).select(*FAMILY, *START, "r.a_id", "r.b_id", "r.route_id", "r.total_price", "r.total_time")


def shared_top_routes(segments: DataFrame, ctrips: DataFrame, n: int = TOP_N, connect_on: str = "place") -> DataFrame:
    """Top ``n`` routes per request, sharing the work between requests.
    ``connect_on``: legs meet at one place, or anywhere in one "city" (V3).

    1. Families searched only without ranges keep their ``n`` best routes.
    2. The others are searched from lower price bounds on (``start_routes``):
       once for all ranges that differ in their upper bound only, as that
       just ends their order.
    3. A request unions the answers of its families and keeps the ``n``
       best; itineraries are built for these from their leg ids.
    Exact: the best ``n`` of a union are among the best ``n`` of each part,
    and families of one request share no route.
    """
    is_open = (F.col("p_lo") == OPEN[0]) & (F.col("p_hi") == OPEN[1]) & (F.col("t_lo") == OPEN[0]) & (F.col("t_hi") == OPEN[1])
    segments = segments.withColumn("open", is_open)
    keys = materialize(segments.select(*FAMILY, *START, "open").distinct())
    legs = family_legs(keys.select(*FAMILY).distinct(), ctrips)

    open_keys, ranged = keys.filter("open"), keys.filter("NOT open AND NOT isnan(p_lo)")
    in_ranges = materialize(ranged.select(*FAMILY).distinct())
    at_cities = None
    if connect_on == "city":
        from routeweave.operators import clusters
        at_cities = open_keys.join(clusters.open_routes(open_keys, legs, n), FAMILY).unionByName(
            ranged.join(clusters.ranged_routes(ranged.withColumn("p_hi", F.lit(OPEN[1])).drop("open"), legs, n).drop("p_hi"), [*FAMILY, *START]))
        open_keys, ranged, in_ranges = (x.filter(F.col("via") == DIRECT) for x in (open_keys, ranged, in_ranges))
    alone = materialize(open_keys.join(in_ranges, FAMILY, "left_anti"))
    whole = top_routes(family_routes(alone.select(*FAMILY), legs, best=n), n, FAMILY).drop("rank")

    # the routes of families with ranges are built anyway: the best of their slots hold their best
    slots = materialize(slot_routes(ranged, family_routes(in_ranges, legs), n))
    rest = top_routes(slots.drop("cell", "mark", "t_class"), n, FAMILY).drop("rank")
    found = ranged.join(start_routes(ranged, slots, n), [*FAMILY, *START])
    answers = open_keys.join(whole.unionByName(rest), FAMILY).unionByName(found)
    answers = materialize(answers if at_cities is None else answers.unionByName(at_cities))

    inside = segments.join(answers, [*FAMILY, *START, "open"]).filter(F.col("open") | (F.col("total_price") <= F.col("p_hi")))
    best = top_routes(inside, n, "request_id").select(
        "request_id", "rank", "route_id", "a_id", "b_id", "total_price", "total_time")
    # legs of the winners only: each is told by its id
    leg = legs.select("leg_id", leg_struct().alias("leg"))
    a = leg.select(F.col("leg_id").alias("a_id"), F.col("leg").alias("a_leg"))
    b = leg.select(F.col("leg_id").alias("b_id"), F.col("leg").alias("b_leg"))
    built = answers.select("route_id", "a_id", "b_id").distinct().join(a, "a_id").join(b, "b_id", "left").select(
        "route_id", F.array_compact(F.array("a_leg", "b_leg")).alias("itinerary"))
    return (best.join(built, "route_id")
            .select("request_id", "rank", "route_id", F.size("itinerary").alias("n_legs"), "itinerary",
                    "total_price", "total_time"))
