"""The ``n`` best routes of arbitrary leg graphs, best first (R4 with R6, R7).

Enumerating all simple routes of a cyclic graph and ranking them afterwards
builds far more routes than are asked for.  Here every open route carries a
bound: its price so far and the least price still to pay from its last place
(the backward labels of R2).  Each round extends the open routes of the least
bounds of every graph, twice as many as in the round before; the others wait.
Once a graph has ``n`` finished routes, open ones whose bound is above the
price of the n-th are dropped.

No route is dropped where a leg of its graph has a negative price, as the
rest of a route could then cost less than nothing; other graphs are cut as
usual.  Routes are leg ids and totals until the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routeweave.operators.graph import distance_labels
from routeweave.operators.routes import ROUTE_ID_SEP, TOP_N, best_rows, leg_struct, route_order
from routeweave.plans.sizing import materialize

FIRST_WIDTH = 8         # open routes of a graph that the first round extends
WIDEST = 512            # more than that, and all are extended
ROUNDING = 1e-9         # sums are added in another order in a bound than in a total


def _bounded_legs(legs: DataFrame, plan: DataFrame, key: str) -> DataFrame:
    """The legs that lead to the destination, with the least price still to
    pay behind them (none where a leg of the graph is negative)."""
    refunds = legs.groupBy(key).agg(F.min("price").alias("least")).filter("least < 0").select(key, F.lit(True).alias("refunds"))
    slim = materialize(legs.select(key, "leg_id", "origin_place_id", "o_city", "dest_place_id", "d_city", "price", "duration_h")
                       .join(refunds, key, "left"))
    # where no price is asked for, labels by hops alone end in fewer rounds
    priced = slim.withColumn("price", F.when(F.col("refunds").isNull(), F.col("price")).otherwise(F.lit(0.0)))
    labels = distance_labels(priced, plan, key).select(key, F.col("place_id").alias("dest_place_id"), "to_pay")
    return materialize(slim.join(labels, [key, "dest_place_id"])
                       .withColumn("rest", F.when(F.col("refunds").isNull(), F.col("to_pay"))).drop("refunds", "to_pay"))


def _first(legs: DataFrame, plan: DataFrame, key: str) -> DataFrame:
    ends = plan.select(key, F.col("o_city").alias("_o"), F.col("d_city").alias("target"))
    return (legs.join(ends, key).filter(F.col("o_city") == F.col("_o"))
            .select(key, "target", F.col("origin_place_id").alias("start_place"), F.col("dest_place_id").alias("last_place"),
                    (F.col("d_city") == F.col("target")).alias("done"), F.array("origin_place_id", "dest_place_id").alias("visited"),
                    F.array("leg_id").alias("leg_ids"), F.col("price").alias("total_price"), F.col("duration_h").alias("total_time"),
                    (F.col("price") + F.col("rest")).alias("bound"), F.lit(True).alias("made")))


def _extended(routes: DataFrame, legs: DataFrame, key: str) -> DataFrame:
    """The routes with one leg more that pass no place twice, but for a final
    return to the start (U6)."""
    l, r = legs.alias("l"), routes.alias("r")
    to, done = F.col("l.dest_place_id"), F.col("l.d_city") == F.col("r.target")
    return (r.join(l, (F.col(f"r.{key}") == F.col(f"l.{key}")) & (F.col("r.last_place") == F.col("l.origin_place_id")))
            .filter(~F.array_contains("r.visited", to) | ((to == F.col("r.start_place")) & done))
            .select(F.col(f"r.{key}").alias(key), "r.target", "r.start_place", to.alias("last_place"), done.alias("done"),
                    F.concat("r.visited", F.array(to)).alias("visited"), F.concat("r.leg_ids", F.array("l.leg_id")).alias("leg_ids"),
                    (F.col("r.total_price") + F.col("l.price")).alias("total_price"),
                    (F.col("r.total_time") + F.col("l.duration_h")).alias("total_time"),
                    (F.col("r.total_price") + F.col("l.price") + F.col("l.rest")).alias("bound"), F.lit(True).alias("made")))


def n_best_routes(legs: DataFrame, plan: DataFrame, n: int = TOP_N, key: str = "graph_id", opened: list | None = None) -> DataFrame:
    """``key, rank, route_id, leg_ids, n_legs, total_price, total_time`` of the
    ``n`` best routes (R6's order) of every graph.

    ``legs`` and ``plan`` as for ``enumerate_routes``; the plan may also hold
    inclusive bounds ``p_lo, p_hi, t_lo, t_hi`` of the totals (F7, F8; null or
    infinite for none).  ``opened`` gets the number of routes that each round
    made."""
    legs_ = _bounded_legs(legs, plan, key)
    asked = [c for c in ("p_lo", "p_hi", "t_lo", "t_hi") if c in plan.columns]
    ranges = plan.select(key, *asked)

    def in_range(routes: DataFrame) -> DataFrame:
        for c in asked:
            total = F.col("total_price" if c[0] == "p" else "total_time")
            routes = routes.filter(F.col(c).isNull() | ((total >= F.col(c)) if c.endswith("lo") else (total <= F.col(c))))
        return routes.drop(*asked)

    pool = materialize(_first(legs_, plan, key))
    best, width = None, FIRST_WIDTH
    while True:
        if opened is not None:
            opened.append(pool.filter("made").count())
        done = pool.filter("done").select(key, F.array_join("leg_ids", ROUTE_ID_SEP).alias("route_id"), "leg_ids", "total_price", "total_time")
        done = in_range(done.join(ranges, key)) if asked else done
        best = materialize(best_rows(done if best is None else best.unionByName(done), [key], route_order(), n))
        cut = best.groupBy(key).agg(F.count("*").alias("found"), F.max("total_price").alias("worst")).filter(F.col("found") == n).select(key, "worst")
        if "p_hi" in asked:
            cut = (ranges.join(cut, key, "left").select(key, F.least("worst", "p_hi").alias("worst")).filter("worst IS NOT NULL"))
        live = (pool.filter("NOT done").join(cut, key, "left")
                .filter("bound IS NULL OR worst IS NULL OR bound <= worst + (abs(worst) + 1) * " + repr(ROUNDING)).drop("worst"))
        live = materialize(live)
        if live.isEmpty():
            break
        if width <= WIDEST:
            order = F.coalesce("bound", "total_price")
            least = best_rows(live.select(key, order.alias("at")), [key], [F.col("at")], width).groupBy(key).agg(F.max("at").alias("upto"))
            live = live.join(least, key).withColumn("now", order <= F.col("upto")).drop("upto")
            waiting = live.filter("NOT now").drop("now").withColumn("made", F.lit(False))
            pool = materialize(_extended(live.filter("now").drop("now"), legs_, key).unionByName(waiting))
            width *= 2
        else:
            pool = materialize(_extended(live, legs_, key))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*route_order())))
    return ranked.select(key, "rank", "route_id", "leg_ids", F.size("leg_ids").alias("n_legs"), "total_price", "total_time")


def itineraries(routes: DataFrame, legs: DataFrame, key: str = "graph_id") -> DataFrame:
    """``routes`` with ``itinerary``, the legs of ``leg_ids`` in order, built
    for these routes only."""
    of = legs.select(key, "leg_id", leg_struct().alias("leg"))
    built = (routes.select(key, "route_id", F.posexplode("leg_ids").alias("pos", "leg_id")).join(of, [key, "leg_id"])
             .groupBy(key, "route_id").agg(F.array_sort(F.collect_list(F.struct("pos", "leg"))).alias("x"))
             .select(key, "route_id", F.transform("x", lambda e: e["leg"]).alias("itinerary")))
    return routes.join(built, [key, "route_id"])
