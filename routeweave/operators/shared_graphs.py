"""Graph views (A1, A2, A4, R2, R3, U5) of the graphs that requests search.

A leg lies in every graph that searches its city pair on its day (some 15), so
the views of ``graph`` on legs per graph shuffle each leg that often.  Here
what depends on a leg or a place is worked out once per day: the cities that
legs from a place arrive in, and those that legs to it come from.  Graphs are
city pairs, a small table; they meet legs and places in the last join, which
nothing wide follows.

In these graphs (U3) a leg goes to the destination city, or to a stop from
which legs go to the destination city only.  So a leg is kept (R2) if it
arrives in the destination city, or at a place with a leg to there.  That
holds as long as a place stands in one city.  Graphs that a place of several
cities could touch (for names: of several names too) are left to the views of
``graph``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeweave.operators import graph
from routeweave.operators.legs import graph_legs_of, leg_city_pairs, shared_legs
from routeweave.plans.sizing import materialize

PLACES_PER_TASK = 50_000    # a place meets some hundred graphs
PAIR = ["from_city", "to_city", "departure_date"]


class SharedGraphs:
    """The views of ``graphs`` (``legs.distinct_graphs``) over ``ctrips``."""

    def __init__(self, graphs: DataFrame, ctrips: DataFrame):
        self.graphs = materialize(graphs)
        pairs = leg_city_pairs(self.graphs)
        target = self.graphs.select("graph_id", F.col("d_city").alias("target"))
        self.pairs = materialize(pairs.join(target, "graph_id"))
        self.legs = shared_legs(pairs, ctrips)
        self._nodes = None

    # --- places of a day ---------------------------------------------------------

    def nodes(self) -> DataFrame:
        """``place_id, departure_date, city_id, place_name, outs, ins,
        moved, renamed``: every place of a day, the cities of its legs' other
        ends, and whether it stands in several cities or has several names."""
        if self._nodes is None:
            def end(side: str, other: str, out: bool) -> Column:
                to = F.col(f"{other}_city")
                no = F.lit(None).cast("int")
                return F.struct(F.col("origin_place_id" if side == "o" else "dest_place_id").alias("place_id"), F.col(f"{side}_city").alias("city_id"),
                                F.col(f"{side}_name").alias("place_name"), (to if out else no).alias("to"), (no if out else to).alias("from"))
            ends = self.legs.select("departure_date", F.explode(F.array(end("o", "d", True), end("d", "o", False))).alias("e")).select("departure_date", "e.*")
            name = F.struct("place_name")
            self._nodes = materialize(
                # dealt by place first: sets of cities are kept per group
                ends.repartition("place_id", "departure_date").groupBy("place_id", "departure_date").agg(
                    F.min("city_id").alias("city_id"), F.max("city_id").alias("_city"), F.min(name).alias("_n"), F.max(name).alias("_m"),
                    F.collect_set("to").alias("outs"), F.collect_set("from").alias("ins"), F.collect_set("city_id").alias("cities"))
                .select("place_id", "departure_date", "city_id", F.col("_n.place_name").alias("place_name"), "outs", "ins", "cities",
                        (F.col("city_id") != F.col("_city")).alias("moved"), (~F.col("_n").eqNullSafe(F.col("_m"))).alias("renamed")))
        return self._nodes

    def _touched(self, names: bool) -> DataFrame | None:
        """Graphs with a city of a place that the shared way cannot tell."""
        odd = self.nodes().filter("moved OR renamed" if names else "moved")
        if odd.isEmpty():
            return None
        at = odd.select("departure_date", F.explode("cities").alias("city_id")).distinct()
        return materialize(self.roles().join(at, ["departure_date", "city_id"], "left_semi").select("graph_id").distinct())

    def _both(self, shared, general, names: bool = False) -> DataFrame:
        """``shared(pairs)`` of the plain graphs and ``general(legs, plan)`` of
        the others."""
        touched = self._touched(names)
        if touched is None:
            return shared(self.pairs)
        rest = self.graphs.join(touched, "graph_id", "left_semi")
        legs = graph_legs_of(leg_city_pairs(rest), self.legs)
        found = shared(self.pairs.join(touched, "graph_id", "left_anti"))
        return found.unionByName(general(legs, rest).select(*found.columns))

    def roles(self, pairs: DataFrame | None = None) -> DataFrame:
        """The cities of each graph, with those that it searches legs to and
        from, and (``onward``) the stop and destination behind them."""
        pairs = self.pairs if pairs is None else pairs
        none = F.lit(None).cast("int")
        over = F.struct(F.col("to_city").alias("stop"), "target")
        ends = F.explode(F.array(
            F.struct(F.col("from_city").alias("city_id"), F.col("to_city").alias("to"), none.alias("from"), F.when(F.col("to_city") != F.col("target"), over).alias("over")),
            F.struct(F.col("to_city").alias("city_id"), none.alias("to"), F.col("from_city").alias("from"), F.lit(None).cast("struct<stop:int,target:int>").alias("over"))))
        return (pairs.select("graph_id", "departure_date", "target", ends.alias("e")).select("graph_id", "departure_date", "target", "e.*")
                .groupBy("graph_id", "departure_date", "target", "city_id")
                .agg(F.collect_set("to").alias("to"), F.collect_set("from").alias("from"), F.collect_set("over").alias("onward")))

    def _placed(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """Places of each graph: a place meets the graphs of its city and day."""
        tasks = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(nodes.count() / PLACES_PER_TASK))
        roles = materialize(self.roles(pairs))
        return (nodes.repartition(tasks, "place_id", "departure_date").join(roles, ["city_id", "departure_date"])
                .filter(F.arrays_overlap("outs", "to") | F.arrays_overlap("ins", "from")))

    # --- views -------------------------------------------------------------------

    def places(self) -> DataFrame:
        """A2, as ``graph.graph_places``."""
        return self._both(lambda pairs: self._placed(pairs, self.nodes()).select("graph_id", "place_id", "place_name", "city_id"),
                          lambda legs, plan: graph.graph_places(legs), names=True)

    def city_nodes(self) -> DataFrame:
        """A1, as ``graph.graph_nodes``."""
        return self._both(lambda pairs: self._placed(pairs, self.nodes()).groupBy("graph_id", "city_id").agg(F.count("place_id").alias("n_places")),
                          lambda legs, plan: graph.graph_nodes(legs))

    def _onward(self) -> DataFrame:
        """The shared legs with the cities that legs of that day lead to from
        where they arrive."""
        onward = self.nodes().select(F.col("place_id").alias("dest_place_id"), "departure_date", F.col("outs").alias("onward"))
        return self.legs.join(onward, ["dest_place_id", "departure_date"])

    def kept_legs(self) -> DataFrame:
        """R2, as ``graph.prune_unreachable``."""
        def shared(pairs):
            legs = self._onward().withColumnsRenamed({"o_city": "from_city", "d_city": "to_city"})
            return (legs.join(pairs, PAIR).filter((F.col("to_city") == F.col("target")) | F.array_contains("onward", F.col("target")))
                    .drop("onward", "target").withColumnsRenamed({"from_city": "o_city", "to_city": "d_city"}))
        return self._both(shared, graph.prune_unreachable)

    def _over(self, pairs: DataFrame) -> DataFrame:
        """Legs to a stop, once for each destination city that is reached from
        where they arrive and that some graph searches over this stop."""
        asked = materialize(pairs.filter(F.col("to_city") != F.col("target")).select(*PAIR, "target").distinct())
        legs = (self._onward().withColumnsRenamed({"o_city": "from_city", "d_city": "to_city"})
                .select("origin_place_id", *PAIR, "price", "duration_h", F.explode("onward").alias("target")))
        return legs.join(asked, [*PAIR, "target"])

    def kept_places(self) -> DataFrame:
        """R3 + U5, as ``graph.prune_nodes``: ``graph_id, city_id, place_id``."""
        def shared(pairs):
            over = self._over(pairs).select(F.col("origin_place_id").alias("place_id"), "departure_date", F.struct(F.col("to_city").alias("stop"), "target").alias("s"))
            nodes = self.nodes().select("place_id", "departure_date", "city_id", "outs", "ins").join(
                over.distinct().groupBy("place_id", "departure_date").agg(F.collect_set("s").alias("over")), ["place_id", "departure_date"], "left")
            target = F.col("target")
            leads_on = (F.col("city_id") == target) | (F.array_contains("to", target) & F.array_contains("outs", target)) | F.coalesce(F.arrays_overlap("over", "onward"), F.lit(False))
            return self._placed(pairs, materialize(nodes)).filter(leads_on).select("graph_id", "city_id", "place_id")
        return self._both(shared, lambda legs, plan: graph.prune_nodes(legs, graph.prune_unreachable(legs, plan), plan))

    def report(self) -> DataFrame:
        """A4: ``graph.graph_report`` over the kept legs of every graph."""
        return graph.graph_report(self.kept_legs(), self.graphs)
