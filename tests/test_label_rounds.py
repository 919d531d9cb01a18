"""Rounds and tables of the multi-leg searches."""
import os

from pyspark.sql import functions as F

from routeweave.operators.best_routes import n_best_routes
from routeweave.operators.routes import enumerate_routes
from routeweave.plans.sizing import scratch_scope
from tests.test_routes import LEG_SCHEMA, _brute, _random_graphs

PLAN = "request_id BIGINT, o_city INT, d_city INT"


def _tables(spark, root):
    path = root.removeprefix("file:")
    return [spark.read.parquet(f"{path}/{d}") for d in os.listdir(path)]


def test_open_routes_above_the_leg_limits_are_not_written(spark):
    legs, plan = _random_graphs(2)
    legs = [(*x[:8], "FLIGHT" if int(i) % 2 else "BUS", *x[9:]) if x[8] in ("BUS", "FLIGHT") else x for i, x in enumerate(legs)]
    ldf, pdf = spark.createDataFrame(legs, LEG_SCHEMA), spark.createDataFrame(plan, PLAN)
    with scratch_scope(spark) as root:
        got = {(r.request_id, r.route_id) for r in enumerate_routes(ldf, pdf, 2, 3, "request_id").collect()}
        written = [t for t in _tables(spark, root) if "n_legs" in t.columns]
        assert written
        for t in written:
            limit = F.when(F.col("all_flight"), 3).otherwise(2)
            assert t.filter((F.col("last_city") != F.col("_target")) & (F.col("n_legs") >= limit)).isEmpty()
    provider = {(x[0], x[1]): x[8] for x in legs}
    want = set()
    for req, route, n, *_ in _brute(legs, plan):
        flight = all(provider[req, i] == "FLIGHT" for i in route.split(">"))
        if len(route.split(">")) <= (3 if flight else 2):
            want.add((req, route))
    assert got == want and want


def test_labels_of_graphs_without_a_bound_take_few_rounds(spark):
    """A place's price improves with every leg more here; no bound reads it."""
    legs, last = [], 9
    for i in range(last):                                # a cheap chain, and a dear leg from each place to the end
        legs.append((1, f"c{i}", f"p{i}", "P", i + 1, f"p{i + 1}", "P", i + 2 if i + 1 < last else 99, "BUS", 1.0, 1.0))
        legs.append((1, f"d{i}", f"p{i}", "P", i + 1, f"p{last}", "P", 99, "BUS", 100.0, 1.0))
    legs.append((1, "r", "x", "X", 50, "y", "Y", 51, "BUS", -1.0, 1.0))
    ldf, pdf = spark.createDataFrame(legs, LEG_SCHEMA), spark.createDataFrame([(1, 1, 99)], PLAN)
    with scratch_scope(spark) as root:
        best = sorted((r["rank"], r.route_id, r.total_price) for r in n_best_routes(ldf, pdf, 2, "request_id").collect())
        rounds = sum("fresh" in t.columns for t in _tables(spark, root))
    assert best == [(1, ">".join(f"c{i}" for i in range(last)), 9.0), (2, "d0", 100.0)]
    assert rounds <= 3
