"""Ranges that begin at the same price share one search."""
import datetime as dt
import os
import random

from pyspark.sql import functions as F

from routeweave.operators.routes import slot_routes, start_routes
from routeweave.plans.search import search
from routeweave.plans.sizing import scratch_scope
from tests.test_shared_searches import _catalogue, _requests, _routes

DAY = dt.date(2024, 1, 1)
INF = float("inf")


def test_upper_bounds_share_a_search(spark):
    ranges = [[5.0, 20.0 + i] for i in range(30)]
    with scratch_scope(spark) as root:
        res = search(_requests(spark, range(30), ranges), _catalogue(spark))
        got, replies = _routes(res), {r.request_id: r.value for r in res.responses.collect()}
        path = root.removeprefix("file:")
        tables = [spark.read.parquet(f"{path}/{d}") for d in os.listdir(path)]
        assert max([t.count() for t in tables if "p_lo" in t.columns]) <= 10
    assert len({len(got.get(i, [])) for i in range(30)}) > 1 and len(got[29]) == 5
    for i in range(30):
        assert got.get(i, []) == got[29][:len(got.get(i, []))]
        assert replies[i].count("\tRoute ") == len(got.get(i, []))


def test_a_start_meets_a_bounded_number_of_rows(spark):
    rnd = random.Random(3)
    rows = [(0, -1, 1, DAY, f"r{i}", None, f"r{i}", float(rnd.randrange(300)) / 2, float(rnd.randrange(9))) for i in range(400)]
    routes = spark.createDataFrame(rows, "o_city INT, via INT, d_city INT, departure_date DATE, a_id STRING, b_id STRING, route_id STRING, "
                                         "total_price DOUBLE, total_time DOUBLE")
    asked = {(rnd.choice([-INF, -3.0, 25.0, 50.0, rnd.randrange(320) / 2]), *rnd.choice([(-INF, INF), (0.0, 3.0), (2.0, 5.0), (4.0, 4.0)])) for _ in range(60)}
    starts = spark.createDataFrame([(0, -1, 1, DAY, *a) for a in asked], "o_city INT, via INT, d_city INT, departure_date DATE, p_lo DOUBLE, t_lo DOUBLE, t_hi DOUBLE")
    got = {}
    for r in start_routes(starts, slot_routes(starts, routes, 5), 5).collect():
        got.setdefault((r.p_lo, r.t_lo, r.t_hi), []).append((r.total_price, -r.total_time, r.route_id))
    for p_lo, t_lo, t_hi in asked:
        want = sorted((p, -t, i) for *_, i, p, t in rows if p >= p_lo and t_lo <= t <= t_hi)[:5]
        assert sorted(got.get((p_lo, t_lo, t_hi), [])) == want


def test_a_catalogue_without_repeated_ids_is_not_grouped(spark, tmp_path, monkeypatch):
    from routeweave.operators import legs
    from routeweave.sources import catalogue as store
    from routeweave.sources.fixtures import Catalogue

    cat = _catalogue(spark)
    grouped, group = [], legs.distinct_legs
    for module in (legs, store):
        monkeypatch.setattr(module, "distinct_legs", lambda rows: grouped.append(rows.count()) or group(rows), raising=False)
    store.write_catalogue(cat, str(tmp_path / "a"))
    assert grouped == []
    one = cat.trips.limit(1).withColumn("price", F.lit(0.5))
    store.write_catalogue(Catalogue(cat.cities, cat.places, cat.trips.unionByName(one)), str(tmp_path / "b"))
    assert grouped == [2]
    got = {r.leg_id: r.price for r in store.read_city_trips(spark, str(tmp_path / "b")).collect()}
    want = {r.leg_id: r.price for r in cat.trips.collect()}
    assert got == want | {r.leg_id: 0.5 for r in one.collect()}
