import random

import pytest

from routeweave.operators.best_routes import itineraries, n_best_routes
from routeweave.operators.graph import distance_labels
from tests.test_routes import LEG_SCHEMA, _brute, _random_graphs

PLAN = "request_id BIGINT, o_city INT, d_city INT"


def _ranked(legs, plan, n, ok=lambda price, time: True):
    by = {}
    for req, route, _, price, time, _ in _brute(legs, plan):
        if ok(price, time):
            by.setdefault(req, []).append((price, -time, route))
    return {k: [(r, p, -t) for p, t, r in sorted(v)[:n]] for k, v in by.items()}


def _got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r.request_id, []).append((r.route_id, r.total_price, r.total_time))
    return out


@pytest.mark.parametrize("seed, refund", [(1, 0.0), (2, 0.0), (3, 12.0)])
def test_best_first_equals_ranking_of_all_routes(spark, monkeypatch, seed, refund):
    from routeweave.operators import best_routes
    monkeypatch.setattr(best_routes, "FIRST_WIDTH", 2)
    monkeypatch.setattr(best_routes, "WIDEST", 8)
    legs, plan = _random_graphs(seed)
    # in one graph of two some legs have a negative price
    legs = [(*x[:9], x[9] - refund * (x[0] % 2), x[10]) for x in legs]
    ldf, pdf = spark.createDataFrame(legs, LEG_SCHEMA), spark.createDataFrame(plan, PLAN)
    found = n_best_routes(ldf, pdf, 4, "request_id")
    want = _ranked(legs, plan, 4)
    assert _got(found) == want and max(len(v) for v in want.values()) == 4
    price = {x[1]: x[9] for x in legs}
    for r in itineraries(found, ldf, "request_id").collect():
        assert [x.leg_id for x in r.itinerary] == r.leg_ids and abs(sum(price[i] for i in r.leg_ids) - r.total_price) < 1e-9


def test_ranges_count_before_the_cut(spark):
    legs, plan = _random_graphs(4)
    bounds = [(*p, 40.0, 90.0, 2.0, None) for p in plan]
    pdf = spark.createDataFrame(bounds, PLAN + ", p_lo DOUBLE, p_hi DOUBLE, t_lo DOUBLE, t_hi DOUBLE")
    want = _ranked(legs, plan, 3, lambda price, time: 40 <= price <= 90 and time >= 2)
    assert _got(n_best_routes(spark.createDataFrame(legs, LEG_SCHEMA), pdf, 3, "request_id")) == want and want


def test_fewer_routes_are_opened_than_enumerated(spark):
    legs, plan = _random_graphs(12, n_req=2, n_cities=9, places_per_city=1, n_legs=40)
    plan = [(r, 0, 8) for r, _, _ in plan]
    total = 0           # open and finished routes of the whole enumeration

    def walk(req, last, city, seen, start, target):
        nonlocal total
        for x in legs:
            if x[0] == req and x[2] == last and (x[5] not in seen or (x[5] == start and x[7] == target)):
                total += 1
                if x[7] != target:
                    walk(req, x[5], x[7], seen | {x[5]}, start, target)

    for req, o, d in plan:
        walk(req, f"p{o}_0", o, {f"p{o}_0"}, f"p{o}_0", d)
    opened = []
    found = n_best_routes(spark.createDataFrame(legs, LEG_SCHEMA), spark.createDataFrame(plan, PLAN), 3, "request_id", opened)
    assert _got(found) == _ranked(legs, plan, 3) and sum(opened) < total / 3


def test_labels_against_brute_force(spark):
    legs, plan = _random_graphs(9, n_req=4, n_legs=14)
    rng = random.Random(1)
    legs = [(*x[:9], x[9] - 20 * (rng.random() < .3), x[10]) for x in legs]
    got = {(r.request_id, r.place_id): (r.hops, r.to_pay) for r in distance_labels(
        spark.createDataFrame(legs, LEG_SCHEMA), spark.createDataFrame(plan, PLAN), "request_id").collect()}
    want = {}
    for req, _, d in plan:
        mine = [(x[2], x[4], x[5], x[7], max(0.0, x[9])) for x in legs if x[0] == req]
        label = {p: (0, 0.0) for a, ac, b, bc, _ in mine for p, c in ((a, ac), (b, bc)) if c == d}
        for _ in range(20):
            for a, _, b, _, price in mine:
                if b in label:
                    h, p = label.get(a, (99, 1e9))
                    label[a] = min(h, label[b][0] + 1), min(p, label[b][1] + price)
        want |= {(req, p): v for p, v in label.items()}
    assert got == want


def test_empty_graphs(spark):
    ldf, pdf = spark.createDataFrame([], LEG_SCHEMA), spark.createDataFrame([(1, 0, 1)], PLAN)
    assert n_best_routes(ldf, pdf, 5, "request_id").collect() == []
