import random

import pytest
from pyspark.sql import functions as F

from routeweave.operators.routes import enumerate_routes, top_routes
from routeweave.plans.search import search, top_route_rows
from routeweave.sources import fixtures
from tests.conftest import SF0001

LEG_SCHEMA = ("request_id BIGINT, leg_id STRING, origin_place_id STRING, o_name STRING, o_city INT, "
              "dest_place_id STRING, d_name STRING, d_city INT, provider STRING, price DOUBLE, duration_h DOUBLE")


def _random_graphs(seed, n_req=6, n_cities=5, places_per_city=2, n_legs=30):
    rnd = random.Random(seed)
    legs, plan = [], []
    for req in range(n_req):
        city_of = {f"p{c}_{k}": c for c in range(n_cities) for k in range(places_per_city)}
        pl = list(city_of)
        o, d = rnd.randrange(n_cities), rnd.randrange(n_cities)
        plan.append((req, o, d))
        for i in range(n_legs):
            a, b = rnd.choice(pl), rnd.choice(pl)
            legs.append((req, f"L{req}-{i}", a, a.upper(), city_of[a], b, b.upper(), city_of[b],
                         rnd.choice(["FLIGHT", "BUS"]), float(rnd.randrange(1, 50)), float(rnd.randrange(0, 5))))
    return legs, plan


def _brute(legs, plan):
    out = set()
    for req, o, d in plan:
        mine = [x for x in legs if x[0] == req]

        def dfs(route, visited, start):
            last = route[-1]
            if last[7] == d:
                out.add((req, ">".join(x[1] for x in route), len(route), sum(x[9] for x in route), float(sum(x[10] for x in route)),
                         all(x[8] == "FLIGHT" for x in route)))
                return
            for nxt in mine:
                if nxt[2] == last[5] and (nxt[5] not in visited or (nxt[5] == start and nxt[7] == d)):
                    dfs(route + [nxt], visited | {nxt[5]}, start)
        for first in mine:
            if first[4] == o:
                dfs([first], {first[2], first[5]}, first[2])
    return out


def test_enumerate_matches_brute_force(spark):
    legs, plan = _random_graphs(1)
    more, plan2 = _random_graphs(2, n_req=3, n_legs=22)
    legs += [(x[0] + 100, *x[1:]) for x in more]
    plan += [(x[0] + 100, *x[1:]) for x in plan2]
    ldf = spark.createDataFrame(legs, LEG_SCHEMA)
    pdf = spark.createDataFrame(plan, "request_id BIGINT, o_city INT, d_city INT")
    want = _brute(legs, plan)
    assert max(x[2] for x in want) > 4

    def found(**kw):
        return {(r.request_id, r.route_id, r.n_legs, r.total_price, r.total_time)
                for r in enumerate_routes(ldf, pdf, key="request_id", **kw).collect()}
    assert found() == {x[:5] for x in want}
    assert found(max_legs=3, max_legs_flight=2) == {x[:5] for x in want if x[2] <= (2 if x[5] else 3)}


def test_long_chains_in_any_order_of_providers(spark):
    def chain(req, providers):
        return [(req, f"{req}-{i}", f"p{i}", "x", 10 + i, f"p{i + 1}", "y", 11 + i, v, 1.25, 1.0) for i, v in enumerate(providers)]
    chains = {1: ["BUS"] * 8, 2: ["FLIGHT"] * 5 + ["BUS"], 3: ["BUS"] + ["FLIGHT"] * 5, 4: ["FLIGHT"] * 7}
    legs = [leg for req, v in chains.items() for leg in chain(req, v)]
    ldf = spark.createDataFrame(legs, LEG_SCHEMA)
    pdf = spark.createDataFrame([(req, 10, 10 + len(v)) for req, v in chains.items()], "request_id BIGINT, o_city INT, d_city INT")
    got = {r.request_id: (r.n_legs, r.total_price) for r in enumerate_routes(ldf, pdf, key="request_id").collect()}
    assert got == {req: (len(v), 1.25 * len(v)) for req, v in chains.items()}
    capped = {r.request_id for r in enumerate_routes(ldf, pdf, max_legs=6, max_legs_flight=4, key="request_id").collect()}
    assert capped == {2, 3}


def test_route_properties_on_fixture(spark):
    res = search(fixtures.requests(spark, SF0001), fixtures.catalogue(spark, SF0001))
    rows = res.top.join(res.plan.select("request_id", "o_city", "d_city"), "request_id").collect()
    assert rows
    for r in rows:
        it = r.itinerary
        assert 1 <= len(it) <= 2 and r.rank <= 5
        assert sum(x.price for x in it) == r.total_price
        assert sum(x.duration_h for x in it) == r.total_time
        for a, b in zip(it, it[1:]):
            assert a.dest_place_id == b.origin_place_id


def test_shared_search_equals_general_enumeration(spark):
    from routeweave.operators.legs import city_trips, distinct_graphs, graph_legs, leg_city_pairs, request_graphs
    from routeweave.operators.routes import filter_price_range, filter_time_range
    from routeweave.plans.search import plan_requests_full
    cat = fixtures.catalogue(spark, SF0001)
    for ranges, n in (("", 2178), ("array(request_id % 100 / 3, 40 + request_id % 170)", None)):
        req = fixtures.requests(spark, SF0001)
        if ranges:
            req = req.withColumn("price_range", F.expr(ranges).cast("array<double>"))
        plan, _, _, pair_stops = plan_requests_full(req, cat.cities)
        graph_of = request_graphs(plan, pair_stops)
        graphs = distinct_graphs(graph_of)
        r = enumerate_routes(graph_legs(leg_city_pairs(graphs), city_trips(cat.trips, cat.places)), graphs)
        r = r.join(graph_of.select("request_id", "graph_id"), "graph_id").join(
            req.select("request_id", "price_range", "time_range"), "request_id")
        general = {(x.request_id, x.rank, x.route_id) for x in top_routes(filter_time_range(filter_price_range(r)), 5).collect()}
        shared = {(x.request_id, x.rank, x.route_id) for x in top_route_rows(search(req, cat)).collect()}
        assert general == shared and (n is None or len(shared) == n)


def test_published_fixture_numbers(spark):
    """The fixture numbers published for the request sample of every 50th
    event (sf0.001): 47 top rows, 18 with two legs, 13 requests answered,
    prices summing to 6905.55 and hours to 130."""
    req = fixtures.requests(spark, SF0001).filter(F.col("request_id") % 50 == 0)
    rows = top_route_rows(search(req, fixtures.catalogue(spark, SF0001))).collect()
    assert len(rows) == 47
    assert sum(1 for r in rows if r.n_legs == 2) == 18
    assert len({r.request_id for r in rows}) == 13
    assert round(sum(r.total_price for r in rows), 2) == 6905.55
    assert sum(r.total_time for r in rows) == 130.0


def _search_small(spark, legs, bounds, n=5, connect_on="place"):
    from routeweave.operators.routes import shared_top_routes
    seg = spark.createDataFrame([(i, 0, 1, 2, "2024-01-01", *b) for i, b in enumerate(bounds)],
                                "request_id BIGINT, o_city INT, via INT, d_city INT, d STRING, p_lo DOUBLE, p_hi DOUBLE, "
                                "t_lo DOUBLE, t_hi DOUBLE").withColumn("departure_date", F.to_date("d")).drop("d")
    ldf = spark.createDataFrame(legs, "leg_id STRING, origin_place_id STRING, o_name STRING, o_city INT, dest_place_id STRING, "
                                "d_name STRING, d_city INT, provider STRING, d STRING, price DOUBLE, duration_h DOUBLE") \
        .withColumn("departure_date", F.to_date("d")).drop("d")
    got = {}
    for r in shared_top_routes(seg, ldf, n, connect_on).collect():
        got.setdefault(r.request_id, []).append((r.rank, r.route_id, r.total_price, r.total_time, len(r.itinerary)))
    return {k: [x[1:4] for x in sorted(v)] for k, v in got.items()}


INF = float("inf")


def test_ranges_on_raw_totals_and_negative_legs(spark):
    legs = [("a", "p", "P", 0, "q", "Q", 1, "BUS", "2024-01-01", 15.0, 1.0),
            ("b", "q", "Q", 1, "r", "R", 2, "BUS", "2024-01-01", -8.0, 1.0),     # a refund leg
            ("c", "p", "P", 0, "s", "S", 1, "BUS", "2024-01-01", 4.0, 1.0),
            ("d", "s", "S", 1, "r", "R", 2, "BUS", "2024-01-01", 96.004, 1.0)]
    got = _search_small(spark, legs, [(-INF, 10.0, -INF, INF), (-INF, 100.0, -INF, INF), (-INF, INF, -INF, INF)])
    assert got == {0: [("a>b", 7.0, 2.0)], 1: [("a>b", 7.0, 2.0)], 2: [("a>b", 7.0, 2.0), ("c>d", 100.004, 2.0)]}


def test_repeated_legs_give_each_route_once(spark):
    leg = ("a", "p", "P", 0, "q", "Q", 1, "BUS", "2024-01-01", 15.0, 1.0)
    back = ("b", "q", "Q", 1, "r", "R", 2, "BUS", "2024-01-01", 5.0, 1.0)
    got = _search_small(spark, [leg] * 3 + [back] * 3, [(-INF, INF, -INF, INF), (0.0, 30.0, 0.0, 5.0)])
    assert got == {0: [("a>b", 20.0, 2.0)], 1: [("a>b", 20.0, 2.0)]}


@pytest.mark.parametrize("connect_on", ["place", "city"])
def test_cells_and_best_pairs_against_brute_force(spark, connect_on):
    rnd = random.Random(5)
    legs = []
    for i in range(60):
        legs.append((f"{i}", "p", "P", 0, f"m{i % 4}", "M", 1, "BUS", "2024-01-01", rnd.choice([-5.0, 0.0, 12.5, rnd.random() * 90]), float(rnd.randrange(4))))
        legs.append((f"{i}-", f"m{i % 4}", "M", 1, "r", "R", 2, "BUS", "2024-01-01", rnd.choice([0.0, 12.5, rnd.random() * 90]), float(rnd.randrange(4))))
    bounds = [(-INF, INF, -INF, INF), (25.0, 25.0, -INF, INF), (-INF, INF, 2.0, 3.0)]
    bounds += [tuple(sorted((rnd.random() * 160, rnd.random() * 160))) + tuple(sorted((float(rnd.randrange(7)), float(rnd.randrange(7))))) for _ in range(25)]
    # bounds that are totals of routes, and on the edges of the price steps
    pairs = [(x[9] + y[9], -(x[10] + y[10]), f"{x[0]}>{y[0]}") for x in legs if x[3] == 0
             for y in legs if y[3] == 1 and (connect_on == "city" or x[4] == y[1])]
    for lo in [-10.0, 0.0, 50.0, 75.0, 100.0] + [rnd.choice(pairs)[0] for _ in range(8)]:
        bounds.append((lo, lo + rnd.choice([0.0, 1.0, 60.0]), *rnd.choice([(-INF, INF), (1.0, 4.0)])))
    got = _search_small(spark, legs, bounds, connect_on=connect_on)
    for i, (p_lo, p_hi, t_lo, t_hi) in enumerate(bounds):
        want = sorted(x for x in pairs if p_lo <= x[0] <= p_hi and t_lo <= -x[1] <= t_hi)[:5]
        assert got.get(i, []) == [(r, p, -t) for p, t, r in want], i


def test_hub_city_is_paired_by_summaries(spark):
    """Arrivals and departures of a hub meet as best lists, not as legs."""
    from routeweave.operators import clusters
    rows = [(f"{i}", 0, 1, float(i % 97) / 3, float(i % 3)) for i in range(3000)] + [(f"{i}-", 1, 2, float(i % 89) / 3, float(i % 2)) for i in range(3000)]
    legs = spark.createDataFrame(rows, "leg_id STRING, o_city INT, d_city INT, price DOUBLE, duration_h DOUBLE").withColumn("departure_date", F.to_date(F.lit("2024-01-01")))
    families = spark.createDataFrame([(0, 1, 2)], "o_city INT, via INT, d_city INT").withColumn("departure_date", F.to_date(F.lit("2024-01-01")))
    made = clusters.diagonals(families, legs, 5)
    assert made.count() <= 5 * 4 * 4        # travel times and diagonals
    a = clusters.best_rows(clusters._slim(legs), [*clusters.SIDE, "duration_h", "cell"], clusters._arrival_order(), 5)
    assert a.count() <= 5 * (3 * 2 + 2 * 2)
