import datetime as dt
import os

from routeweave.operators.render import NO_ROUTES
from routeweave.plans.search import search, top_route_rows
from routeweave.plans.sizing import scratch_scope
from routeweave.sources.fixtures import Catalogue

DAY = dt.date(2024, 1, 1)


def _catalogue(spark):
    cities = [(c, f"C{c}", "X", 45.0 + c, 5.0, 200_000 + c) for c in (0, 4)] + [(1, "C1", "X", 45.5, 5.0, 150_000)]
    places = [(f"p{c}{k}", f"P{c}{k}", "BUS", c, "x") for c in (0, 1, 4) for k in (0, 1)]
    ends = [("p00", "p40"), ("p01", "p41"), ("p00", "p10"), ("p10", "p40"), ("p01", "p11"), ("p11", "p41"), ("p10", "p41")]
    trips = [(f"L{i}-{n}", a, b, "BUS", DAY, True, 10.0 + 3 * i + n, 1.0 + i, "", "") for i, (a, b) in enumerate(ends) for n in (0, 1)]
    return Catalogue(spark.createDataFrame(cities, "city_id INT, city_name STRING, country_code STRING, lat DOUBLE, lon DOUBLE, population BIGINT"),
                     spark.createDataFrame(places, "place_id STRING, place_name STRING, provider STRING, city_id INT, place_code STRING"),
                     spark.createDataFrame(trips, "leg_id STRING, origin_place_id STRING, dest_place_id STRING, provider STRING, departure_date DATE, "
                                                  "is_direct BOOLEAN, price DOUBLE, duration_h DOUBLE, departure_dt STRING, arrival_dt STRING"))


def _requests(spark, ids, ranges=([], [0.0, 30.0])):
    rows = [(i, "7", "+45.0000,+5.0000", "+49.0000,+5.0000", DAY, ranges[(i or 0) % len(ranges)], []) for i in ids]
    return spark.createDataFrame(rows, "request_id BIGINT, user_id STRING, src STRING, dst STRING, departure_date DATE, price_range ARRAY<DOUBLE>, time_range ARRAY<DOUBLE>")


def _routes(res):
    out = {}
    for r in sorted(top_route_rows(res).collect(), key=lambda r: (str(r.request_id), r.rank)):
        out.setdefault(r.request_id, []).append(r.route_id)
    return out


def test_equal_requests_are_searched_once(spark):
    with scratch_scope(spark) as root:
        res = search(_requests(spark, range(200)), _catalogue(spark))
        got, replies = _routes(res), {r.request_id: r.value for r in res.responses.collect()}
        path = root.removeprefix("file:")
        tables = [spark.read.parquet(f"{path}/{d}") for d in os.listdir(path)]
        assert max([t.count() for t in tables if "p_lo" in t.columns]) <= 20
    assert len(got) == len(replies) == 200
    for i in range(200):
        assert got[i] == got[i % 2] and replies[i] == replies[i % 2]
    assert len(got[0]) == 5 and 0 < len(got[1]) <= 5 and all("Route 1" in v for v in replies.values())


def test_rows_of_one_request_have_n_routes_in_all(spark):
    once = _routes(search(_requests(spark, [0]), _catalogue(spark)))[0]
    res = search(_requests(spark, [0, 2, 2, None]), _catalogue(spark))
    got = _routes(res)
    assert got[0] == got[None] == once
    assert got[2] == sorted(once * 2, key=once.index)[:5]
    replies = [(r.request_id, r.value) for r in res.responses.collect()]
    assert sorted(str(i) for i, _ in replies) == ["0", "2", "2", "None"]
    assert [v for i, v in replies if i is None] == [NO_ROUTES]
    assert all(v.count("\tRoute ") == 5 for i, v in replies if i is not None)
