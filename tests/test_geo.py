from pyspark.sql import functions as F

from routeweave.operators import geo

CITIES = [  # id, name, country, lat, lon, population
    (1, "A", "X", 50.0, 10.0, 500000),
    (2, "B", "X", 51.0, 10.0, 900000),      # 111 km north
    (3, "C", "X", 50.0, 12.5, 800000),      # ~179 km east
    (4, "D", "X", 52.0, 10.0, 950000),      # 222 km: outside
    (5, "E", "X", 49.0, 10.0, 90000),       # below the population floor
    (6, "F", "X", 49.5, 10.5, 200000),
    (7, "G", "X", 50.5, 9.5, 300000),
    (8, "H", "X", 49.9, 9.9, 100000),       # exactly on the floor: kept
]


def _cities(spark):
    return spark.createDataFrame(CITIES, "city_id INT, city_name STRING, country_code STRING, lat DOUBLE, "
                                 "lon DOUBLE, population BIGINT")


def _points(spark, lat=50.0, lon=10.0):
    return spark.createDataFrame([(1, "SRC", lat, lon)], "request_id BIGINT, side STRING, lat DOUBLE, lon DOUBLE")


def test_nearby_radius_floor_limit_rank(spark):
    got = geo.nearby_cities(_points(spark), _cities(spark)).orderBy("rank").collect()
    assert [r.city_id for r in got] == [2, 3, 1, 7, 6]          # 5 by population, D and E out
    assert [r.rank for r in got] == [1, 2, 3, 4, 5]
    assert abs(got[0].distance_km - 111.19) < 0.01


def test_nearby_brute_force_many_points(spark):
    import math
    import random
    rnd = random.Random(3)
    pts = [(i, "SRC", rnd.uniform(40, 60), rnd.uniform(0, 20)) for i in range(60)]
    cities = [(i, f"c{i}", "X", rnd.uniform(40, 60), rnd.uniform(0, 20), rnd.randrange(50000, 2000000))
              for i in range(150)]
    cdf = spark.createDataFrame(cities, "city_id INT, city_name STRING, country_code STRING, lat DOUBLE, "
                                "lon DOUBLE, population BIGINT")
    pdf = spark.createDataFrame(pts, "request_id BIGINT, side STRING, lat DOUBLE, lon DOUBLE")
    got = {}
    for r in geo.nearby_cities(pdf, cdf).collect():
        got.setdefault(r.request_id, []).append((r.rank, r.city_id))

    def hav(a, b, c, d):
        p1, p2 = math.radians(a), math.radians(c)
        h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * 6371.0 * math.asin(math.sqrt(h))
    for pid, _, la, lo in pts:
        near = [c for c in cities if c[5] >= 100000 and hav(la, lo, c[3], c[4]) <= 200.0]
        near.sort(key=lambda c: (-c[5], c[0]))
        want = [(i + 1, c[0]) for i, c in enumerate(near[:5])]
        assert sorted(got.get(pid, [])) == want


def test_roles_population_and_distance(spark):
    ranked = geo.nearby_cities(_points(spark), _cities(spark))
    by_pop = {r.city_id: r.role for r in geo.name_roles(geo.assign_roles(ranked)).collect()}
    assert by_pop[2] == "ORIGIN" and by_pop[1] == "TRANSIT"
    by_dist = {r.city_id: r.role
               for r in geo.name_roles(geo.assign_roles(ranked, by="distance", threshold_km=50)).collect()}
    # A is at distance 0; only cities beyond 50 km are transit; endpoint is A
    assert by_dist[1] == "ORIGIN"
    assert all(v == "TRANSIT" for k, v in by_dist.items() if k != 1)


REQ = "request_id BIGINT, user_id STRING, src_lat DOUBLE, src_lon DOUBLE, dst_lat DOUBLE, dst_lon DOUBLE, status STRING"


def _plan(spark, rows, cities):
    from routeweave.plans.search import plan_requests
    req = spark.createDataFrame(rows, REQ).selectExpr("*", "DATE'2024-01-01' AS departure_date", "array(1D) AS price_range", "array(1D) AS time_range")
    return plan_requests(req, cities)


def test_plan_no_city_and_transit_without_endpoints(spark):
    rows = [(1, "u", 50.0, 10.0, 50.0, 12.5, "OK"), (2, "v", 0.0, 0.0, 50.0, 10.0, "OK")]
    plan, roles, stops = _plan(spark, rows, _cities(spark))
    req = spark.createDataFrame(rows, REQ)
    direct = geo.name_roles(geo.assign_roles(geo.nearby_cities(geo.request_points(req), _cities(spark))))
    cols = ["request_id", "side", "city_id", "rank", "role"]
    assert sorted(map(tuple, roles.select(cols).collect())) == sorted(map(tuple, direct.select(cols).collect()))
    plan = {r.request_id: r for r in plan.collect()}
    assert plan[1].status == "OK" and plan[2].status == "NO_CITY"
    stops = stops.filter(F.col("request_id") == 1).collect()
    vias = {r.via for r in stops}
    assert plan[1].o_city not in vias and plan[1].d_city not in vias
    assert len(vias) == len(stops)


def test_transit_cities_of_one_name_keep_the_most_populous(spark):
    cities = spark.createDataFrame(
        [(1, "A", "X", 50.0, 10.0, 900000), (2, "T", "X", 50.1, 10.0, 300000), (3, "T", "X", 50.2, 10.0, 400000),
         (4, "Z", "X", 55.0, 20.0, 900000), (5, "T", "X", 55.1, 20.0, 400000)],
        "city_id INT, city_name STRING, country_code STRING, lat DOUBLE, lon DOUBLE, population BIGINT")
    _, _, stops = _plan(spark, [(1, "u", 50.0, 10.0, 55.0, 20.0, "OK")], cities)
    assert [(r.via, r.via_name) for r in stops.collect()] == [(3, "T")]


def test_grid_near_poles_and_the_date_line(spark):
    import math
    import random
    rnd = random.Random(9)
    def lon():
        return rnd.choice([rnd.uniform(-180, 180), rnd.uniform(178, 180), rnd.uniform(-180, -178)])
    def lat():
        return rnd.choice([rnd.uniform(-90, 90), rnd.uniform(84, 90), rnd.uniform(-90, -84), rnd.uniform(-2, 2)])
    cities = [(i, f"c{i}", "X", lat(), lon(), 200000) for i in range(400)]
    pts = [(i, "SRC", lat(), lon()) for i in range(200)] + [(900, "SRC", 90.0, 0.0), (901, "SRC", 0.0, 180.0), (902, "SRC", 0.0, -180.0)]
    cdf = spark.createDataFrame(cities, "city_id INT, city_name STRING, country_code STRING, lat DOUBLE, lon DOUBLE, population BIGINT")
    pdf = spark.createDataFrame(pts, "request_id BIGINT, side STRING, lat DOUBLE, lon DOUBLE")
    got = {(r.request_id, r.city_id) for r in geo.nearby_cities(pdf, cdf, limit=1000).collect()}

    def hav(a, b, c, d):
        p1, p2 = math.radians(a), math.radians(c)
        h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * 6371.0 * math.asin(math.sqrt(h))
    want = {(p[0], c[0]) for p in pts for c in cities if hav(p[2], p[3], c[3], c[4]) <= 200.0}
    assert got == want and len(want) > 100
