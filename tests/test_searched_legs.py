"""The legs of every graph without names and without a row per graph until the last step."""
import datetime as dt
import random

from routeweave.operators.legs import city_trips, graph_legs, leg_city_pairs, searched_legs

DAYS = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
COLS = ["graph_id", "leg_id", "o_city", "d_city", "price", "duration_h"]


def _tables(spark, odd):
    """Cities 0 to 3, city 3 in no graph; ``odd``: repeated and null places,
    legs with one id and different fields, equal legs."""
    rnd = random.Random(11)
    places = [(f"p{i}", f"P{i}", rnd.choice(["BUS", "FLIGHT"]), i % 4, "x") for i in range(24)]
    if odd:
        places += [("p1", "A", "BUS", 2, "x"), ("p1", "Z", "BUS", 1, "x"), ("p2", None, "FLIGHT", 0, "x"), ("p5", "P5", None, 1, "x"), (None, "N", "BUS", 1, "x"), places[7]]
    trips = []
    for i in range(400):
        a, b = (rnd.choice([*(f"p{k}" for k in range(24)), *([None] if odd else [])]) for _ in range(2))
        row = (f"L{i % 390 if odd else i}", a, b, rnd.choice(["BUS", "FLIGHT"]), rnd.choice(DAYS), True, float(rnd.randrange(9)), 1.0, "", "")
        trips += [row] * (rnd.choice([1, 2]) if odd else 1)
    graphs = [(f"{o}|{d}|{day}|{v}", o, d, day, [v]) for day in DAYS for o, d, v in ((0, 1, 2), (0, 2, 1), (1, 2, 0), (2, 0, 1))]
    return (spark.createDataFrame(graphs, "graph_id STRING, o_city INT, d_city INT, departure_date DATE, vias ARRAY<INT>"),
            spark.createDataFrame(trips, "leg_id STRING, origin_place_id STRING, dest_place_id STRING, provider STRING, departure_date DATE, "
                                         "is_direct BOOLEAN, price DOUBLE, duration_h DOUBLE, departure_dt STRING, arrival_dt STRING"),
            spark.createDataFrame(places, "place_id STRING, place_name STRING, provider STRING, city_id INT, place_code STRING"))


def test_searched_legs_equal_graph_legs(spark):
    for odd in (False, True):
        graphs, trips, places = _tables(spark, odd)
        pairs = leg_city_pairs(graphs)
        want = graph_legs(pairs, city_trips(trips, places)).select(*COLS)
        got = searched_legs(pairs, trips, places)
        assert got.columns == COLS
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) != []


def test_rows_of_a_leg_come_one_after_the_other(spark):
    """Also where the last join is no broadcast: a result ordered by graph
    repeats every leg id too far apart to be packed."""
    graphs, trips, places = _tables(spark, False)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = [r.leg_id for r in searched_legs(leg_city_pairs(graphs), trips, places).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    runs = 1 + sum(a != b for a, b in zip(ids, ids[1:]))
    assert runs == len(set(ids)) < len(ids)
