import itertools
import os
import random

import pytest

from routeweave.operators import graph
from routeweave.operators.legs import graph_legs, leg_city_pairs
from routeweave.operators.shared_graphs import SharedGraphs
from routeweave.plans.sizing import scratch_scope

TRIPS = ("leg_id STRING, origin_place_id STRING, o_name STRING, o_city INT, dest_place_id STRING, d_name STRING, d_city INT, "
         "provider STRING, departure_date DATE, price DOUBLE, duration_h DOUBLE")
GRAPHS = "graph_id STRING, o_city INT, d_city INT, departure_date DATE, vias ARRAY<INT>"


def _tables(spark, seed, odd, n_cities=5, per_city=4, n_legs=300):
    """Graphs of all city pairs over two days, legs with repeated ids; ``odd``:
    places with several cities, several names or none."""
    import datetime as dt
    rnd = random.Random(seed)
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    home = {f"p{i}": i % n_cities for i in range(n_cities * per_city)}
    legs = []
    for i in range(n_legs):
        a, b = rnd.choice(list(home)), rnd.choice(list(home))

        def end(p):
            moved = odd and p == "p3" and rnd.random() < 0.5
            name = rnd.choice([None, "x", "y"]) if odd and p in ("p1", "p3") else p.upper()
            return p, name, 4 if moved else home[p]
        row = (f"L{i % (n_legs - 9)}", *end(a), *end(b), "BUS", rnd.choice(days), float(rnd.randrange(90)), float(rnd.randrange(9)))
        legs += [row] * rnd.choice([1, 1, 2])
    # city 4 is in no graph of the second day
    graphs = [(f"{o}|{d}|{day}", o, d, day, sorted(rnd.sample([c for c in range(n) if c not in (o, d)], 2)))
              for day, n in zip(days, (n_cities, n_cities - 1)) for o, d in itertools.product(range(n), repeat=2)]
    return spark.createDataFrame(graphs, GRAPHS), spark.createDataFrame(legs, TRIPS)


def _rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("odd", [False, True])
def test_shared_views_equal_views_per_graph(spark, odd):
    graphs, trips = _tables(spark, 5, odd)
    legs = graph_legs(leg_city_pairs(graphs), trips)
    kept = graph.prune_unreachable(legs, graphs)
    places = graph.prune_nodes(legs, kept, graphs)
    shared = SharedGraphs(graphs, trips)
    names = ["graph_id", "leg_id"]
    assert _rows(shared.kept_legs().select(*names)) == _rows(kept.select(*names)) != []
    assert len(_rows(kept.select(*names))) < legs.count()
    assert _rows(graph.graph_report_lines(shared.kept_legs(), graphs)) == _rows(graph.graph_report_lines(kept, graphs))
    assert _rows(shared.places()) == _rows(graph.graph_places(legs))
    assert _rows(shared.city_nodes()) == _rows(graph.graph_nodes(legs))
    assert _rows(shared.kept_places()) == _rows(places.select("graph_id", "city_id", "place_id"))
    assert _rows(shared.report()) == _rows(graph.graph_report(kept, graphs))


def test_legs_are_not_written_per_graph(spark):
    """Each leg lies in several graphs; no table that is written grows with them."""
    graphs, trips = _tables(spark, 6, False, n_legs=900)
    with scratch_scope(spark) as root:
        legs = graph_legs(leg_city_pairs(graphs), trips).count()
    with scratch_scope(spark) as root:
        shared = SharedGraphs(graphs, trips)
        for view in (shared.kept_legs, shared.places, shared.city_nodes, shared.kept_places, shared.report):
            view().collect()
        path = root.removeprefix("file:")
        sizes = [spark.read.parquet(f"{path}/{d}").count() for d in os.listdir(path)]
    assert legs > 3 * 891 and max(sizes) <= 900


def test_the_report_sums_up_the_kept_legs_of_each_graph(spark, monkeypatch):
    """The report goes through its operator, which gets every kept leg of every graph."""
    graphs, trips = _tables(spark, 7, False)
    shared = SharedGraphs(graphs, trips)
    kept, got, report = shared.kept_legs().count(), [], graph.graph_report

    def operator(legs, plan, key="graph_id"):
        got.append(legs.count())
        return report(legs, plan, key)
    monkeypatch.setattr(graph, "graph_report", operator)
    found = shared.report().collect()
    assert got == [kept] and kept > len(found) > 0
