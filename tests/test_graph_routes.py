from routeweave.operators.routes import graph_routes
from tests.test_shared_graphs import _rows, _tables


def test_routes_of_graphs_need_no_place_names(spark):
    """Where no place id repeats, names choose nothing and are not read; the graphs meet the routes from a written table."""
    graphs, trips = _tables(spark, 11, False)
    named = graph_routes(graphs, trips)
    bare = graph_routes(graphs, trips, named=False)
    assert _rows(bare) == _rows(named) != []
    # every graph comes with its route families from one small file
    read = [f for f in bare.inputFiles() if "via" in spark.read.parquet(f).columns and "graph_id" in spark.read.parquet(f).columns]
    assert read
