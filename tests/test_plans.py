import io
from contextlib import redirect_stdout

import __spark_entry__ as entry
from routeweave.plans.search import search, top_route_rows
from routeweave.sources import fixtures
from tests.conftest import SF0001


def _plan_text(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_flagship_plan_shape(spark):
    txt = _plan_text(top_route_rows(search(fixtures.requests(spark, SF0001), fixtures.catalogue(spark, SF0001))))
    assert "CartesianProduct" not in txt and "BroadcastNestedLoopJoin" not in txt
    assert "BatchEvalPython" not in txt and "ArrowEvalPython" not in txt
    assert "WindowGroupLimit" in txt


def test_trip_scan_prunes_columns(spark):
    txt = _plan_text(fixtures.trips(spark, SF0001))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int," \
           "l_extendedprice:double>" in txt


def test_entry_contract(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["request_id", "rank", "route_id", "n_legs", "total_price", "total_time", "stops"]
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs) and "top_routes" in sql


def test_catalogue_round_trip(spark, tmp_path):
    from routeweave.sources import catalogue as store
    cat = fixtures.catalogue(spark, SF0001)
    store.write_catalogue(cat, str(tmp_path))
    back = store.read_catalogue(spark, str(tmp_path))
    assert back.trips.count() == cat.trips.count() == 6000
    day = back.trips.filter("departure_date = DATE'2024-01-02'")
    assert "PartitionFilters: [isnotnull(departure_date" in _plan_text(day)
    want = {(r.request_id, r.route_id) for r in top_route_rows(search(fixtures.requests(spark, SF0001), cat)).collect()}
    got = {(r.request_id, r.route_id) for r in top_route_rows(
        search(fixtures.requests(spark, SF0001), back, ctrips=store.read_city_trips(spark, str(tmp_path)))).collect()}
    assert got == want
