"""Registered queries: name -> (spark, sf_dir) -> DataFrame, with SQL twins.

Every query reads the whole driver tables of ``sf_dir`` (through the
fixture derivation) so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from routeweave.plans import oracle
from routeweave.plans.search import search, top_route_rows
from routeweave.sources import fixtures

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None, roles_by: str = "population", trip: str = "t.*", connect_on: str = "place"):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = oracle.with_fixtures(sql, roles_by, trip, connect_on)
        return fn
    return deco


def register_sql(found: dict[str, str]) -> None:
    """Statements that need no fixture tables."""
    _SQL.update(found)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _search(spark: SparkSession, sf_dir: str):
    return search(fixtures.requests(spark, sf_dir), fixtures.catalogue(spark, sf_dir))


@register("top_routes", """
SELECT request_id, rank, route_id, n_legs, total_price, total_time, stops FROM top
""")
def q_top_routes(spark, sf_dir):
    """Flagship: the five cheapest in-range routes of every request."""
    return top_route_rows(_search(spark, sf_dir))


@register("top_routes_by_distance", """
SELECT request_id, rank, route_id, n_legs, total_price, total_time, stops FROM top
""", roles_by="distance")
def q_top_routes_by_distance(spark, sf_dir):
    """V1: the endpoint is the nearest city (ties within 50 km go to the
    most populous), farther cities are transit."""
    from routeweave.plans.search import SearchParams
    res = search(fixtures.requests(spark, sf_dir), fixtures.catalogue(spark, sf_dir),
                 SearchParams(roles_by="distance"))
    return top_route_rows(res)


import routeweave.plans.queries_more  # noqa: E402,F401  (registers the rest)
