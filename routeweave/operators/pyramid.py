"""Nearby cities in a large catalogue (G1 with K1): a pyramid of cells that
keep their most populous cities.

The plain join (``geo.nearby_cities``) meets every city of the cells around a
point, which in a dense region are far more than the few that are wanted.
Here latitude/longitude cells of ``LEVELS`` sizes, each half as wide as the
one before, keep their ``limit`` most populous cities.  A point's circle is
covered from large cells to small ones: a cell that lies inside gives its
list, one that lies outside goes, and one that is cut is cut further.  The
last city of a full list inside the circle bounds what is wanted: lists that
begin below it are not read, and in the smallest cells along the circle cities
beyond a list are met only where the whole list is above it.  So a circle reads
lists in number of its length, whatever the density.

Points of one cell share this work: around its middle, what is within the
radius less half the cell's diagonal is near to each of them, and what is
beyond the radius plus that is near to none.  The cities up to the ``limit``-th
that is near to all are few, and a point looks at these alone.  Points whose
cell has no such bound, or too many cities before it, go on with smaller
cells, and at last by themselves.  So the work grows with the places where
points are, and points only measure some distances.

Exact: the farthest point of a cell is one of its corners as long as it is
within 90 degrees of longitude (others count as cut), and lists hold the best
``limit`` of their cells.  Cities are compared by population and id, so many
of equal population bound as well.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from routeweave.functions.geo import KM_PER_DEGREE_LAT, haversine_km
from routeweave.operators.geo import CITY_LIMIT, MIN_POPULATION, RADIUS_KM
from routeweave.operators.routes import best_rows
from routeweave.plans.sizing import materialize

AROUND = 128            # largest cells around the globe
LEVELS = 6
BOUND_LEVELS = 3        # of the cells whose lists bound what is wanted
GROUP_LEVELS = (3, 5)   # of the cells whose points are searched together
MOST = 200              # cities that the points of a cell look at
FEW = 1000              # points that are left go by themselves at once
GROUPS_PER_TASK = 1000
POINTS_PER_TASK = 50_000
MARGIN_KM = 1e-6        # of rounding, inside a circle
CELL = ["level", "y", "x"]
GROUP = ["lat", "lon"]  # the middle of a group of points


def _side(level: int) -> float:
    return 360.0 / (AROUND << level)


def _y(lat: Column, level: int) -> Column:
    return F.floor((lat + 90.0) / _side(level)).cast("long")


def _x(lon: Column, level: int) -> Column:
    return F.pmod(F.floor((lon + 180.0) / _side(level)).cast("long"), F.lit(AROUND << level))


def _order() -> list:
    return [F.col("population").desc(), F.col("city_id")]


def city_pyramid(cities: DataFrame, min_population: int = MIN_POPULATION, limit: int = CITY_LIMIT) -> tuple[DataFrame, DataFrame]:
    """(lists, leaves): the most populous cities of every cell of every level,
    and every city with its smallest cell and its ``place`` in that cell's order."""
    cat = (cities.filter((F.col("population") >= min_population) & F.col("lat").isNotNull() & F.col("lon").isNotNull())
           .select("city_id", "city_name", "country_code", "population", F.col("lat").alias("c_lat"), F.col("lon").alias("c_lon")))
    last = LEVELS - 1
    cells = F.array(*[F.struct(F.lit(k).alias("level"), _y(F.col("c_lat"), k).alias("y"), _x(F.col("c_lon"), k).alias("x")) for k in range(last)])
    in_cell = Window.partitionBy("y", "x").orderBy(*_order())
    leaves = materialize(cat.withColumns({"y": _y(F.col("c_lat"), last), "x": _x(F.col("c_lon"), last)}).withColumn("place", F.row_number().over(in_cell)))
    small = leaves.filter(F.col("place") <= limit).select(F.lit(last).alias("level"), "y", "x", *cat.columns)
    # the best of a large cell are among the best of its smallest cells
    upper = best_rows(small.drop(*CELL).withColumn("cell", F.explode(cells)).select("cell.*", *cat.columns), CELL, _order(), limit)
    # the lists are bounded by the cells, so their size on disk may let joins broadcast them
    return materialize(upper.unionByName(small)), leaves


def _classified(rows: DataFrame, level: int, radius_km: float, slack: float) -> DataFrame:
    """Cells of a level that the circle covers or cuts, for points up to
    ``slack`` km from the given one; rows that are inside already stay as they are."""
    side = _side(level)
    south, west = F.col("y") * side - 90.0, F.col("x") * side - 180.0
    north, east = south + side, west + side
    # degrees of longitude from the point to the cell's edges, -180 to 180
    turn = lambda lon: F.pmod(lon - F.col("lon") + 180.0, F.lit(360.0)) - 180.0
    a, b = turn(west), turn(east)
    beside = F.when((a <= 0) & (b >= 0) & (b - a < 180), F.lit(0.0)).otherwise(F.least(F.abs(a), F.abs(b)))
    far = F.greatest(*[haversine_km(F.col("lat"), F.col("lon"), la, lo) for la in (south, north) for lo in (west, east)])
    whole = (F.greatest(F.abs(a), F.abs(b)) < 90) & (b > a) & (far <= radius_km - slack - MARGIN_KM)
    # the nearest place of a cell is on its nearer meridian, where that is nearest or at an end
    lat, side_turn = F.radians("lat"), F.radians(beside)
    closest = F.degrees(F.atan2(F.sin(lat), F.cos(lat) * F.cos(side_turn)))
    near = haversine_km(F.col("lat"), F.lit(0.0), F.least(F.greatest(closest, south), north), beside)
    out = near > radius_km + slack + MARGIN_KM
    return (rows.withColumn("inside", F.col("inside") | whole).withColumn("out", ~F.col("inside") & out)
            .filter(~F.col("out")).drop("out"))


def cover(points: DataFrame, radius_km: float = RADIUS_KM, levels: int = LEVELS, wanted=lambda rows: rows, slack: float = 0.0) -> DataFrame:
    """``points`` with the cells of their circles: level, y, x, inside.
    ``wanted`` filters the cells of a level before they are cut further.
    ``slack``: a row stands for all points up to so many km from it; cells are
    inside if they are for all of these, and left out if they are for none."""
    angle = (radius_km + slack) / KM_PER_DEGREE_LAT
    low, high = _y(F.greatest(F.col("lat") - angle, F.lit(-90.0)), 0), _y(F.least(F.col("lat") + angle, F.lit(90.0)), 0)
    pole = F.abs("lat") + angle >= 90.0
    reach = F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(F.lit(angle))) / F.cos(F.radians("lat")))))
    n = F.ceil(reach / _side(0)) + 1
    own = F.floor((F.col("lon") + 180.0) / _side(0)).cast("long")
    wide = pole | (2 * n + 1 >= AROUND)
    xs = F.when(wide, F.sequence(F.lit(0).cast("long"), F.lit(AROUND - 1).cast("long"))).otherwise(
        F.transform(F.sequence(own - n, own + n), lambda x: F.pmod(x, F.lit(AROUND))))
    rows = (points.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
            .withColumn("y", F.explode(F.sequence(low, high))).withColumn("x", F.explode(xs))
            .withColumns({"level": F.lit(0), "inside": F.lit(False)}))
    rows = wanted(_classified(rows, 0, radius_km, slack))
    for level in range(1, levels):
        parts = [F.struct(F.lit(level).alias("level"), (2 * F.col("y") + i).alias("y"), (2 * F.col("x") + j).alias("x"), F.lit(False).alias("inside"))
                 for i in (0, 1) for j in (0, 1)]
        same = F.struct("level", "y", "x", "inside")
        cut = F.explode(F.when(F.col("inside"), F.array(same)).otherwise(F.array(*parts)))
        rows = rows.withColumn("cell", cut).drop("level", "y", "x", "inside").select("*", "cell.*").drop("cell")
        rows = wanted(_classified(rows, level, radius_km, slack))
    return rows


def _middles(points: DataFrame, level: int | None) -> tuple[DataFrame, float]:
    """``points`` with the middle of their cell, null for those that no cell of
    the globe holds, and how far from it they may be; without a level, each
    place by itself."""
    if level is None:
        return points.withColumns({"g_lat": F.col("lat"), "g_lon": F.col("lon")}), 0.0
    side = _side(level)
    y = F.least(_y(F.col("lat"), level), F.lit((AROUND << level) // 2 - 1))
    middles = points.withColumns({"g_lat": F.when(F.abs("lat") <= 90.0, (y + 0.5) * side - 90.0), "g_lon": (_x(F.col("lon"), level) + 0.5) * side - 180.0})
    # degrees of longitude are nowhere longer than those of latitude
    return middles, side * math.sqrt(0.5) * KM_PER_DEGREE_LAT + MARGIN_KM


def _candidates(groups: DataFrame, pyramid: tuple[DataFrame, DataFrame], heads: DataFrame, radius_km: float, slack: float,
                limit: int) -> tuple[DataFrame, DataFrame | None]:
    """(lists, loose) of ``groups`` (lat, lon): the cities, best first, among
    which are the ``limit`` best of each point within ``slack`` km of the
    group's middle, and the groups that have no bounded list."""
    lists, leaves = pyramid
    tasks = max(int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(groups.count() / GROUPS_PER_TASK))
    spread = lambda g: g.repartition(tasks, *GROUP)
    at_least = lambda c: F.col("least").isNull() | (F.col(c) <= F.col("least"))
    # a full list inside the circle: what is below its last city is not wanted
    least = (cover(spread(groups), radius_km, BOUND_LEVELS, slack=slack).filter("inside").join(heads, CELL)
             .groupBy(*GROUP).agg(F.min("worst").alias("least")))
    bounded = materialize(groups.join(least, GROUP, "left"))
    bests = heads.select(*[F.col(c).alias(f"_{c}") for c in CELL], "best")
    shown = at_least("best")
    for c in CELL:
        shown = shown & (F.col(c) == F.col(f"_{c}"))
    # a semi-join leaves the groups where they are spread
    cells = materialize(cover(spread(bounded), radius_km, wanted=lambda rows: rows.join(bests, shown, "left_semi"), slack=slack)
                        .join(heads.drop("best"), CELL))
    loose = None
    if slack > 0:
        # no list inside, not even of a small cell, and too many cities in some cell to look at all
        ends = cells.groupBy(*GROUP).agg(F.min(F.when(F.col("inside"), F.col("worst"))).alias("more"), F.max(~F.col("inside") & F.col("worst").isNotNull()).alias("many"))
        ends = materialize(ends)
        loose = ends.filter("more IS NULL AND many").join(bounded.filter("least IS NULL"), GROUP, "left_semi").select(*GROUP)
        cells = (cells.join(loose, GROUP, "left_anti").join(ends.select(*GROUP, "more"), GROUP)
                 .withColumn("least", F.least("least", "more")).drop("more"))
    order = F.struct((-F.col("population")).alias("p"), "city_id")
    listed = cells.drop("worst").join(lists, CELL).withColumn("o", order).filter(at_least("o")).drop(*CELL, "inside", "least")
    # cells along the circle show more than their list only where all of it is wanted
    rest = leaves.filter(F.col("place") > limit).drop("place")
    met = (cells.filter(~F.col("inside") & F.col("worst").isNotNull() & at_least("worst")).drop("inside", "level", "worst")
           .join(rest, ["y", "x"]).withColumn("o", order).filter(at_least("o")).drop("y", "x", "least"))
    margin = slack + MARGIN_KM if slack > 0 else 0.0
    away = haversine_km(F.col("lat"), F.col("lon"), F.col("c_lat"), F.col("c_lon"))
    found = listed.unionByName(met).drop("o").withColumn("_away", away).filter(F.col("_away") <= radius_km + margin)
    best_first = Window.partitionBy(*GROUP).orderBy(*_order())
    sure = F.sum((F.col("_away") <= radius_km - margin).cast("long")).over(best_first.rowsBetween(Window.unboundedPreceding, -1))
    most = max(MOST, limit)
    kept = (found.withColumns({"place": F.row_number().over(best_first), "_sure": F.coalesce(sure, F.lit(0))})
            .filter((F.col("_sure") < limit) & (F.col("place") <= most + 1)).drop("_away", "_sure"))
    of = [c for c in kept.columns if c not in (*GROUP, "place")]
    full = materialize(kept.groupBy(*GROUP).agg(F.array_sort(F.collect_list(F.struct("place", *of))).alias("cities")))
    if loose is not None:
        loose = materialize(loose.unionByName(full.filter(F.size("cities") > most).select(*GROUP)))
    return full.filter(F.size("cities") <= most), loose


def nearby_cities(points: DataFrame, pyramid: tuple[DataFrame, DataFrame], radius_km: float = RADIUS_KM, limit: int = CITY_LIMIT,
                  key=("request_id", "side")) -> DataFrame:
    """As ``geo.nearby_cities``, over ``city_pyramid(cities, ..., limit)``."""
    lists, _ = pyramid
    keys = list(key)
    left = materialize(points.select(*keys, "lat", "lon").filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()))
    tasks = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(left.count() / POINTS_PER_TASK))
    # the best and, of full lists, the last city of a cell
    order = F.struct((-F.col("population")).alias("p"), "city_id")
    heads = materialize(lists.withColumn("o", order).groupBy(*CELL).agg(F.min("o").alias("best"), F.when(F.count("*") == limit, F.max("o")).alias("worst")))
    placed, around = [], []
    levels, turn = [*GROUP_LEVELS, None], -1
    while levels:
        turn, level = turn + 1, levels.pop(0)
        at, slack = _middles(left, level)
        groups = materialize(at.filter("g_lat IS NOT NULL").select(F.col("g_lat").alias("lat"), F.col("g_lon").alias("lon")).distinct())
        full, loose = _candidates(groups, pyramid, heads, radius_km, slack, limit)
        around.append(full.select(F.lit(turn).alias("turn"), F.col("lat").alias("g_lat"), F.col("lon").alias("g_lon"), "cities"))
        at = at.withColumn("turn", F.lit(turn))
        if loose is None:
            placed.append(at)
            break       # each place had its own turn
        gone = loose.toDF("g_lat", "g_lon")
        placed.append(at.filter("g_lat IS NOT NULL").join(gone, ["g_lat", "g_lon"], "left_anti"))
        left = materialize(at.filter("g_lat IS NULL").select(*keys, "lat", "lon").unionByName(
            at.join(gone, ["g_lat", "g_lon"], "left_semi").select(*keys, "lat", "lon")))
        rest = left.count()
        levels = [] if rest == 0 else [None] if rest <= FEW else levels
    union = lambda parts: functools.reduce(DataFrame.unionByName, parts)
    # dealt by key, as the last ranking needs them
    met = union(placed).repartition(tasks, *keys).join(union(around), ["turn", "g_lat", "g_lon"])
    far = F.transform("cities", lambda c: c.withField("distance_km", haversine_km(F.col("lat"), F.col("lon"), c["c_lat"], c["c_lon"])))
    near = F.slice(F.filter(far, lambda c: c["distance_km"] <= radius_km), 1, limit)
    found = met.select(*keys, F.explode(near).alias("c")).select(*keys, "c.city_id", "c.city_name", "c.country_code", "c.population", "c.distance_km")
    # rows that share a key share its cities
    return best_rows(found, keys, _order(), limit, rank="rank").select(*keys, "city_id", "city_name", "country_code", "population", "distance_km", "rank")
