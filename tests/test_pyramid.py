from pyspark.sql import functions as F

from routeweave.operators import geo, pyramid


def _rows(df):
    return sorted((r.request_id, r["rank"], r.city_id, r.city_name, round(r.distance_km, 6)) for r in df.collect())


def _hash(column, salt, top):
    return F.pmod(F.xxhash64(F.lit(salt), column), F.lit(top))


def _world(spark, n, lat, lon):
    """n cities within ranges of degrees, many of equal population."""
    i = F.col("id")
    at = lambda salt, low, high: low + (high - low) * _hash(i, salt, 1 << 30) / float(1 << 30)
    return spark.range(n).select(i.alias("city_id"), F.concat(F.lit("c"), i.cast("string")).alias("city_name"), F.lit("X").alias("country_code"),
                                 at("lat", *lat).alias("lat"), at("lon", *lon).alias("lon"), (F.lit(50_000) + _hash(i, "p", 4000) * 100).alias("population"))


def _points(spark, rows):
    return spark.createDataFrame([(i, "SRC", *p) for i, p in enumerate(rows)], "request_id BIGINT, side STRING, lat DOUBLE, lon DOUBLE")


def test_equals_the_plain_join_on_a_million_cities(spark):
    cities = _world(spark, 1_000_000, (40, 52), (0, 16))
    points = _points(spark, [(46.0, 8.0), (45.123, 3.9), (41.0, 0.5), (51.9, 15.9), (53.5, 8.0), (60.0, 8.0), (46.0, None)])
    got = _rows(pyramid.nearby_cities(points, pyramid.city_pyramid(cities)))
    assert got == _rows(geo.nearby_cities(points, cities)) and len({x[0] for x in got}) == 5


def test_a_point_reads_lists_and_not_the_region(spark):
    cities = _world(spark, 400_000, (44, 48), (6, 10))
    points = _points(spark, [(46.0, 8.0)])
    lists, leaves = pyramid.city_pyramid(cities)
    cells = pyramid.cover(points)
    assert cells.count() < 500
    met = cells.filter("inside").join(lists, pyramid.CELL).count() + cells.filter("NOT inside").join(leaves, ["y", "x"]).count()
    within = leaves.filter((F.abs(F.col("c_lat") - 46) < 1.8) & (F.abs(F.col("c_lon") - 8) < 1.8)).count()
    assert met < within / 4


def test_poles_date_line_and_few_cities(spark):
    cities = (_world(spark, 3000, (84, 90), (-180, 180)).unionByName(_world(spark, 800, (-3, 3), (178, 180)).withColumn("city_id", F.col("city_id") + 10_000))
              .unionByName(_world(spark, 800, (-3, 3), (-180, -178)).withColumn("city_id", F.col("city_id") + 20_000)))
    points = _points(spark, [(90.0, 0.0), (89.5, -170.0), (88.6, 100.0), (87.0, 179.9), (0.0, 180.0), (0.1, -180.0), (1.0, 179.5), (-1.0, -179.2), (-90.0, 5.0)])
    for radius in (60.0, 200.0, 450.0):
        got = _rows(pyramid.nearby_cities(points, pyramid.city_pyramid(cities), radius))
        assert got == _rows(geo.nearby_cities(points, cities, radius)) and len(got) >= 35
    empty = cities.limit(0)
    assert pyramid.nearby_cities(points, pyramid.city_pyramid(empty)).collect() == []


def test_few_points_make_a_task_and_ties_at_the_bound_are_kept(spark):
    """Points of one file are spread over tasks; cities as populous as the last of a list inside the circle count."""
    cities = _world(spark, 60_000, (44, 48), (6, 10)).withColumn("population", 100_000 + F.col("population") % 500)
    points = _points(spark, [(46.0 + i / 50, 8.0 - i / 40) for i in range(12)]).coalesce(1)
    found = pyramid.nearby_cities(points, pyramid.city_pyramid(cities))
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().toString()
    assert _rows(found) == _rows(geo.nearby_cities(points, cities))


def test_points_of_one_cell_share_their_search(spark, monkeypatch):
    """Circles are covered for cells of points, not for points; repeated keys, odd places and edges of the region stay right."""
    cities = _world(spark, 40_000, (44, 46), (6, 9)).withColumn("population", 100_000 + F.col("population") % 700)
    cities = cities.unionByName(cities.limit(50))
    i = F.col("id")
    points = spark.range(600).select((i % 590).alias("request_id"), F.lit("SRC").alias("side"), (43.0 + i % 25 / 6).alias("lat"), (5.0 + i % 24 / 5).alias("lon"))
    points = points.unionByName(spark.range(400).select((i + 1000).alias("request_id"), F.lit(None).cast("string").alias("side"), (42.15 + i % 40 / 900).alias("lat"), (7.0 + i / 900).alias("lon")))
    odd = spark.createDataFrame([(2000, "SRC", 91.0, 7.0), (2001, "SRC", 90.0, 0.0), (2002, "SRC", float("nan"), 7.0), (2003, "SRC", -90.0, 180.0), (2004, "SRC", None, 1.0)], points.schema)
    covered, cover = [], pyramid.cover

    def counted(rows, *args, **more):
        covered.append((rows.count(), more.get("slack", 0.0)))
        return cover(rows, *args, **more)
    monkeypatch.setattr(pyramid, "cover", counted)
    monkeypatch.setattr(pyramid, "FEW", 0)
    got = _rows(pyramid.nearby_cities(points.unionByName(odd), pyramid.city_pyramid(cities)))
    assert got == _rows(geo.nearby_cities(points.unionByName(odd), cities)) and len(got) > 2500
    assert covered[0][0] < 250 and [x[1] > 0 for x in covered] == [True] * 4 + [False] * 2
