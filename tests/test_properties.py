"""Property tests: column expressions against plain Python definitions."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from routeweave.functions.ranges import in_range, lower_bound, upper_bound
from routeweave.functions.timefmt import journey_hours


def _j7(dep, arr):
    dh, dm = int(dep[11:13]), int(dep[14:16])
    ah, am = int(arr[11:13]), int(arr[14:16])
    hours = ah + 24 - dh if dh > ah else ah - dh
    total = hours * 60 + am - dm
    return int(total / 60)                     # truncation toward zero


clock = st.tuples(st.integers(0, 23), st.integers(0, 59))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(clock, clock), min_size=1, max_size=200))
def test_journey_hours_matches_definition(spark, pairs):
    rows = [(f"2024-01-01T{a:02d}:{b:02d}:00.000Z", f"2024-01-02T{c:02d}:{d:02d}:00.000Z")
            for (a, b), (c, d) in pairs]
    df = spark.createDataFrame(rows, "d STRING, a STRING")
    got = [r[0] for r in df.select(journey_hours(F.col("d"), F.col("a"))).collect()]
    assert got == [_j7(d, a) for d, a in rows]


bounds = st.lists(st.floats(-5, 300, allow_nan=False), max_size=3)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 300, allow_nan=False), bounds), min_size=1, max_size=100))
def test_range_rule_and_normalised_bounds(spark, cases):
    df = spark.createDataFrame(cases, "v DOUBLE, r ARRAY<DOUBLE>")
    got = df.select(in_range(F.col("v"), F.col("r")).alias("k"),
                    F.col("v").between(lower_bound(F.col("r")), upper_bound(F.col("r"))).alias("n")).collect()
    for (v, r), row in zip(cases, got):
        want = len(r) != 2 or (r[0] <= v <= r[1])
        assert row.k == want and row.n == want
