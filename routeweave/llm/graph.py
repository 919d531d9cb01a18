"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeweave.llm.tables import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node on an edge of (a, b): root is the least
    node that it reaches.  Each round links neighbours to the least
    neighbour (larger ones first, then smaller ones); hubs only ever take
    part in a minimum, which is combined before the shuffle.  Loops and
    repeated edges are allowed; no edges give no rows."""
    now = written(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _stars(now):
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        lower = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(lower.union(least).distinct(), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node is either a root or has one edge, to a root."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR up + down > 1").isEmpty()
