"""Connected components of a graph too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for all nodes of ``edges`` (``a``, ``b``).

    Alternates large stars and small stars: every node hands its neighbours on to the smallest one it knows, until
    each component is a star. Rounds grow with the logarithm of a component's size. Self-edges are allowed.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        handed = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        kept = handed.filter("a > b").distinct()
        now = stored(kept, "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % F.lit(1_000_003))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    tops = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    return tops.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
