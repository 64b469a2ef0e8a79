"""Equi joins that keep a frequent key off a single task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import MAX_BROADCAST_GROUPS, group_limit

MAX_DIMENSION_ROWS = 100_000


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than one beyond that."""
    return df.limit(rows + 1).count() <= rows


def join_dimension(left: DataFrame, dimension: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join a lookup table, broadcast when its row count is checked to be small."""
    if has_at_most(dimension.select(*on), MAX_DIMENSION_ROWS):
        return left.join(F.broadcast(dimension), on, how)
    return join_frequent(left, dimension, on, how)


def join_frequent(
    left: DataFrame, right: DataFrame, on: list[str], how: str, max_rows: int | None = None
) -> DataFrame:
    """Join ``left`` with a ``right`` that is unique on ``on`` (left, left_semi or left_anti).

    Rows of keys that occur more than ``max_rows`` times on the left join a broadcast of just those
    keys' right rows and never shuffle; the rest join as usual.
    """
    counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > group_limit(left, max_rows)).select(*on)
    sample = counts.limit(MAX_BROADCAST_GROUPS + 1).collect()
    if not sample or len(sample) > MAX_BROADCAST_GROUPS:
        # Nothing frequent, or so many frequent keys that hashing spreads them; adaptive execution splits the rest.
        return left.join(right, on, how)
    frequent = F.broadcast(left.sparkSession.createDataFrame(sample, counts.schema))
    same = reduce(lambda a, b: a & b, (left[c].eqNullSafe(frequent[c]) for c in on))
    hot = left.join(frequent, same, "left_semi")
    cold = left.join(frequent, same, "left_anti")
    hot_right = F.broadcast(right.join(frequent, on, "left_semi"))
    return hot.join(hot_right, on, how).unionByName(cold.join(right, on, how))
