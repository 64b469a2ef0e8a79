"""Resampling of segments onto a fixed grid with linear interpolation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import AXES, DAY_MS, GRID_POINTS


def _bin_ms() -> Column:
    return F.expr(f"(last_ms - first_ms) div {GRID_POINTS}L")


def too_short(segments: DataFrame, keys) -> DataFrame:
    """Segments without a grid: they last fewer milliseconds than the grid has points."""
    return segments.filter(_bin_ms() < 1).select(*keys, "segment_no", "first_ms", "last_ms").distinct()


def binned(segments: DataFrame, keys) -> DataFrame:
    """Axis means per grid bin.  Bins are multiples of the bin width counted from midnight of the first day."""
    rows = segments.withColumn("bin_ms", _bin_ms()).filter(F.col("bin_ms") > 0)
    midnight = F.col("first_ms") - F.pmod(F.col("first_ms"), F.lit(DAY_MS))
    rows = rows.withColumn("midnight", midnight).withColumn(
        "bin", F.expr("(timeMs - midnight) div bin_ms - (first_ms - midnight) div bin_ms")
    )
    return rows.groupBy(*keys, "segment_no", "bin").agg(*(F.avg(a).alias(a) for a in AXES))


def resampled(segments: DataFrame, keys) -> DataFrame:
    """One row per segment and grid point ``k``; empty bins lie on the line between their filled neighbours."""
    ahead = Window.partitionBy(*keys, "segment_no").orderBy("bin")
    known = binned(segments, keys).withColumns(
        {"next_bin": F.lead("bin").over(ahead)} | {f"next_{a}": F.lead(a).over(ahead) for a in AXES}
    )
    # The neighbour is looked up before the cut: the last kept bins may lean on one beyond the grid.
    known = known.filter(F.col("bin") < GRID_POINTS)
    stop = F.least(F.coalesce(F.col("next_bin") - 1, F.col("bin")), F.lit(GRID_POINTS - 1))
    points = known.withColumn("k", F.explode(F.sequence(F.col("bin"), stop)))
    share = (F.col("k") - F.col("bin")) / (F.col("next_bin") - F.col("bin"))

    def value(axis: str) -> Column:
        start, end = F.col(axis), F.col(f"next_{axis}")
        return F.when(F.col("k") == F.col("bin"), start).otherwise(start + (end - start) * share).alias(axis)

    return points.select(*keys, "segment_no", F.col("k").cast("int").alias("k"), *(value(a) for a in AXES))


def samples(points: DataFrame, keys) -> DataFrame:
    """One row per segment with an array of grid values per axis (the group size is the grid size)."""
    packed = points.groupBy(*keys, "segment_no").agg(
        F.array_sort(F.collect_list(F.struct("k", *AXES))).alias("grid")
    )
    return packed.select(*keys, "segment_no", *(F.col(f"grid.{a}").alias(a) for a in AXES))
