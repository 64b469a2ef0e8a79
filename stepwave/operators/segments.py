"""Overlapping two-cycle segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CYCLE_MS
from .ordered import Ordered, with_context
from .peaks import cycle_peaks, numbered_peaks, with_cycles


def cycle_numbers(data: Ordered, cycle_ms: int = CYCLE_MS) -> DataFrame:
    """Every reading with ``cycle``, the number of cycle peaks strictly before it."""
    peaks = numbered_peaks(cycle_peaks(data, cycle_ms))
    rows = with_cycles(data, peaks, {"cycle": F.col("cycle")}).rows
    return rows.withColumn("cycle", F.coalesce("cycle", F.lit(0)))


def segment_bounds(peaks: Ordered) -> Ordered:
    """For each peak the segment it opens and the one it divides, as ``(segment_no, first_ms, last_ms)``.

    Segment ``i`` runs from the reading after peak ``i`` to peak ``i + 2``; it is NULL where that
    peak does not exist.
    """
    near = with_context(
        peaks,
        running={"cycle": F.lit(1)},
        prev={"prev_next_ms": F.col("next_ms")},
        next={"peak1_ms": F.col("timeMs")},
    )
    far = with_context(near, next={"peak2_ms": F.col("peak1_ms")})
    opened = F.struct(
        F.col("cycle").alias("segment_no"), F.col("next_ms").alias("first_ms"), F.col("peak2_ms").alias("last_ms")
    )
    divided = F.struct(
        (F.col("cycle") - 1).alias("segment_no"),
        F.col("prev_next_ms").alias("first_ms"),
        F.col("peak1_ms").alias("last_ms"),
    )
    bounds = far.rows.withColumns(
        {
            "opened": F.when(F.col("peak2_ms").isNotNull(), opened),
            "divided": F.when(F.col("prev_next_ms").isNotNull() & F.col("peak1_ms").isNotNull(), divided),
        }
    )
    return far.with_rows(bounds.drop("prev_next_ms", "peak1_ms", "peak2_ms"))


def segments(data: Ordered, cycle_ms: int = CYCLE_MS) -> DataFrame:
    """The readings of every segment with its number and its first and last time; most readings appear twice."""
    bounds = segment_bounds(cycle_peaks(data, cycle_ms))
    marked = with_cycles(data, bounds, {"opened": F.col("opened"), "divided": F.col("divided")}).rows
    kept = [c for c in data.rows.columns if c not in ("slice", "slices", "place")]
    both = F.filter(F.array("divided", "opened"), lambda s: s.isNotNull())
    return marked.select(*kept, F.explode(both).alias("segment")).select(*kept, "segment.*")


def segment_stats(rows: DataFrame, keys) -> DataFrame:
    """Size, first and last time and duration of every segment."""
    return (
        rows.groupBy(*keys, "segment_no")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min("timeMs").alias("t_first"), F.max("timeMs").alias("t_last"))
        .withColumn("duration_ms", F.col("t_last") - F.col("t_first"))
    )


def group_counts(data: Ordered, cycle_ms: int = CYCLE_MS) -> DataFrame:
    """Cycle peaks and segments per group; groups without a peak are absent."""
    peaks = cycle_peaks(data, cycle_ms).rows.groupBy(*data.keys).agg(F.count(F.lit(1)).alias("n_peaks"))
    return peaks.withColumn("n_segments", F.greatest(F.col("n_peaks") - 2, F.lit(0)))
