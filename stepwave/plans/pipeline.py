"""From readings to samples, scores and inference records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.peaks import by_user
from ..operators.resample import resampled, samples
from ..operators.scoring import centroids, named, points_of, score_centroids, with_choice
from ..operators.segments import segments
from ..schema import CYCLE_MS
from ..session import cut


def group_keys(scope_ms: int | None) -> tuple[str, ...]:
    return ("userID",) if scope_ms is None else ("scope", "userID")


def grid_points(
    readings: DataFrame, scope_ms: int | None = None, cycle_ms: int = CYCLE_MS, max_rows: int | None = None
) -> DataFrame:
    """One row per segment and grid point."""
    data = by_user(readings, scope_ms, max_rows)
    return resampled(segments(data, cycle_ms), data.keys)


def sample_vectors(
    readings: DataFrame, scope_ms: int | None = None, cycle_ms: int = CYCLE_MS, max_rows: int | None = None
) -> DataFrame:
    """One row per segment with one fixed-length vector per axis."""
    return samples(grid_points(readings, scope_ms, cycle_ms, max_rows), group_keys(scope_ms))


def identified(points: DataFrame, classes: DataFrame, keys=("userID",)) -> DataFrame:
    """Class probabilities, inferred id and confidence per segment, from centroids of the known users.

    The samples, one narrow row per segment, are written once: centroids and scores both read them.
    """
    vectors = cut(samples(points, keys))
    centers = centroids(points_of(vectors, keys), classes)
    return with_choice(score_centroids(vectors, centers, keys))


def inferences(points: DataFrame, classes: DataFrame, identities: DataFrame, keys=("userID",)) -> DataFrame:
    """Inference records with the name of the inferred user."""
    scored = identified(points, classes, keys).withColumn("actual_user_id", F.col("userID"))
    return named(scored, identities)
