"""Vector expressions: norm, text form, model tensor, class choice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import DECIMAL_PLACES, GRID_POINTS, ZERO_CHANNELS


def norm(x: Column, y: Column, z: Column) -> Column:
    """Euclidean length, for readings that arrive without ``vSum``."""
    return F.sqrt(x * x + y * y + z * z)


def to_text(vector: Column, places: int = DECIMAL_PLACES) -> Column:
    """Rounded values joined by blanks."""
    return F.array_join(F.transform(vector, lambda v: F.round(v, places).cast("string")), " ")


def from_text(text: Column) -> Column:
    """Single-precision values of a blank-separated text."""
    return F.transform(F.split(F.trim(text), " "), lambda v: v.try_cast("float"))


def zeros(size: int = GRID_POINTS) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), size)


def tensor(x: Column, y: Column, z: Column, size: int = GRID_POINTS) -> Column:
    """``size`` rows of six channels: the three axes and three zero channels, single precision."""
    channels = [a.cast("array<float>") for a in (x, y, z)] + [zeros(size)] * ZERO_CHANNELS
    points = F.arrays_zip(*(c.alias(f"c{i}") for i, c in enumerate(channels)))
    return F.transform(points, lambda p: F.array(*(p[f"c{i}"] for i in range(len(channels)))))


def best_class(probabilities: Column) -> Column:
    """1-based position of the largest probability; the first wins a tie."""
    return F.array_position(probabilities, F.array_max(probabilities)).cast("int")


def confidence(probabilities: Column) -> Column:
    return F.array_max(probabilities)
