"""Scoring of samples: a pluggable model on the executors, or distances to class centroids."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import best_class, confidence, tensor
from ..schema import AXES, CONFIDENCE_FIELD, DECIMAL_PLACES, GRID_POINTS, ZERO_CHANNELS
from .joins import join_dimension

# Workers get this module's functions themselves, so they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_CLASSES = 1_000
MODEL_ROWS = 1_024
TENSOR_CHANNELS = len(AXES) + ZERO_CHANNELS


def with_tensor(samples: DataFrame) -> DataFrame:
    """Add the model's input, from axis values rounded as in their text form."""
    rounded = (F.transform(a, lambda v: F.round(v, DECIMAL_PLACES)) for a in AXES)
    return samples.withColumn("tensor", tensor(*rounded))


def with_choice(scored: DataFrame) -> DataFrame:
    """Add the inferred class, counted from 1, and its probability from ``probabilities``."""
    p = F.col("probabilities")
    return scored.withColumns({"inferred_user_id": best_class(p), CONFIDENCE_FIELD: confidence(p)})


def score_with(samples: DataFrame, load: Callable[[], Callable[[np.ndarray], np.ndarray]]) -> DataFrame:
    """Add ``probabilities`` from a model.

    ``load`` runs once per Python worker and returns ``predict``, which maps a float32 batch of shape
    ``(n, 128, 6)`` to ``(n, classes)``, with up to ``MODEL_ROWS`` samples at a time, whatever the Arrow batch holds.  Ship model files with ``spark.addArtifact`` or a broadcast.
    """

    @F.arrow_udf("array<double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load()
        for batch in batches:
            scored = [pa.array([], pa.list_(pa.float64()))]
            for at in range(0, len(batch), MODEL_ROWS):
                piece = batch.slice(at, MODEL_ROWS)
                points = piece.flatten().flatten().to_numpy(zero_copy_only=False).astype(np.float32)
                scores = np.asarray(model(points.reshape(len(piece), GRID_POINTS, TENSOR_CHANNELS)), np.float64)
                ends = np.arange(len(piece) + 1, dtype=np.int32) * scores.shape[1]
                scored.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(scores.ravel(), from_pandas=True)))  # NaN is null
            yield pa.concat_arrays(scored)

    return with_tensor(samples).withColumn("probabilities", predict("tensor")).drop("tensor")


def centroids(points: DataFrame, classes: DataFrame, on: str = "userID") -> DataFrame:
    """Mean value per class and grid point from the points of users with a known ``class``.

    Each user is reduced to one row per grid point before the classes are looked up.
    """
    sums = [F.sum(a).alias(f"s_{a}") for a in AXES]
    per_user = points.groupBy(on, "k").agg(*sums, F.count(F.lit(1)).alias("n"))
    known = join_dimension(per_user, classes.select(on, "class"), [on], "inner")
    return known.groupBy("class", "k").agg(*((F.sum(f"s_{a}") / F.sum("n")).alias(f"c_{a}") for a in AXES))


def points_of(samples: DataFrame, keys) -> DataFrame:
    """Grid points of samples, one row each."""
    zipped = F.arrays_zip(*(F.col(a) for a in AXES))
    return samples.select(*keys, "segment_no", F.posexplode(zipped).alias("k", "point")).select(
        *keys, "segment_no", "k", "point.*"
    )


def scorer(centers: DataFrame, keys=("userID",)) -> Callable[[DataFrame], DataFrame]:
    """A function that adds ``probabilities`` to samples, ``softmax(-d2)`` over the classes in id order.

    Up to ``MAX_CLASSES`` centroids go to the executors as arrays and nothing is shuffled; samples meet more
    classes than that by grid position (``score_by_position``).
    """
    axes = F.struct("k", *(f"c_{a}" for a in AXES))
    packed = centers.groupBy("class").agg(F.array_sort(F.collect_list(axes)).alias("grid"))
    known = packed.orderBy("class").limit(MAX_CLASSES + 1).collect()
    if len(known) > MAX_CLASSES:
        return lambda samples: score_by_position(samples, centers, keys)
    grids = np.full((len(known), len(AXES), GRID_POINTS), np.nan)
    for i, row in enumerate(known):
        for point in row.grid:
            grids[i, :, point[0]] = point[1:]

    @F.pandas_udf("array<double>")
    def probabilities(x: pd.Series, y: pd.Series, z: pd.Series) -> pd.Series:
        if x.empty or not len(grids):
            return pd.Series([[]] * len(x), dtype=object)
        batch = np.stack([np.stack(axis.tolist()) for axis in (x, y, z)], axis=1)
        # One class at a time, so that memory follows the batch and not the number of classes.
        d2 = np.stack([np.nansum((batch - grid) ** 2, axis=(1, 2)) for grid in grids], axis=1)
        weights = np.exp(d2.min(axis=1, keepdims=True) - d2)
        return pd.Series(list(weights / weights.sum(axis=1, keepdims=True)))

    return lambda samples: samples.withColumn("probabilities", probabilities(*AXES)).drop(*AXES)


def score_centroids(samples: DataFrame, centers: DataFrame, keys=("userID",)) -> DataFrame:
    """``samples`` with class probabilities, from the centroids ``centers``."""
    return scorer(centers, keys)(samples)


def score_by_position(samples: DataFrame, centers: DataFrame, keys) -> DataFrame:
    """As ``scorer`` for any number of classes: points meet the centroids of their own grid position.

    A segment is compared with each class once; the distances are summed before anything is shuffled.
    """
    salts = 64  # Spreads the few grid positions over more join keys.
    points = points_of(samples, keys)
    points = points.withColumn("salt", F.pmod(F.xxhash64(*keys, "segment_no"), F.lit(salts)).cast("int"))
    centers = centers.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    gaps = [F.col(axis) - F.col(f"c_{axis}") for axis in AXES]
    d2 = sum((gap * gap for gap in gaps[1:]), gaps[0] * gaps[0])
    segment = [*keys, "segment_no"]
    distances = points.join(centers, ["k", "salt"]).groupBy(*segment, "class").agg(F.sum(d2).alias("d2"))
    ranked = distances.groupBy(*segment).agg(F.array_sort(F.collect_list(F.struct("class", "d2"))).alias("all"))
    nearest = F.array_min(F.col("all.d2"))
    weights = ranked.select(*segment, F.transform(F.col("all.d2"), lambda d: F.exp(nearest - d)).alias("w"))
    total = F.aggregate("w", F.lit(0.0), lambda a, x: a + x)
    return weights.select(*segment, F.transform("w", lambda x: x / total).alias("probabilities"))


def named(inferences: DataFrame, identities: DataFrame) -> DataFrame:
    """Add ``inferred_users_name`` and ``known``; ids without a name stay, with a NULL name."""
    names = identities.select("inferred_user_id", "inferred_users_name", F.lit(True).alias("_known"))
    joined = join_dimension(inferences, names, ["inferred_user_id"])
    return joined.withColumn("known", F.coalesce("_known", F.lit(False))).drop("_known")
