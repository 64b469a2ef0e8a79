"""Model files for ``score_with``: read once, sent once to each worker, opened once there."""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Callable
from types import ModuleType

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import AXES

# Workers get this module's functions themselves, so they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_MODEL_BYTES = 512 << 20
OPENED = "stepwave_opened_models"

Model = Callable[[np.ndarray], np.ndarray]


def model_file(
    spark: SparkSession, path: str, opened: Callable[[bytes], Model], max_bytes: int = MAX_MODEL_BYTES
) -> Callable[[], Model]:
    """A ``load`` for ``score_with`` from the one file that ``path`` (any Hadoop path or pattern) names.

    The bytes reach the workers as a broadcast and are opened there once for each content: two models read from
    equal files are one, and a file that was replaced is another.  A file above ``max_bytes`` is an error: a
    broadcast is held whole by driver and workers, so ship such a model with the cluster's files and give
    ``score_with`` a ``load`` of your own.
    """
    found = spark.read.format("binaryFile").load(path)
    sizes = [row.length for row in found.select("length").limit(2).collect()]
    if len(sizes) != 1:
        raise ValueError(f"{path} names {'no file' if not sizes else 'several files'}")
    if sizes[0] > max_bytes:
        raise ValueError(f"{path} holds {sizes[0]} bytes, above max_bytes={max_bytes}")
    content = bytes(found.select("content").first().content)
    key = f"{opened.__module__}.{opened.__qualname__} {hashlib.sha256(content).hexdigest()}"
    sent = spark.sparkContext.broadcast(content)

    def load() -> Model:
        # Functions are unpickled anew for every task; a module of its own lives as long as the worker.
        known = sys.modules.setdefault(OPENED, ModuleType(OPENED)).__dict__
        if key not in known:
            known[key] = opened(sent.value)
        return known[key]

    return load


def write_channel_model(centers: DataFrame, path: str, sharpness: float = 1.0) -> None:
    """A linear model of channel means from class centroids (``class, k, c_*``), as one JSON document.

    The logits are ``weights @ means + bias``, which rank classes by the distance of their centroids' channel means.
    It has one row of numbers for each class.
    """
    means = centers.groupBy("class").agg(*(F.avg(f"c_{a}").alias(a) for a in AXES))
    squares = sum((F.col(a) * F.col(a) for a in AXES[1:]), F.col(AXES[0]) * F.col(AXES[0]))
    row = F.struct(
        "class",
        F.array(*(F.lit(2 * sharpness) * F.col(a) for a in AXES)).alias("weights"),
        (F.lit(-sharpness) * squares).alias("bias"),
    )
    document = means.agg(F.to_json(F.array_sort(F.collect_list(row))).alias("value"))
    document.coalesce(1).write.text(path)


def open_channel_model(content: bytes) -> Model:
    """The model that ``write_channel_model`` wrote: probabilities of the classes in id order."""
    classes = sorted(json.loads(content), key=lambda c: c["class"])
    weights = np.array([c["weights"] for c in classes], np.float64).reshape(len(classes), -1)
    bias = np.array([c["bias"] for c in classes], np.float64)

    def predict(batch: np.ndarray) -> np.ndarray:
        means = batch[:, :, : weights.shape[1]].astype(np.float64).mean(axis=1)
        logits = means @ weights.T + bias
        scores = np.exp(logits - logits.max(axis=1, keepdims=True))
        return scores / scores.sum(axis=1, keepdims=True)

    return predict
