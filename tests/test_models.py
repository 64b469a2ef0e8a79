"""Model files: one file, checked size, opened once in a worker for each content."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from stepwave.operators import models, scoring
from stepwave.schema import AXES, GRID_POINTS


def vectors(spark, n):
    value = lambda k: F.array([F.col("id").cast("double") + k] * GRID_POINTS)
    return spark.range(n, numPartitions=1).select("id", *(value(k).alias(a) for k, a in enumerate(AXES)))


def counting(folder):
    """Opens a model whose probabilities tell nothing; every opening leaves a file in ``folder``."""

    def opened(content):
        import os
        import uuid

        open(os.path.join(folder, uuid.uuid4().hex), "w").close()
        share = float(content)
        return lambda batch: np.tile([share, 1 - share], (len(batch), 1))

    return opened


def test_opened_once_for_each_content(spark, tmp_path):
    (tmp_path / "opened").mkdir()
    opened = counting(str(tmp_path / "opened"))
    path = tmp_path / "model"
    for content, best, files in (("0.75", 1, 1), ("0.75", 1, 1), ("0.25", 2, 2)):
        path.write_text(content)
        load = models.model_file(spark, str(path), opened)
        scored = scoring.with_choice(scoring.score_with(vectors(spark, 5), load))
        assert [r.inferred_user_id for r in scored.collect()] == [best] * 5
        # One task at a time: an idle worker is taken again, and a second one opens the model once more at most.
        assert files <= len(list((tmp_path / "opened").iterdir())) <= 2 * files


def test_a_model_gets_bounded_batches(spark):
    """Memory follows ``MODEL_ROWS`` and not the rows of an Arrow batch; rows keep their order and values."""
    most, n = scoring.MODEL_ROWS, 2 * scoring.MODEL_ROWS + 7

    def load():
        def predict(batch):
            assert len(batch) <= most and batch.dtype == np.float32
            return np.stack([batch[:, 0, 0], batch[:, -1, 2], batch[:, 5, 4]], axis=1)

        return predict

    scored = scoring.score_with(vectors(spark, n), load).select("id", "probabilities").collect()
    assert {r.id: list(r.probabilities) for r in scored} == {i: [i, i + 2, 0] for i in range(n)}


def test_samples_without_a_value_have_no_choice(spark):
    gap = F.when(F.col("id") != 1, F.col("id").cast("double"))
    rows = spark.range(3, numPartitions=1).select("id", *(F.array([gap] * GRID_POINTS).alias(a) for a in AXES))
    share = lambda batch: np.stack([batch[:, 0, 0], batch[:, 0, 0] - 1], axis=1)
    scored = scoring.with_choice(scoring.score_with(rows, lambda: share)).collect()
    assert {r.id: (list(r.probabilities), r.inferred_user_id) for r in scored} == {0: ([0, -1], 1), 1: ([None, None], None), 2: ([2, 1], 1)}


def test_one_file_of_checked_size(spark, tmp_path):
    for name in "ab":
        (tmp_path / name).write_text("[]" * 10)
    with pytest.raises(ValueError, match="several files"):
        models.model_file(spark, str(tmp_path / "*"), models.open_channel_model)
    with pytest.raises(ValueError, match="above max_bytes"):
        models.model_file(spark, str(tmp_path / "a"), models.open_channel_model, max_bytes=19)
    models.model_file(spark, str(tmp_path / "a"), models.open_channel_model, max_bytes=20)


def test_channel_model_prefers_the_nearest_means():
    classes = [{"class": 2, "weights": [20.0, 0.0, 0.0], "bias": -100.0}, {"class": 1, "weights": [0.0] * 3, "bias": 0.0}]
    model = models.open_channel_model(json.dumps(classes).encode())
    batch = np.zeros((3, GRID_POINTS, 6), np.float32)
    batch[1, :, 0], batch[2, :, 0] = 10, 5
    scores = model(batch)
    assert scores.argmax(axis=1)[:2].tolist() == [0, 1]
    assert scores[2] == pytest.approx([0.5, 0.5])
    assert scores.sum(axis=1) == pytest.approx(1)
