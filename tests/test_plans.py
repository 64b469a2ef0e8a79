"""Plans keep their shape: few shuffles, pruned scans, no pairwise joins."""

import re

import pytest
from data import frame, walk

from __spark_entry__ import queries
from stepwave.operators import feed, peaks
from stepwave.plans.pipeline import sample_vectors


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("readings") / "r")
    frame(spark, walk(1, {"a": 300, "b": 200})).write.parquet(path)
    return spark.read.parquet(path)


def test_no_pairwise_joins(spark, sf_dir):
    for name, query in queries().items():
        plan = plan_of(query(spark, sf_dir))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_vectors_shuffle_readings_twice_and_peaks_once(stored):
    plan = plan_of(sample_vectors(stored))
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\), (\w+)", plan)
    assert len(shuffles) == 3
    assert all(re.fullmatch(r"userID#\d+, \d+", keys) for keys, _ in shuffles)
    assert sum(kind == "REPARTITION_BY_COL" for _, kind in shuffles) == 1


def test_peaks_read_no_axes(stored):
    plan = plan_of(peaks.local_maxima(peaks.by_user(stored)).rows)
    assert plan.count("Exchange") == 1
    assert "accX" not in plan.split("ReadSchema")[1]


def test_scope_is_part_of_the_only_shuffle_key(stored):
    plan = plan_of(peaks.local_maxima(peaks.by_user(stored, 10_000)).rows)
    assert len(re.findall(r"Exchange hashpartitioning\(scope#\d+L?, userID#\d+", plan)) == plan.count("Exchange") == 1


def test_tail_filter_reaches_the_scan(stored):
    plan = plan_of(feed.tail(feed.live_feed(stored), 5))
    assert "GreaterThan(timeMs,5)" in plan
    assert "accX" not in plan


def test_front_aggregates_before_its_shuffle(stored):
    plan = plan_of(feed.front(feed.live_feed(stored)))
    assert plan.count("Exchange") == 1 and "partial_min_by" in plan


def test_scores_read_samples_once_and_shuffle_nothing(spark, sf_dir):
    plan = plan_of(queries()["score_centroid"](spark, sf_dir))
    assert "Exchange" not in plan and plan.count("Scan") == 1
