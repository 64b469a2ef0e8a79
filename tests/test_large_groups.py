"""Sequence operators against plain Python, with groups far above the size that one task takes."""

import plain
import pytest
from data import connection_events, events, frame, walk
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stepwave.operators import feed, joins, ordered, peaks, segments, sessions
from stepwave.plans import pipeline

SIZES = {"hot": 900, "a": 60, "b": 7, "c": 3, "d": 1}
LIMITS = [100_000, 12]


@pytest.fixture(scope="module", params=[(1, (1, 400)), (3, (1, 5000))])
def rows(request):
    seed, step = request.param
    return walk(seed, SIZES, step)


def ids(groups):
    return sorted((key, r["index"]) for key, found in groups.items() for r in found)


@pytest.mark.parametrize("max_rows", LIMITS)
@pytest.mark.parametrize("gap", [0, 1000, 20_000])
def test_cycle_peaks(spark, rows, gap, max_rows):
    data = peaks.by_user(frame(spark, rows), None, max_rows)
    found = peaks.numbered_peaks(peaks.cycle_peaks(data, gap)).rows.collect()
    expected = {k: plain.cycle_peaks(g, gap) for k, g in plain.grouped(rows).items()}
    assert sorted(((r.userID,), r["index"]) for r in found) == ids(expected)
    numbers = {(k, r["index"]): i for k, g in expected.items() for i, r in enumerate(g, 1)}
    assert {((r.userID,), r["index"]): r.cycle for r in found} == numbers


@pytest.mark.parametrize("max_rows", LIMITS)
@pytest.mark.parametrize("skip", [True, False])
def test_local_maxima(spark, rows, skip, max_rows):
    data = peaks.by_user(frame(spark, rows), None, max_rows)
    found = peaks.local_maxima(data, skip).rows.collect()
    expected = {k: plain.local_maxima(g, skip) for k, g in plain.grouped(rows).items()}
    assert sorted(((r.userID,), r["index"]) for r in found) == ids(expected)


@pytest.mark.parametrize("max_rows", LIMITS)
def test_cycle_numbers_and_strongest(spark, rows, max_rows):
    data = peaks.by_user(frame(spark, rows), None, max_rows)
    numbers = {r["index"]: r.cycle for r in segments.cycle_numbers(data, 1000).collect()}
    strongest = sorted((r.userID, r.cycle, r["index"]) for r in peaks.strongest_per_cycle(data, 1000).collect())
    expected, best = {}, []
    for (user,), group in plain.grouped(rows).items():
        found = [p["index"] for p in plain.cycle_peaks(group, 1000)]
        cycle = 0
        for r in group:
            expected[r["index"]] = cycle
            cycle += r["index"] in found
        tops = {}
        for r in plain.local_maxima(group):
            c = expected[r["index"]] + 1
            if c <= len(found) and (c not in tops or r["vSum"] > tops[c]["vSum"]):
                tops[c] = r
        best += [(user, c, r["index"]) for c, r in tops.items()]
    assert numbers == expected
    assert strongest == sorted(best)


@pytest.mark.parametrize("max_rows", LIMITS)
@pytest.mark.parametrize("gap", [1000, 20_000])
def test_segments_and_grid(spark, rows, gap, max_rows):
    data = peaks.by_user(frame(spark, rows), None, max_rows)
    found = {}
    for r in segments.segments(data, gap).collect():
        found.setdefault((r.userID, r.segment_no), []).append((r.timeMs, r["index"], r.first_ms, r.last_ms))
    expected = {}
    for (user,), group in plain.grouped(rows).items():
        for i, s in enumerate(plain.segments(group, gap), 1):
            expected[user, i] = s
    ends = {k: (s[0]["timeMs"], s[-1]["timeMs"]) for k, s in expected.items()}
    assert {k: sorted(v) for k, v in found.items()} == {
        k: [(r["timeMs"], r["index"], *ends[k]) for r in s] for k, s in expected.items()
    }
    grid = {(r.userID, r.segment_no): r for r in pipeline.sample_vectors(frame(spark, rows), None, gap, max_rows).collect()}
    long_enough = {k: s for k, s in expected.items() if ends[k][1] - ends[k][0] >= 128}
    assert set(grid) == set(long_enough)
    for key, segment in long_enough.items():
        for axis in ("accX", "accY", "accZ"):
            assert grid[key][axis] == pytest.approx(plain.resampled(segment, axis), abs=1e-9)


@pytest.mark.parametrize("max_rows", LIMITS)
def test_scoped_peaks(spark, rows, max_rows):
    scope = 30_000
    data = peaks.by_user(frame(spark, rows), scope, max_rows)
    found = sorted(((r.scope, r.userID), r["index"]) for r in peaks.cycle_peaks(data).rows.collect())
    groups = plain.grouped([{**r, "scope": r["timeMs"] // scope} for r in rows], ("scope", "userID"))
    assert found == ids({k: plain.cycle_peaks(g, 1000) for k, g in groups.items()})


@pytest.mark.parametrize("max_rows", LIMITS)
@pytest.mark.parametrize("gap", [0, 200, 10_000])
def test_throttle_and_decimation(spark, rows, gap, max_rows):
    points = feed.live_feed(frame(spark, rows))
    groups = plain.grouped(rows)
    sent = feed.throttled(points, gap, max_rows).collect()
    assert sorted(((r.userID,), r["index"]) for r in sent) == ids({k: plain.throttled(g, gap) for k, g in groups.items()})
    nth = feed.every_nth(points, 7, max_rows).collect()
    assert sorted(((r.userID,), r["index"]) for r in nth) == ids({k: g[::7] for k, g in groups.items()})


@pytest.mark.parametrize("max_rows", LIMITS)
@pytest.mark.parametrize("seed", [1, 2])
def test_sessions(spark, seed, max_rows):
    rows = connection_events(seed, {"hot": 700, "x": 30, "y": 2, "z": 1})
    data = events(spark, rows)
    expected = plain.sessions(rows)
    points = {r["index"]: (r.session_no, r.counter) for r in sessions.session_points(data, max_rows).collect()}
    assert points == {i: v for i, v in expected.items() if len(v) == 2}
    told = {r["index"]: (r.session_no, r.accepted) for r in sessions.attributed(data, max_rows).collect()}
    assert told == {i: v[:2] for i, v in expected.items() if len(v) == 3}
    lists = {r["index"]: (r.session_no, r.position) for r in sessions.inference_lists(data, max_rows).collect()}
    assert lists == {i: (v[0], v[2]) for i, v in expected.items() if len(v) == 3 and v[1]}
    online = {r.userID for r in sessions.online_users(data, max_rows).collect()}
    assert online == {r.userID for r in sessions.online_ids(data).collect()}


@pytest.mark.parametrize("max_rows", [1000, 8])
def test_rows_without_user_and_empty_input(spark, max_rows):
    rows = walk(6, {"a": 40})
    nobody = [{**r, "userID": None, "index": 1000 + r["index"]} for r in rows]
    data = peaks.by_user(frame(spark, rows + nobody), None, max_rows)
    found = sorted(((r.userID,), r["index"]) for r in peaks.cycle_peaks(data, 300).rows.collect())
    assert found == ids({k: plain.cycle_peaks(g, 300) for k, g in plain.grouped(rows).items()})
    assert pipeline.sample_vectors(frame(spark, []), None, 300, max_rows).count() == 0
    assert sessions.session_points(events(spark, []), max_rows).count() == 0


def test_many_large_groups_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(ordered, "MAX_BROADCAST_GROUPS", 1)
    rows = walk(5, {"p": 200, "q": 150, "r": 100, "s": 4})
    data = peaks.by_user(frame(spark, rows), None, 20)
    found = sorted(((r.userID,), r["index"]) for r in peaks.cycle_peaks(data, 500).rows.collect())
    assert found == ids({k: plain.cycle_peaks(g, 500) for k, g in plain.grouped(rows).items()})


@pytest.mark.parametrize("max_rows", [1000, 10])
def test_frequent_keys_in_joins(spark, max_rows):
    left = spark.createDataFrame([("hot", i) for i in range(60)] + [("a", 1), ("b", 2), (None, 3)], "userID string, i int")
    right = spark.createDataFrame([("hot", 1), ("a", 2)], "userID string, v int")
    for how, count in (("left_semi", 61), ("left_anti", 2), ("left", 63)):
        assert joins.join_frequent(left, right, ["userID"], how, max_rows).count() == count
    joined = joins.join_frequent(left, right, ["userID"], "left", max_rows)
    assert {tuple(r) for r in joined.groupBy("userID", "v").count().collect()} == {
        ("hot", 1, 60), ("a", 2, 1), ("b", None, 1), (None, None, 1)
    }


@pytest.mark.parametrize("burst", [False, True])
def test_no_group_reaches_a_task_whole(spark, burst):
    rows = walk(9, {"hot": 1200, "a": 5}, ties=0.0)
    if burst:
        for r in rows[:900]:
            r["timeMs"] = 1_574_812_000_000 + r["timeMs"] % 2000
    data = peaks.by_user(frame(spark, rows), None, 50)
    sizes = data.rows.groupBy(*data.part).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 100 and sizes[1] >= 20
    found = sorted(((r.userID,), r["index"]) for r in peaks.cycle_peaks(data, 300).rows.collect())
    assert found == ids({k: plain.cycle_peaks(g, 300) for k, g in plain.grouped(rows).items()})


def test_pieces_are_split_further(spark, monkeypatch):
    monkeypatch.setattr(ordered, "PIECES", 4)
    rows = walk(4, {"hot": 1000, "a": 9})
    data = peaks.by_user(frame(spark, rows), None, 20)
    assert data.rows.agg(F.max("slices")).first()[0] > 40
    order = data.rows.filter("userID = 'hot'").orderBy("timeMs", "index").collect()
    assert [r.slice for r in order] == sorted(r.slice for r in order)
    found = sorted(((r.userID,), r["index"]) for r in peaks.cycle_peaks(data, 700).rows.collect())
    assert found == ids({k: plain.cycle_peaks(g, 700) for k, g in plain.grouped(rows).items()})


@pytest.mark.parametrize("copies", [2, 3, 5])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_first_line_repeated(spark, seed, copies):
    """Copies of the first row take positions of their own, however large the group is."""
    rows = walk(seed, {"hot": 60}, ties=0.0)
    rows += [min(rows, key=lambda r: r["timeMs"])] * (copies - 1)
    expected = [(r["timeMs"], r["index"]) for g in plain.grouped(rows).values() for r in plain.local_maxima(g)]
    for max_rows in (1000, 12):
        found = peaks.local_maxima(peaks.by_user(frame(spark, rows), None, max_rows)).rows.collect()
        assert sorted((r.timeMs, r["index"]) for r in found) == sorted(expected)


@pytest.mark.parametrize("max_rows", LIMITS)
def test_restarted_indexes(spark, max_rows):
    """A counter that starts again keeps the peaks of every run of it."""
    rows = [r | {"index": i % 30} for i, r in enumerate(sorted(walk(2, {"u": 90}, ties=0.0), key=lambda r: r["timeMs"]))]
    expected = [(r["timeMs"], r["index"]) for g in plain.grouped(rows).values() for r in plain.cycle_peaks(g, 300)]
    found = peaks.cycle_peaks(peaks.by_user(frame(spark, rows), None, max_rows), 300).rows.collect()
    assert sorted((r.timeMs, r["index"]) for r in found) == sorted(expected)
    assert len({i for _, i in expected}) < len(expected)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from("ab"), st.integers(0, 6000), st.integers(0, 9)), min_size=1, max_size=80
    ),
    st.integers(0, 1500),
    st.integers(2, 30),
)
def test_any_input(spark, points, gap, max_rows):
    rows = [
        {"index": i, "userID": u, "timeMs": t, "accX": 1.0, "accY": float(v), "accZ": 0.0, "vSum": float(v)}
        for i, (u, t, v) in enumerate(points)
    ]
    data = peaks.by_user(frame(spark, rows), None, max_rows)
    expected = {k: plain.cycle_peaks(g, gap) for k, g in plain.grouped(rows).items()}
    found = peaks.cycle_peaks(data, gap).rows.collect()
    assert sorted(((r.userID,), r["index"]) for r in found) == ids(expected)
    per_group = {k: len(v) for k, v in expected.items()}
    vectors = pipeline.sample_vectors(frame(spark, rows), None, gap, max_rows).collect()
    assert len(vectors) <= sum(max(0, n - 2) for n in per_group.values())
    assert all(r.accX == [1.0] * 128 for r in vectors)
