"""Hand-worked cases."""

import json

import pytest
from data import events, first_fixture, frame
from pyspark.sql import functions as F

from stepwave.functions.vectors import best_class, confidence, from_text, norm, tensor, to_text
from stepwave.operators import peaks, resample, segments, sessions
from stepwave.sources import envelopes, lines


@pytest.mark.parametrize("max_rows", [500, 4])
@pytest.mark.parametrize(
    "step, expected, bounds",
    [(300, [7, 13, 19, 25], [(1, 8, 19), (2, 14, 25)]), (500, [5, 11, 17, 23], [(1, 6, 17), (2, 12, 23)])],
)
def test_peaks_and_segments(spark, step, expected, bounds, max_rows):
    data = peaks.by_user(frame(spark, first_fixture(step)), None, max_rows)
    found = peaks.numbered_peaks(peaks.cycle_peaks(data)).rows.orderBy("cycle").collect()
    assert [r["index"] for r in found] == expected
    rows = segments.segments(data).groupBy("segment_no").agg(F.min("index"), F.max("index"), F.count("*"))
    assert sorted(map(tuple, rows.collect())) == [(*b, 12) for b in bounds]


def test_local_maxima_skip_warmup(spark):
    data = peaks.by_user(frame(spark, first_fixture()))
    found = sorted(r["index"] for r in peaks.local_maxima(data).rows.collect())
    assert found == [2, *range(5, 28, 2)]
    clean = sorted(r["index"] for r in peaks.local_maxima(data, skip_warmup=False).rows.collect())
    assert clean == [3, *range(5, 28, 2)]


def test_grid_starts_at_midnight(spark):
    day = 1_574_812_800_000
    times, values = (5, 6, 10, 305), (0.0, 1.0, 3.0, 150.0)
    rows = spark.createDataFrame(
        [("u", 1, day + t, day + 5, day + 305, v, v, v) for t, v in zip(times, values)],
        "userID string, segment_no bigint, timeMs bigint, first_ms bigint, last_ms bigint, "
        "accX double, accY double, accZ double",
    )
    found = resample.resampled(rows, ("userID",)).orderBy("k").collect()
    assert [r.k for r in found] == list(range(128))
    assert [r.accX for r in found] == pytest.approx(list(range(128)), abs=1e-9)


@pytest.mark.parametrize("size", [1, 4, 8])
def test_too_few_rows(spark, size):
    data = peaks.by_user(frame(spark, first_fixture()[:size]))
    assert peaks.cycle_peaks(data).rows.count() == 0 or size > 4
    assert segments.segments(data).count() == 0


def test_short_segment_goes_to_diagnostics(spark):
    rows = spark.createDataFrame(
        [("u", 1, 10 + t, 10, 110, 1.0, 1.0, 1.0) for t in (0, 50, 100)],
        "userID string, segment_no bigint, timeMs bigint, first_ms bigint, last_ms bigint, "
        "accX double, accY double, accZ double",
    )
    assert resample.resampled(rows, ("userID",)).count() == 0
    assert [tuple(r) for r in resample.too_short(rows, ("userID",)).collect()] == [("u", 1, 10, 110)]


def test_repeated_index_counts_once_in_a_scope(spark):
    rows = first_fixture()
    rows[19]["index"] = 7
    found = peaks.cycle_peaks(peaks.by_user(frame(spark, rows), 10_000)).rows.collect()
    assert sorted((r["index"], r["timeMs"]) for r in found) == [(7, 2100), (13, 3900), (25, 7500)]
    whole = peaks.cycle_peaks(peaks.by_user(frame(spark, rows))).rows.collect()
    assert len(whole) == 4


def test_bad_lines(spark):
    good = ["195, 2, 1574839747019, -1.087339, 6.710845, 7.041358, 9.787669", "1, 2, 3, 0, 0, 0, 4, 9", " 7 , 2 , 3 ,0,0,0,4 "]
    bad = ["", "195, 2", "x, 2, 1, 0, 0, 0, 0", "1, 2, 3, 0, 0, 0, nope", "1,2,3,0,0,0,NaN", "1,2,3,0,0,0,4d", "1, ,3,0,0,0,4"]
    payload = spark.createDataFrame([("\n".join([good[0], *bad, *good[1:]]),)], "value string")
    parsed = lines.parsed(lines.split_lines(payload))
    assert sorted(r["index"] for r in lines.good(parsed).collect()) == [1, 7, 195]
    assert sorted(r.value for r in lines.quarantined(parsed).collect()) == sorted(bad)


def test_documented_norms(spark):
    rows = [(-1.087339, 6.710845, 7.041358, 9.787669), (-1.403481, 4.89542, 8.473579, 9.886174)]
    found = spark.createDataFrame(rows, "x double, y double, z double, v double").select(
        F.round(norm(F.col("x"), F.col("y"), F.col("z")), 6) == F.col("v")
    )
    assert [r[0] for r in found.collect()] == [True, True]


def test_lifecycle(spark):
    kinds = ["connect", "point", "point", "stop", "connect", "inference", "point", "inference"]
    rows = [{"userID": "A", "index": i, "timeMs": i, "kind": k} for i, k in enumerate(kinds)]
    rows.append({"userID": "B", "index": 90, "timeMs": 90, "kind": "stop"})
    data = events(spark, rows)
    assert sorted((r.session_no, r.counter) for r in sessions.session_points(data).collect()) == [(0, 1), (0, 2), (1, 1)]
    assert sorted((r["index"], r.accepted) for r in sessions.attributed(data).collect()) == [(5, False), (7, True)]
    assert [tuple(r) for r in sessions.online_users(data).collect()] == [("A", 1, 1)]
    assert [r.userID for r in sessions.online_ids(data).collect()] == ["A"]
    lists = [(r["index"], r.session_no, r.position, r.open) for r in sessions.inference_lists(data).collect()]
    assert lists == [(7, 1, 1, True)]
    connected = sessions.online_users(events(spark, rows[:1]))
    assert connected.count() == 0
    messages = {(r.userID, r.session_no): r.n_messages for r in sessions.session_messages(data).collect()}
    assert messages == {("A", 0): 3, ("A", 1): 2, ("B", 0): 0}  # inferences reach no connection


def test_first_class_wins_a_tie(spark):
    p = spark.createDataFrame([([0.1, 0.7, 0.7],)], "p array<double>")
    assert tuple(p.select(best_class(F.col("p")), confidence(F.col("p"))).first()) == (2, 0.7)


def test_order_check_restarts_per_message(spark):
    def message(*indexes):
        return json.dumps({"event": "gait", "data": {"uuid": "q", "gait": [i and f"{i}, u, {9 - i}, 0, 0, 0, 0" for i in indexes]}})

    rows = spark.createDataFrame([(1, message(1, 2, 5, "", 4, 6)), (2, message(1, 2))], "m int, value string")
    points = envelopes.points(envelopes.decoded(rows).drop("value"))
    found = envelopes.order_violations(points).select("m", "pos", "current", "last")
    assert [tuple(r) for r in found.collect()] == [(1, 4, 4, 5)]
    by_time = envelopes.order_violations(points, field=2).select("m", "current")
    assert sorted(map(tuple, by_time.collect())) == [(1, 3), (1, 4), (1, 7), (2, 7)]


def test_vector_text_and_tensor(spark):
    row = spark.createDataFrame([([0.123456789, 1e-8, -2.0], [1.0, 2.0, 3.0], [4.0, 5.0, 6.0])], "x array<double>, y array<double>, z array<double>")
    text = row.select(to_text(F.col("x")).alias("t")).first().t
    assert [float(v) for v in text.split(" ")] == [0.12345679, 1e-8, -2.0]
    back = row.select(from_text(F.lit(" 0.5 1.5 "))).first()[0]
    assert back == [0.5, 1.5]
    grid = row.select(tensor(F.col("x"), F.col("y"), F.col("z"), 3)).first()[0]
    assert grid[1] == pytest.approx([1e-8, 2.0, 5.0, 0.0, 0.0, 0.0])
    assert [len(p) for p in grid] == [6, 6, 6]
