import json

import numpy as np
import pytest
from data import frame, reading, walk
from pyspark.sql import functions as F

from stepwave.operators import feed, scoring
from stepwave.operators.sessions import closed_readings, connection_messages, connection_points
from stepwave.plans import pipeline
from stepwave.schema import READING
from stepwave.session import cut
from stepwave.sinks.writers import export_sessions
from stepwave.sources import envelopes, lines


def messages(spark, *bodies):
    return spark.createDataFrame([(b if isinstance(b, str) else json.dumps(b),) for b in bodies], "value string")


def test_envelopes(spark):
    line = "195, 2, 1574839747019, -1.087339, 6.710845, 7.041358, 9.787669"
    decoded = envelopes.decoded(
        messages(
            spark,
            {"event": "connect", "data": {"uuid": "q"}},
            {"event": "gait", "data": {"uuid": "q", "gait": [line, "", None, line]}},
            {"event": "stop", "data": {"uuid": "q"}},
            {"event": "hello", "data": {"uuid": "q"}},
            "not json",
        )
    )
    assert [r.uuid for r in envelopes.connects(decoded).collect()] == ["q"]
    assert [(r.pos, r.point) for r in envelopes.points(decoded).orderBy("pos").collect()] == [(0, line), (3, line)]
    assert envelopes.others(decoded).count() == 2
    assert [r.uuid for r in envelopes.stops(decoded).collect()] == ["q"]
    arrived = decoded.withColumn("arrival", F.when(F.col("event") == "connect", 1).when(F.col("event") == "gait", 2).otherwise(3))
    rows = envelopes.connection_events(arrived.withColumn("arrival", F.col("arrival").cast("bigint")))
    found = sorted((r.timeMs, r["index"], r.userID, r.kind) for r in rows.collect())
    assert found == [(1, 0, "q", "connect"), (2, 0, "2", "point"), (2, 1, "2", "point"), (3, 0, "2", "stop")]
    named = envelopes.connection_events(arrived, fill_users=False).filter("kind = 'stop'")
    assert [r.userID for r in named.collect()] == [None]


def test_four_field_points(spark):
    points = spark.createDataFrame([("q", 0, "5, 1, 2, 2"), ("q", 1, "6, 0, 3, 4"), ("q", 2, "7, 0")], "uuid string, pos int, point string")
    parsed = lines.parsed_xyz4(points, position="pos")
    assert [(r["index"], r.userID, r.timeMs, r.vSum) for r in lines.good(parsed).orderBy("index").collect()] == [
        (0, "q", 5, 3.0),
        (1, "q", 6, 5.0),
    ]
    assert lines.quarantined(parsed, "point").count() == 1


def test_inference_records(spark):
    records = messages(
        spark,
        {"confidency": "0.98", "inferred_user_id": "1", "actual_user_id": "7"},
        {"confidency": 0.5, "inferred_user_id": 9, "actual_user_id": "8"},
        {"confidency": "high", "inferred_user_id": "x", "actual_user_id": "8"},
    )
    names = spark.createDataFrame([(1, "One"), (2, "Two")], "inferred_user_id int, inferred_users_name string")
    found = scoring.named(envelopes.inferences(records), names)
    rows = sorted((tuple(r) for r in found.select("confidency", "inferred_user_id", "actual_user_id", "inferred_users_name", "known").collect()), key=repr)
    assert rows == [(0.5, 9, "8", None, False), (0.98, 1, "7", "One", True), (None, None, "8", None, False)]


def test_session_export(spark, tmp_path):
    rows = walk(3, {"s": 200, "t": 20})
    points = frame(spark, rows).withColumn("uuid", F.concat(F.lit("id-"), "userID"))
    export_sessions(points, str(tmp_path / "x"))
    back = lines.reading_files(spark, str(tmp_path / "x" / "uuid=id-s"))
    assert back.schema == READING
    assert sorted(r["index"] for r in back.collect()) == sorted(r["index"] for r in rows if r["userID"] == "s")
    for path in (tmp_path / "x" / "uuid=id-s").glob("*.csv"):
        times = [int(text.split(",")[2]) for text in path.read_text().splitlines()[1:]]
        assert times == sorted(times)
    export_sessions(points.filter("userID = 't'"), str(tmp_path / "x"))
    assert lines.reading_files(spark, str(tmp_path / "x" / "uuid=id-t")).count() == 40


def test_session_export_into_few_folders(spark, tmp_path):
    rows = walk(3, {f"s{i}": 6 for i in range(30)})
    points = frame(spark, rows).withColumn("uuid", F.col("userID"))
    export_sessions(points, str(tmp_path / "x"), folders=4)
    assert len([p for p in (tmp_path / "x").iterdir() if p.name.startswith("folder=")]) <= 4
    back = spark.read.csv(str(tmp_path / "x"), header=True)
    assert back.count() == len(rows) and back.select("uuid").distinct().count() == 30


def test_feed_cursor_and_messages(spark):
    data = feed.live_feed(frame(spark, [reading(i, "u", i, 9.787669) for i in range(5)]))
    message = json.loads(feed.as_messages(data).filter("timeMs = 3").first().message)
    assert message == {"xyz": "9.787669", "timestamp": "3"}
    cursors = spark.createDataFrame([("u", 2)], "userID string, read_ms bigint")
    assert [(r["index"], r.backlog) for r in feed.front(data, cursors).collect()] == [(3, 2)]
    assert feed.tail(data, 3).count() == 1
    assert feed.every_nth(data).count() == 5


def test_model_hook_loads_once_and_sees_tensors(spark):
    grid = [[float(i) for i in range(128)]] * 3
    samples = spark.createDataFrame(
        [("u", i, *grid) for i in range(20)],
        "userID string, segment_no int, accX array<double>, accY array<double>, accZ array<double>",
    )

    def load():
        def predict(batch):
            assert batch.dtype == np.float32 and batch.shape[1:] == (128, 6) and not batch[:, :, 3:].any()
            return np.stack([batch[:, 0, 0], batch[:, 127, 0] / 200, batch[:, 1, 1] / 200], axis=1)

        return predict

    scored = scoring.with_choice(scoring.score_with(samples, load)).collect()
    assert {(r.inferred_user_id, round(r.confidency, 4)) for r in scored} == {(2, 0.635)}
    assert len(scored) == 20


@pytest.mark.parametrize("many", [False, True])
def test_centroid_scores(spark, monkeypatch, many):
    monkeypatch.setattr(scoring, "MAX_CLASSES", 1 if many else 100)
    rows = [("a", 1, k, 0.0, 0.0, 0.0) for k in range(128)] + [("b", 1, k, 0.1, 0.1, 0.1) for k in range(128)]
    points = spark.createDataFrame(rows, "userID string, segment_no bigint, k int, accX double, accY double, accZ double")
    classes = spark.createDataFrame([("a", 1), ("b", 2)], "userID string, class int")
    found = {r.userID: r for r in pipeline.identified(points, classes).collect()}
    p = 1 / (1 + np.exp(-3 * 128 * 0.01))
    assert found["a"].inferred_user_id == 1 and found["b"].inferred_user_id == 2
    assert found["a"].probabilities == pytest.approx([p, 1 - p])
    assert found["b"].probabilities == pytest.approx([1 - p, p])


def test_cut_keeps_rows(spark):
    assert cut(spark.range(10)).count() == 10


def test_points_without_uuid_keep_their_rows(spark):
    line = "7, q, 1000, 1, 2, 3, 4"
    rows = [(uuid, "gait", None, [line], at) for at, uuid in enumerate([None, "c", None])] + [("c", "stop", None, None, 5), (None, "stop", None, None, 6)]
    events = spark.createDataFrame(rows, "uuid string, event string, userid string, points array<string>, arrival long")
    found = sorted(((r.userID, r.timeMs, r.kind) for r in envelopes.connection_events(events).collect()), key=lambda r: r[1])
    assert found == [("q", 0, "point"), ("q", 1, "point"), ("q", 2, "point"), ("q", 5, "stop"), (None, 6, "stop")]


def test_messages_are_counted_before_their_points(spark):
    rows = [("c", "connect", 0), ("c", "gait", 1), ("c", "stop", 1), ("c", "gait", 2), (None, "gait", 2), ("d", None, 3)]
    messages = spark.createDataFrame(rows, "uuid string, event string, arrival long")
    for limit in (1000, 2):
        found = {(r.uuid, r.session_no): r.n_messages for r in connection_messages(messages, max_rows=limit).collect()}
        assert found == {("c", 0): 2, ("c", 1): 1, ("d", 0): 1}


@pytest.mark.parametrize("limit", [1000, 2])
def test_closed_sessions_reach_the_export(spark, tmp_path, limit):
    """Two messages of one arrival, an empty point, a bad point, a stop among them, a session still open."""
    def line(i):
        return f"{i}, u, {100 * i}, 1.0, 2.0, 3.0, 4.0"

    sent = [
        (1, 1, "connect", None), (2, 3, "gait", [line(3), "", line(4), "bad"]), (2, 2, "gait", [line(1), line(2)]),
        (2, 4, "stop", None), (3, 5, "gait", [line(5)]), (4, 6, "stop", None), (5, 7, "gait", [line(6)]),
        (6, 8, "hello", None), (None, 9, "gait", [line(7)]),
    ]
    bodies = [(a, n, json.dumps({"event": e, "data": {"uuid": "q", "gait": p}})) for a, n, e, p in sent]
    decoded = envelopes.decoded(spark.createDataFrame(bodies, "arrival long, message long, value string"))
    points = connection_points(decoded, message="message", max_rows=limit)
    places = {(r.session_no, r.place): (r.point.split(",")[0], r.closed) for r in points.collect()}
    assert places == {
        (0, 1): ("1", True), (0, 2): ("2", True), (0, 3): ("3", True), (0, 4): ("4", True), (0, 5): ("bad", True),
        (1, 1): ("5", True), (2, 1): ("6", False),
    }
    closed = closed_readings(decoded, message="message", max_rows=limit)
    for _ in range(2):  # a retried batch
        export_sessions(closed, str(tmp_path / "x"), batch=3)
    back = lines.reading_files(spark, str(tmp_path / "x" / "batch=3" / "uuid=q"))
    assert sorted(r["index"] for r in back.collect()) == [1, 2, 3, 4, 5]
