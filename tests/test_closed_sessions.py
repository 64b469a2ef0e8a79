"""Closed sessions out of a stream are those of the batch operator."""

import json
import random
import time

from pyspark.sql import functions as F

from stepwave.operators import sessions
from stepwave.schema import POINTS_FIELD
from stepwave.sources import envelopes
from stepwave.streaming import closed_sessions

SCHEMA = "arrival bigint, message bigint, value string"


def point(index, user="u"):
    return f"{index}, {user}, {index * 10}, 1.5, 2.5, 3.5, 4.5"


def sent(arrival, message, uuid, event, points=None):
    return arrival, message, json.dumps({"event": event, "data": {"uuid": uuid, POINTS_FIELD: points}})


def chatter(seed, connections, n):
    """Messages in the order of their arrival; several of one connection may share one, with a stop last."""
    rng, rows, index = random.Random(seed), [], 0
    for message in range(n):
        uuid, arrival = rng.choice(connections), message // 4
        event = rng.choices(["gait", "stop", "connect"], [8, 1, 1])[0]
        points = []
        for _ in range(rng.randrange(4)):
            points.append(rng.choice(["", "no reading", point(index), point(index)]))
            index += 1
        rows.append(sent(arrival, message, uuid, event, points if event == "gait" else None))
    return rows


def started(spark, tmp_path, sink):
    files = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    rows = closed_sessions.session_rows(envelopes.decoded(files), message="message")
    writer = closed_sessions.each_closed_session(rows, sink, str(tmp_path / "checkpoint"), None)
    assert writer.start().awaitTermination(300)


def landed(tmp_path, number, rows):
    (tmp_path / "in").mkdir(exist_ok=True)
    text = "\n".join(json.dumps(dict(zip(("arrival", "message", "value"), row))) for row in rows)
    (tmp_path / "in" / f"part-{number}.json").write_text(text + "\n")


def found(df):
    return sorted(tuple(row[c] for c in ("uuid", "session_no", "place", "index", "userID")) for row in df.collect())


def test_sessions_match_batch(spark, tmp_path):
    """Sessions spread over batches and restarts, from batches that know nothing of the order inside them."""
    rows = chatter(5, ["a", "b", "c"], 160) + [(50, 900, json.dumps({"event": "stop", "data": {}})), (50, 901, "{")]
    rng = random.Random(1)
    for number in range(4):
        part = rows[number * 40 : number * 40 + 40 if number < 3 else None]
        landed(tmp_path, number, rng.sample(part, len(part)))
        started(spark, tmp_path, lambda df, n: df.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}"))
    got = spark.read.parquet(str(tmp_path / "out"))
    expected = sessions.closed_readings(envelopes.decoded(spark.createDataFrame(rows, SCHEMA)), message="message")
    assert found(got) == found(expected)
    spread = got.groupBy("uuid").agg(F.countDistinct("batch").alias("n")).filter("n > 1")
    assert not got.isEmpty() and not spread.isEmpty()


def test_a_session_over_three_batches_is_exported_once(spark, tmp_path):
    out = str(tmp_path / "out")
    seen = []

    def twice(rows, number):
        seen.append(rows.count())
        for _ in range(2):  # as after a failure behind the write
            closed_sessions.exported(out)(rows, number)

    landed(tmp_path, 0, [sent(1, 1, "a", "gait", [point(0), point(1)])])
    started(spark, tmp_path, twice)
    landed(tmp_path, 1, [sent(2, 2, "a", "gait", [point(2)]), sent(2, 3, "b", "gait", [point(9)])])
    started(spark, tmp_path, twice)
    landed(tmp_path, 2, [sent(3, 4, "a", "stop"), sent(4, 5, "a", "gait", [point(3)])])
    started(spark, tmp_path, twice)
    assert sum(seen) == 3
    rows = spark.read.csv(f"{out}/batch=*", header=True)
    files = spark.read.option("basePath", out).option("header", True).csv(out)
    assert sorted(int(r["index"]) for r in rows.collect()) == [0, 1, 2]
    assert [r.uuid for r in files.select("uuid").distinct().collect()] == ["a"]


def test_silent_connections_end(spark, tmp_path):
    landed(tmp_path, 0, [sent(1, 1, "a", "gait", [point(0), point(1)])])
    files = spark.readStream.schema(SCHEMA).json(str(tmp_path / "in"))
    rows = closed_sessions.session_rows(envelopes.decoded(files), message="message", idle_ms=100)
    query = (
        rows.writeStream.format("memory").queryName("silent").option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(processingTime="1 second").start()
    )
    try:
        until = time.time() + 90
        while time.time() < until and spark.table("silent").isEmpty():
            time.sleep(1)
        shown = spark.table("silent").collect()
    finally:
        query.stop()
    assert sorted((r.uuid, r.session_no, r.place, r.closed) for r in shown) == [("a", 0, 1, False), ("a", 0, 2, False)]


def test_many_connections_share_few_states(spark, tmp_path):
    """Connections of one group, some of which end: the others stay in the parts that these leave."""
    names = [f"c{i}" for i in range(60)]
    rows = chatter(8, names, 400)
    for number in range(2):
        landed(tmp_path, number, rows[number * 200 : number * 200 + 200])
    files = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    stream = closed_sessions.session_rows(envelopes.decoded(files), message="message", groups=3)
    to = lambda df, n: df.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}")
    checkpoint = str(tmp_path / "checkpoint")
    assert closed_sessions.each_closed_session(stream, to, checkpoint, None).start().awaitTermination(300)
    assert spark.read.format("statestore").option("stateVarName", "entry").load(checkpoint).count() == 3
    expected = sessions.closed_readings(envelopes.decoded(spark.createDataFrame(rows, SCHEMA)), message="message")
    assert found(spark.read.parquet(str(tmp_path / "out"))) == found(expected) != []
