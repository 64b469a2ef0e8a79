"""Streams give the same rows as the batch operators."""

import os

import pytest
from data import connection_events, events, frame, walk
from pyspark.sql import functions as F

from stepwave.operators import resample, scoring
from stepwave.plans.pipeline import grid_points
from stepwave.schema import READING_FIELDS
from stepwave.session import cut
from stepwave.sinks.writers import to_line, write_inferences
from stepwave.sources import lines
from stepwave.streaming import lifecycle, scopes

SCOPE = 30_000


def chunked(folder, texts):
    for i, text in enumerate(texts):
        path = os.path.join(folder, f"part-{i:03}.txt")
        with open(path, "w") as out:
            out.write(text)
        os.utime(path, (1_600_000_000 + i, 1_600_000_000 + i))


def chunks_of(rows, size):
    """Lines in time order, cut so that users and scopes are split over chunks."""
    ordered = sorted(rows, key=lambda r: (r["timeMs"], r["index"]))
    texts = [", ".join(str(r[f]) for f in READING_FIELDS) for r in ordered]
    return ["\n".join(texts[i : i + size]) + "\n" for i in range(0, len(texts), size)]


@pytest.fixture
def rows():
    return walk(11, {"a": 500, "b": 400, "c": 3}, (1, 300), ties=0.0)


def grid_rows(df):
    fields = ("scope", "userID", "segment_no", "k")
    return {tuple(r[f] for f in fields): (r.accX, r.accY, r.accZ) for r in df.collect()}


def test_complete_scopes_match_batch(spark, rows, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    last = max(r["timeMs"] for r in rows)
    closing = f"999999, closer, {last + 10 * SCOPE}, 0, 0, 0, 0\n"
    chunked(source, [*chunks_of(rows, 170), "broken line\n" + closing, "\n"])
    readings = scopes.readings_of(lines.line_stream(spark, str(source), max_files=1))
    out = str(tmp_path / "out")

    def sink(df, number):
        df.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = scopes.each_scope(
        readings,
        sink,
        str(tmp_path / "checkpoint"),
        str(tmp_path / "held"),
        scopes.grid_per_scope(1000, SCOPE),
        None,
        SCOPE,
    ).start()
    assert query.awaitTermination(300)
    found = spark.read.parquet(out)
    assert found.select("batch").distinct().count() > 1
    expected = grid_rows(grid_points(frame(spark, rows), SCOPE, 1000))
    got = grid_rows(found)
    assert expected and set(got) == set(expected)
    assert all(got[k] == pytest.approx(expected[k], abs=1e-9) for k in expected)
    assert found.count() == len(got)


def test_lines_to_inferences(spark, rows, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    closing = f"999999, closer, {max(r['timeMs'] for r in rows) + 10 * SCOPE}, 0, 0, 0, 0\n"
    chunked(source, [*chunks_of(rows, 400), closing, "\n"])
    classes = spark.createDataFrame([("a", 1), ("b", 2)], "userID string, class int")
    points = grid_points(frame(spark, rows), SCOPE, 1000)
    centers = cut(scoring.centroids(points, classes))
    stream = scopes.readings_of(lines.line_stream(spark, str(source), max_files=1))
    out = str(tmp_path / "out")
    query = scopes.each_scope(
        stream,
        lambda df, n: write_inferences(df, out, n),
        str(tmp_path / "checkpoint"),
        str(tmp_path / "held"),
        scopes.scores_per_scope(centers, 1000, SCOPE),
        None,
        SCOPE,
    ).start()
    assert query.awaitTermination(300)
    keys = ("scope", "userID")
    scored = scoring.with_choice(scoring.score_by_position(resample.samples(points, keys), centers, keys))
    expected = sorted((r.userID, r.inferred_user_id, round(r.confidency, 9)) for r in scored.collect())
    found = spark.read.parquet(out).collect()
    assert expected
    assert sorted((r.actual_user_id, r.inferred_user_id, round(r.confidency, 9)) for r in found) == expected


@pytest.mark.parametrize("apart", [True, False])
def test_every_reading_is_accounted_for(spark, tmp_path, apart):
    """A clock far ahead closes nothing; late readings and those ahead go to their own outputs or are kept."""
    source = tmp_path / "in"
    source.mkdir()
    start = 1_574_812_800_000
    normal = [f"{i}, {u}, {start + 50 * i}, 0, 0, 0, {i % 7}" for i in range(400) for u in "ab"]
    ahead = [f"900, c, {start + 10**10}, 0, 0, 0, 1"]
    late = [f"{1000 + i}, a, {start + i}, 0, 0, 0, 2" for i in range(5)]
    closing = [f"2000, z, {start + 600_000}, 0, 0, 0, 0"]
    parts = [normal[:400], ahead, normal[400:], late, closing, late[:2]]
    chunked(source, ["\n".join(p) for p in parts])
    out = {"over": {}, "late": {}, "ahead": {}}

    def into(name):
        def sink(df, number):
            out[name][number] = [(r["index"], r.userID, r.timeMs) for r in df.collect()]

        return sink

    files = lines.line_stream(spark, str(source), max_files=1)
    arrived = F.when(~F.col("value").contains(", b,"), F.timestamp_millis(F.lit(start + 700_000)))  # null for some
    readings = scopes.readings_of(files.withColumn("arrival", arrived))
    others = {"late": into("late"), "quarantine": into("ahead")} if apart else {}
    query = scopes.each_scope(
        readings, into("over"), str(tmp_path / "c"), str(tmp_path / "held"), None, None, 1000, **others
    ).start()
    assert query.awaitTermination(300)
    held = spark.read.parquet(str(tmp_path / "held" / f"slot={(len(parts) - 1) % 2}" / "rows")).collect()
    flat = {name: sum(found.values(), []) for name, found in out.items()}
    everything = sorted(sum(flat.values(), []) + [(r["index"], r.userID, r.timeMs) for r in held])
    wanted = ", ".join(str(x) for x in sum(([*p] for p in parts), [])).split(", ")
    rows = [wanted[i : i + 7] for i in range(0, len(wanted), 7)]
    assert everything == sorted((int(r[0]), r[1], int(r[2])) for r in rows)
    if apart:
        assert [r[1] for r in flat["ahead"]] == ["c"] and len(flat["late"]) == 7
        assert {r.userID for r in held} == {"z"} and len(flat["over"]) == 800
    else:
        assert {r.userID for r in held} == {"c", "z"} and len(flat["over"]) == 807


@pytest.mark.parametrize("apart", [True, False])
def test_readings_without_a_time(spark, tmp_path, apart):
    schema = "index long, userID string, timeMs long, accX double, accY double, accZ double, vSum double, arrival timestamp"
    source, held = str(tmp_path / "in"), str(tmp_path / "held")
    for part in ([(1, "a", 500), (2, "a", None)], [(3, "a", None), (4, "a", 5000)]):
        rows = [(i, u, t, 0.0, 0.0, 0.0, 0.0, None) for i, u, t in part]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    out = {"over": [], "late": [], "quarantine": []}

    def into(name):
        return lambda df, n: out[name].extend((r["index"], r.asDict().get("problem")) for r in df.collect())

    others = {name: into(name) for name in ("late", "quarantine")} if apart else {}
    query = scopes.each_scope(stream, into("over"), str(tmp_path / "c"), held, None, None, 1000, **others).start()
    assert query.awaitTermination(120)
    assert [r["index"] for r in spark.read.parquet(f"{held}/slot=1/rows").collect()] == [4]
    if apart:
        assert out == {"over": [(1, None)], "late": [], "quarantine": [(2, "no time"), (3, "no time")]}
    else:
        assert sorted(out["over"]) == [(1, None), (2, None), (3, None)]


def test_batch_as_scope_and_restart(spark, rows, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    parts = chunks_of(rows, 300)
    chunked(source, parts[:2])
    out, checkpoint = {}, str(tmp_path / "checkpoint")

    def sink(df, number):
        out[number] = sorted((r.userID, r.segment_no, r.k) for r in df.select("userID", "segment_no", "k").collect())

    def run():
        stream = scopes.readings_of(lines.line_stream(spark, str(source), max_files=1))
        query = scopes.each_batch(stream, sink, checkpoint, scopes.grid_per_batch(500), None).start()
        assert query.awaitTermination(300)

    run()
    assert len(out) == 2
    chunked(source, parts)
    run()
    assert len(out) == len(parts)
    for number, part in enumerate(parts):
        payload = spark.createDataFrame([(part,)], "value string")
        batch = grid_points(scopes.readings_of(payload), None, 500)
        assert out[number] == sorted((r.userID, r.segment_no, r.k) for r in batch.collect())


def test_rejected_lines_of_a_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    chunked(source, ["1, u, 2, 0, 0, 0, 4\nbad\n", "1, u\n"])
    seen = []
    stream = scopes.rejected_of(lines.line_stream(spark, str(source)))
    query = scopes.each_batch(
        stream, lambda df, n: seen.extend(r.value for r in df.collect()), str(tmp_path / "c"), None, None
    ).start()
    assert query.awaitTermination(120)
    assert sorted(seen) == ["1, u", "bad"]


def test_lifecycle_matches_batch(spark, tmp_path):
    from stepwave.operators import sessions

    rows = connection_events(3, {"u": 120, "v": 40, "w": 2})
    source = str(tmp_path / "in")
    ordered = sorted(rows, key=lambda r: (r["timeMs"], r["index"]))
    for i in range(0, len(ordered), 30):
        events(spark, ordered[i : i + 30]).coalesce(1).write.mode("append").parquet(source)
    batch = events(spark, rows)
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(source)
    out = str(tmp_path / "out")
    query = scopes.each_batch(
        lifecycle.tracked(stream),
        lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}"),
        str(tmp_path / "c"),
        None,
        None,
    ).start()
    assert query.awaitTermination(300)
    found = spark.read.parquet(out)
    assert found.count() == len(rows)
    points = {tuple(r) for r in found.filter("kind = 'point'").select("userID", "session_no", "counter", "index", "timeMs").collect()}
    assert points == {tuple(r) for r in sessions.session_points(batch).collect()}
    told = {(r["index"], r.accepted) for r in found.filter("kind = 'inference'").collect()}
    assert told == {(r["index"], r.accepted) for r in sessions.attributed(batch).collect()}
    lists = {(r["index"], r.session_no, r.position) for r in found.filter("accepted").collect()}
    assert lists == {(r["index"], r.session_no, r.position) for r in sessions.inference_lists(batch).collect()}


def test_retried_batch_adds_nothing(spark, tmp_path):
    scored = spark.createDataFrame([("u", 0.9, 2)], "userID string, confidency double, inferred_user_id int")
    for _ in range(2):
        write_inferences(scored, str(tmp_path / "o"), batch=4)
    write_inferences(scored, str(tmp_path / "o"), batch=5)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2


def test_relayed_lines_come_back(spark, rows, tmp_path):
    from stepwave.sinks.writers import relay

    data = frame(spark, rows)
    relay(data, str(tmp_path / "lines"))
    back = lines.good(lines.parsed(spark.read.text(str(tmp_path / "lines"))))
    assert back.exceptAll(data).count() == 0 and data.exceptAll(back).count() == 0
    assert data.select(F.length(to_line())).count() == len(rows)
