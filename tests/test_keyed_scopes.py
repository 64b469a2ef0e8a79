"""Scopes kept as state per user."""

import pytest
from data import frame, reading, walk
from pyspark.sql import functions as F
from test_streaming import chunked, chunks_of, grid_rows

from stepwave.plans.pipeline import grid_points
from stepwave.schema import READING, READING_FIELDS
from stepwave.sources import lines
from stepwave.streaming import keyed_scopes, scopes

SCOPE = 30_000


def replayed(spark, tmp_path, texts, transform=None, sinks=("over",), **options):
    """Runs the texts through the stream one file a batch; the rows of each sink, with ``batch``."""
    source = tmp_path / "in"
    source.mkdir()
    chunked(source, texts)
    readings = scopes.readings_of(lines.line_stream(spark, str(source), max_files=1))
    if "arrivals" in options:
        readings = readings.withColumn("arrival", options.pop("arrivals"))
    to = lambda name: lambda df, n: df.write.mode("overwrite").parquet(f"{tmp_path}/{name}/batch={n}")
    named = {name: to(name) for name in sinks if name != "over"}
    writer = keyed_scopes.each_user_scope(
        readings, to("over"), str(tmp_path / "checkpoint"), transform, None, SCOPE, **named, **options
    )
    assert writer.start().awaitTermination(300)
    return {name: spark.read.parquet(f"{tmp_path}/{name}") for name in sinks}


def keys(df):
    return sorted((r["userID"], r["index"]) for r in df.collect())


def test_scopes_match_batch(spark, tmp_path):
    """Users split over batches; what stays open lies in the state, and both together are the batch result."""
    rows = walk(11, {"a": 500, "b": 400, "c": 3}, (1, 300), ties=0.0)
    transform = scopes.grid_per_scope(1000, SCOPE)
    found = replayed(spark, tmp_path, [*chunks_of(rows, 310), "broken line\n"], transform)["over"]
    assert found.select("batch").distinct().count() > 1
    left = keyed_scopes.open_readings(spark, str(tmp_path / "checkpoint"))
    assert left.schema.names == list(READING_FIELDS)
    assert left.groupBy("userID").agg(F.countDistinct(F.expr(f"timeMs div {SCOPE}")).alias("n")).filter("n > 1").isEmpty()
    got = grid_rows(found) | grid_rows(transform(left))
    expected = grid_rows(grid_points(frame(spark, rows), SCOPE, 1000))
    assert set(got) == set(expected) and expected
    assert all(got[k] == pytest.approx(expected[k]) for k in expected)


def line(row):
    return ", ".join(str(row[f]) for f in READING_FIELDS) + "\n"


def test_no_user_closes_the_scopes_of_others(spark, tmp_path):
    """The clock of ``fast`` runs 50 s ahead; ``slow`` still sends for its first scope and loses nothing."""
    texts = [
        line(reading(0, "slow", 1_000, 1)) + line(reading(0, "fast", 51_000, 1)),
        line(reading(1, "slow", 2_000, 1)) + line(reading(1, "fast", 92_000, 1)),
        line(reading(2, "slow", 31_000, 1)),
    ]
    found = replayed(spark, tmp_path, texts, sinks=("over", "late"))
    assert found["late"].isEmpty()
    over = {(r["batch"], r["userID"], r["index"]) for r in found["over"].collect()}
    assert over == {(1, "fast", 0), (2, "slow", 0), (2, "slow", 1)}


@pytest.mark.parametrize("sinks", [("over",), ("over", "late"), ("over", "late", "quarantine")])
def test_every_reading_is_accounted_for(spark, tmp_path, sinks):
    """Late ones, clocks ahead, null arrivals: every reading is in one sink or in the state."""
    rows = walk(3, {"a": 70, "b": 50}, (1, 1_500), start=0, ties=0.2)
    ahead = reading(900, "a", 10**9, 1)
    delayed = reading(901, "b", 5, 1)
    texts = chunks_of(rows, 60)
    texts.insert(1, line(ahead))
    texts.append(line(delayed))
    arrivals = F.when(F.col("index") % 3 != 0, F.timestamp_millis(F.least("timeMs", F.lit(200_000))))
    found = replayed(spark, tmp_path, texts, sinks=sinks, arrivals=arrivals if len(sinks) < 3 else F.timestamp_millis(F.lit(300_000)))
    left = keyed_scopes.open_readings(spark, str(tmp_path / "checkpoint"))
    got = sorted(k for df in (*found.values(), left) for k in keys(df))
    assert got == sorted((r["userID"], r["index"]) for r in [*rows, ahead, delayed])
    if "late" in sinks:
        assert ("b", 901) in keys(found["late"])
    if "quarantine" in sinks:
        assert [(r["index"], r["problem"]) for r in found["quarantine"].collect()] == [(900, "clock ahead")]


def test_incomplete_rows(spark, tmp_path):
    rows = [(0, "a", 1_000, 1.0, 1.0, 1.0, 1.0), (1, "a", None, 1.0, 1.0, 1.0, 1.0), (None, "a", 5, 1.0, None, 1.0, 1.0)]
    rows.append((2, None, 1_000, 1.0, 1.0, 1.0, 1.0))
    spark.createDataFrame(rows, READING).write.parquet(str(tmp_path / "in"))
    stream = keyed_scopes.scoped(spark.readStream.schema(READING).parquet(str(tmp_path / "in")), SCOPE)
    query = stream.writeStream.format("memory").queryName("incomplete").option(
        "checkpointLocation", str(tmp_path / "checkpoint")
    ).trigger(availableNow=True).start()
    assert query.awaitTermination(300)
    assert sorted((r["index"] is None, r["kind"]) for r in spark.table("incomplete").collect()) == [
        (False, "incomplete"), (False, "incomplete"), (True, "incomplete")]
    assert keys(keyed_scopes.open_readings(spark, str(tmp_path / "checkpoint"))) == [("a", 0)]


def test_many_users_share_few_states(spark, tmp_path):
    """Users of one group whose clocks differ: those still open stay in the parts that others leave."""
    rows = [(i, f"u{i % 90}", 1_000 + i, 1.0, 1.0, 1.0, 1.0) for i in range(270)]
    rows += [(270 + i, f"u{i}", 70_000, 1.0, 1.0, 1.0, 1.0) for i in range(0, 90, 2)]
    spark.createDataFrame(rows, READING).write.parquet(str(tmp_path / "in"))
    stream = keyed_scopes.scoped(spark.readStream.schema(READING).parquet(str(tmp_path / "in")), SCOPE, groups=3)
    checkpoint = str(tmp_path / "checkpoint")
    query = stream.writeStream.format("memory").queryName("shared").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    assert query.awaitTermination(300)
    assert spark.read.format("statestore").option("stateVarName", "clock").load(checkpoint).count() == 3
    over = [(f"u{i % 90}", i) for i in range(270) if i % 2 == 0]
    assert keys(spark.table("shared").filter("kind = 'over'")) == sorted(over)
    assert keys(keyed_scopes.open_readings(spark, checkpoint)) == sorted({(r[1], r[0]) for r in rows} - set(over))
