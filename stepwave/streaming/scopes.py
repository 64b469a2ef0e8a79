"""Readings as a stream: parse, gather complete scopes, run the batch operators per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.resample import samples
from ..operators.scoring import scorer, with_choice
from ..plans.pipeline import grid_points
from ..schema import CYCLE_MS, READING_FIELDS, SCOPE_MS
from ..sources import lines

Sink = Callable[[DataFrame, int], None]
Transform = Callable[[DataFrame], DataFrame]
AHEAD_MS = 60_000


def readings_of(payloads: DataFrame) -> DataFrame:
    """Good readings of a stream of line payloads (column ``value``); a column ``arrival`` is kept."""
    typed = lines.parsed(lines.split_lines(payloads))
    if "arrival" not in payloads.columns:
        return lines.good(typed)
    return typed.filter(F.col("problem").isNull()).select(*READING_FIELDS, "arrival")


def rejected_of(payloads: DataFrame) -> DataFrame:
    return lines.quarantined(lines.parsed(lines.split_lines(payloads)))


def _started(readings: DataFrame, run: Sink, checkpoint: str, interval_ms: int | None) -> DataStreamWriter:
    writer = readings.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if interval_ms is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{interval_ms} milliseconds")


def each_batch(
    readings: DataFrame,
    sink: Sink,
    checkpoint: str,
    transform: Transform | None = None,
    interval_ms: int | None = SCOPE_MS,
) -> DataStreamWriter:
    """Run ``transform`` on every micro-batch and hand the result and the batch number to ``sink``.

    The number is the same when a batch is retried, so a sink that replaces its batch's output is
    exact.  ``interval_ms=None`` processes what is there and stops.
    """

    def run(batch: DataFrame, number: int) -> None:
        batch.persist()  # The operators look at the batch more than once.
        try:
            if not batch.isEmpty():
                sink(transform(batch) if transform else batch, number)
        finally:
            batch.unpersist()

    return _started(readings, run, checkpoint, interval_ms)


def each_scope(
    readings: DataFrame,
    sink: Sink,
    checkpoint: str,
    held: str,
    transform: Transform | None = None,
    interval_ms: int | None = SCOPE_MS,
    scope_ms: int = SCOPE_MS,
    delay_ms: int = 0,
    ahead_ms: int = AHEAD_MS,
    late: Sink | None = None,
    quarantine: Sink | None = None,
) -> DataStreamWriter:
    """Gather readings until their scope is over and hand each complete scope to ``sink``, after ``transform``.

    A scope is over once a reading more than ``delay_ms`` past its end has been seen.  No reading is dropped:

    * A reading of a scope that was closed by an earlier batch is late.  It goes to ``late``, or, without one, to
      ``transform`` in its own batch like a scope of what came late.
    * A reading more than ``ahead_ms`` ahead of its arrival (column ``arrival``, a timestamp; without one, or where it
      is null, the time of its micro-batch) closes nothing.  It goes to ``quarantine`` with its ``problem``, or,
      without one, waits for its own scope to be over.
    * A reading without a time belongs to no scope.  It goes to ``quarantine``, or, without one, where late ones go.

    Open scopes lie as a table in ``held``, a folder every executor reaches, one per stream.  Batches write two slots
    in turn, so that a retried batch finds the state it began with.  Sinks are called for every batch, also with
    no rows, and are exact if they replace the output of the same batch number.
    """
    arrived = [F.col("arrival")] if "arrival" in readings.columns else []
    arrival = F.coalesce(*arrived, F.current_timestamp())
    ahead = F.col("timeMs") > F.unix_millis(arrival) + ahead_ms
    timed = readings.select(*READING_FIELDS, F.coalesce(ahead, F.lit(False)).alias("ahead"))
    no_time = F.col("timeMs").isNull()
    state = timed.schema
    end = F.col("timeMs") - F.pmod("timeMs", F.lit(scope_ms)) + scope_ms

    def slot(number: int) -> str:
        return f"{held}/slot={number % 2}"

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            before = None  # Scopes that end up to here were closed by earlier batches.
            rows = batch
            if number > 0:
                before = spark.read.schema("closed bigint").parquet(f"{slot(number - 1)}/closed").first().closed
            if quarantine is not None:
                problem = F.when(no_time, "no time").otherwise("clock ahead").alias("problem")
                quarantine(rows.filter(F.col("ahead") | no_time).select(*READING_FIELDS, problem), number)
                rows = rows.filter(~F.col("ahead") & ~no_time)
            seen = rows.filter("NOT ahead").agg(F.max("timeMs")).first()[0]
            closed = max((x for x in (before, None if seen is None else seen - delay_ms) if x is not None), default=None)
            is_late = no_time if before is None else no_time | (end <= before)
            is_over = F.lit(False) if closed is None else end <= closed
            waiting = rows.filter(~is_late)
            if number > 0:
                waiting = waiting.unionByName(spark.read.schema(state).parquet(f"{slot(number - 1)}/rows"))
            over = waiting.filter(is_over)
            if late is None:
                over = over.unionByName(rows.filter(is_late))
            else:
                late(rows.filter(is_late).select(*READING_FIELDS), number)
            over = over.select(*READING_FIELDS).persist()
            try:
                sink(transform(over) if transform else over, number)
            finally:
                over.unpersist()
            waiting.filter(~is_over).write.mode("overwrite").parquet(f"{slot(number)}/rows")
            spark.createDataFrame([(closed,)], "closed bigint").write.mode("overwrite").parquet(f"{slot(number)}/closed")
        finally:
            batch.unpersist()

    return _started(timed, run, checkpoint, interval_ms)


def grid_per_scope(cycle_ms: int = CYCLE_MS, scope_ms: int = SCOPE_MS) -> Transform:
    """Transform for complete scopes: grid points per scope and user, the same rows as over the whole table."""
    return lambda batch: grid_points(batch, scope_ms, cycle_ms)


def grid_per_batch(cycle_ms: int = CYCLE_MS) -> Transform:
    """Transform where the micro-batch itself is the scope: nothing is held back and nothing is late."""
    return lambda batch: grid_points(batch, None, cycle_ms)


def scores_per_scope(centers: DataFrame, cycle_ms: int = CYCLE_MS, scope_ms: int = SCOPE_MS) -> Transform:
    """Transform for complete scopes: one scored row per segment, from stored centroids."""
    keys, points, score = ("scope", "userID"), grid_per_scope(cycle_ms, scope_ms), scorer(centers)
    return lambda batch: with_choice(score(samples(points(batch), keys)))
