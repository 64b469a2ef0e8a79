"""Tables replayed as streams: readings land as line files step by step, and a stream takes each step up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, new_folder, setting
from ..sinks.writers import to_line
from ..sources import envelopes, lines
from ..streaming import closed_sessions, keyed_scopes, scopes

STEPS = 3
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def steps_of(rows: DataFrame, steps: int, time: str = "timeMs") -> list[DataFrame]:
    """The rows cut into ranges of time of about equal size; those without a time are in the first."""
    cuts = rows.agg(F.percentile_approx(time, [i / steps for i in range(1, steps)])).first()[0] or []
    borders = [None, *sorted(set(cuts)), None]
    ranges = []
    for low, high in zip(borders, borders[1:]):
        kept = F.col(time).isNull() if low is None else F.lit(False)
        after = F.lit(True) if low is None else F.col(time) > low
        kept = kept | (after & (F.lit(True) if high is None else F.col(time) <= high))
        ranges.append(rows.filter(kept))
    return ranges


def scoped_replay(readings: DataFrame, transform: scopes.Transform, scope_ms: int, steps: int = STEPS) -> DataFrame:
    """``transform`` of every scope, by a stream that is stopped and started again from its checkpoint with each step.

    A user's lines of one step lie in one file, so that batches, however they are cut, see a user in the order of time.
    Scopes still open at the end are read from the state.
    """
    spark = readings.sparkSession
    root = new_folder(spark, "replay")
    landed, checkpoint, out = f"{root}/in", f"{root}/checkpoint", f"{root}/out"

    def sink(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    for number, step in enumerate(steps_of(readings, steps)):
        step.repartition("userID").select(to_line().alias("value")).write.text(f"{landed}/step={number}")
        stream = scopes.readings_of(lines.line_stream(spark, f"{landed}/step=*").select("value"))
        with setting(spark, "spark.sql.streaming.stateStore.providerClass", ROCKSDB):
            writer = keyed_scopes.each_user_scope(stream, sink, checkpoint, transform, None, scope_ms)
            query = writer.start()
            query.awaitTermination()
    left = transform(keyed_scopes.open_readings(spark, checkpoint))
    done = spark.read.schema(left.schema).parquet(f"{out}/batch=*")
    return done.select(*left.columns).unionByName(left)


def sessions_replay(messages: DataFrame, steps: int = STEPS) -> DataFrame:
    """Readings of closed sessions from message texts (``uuid, arrival, value``), by a stream restarted with each step."""
    spark = messages.sparkSession
    messages = cut(messages)  # read once for the borders of the steps and once for each step
    root = new_folder(spark, "replay")
    landed, checkpoint, out = f"{root}/in", f"{root}/checkpoint", f"{root}/out"
    schema = messages.select("arrival", "value").schema

    def sink(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    for number, step in enumerate(steps_of(messages, steps, "arrival")):
        step.repartition("uuid").select("arrival", "value").write.parquet(f"{landed}/step={number}")
        arrived = spark.readStream.schema(schema).parquet(f"{landed}/step=*").select("arrival", "value")
        rows = closed_sessions.session_rows(envelopes.decoded(arrived))
        with setting(spark, "spark.sql.streaming.stateStore.providerClass", ROCKSDB):
            closed_sessions.each_closed_session(rows, sink, checkpoint, None).start().awaitTermination()
    shape = closed_sessions.session_readings(spark.createDataFrame([], closed_sessions.OUTPUT))
    return spark.read.schema(shape.schema).parquet(f"{out}/batch=*").select(*shape.columns)
