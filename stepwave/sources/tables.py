"""Readings, lifecycle events and inferences from a table of user events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import norm


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds of a zone-free timestamp, whatever the session zone is."""
    return F.unix_millis(F.from_utc_timestamp(ts.cast("timestamp"), F.current_timezone()))


def readings(spark: SparkSession, folder: str, *extra: Column) -> DataFrame:
    """Three-axis readings with their strength, and ``extra`` columns of the event."""
    events = table(spark, folder, "events").select(
        F.col("event_id").alias("index"),
        F.col("user_id").cast("string").alias("userID"),
        epoch_ms(F.col("ts")).alias("timeMs"),
        F.col("value").alias("accX"),
        F.get_json_object("props", "$.k").cast("double").alias("accY"),
        (F.col("event_id") % 97).cast("double").alias("accZ"),
        *extra,
    )
    return events.withColumn("vSum", norm(F.col("accX"), F.col("accY"), F.col("accZ")))


def event_kind() -> Column:
    return (
        F.when(F.col("event_type") == "signup", "connect")
        .when(F.col("event_type") == "error", "stop")
        .when(F.col("event_type") == "view", "inference")
        .otherwise("point")
        .alias("kind")
    )


def lifecycle(spark: SparkSession, folder: str) -> DataFrame:
    """Connection events: ``kind`` is connect, point, inference or stop."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("index"),
        F.col("user_id").cast("string").alias("userID"),
        epoch_ms(F.col("ts")).alias("timeMs"),
        event_kind(),
    )
