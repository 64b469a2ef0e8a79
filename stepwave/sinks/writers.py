"""Writers for sessions, inferences, relayed lines and vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import to_text
from ..schema import AXES, CONFIDENCE_FIELD, READING_FIELDS


def to_line(separator: str = ", ") -> Column:
    """A reading as one comma-separated line."""
    return F.concat_ws(separator, *(F.col(f).cast("string") for f in READING_FIELDS))


def of_batch(path: str, mode: str, batch: int | None) -> tuple[str, str]:
    """Folder and mode of a write: a batch replaces its own folder, so a retry adds nothing."""
    return (path, mode) if batch is None else (f"{path}/batch={batch}", "overwrite")


def relay(readings: DataFrame, path: str, mode: str = "append", batch: int | None = None) -> None:
    path, mode = of_batch(path, mode, batch)
    readings.select(to_line().alias("value")).write.mode(mode).text(path)


def export_sessions(
    points: DataFrame, path: str, mode: str = "append", folders: int | None = None, batch: int | None = None
) -> None:
    """Points of closed sessions as CSV under ``uuid=...``, or under ``folder=...`` where there are too
    many sessions for a folder each.

    Range partitioning keeps each session's files in time order and lets a long session span several
    tasks.  ``path`` may be any Hadoop path, so an object store needs no client of its own.
    """
    path, mode = of_batch(path, mode, batch)
    by, columns = ["uuid"], ["uuid", *READING_FIELDS]
    if folders is not None:
        points = points.withColumn("folder", F.pmod(F.xxhash64("uuid"), F.lit(folders)))
        by, columns = ["folder"], ["folder", *columns]
    order = [*by, "uuid", "timeMs", "index"] if folders is not None else ["uuid", "timeMs", "index"]
    ordered = points.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select(*columns).write.mode(mode).partitionBy(*by).csv(path, header=True)


def write_inferences(scored: DataFrame, path: str, batch: int | None = None) -> None:
    """Append inference records.  With a batch number the batch's own folder is replaced, so a retry adds nothing."""
    records = scored.select(CONFIDENCE_FIELD, "inferred_user_id", F.col("userID").alias("actual_user_id"))
    path, mode = of_batch(path, "append", batch)
    records.write.mode(mode).parquet(path)


def vector_texts(samples: DataFrame, keys) -> DataFrame:
    """Samples with each axis as a text of rounded values."""
    return samples.select(*keys, "segment_no", *(to_text(F.col(a)).alias(a) for a in AXES))
