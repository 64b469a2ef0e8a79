"""Session settings and lineage cuts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings the plans are written for; sizes such as shuffle.partitions stay with the cluster."""
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")  # with their last reference
    )


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the session names, which every executor reaches; a local one where it names none."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is not None:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return (Path.cwd() / "spark-warehouse" / "shared").as_uri()


def new_folder(spark: SparkSession, purpose: str) -> str:
    """Name of a folder of its own in the shared folder; nothing is created."""
    return f"{shared_folder(spark)}/{purpose}-{uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the length of a block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder so later branches read it instead of recomputing it."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
