"""Gapless numbers in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

#: Rows of one range, whose first numbers are summed on the driver.
RANGE_ROWS = 2_000_000


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``name``: its place from 0 in ``order``, which must be total (ties would move when a task is repeated).

    Ranges of the order are sorted side by side; the driver only sees one count per range of about ``RANGE_ROWS`` rows.
    """
    spark = df.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), df.count() // RANGE_ROWS)
    placed = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = stored(placed.withColumn("range", F.shiftright("at", 33).cast("int")).withColumn("at", F.col("at") % (1 << 33)), name)
    first, firsts = 0, []
    for r in placed.groupBy("range").count().orderBy("range").collect():
        firsts.append((r["range"], first))
        first += r["count"]
    offsets = F.broadcast(spark.createDataFrame(firsts, "range int, first long"))
    return placed.join(offsets, "range").withColumn(name, F.col("at") + F.col("first")).drop("range", "at", "first")
