"""Documents into shards of near equal or of fixed size; equal texts stay together."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .best_fit import into_capacity, into_shards
from .ranking import numbered
from .shared import stored

#: A group is hot above this share of all rows, so there are at most a thousand hot groups.
HOT_SHARE = 1000
#: Shards whose first rows may be broadcast.
MOST_BROADCAST = 1_000_000


def shard_of_groups(groups: DataFrame, shards: int | None, capacity: int | None) -> DataFrame:
    """``h``, ``n`` and the ``shard`` of each group (``h``, ``n`` rows, ``weight`` bytes).

    Groups are numbered by falling weight over all tasks. The driver gets the counts of the different weights, whose
    number is at most the square root of twice the bytes of all documents, and gives back ranges of numbers.
    """
    placed = numbered(groups, [F.desc("weight"), F.asc("h")], "number")
    runs = [(r["weight"], r["n"]) for r in groups.groupBy("weight").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("weight")).collect()]
    plan = into_shards(runs, shards) if capacity is None else into_capacity(runs, capacity)
    first, begin, each = (np.array(x, np.int64) for x in zip(*((p.first, p.bin, p.each) for p in plan), strict=True)) if plan else (np.zeros(1, np.int64),) * 3
    order = np.argsort(first)
    shared = groups.sparkSession.sparkContext.broadcast((first[order], begin[order], each[order]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, begin, each = shared.value
        for batch in batches:
            number = batch.column(2).to_numpy()
            at = np.searchsorted(first, number, "right") - 1
            shard = pa.array(begin[at] + (number - first[at]) // each[at], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), shard], names=["h", "n", "shard"])

    return placed.select("h", "n", "number").mapInArrow(place, "h binary, n long, shard int")


def shard_documents(docs: DataFrame, shards: int | None = 8, capacity: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Give every row of ``docs`` a shard: ``key``, ``size``, ``text_crc32``, ``shard``, ``slot`` (from 0 in its shard).

    Size is the UTF-8 bytes of the text plus one. With ``shards``, their sizes are as equal as whole groups of equal
    texts allow: a group above an even share has a shard of its own, and the rest goes by best fit, largest groups first,
    at the least capacity found to hold it. With ``capacity`` instead, as few shards of that many bytes as best fit
    needs; a larger group has one of its own. Ties go by the SHA-256 of the text. A null text counts as an empty one;
    repeated rows are rows of one group; a null key only counts for the order in a shard (first). An empty table
    gives an empty one.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{key}`").alias("k"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("crc"),
        F.unhex(F.sha2(body.cast("binary"), 256)).alias("h"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(rows, "sizes")
    groups = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("weight"))
    groups = stored(shard_of_groups(stored(groups, "groups"), shards, capacity), "shards")
    total, bins = rows.count(), groups.agg(F.max("shard")).first()[0] or 0
    hot = F.broadcast(groups.filter(F.col("n") > total // HOT_SHARE).select("h", "shard"))
    # Rows of hot groups meet them where they are; only the others are shuffled.
    met = rows.join(hot, "h", "left")
    few = met.filter("shard IS NULL").drop("shard").join(groups.filter(F.col("n") <= total // HOT_SHARE).select("h", "shard"), "h")
    sharded = met.filter("shard IS NOT NULL").unionByName(few).drop("h")
    placed = numbered(sharded, [F.asc("shard"), F.asc("k"), F.asc("row")], "number")
    begins = placed.groupBy("shard").agg(F.min("number").alias("begin"))
    placed = placed.join(F.broadcast(begins) if bins < MOST_BROADCAST else begins, "shard")
    return placed.select(F.col("k").alias(key), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("number") - F.col("begin")).alias("slot"))
