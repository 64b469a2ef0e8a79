"""Bounded samples of labelled documents for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text modulo ``modulus``; a null key gives -1."""
    return F.coalesce(F.crc32(key.cast("string")) % modulus, F.lit(-1))


def agreed_labels(labels: DataFrame, key: str, label: str) -> DataFrame:
    """One label (0 or 1) per key; rows with nulls are left out, and keys with contradicting labels too."""
    some = labels.select(F.col(f"`{key}`").alias("k"), F.col(f"`{label}`").cast("int").alias("y")).filter("k IS NOT NULL AND y IN (0, 1)")
    return some.groupBy("k").agg(F.min("y").alias("y"), F.max("y").alias("z")).filter("y = z").select("k", "y")


def first_by_hash(keys: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows in the order of a hash of ``k``: the same sample wherever it is drawn."""
    return keys.orderBy(F.xxhash64("k"), "k").limit(most)


def with_texts(sample: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """The texts of a sample whose number of keys is bounded, so that it may be broadcast."""
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    return rows.join(F.broadcast(sample), "k")
