"""Importance resampling towards a target distribution, by hashed n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hashing import ALNUM, LOWER
from .prefix_crc import RunningCrc
from .ranking import numbered
from .shared import begins_of, cut_by_bytes, keyed_texts, release, stored, typed

#: Bytes of text that are scanned at once; a block ends behind a word.
BLOCK = 1 << 21


def blocks(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``BLOCK`` bytes that end outside words; a longer word stays in one."""
    at = 0
    while at < len(data):
        stop = min(len(data), at + BLOCK)
        while stop < len(data) and ALNUM[data[stop - 1]]:
            rest = np.flatnonzero(~ALNUM[data[stop : stop + BLOCK]])
            stop = stop + int(rest[0]) + 1 if len(rest) else min(len(data), stop + BLOCK)
        yield at, stop
        at = stop


class Counter:
    """Buckets of all n-grams of whole documents, block by block; the last words of a block are kept for the next."""

    def __init__(self, least: int, most: int, buckets: int):
        self.least, self.most, self.buckets = least, most, buckets
        self.text, self.size, self.doc = np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, raw: np.ndarray, at: int, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words per document and (document, bucket) codes with counts of what begins in this block.

        ``raw`` ends outside words and starts at byte ``at`` of documents that begin at ``first``.
        """
        inside = ALNUM[raw]
        edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
        begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        doc = np.searchsorted(first, begin + at, "right") - 1
        kept = inside.copy()
        kept[end[end < len(raw)]] = True  # one separator for all that stand between two words
        text = np.where(inside, LOWER[raw], 32).astype(np.uint8)[kept]
        if len(end) and end[-1] == len(raw):
            text = np.append(text, np.uint8(32))
        text = np.concatenate((self.text, text))
        size = np.concatenate((self.size, end - begin))
        old, docs = len(self.doc), np.concatenate((self.doc, doc))
        ends = np.cumsum(size + 1) - 1
        begins = ends - size
        running = RunningCrc(text)
        codes = []
        for n in range(self.least, self.most + 1):
            # An n-gram belongs to the block that holds its last word.
            last = np.arange(max(old, n - 1), len(docs))
            last = last[docs[last] == docs[last - n + 1]]
            crc = running.between(begins[last - n + 1], ends[last]) % np.uint32(self.buckets)
            codes.append(docs[last] * self.buckets + crc)
        carry = min(self.most - 1, len(docs))
        cut = len(docs) - carry
        self.text = text[begins[cut] :] if carry else text[:0]
        self.size, self.doc = size[cut:], docs[cut:]
        return np.bincount(doc, minlength=len(first) - 1), *np.unique(np.concatenate(codes), return_counts=True)


def featured(docs: DataFrame, key: str, text: str, least: int, most: int, buckets: int) -> DataFrame:
    """Per row ``k``, ``row`` (a number of its own), ``n_words``, and the distinct ``buckets`` of its n-grams with ``counts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for keys, lens, parts in cut_by_bytes(batches):
            data, first = np.frombuffer(b"".join(parts), np.uint8), begins_of(lens)
            n_words, found, counter = np.zeros(len(keys), np.int64), [], Counter(least, most, buckets)
            for a, z in blocks(data):
                words, codes, counts = counter.add(data[a:z], a, first)
                n_words += words
                found.append((codes, counts))
            codes, where = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([n for _, n in found]), len(codes)).astype(np.int64)
            ends = pa.array(np.searchsorted(codes, np.arange(len(keys) + 1) * buckets), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    pa.array(np.arange(row, row + len(keys))),
                    pa.array(n_words),
                    pa.ListArray.from_arrays(ends, pa.array(codes % buckets, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(counts)),
                ],
                names=["k", "row", "n_words", "buckets", "counts"],
            )
            row += len(keys)

    schema = typed("row long, n_words long, buckets array<int>, counts array<long>", 0, "k", docs.schema[key].dataType)
    return keyed_texts(docs, key, text).mapInArrow(run, schema)


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket over all rows: each task sums its own, so at most ``buckets`` rows leave it and reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            np.add.at(total, batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in features.select("buckets", "counts").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(target share / source share)) per bucket, each count raised by one."""
    buckets, s, t = len(source), float(source.sum()), float(target.sum())
    pairs = zip(source.astype(float).tolist(), target.astype(float).tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((b + 1) * (s + buckets) / ((a + 1) * (t + buckets)))) for a, b in pairs], np.int64)


def noise(key: Column, seed: int) -> Column:
    """floor of 1000 times a standard Gumbel value that the key and the seed decide."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share)))


def resample(
    docs: DataFrame, target: DataFrame, least: int = 1, most: int = 1, buckets: int = 10_000, percent: int = 10, min_words: int = 20, seed: int = 2024,
    key: str = "doc_id", text: str = "text", target_key: str = "item_id", target_text: str = "text",
) -> DataFrame:
    """Draw ``percent`` of the documents, likelier the more their n-grams look like those of ``target``.

    Features are the runs of ``least`` to ``most`` words (lower-cased, letters, digits and all beyond ASCII), hashed by
    the CRC-32 of the words joined by one blank. Returns every row of ``docs`` as ``key``, ``n_words``, ``n_features``,
    ``weight`` (sum of bucket gains), ``score`` (weight plus Gumbel noise of the key) and ``rank`` (from 1 in the order
    of falling scores, of those drawn). Only rows with ``min_words`` words can be drawn; ties go to the smaller
    key, a null one last; repeated rows score alike and are drawn one by one. A null text has no words, a null key
    counts as an empty one for the noise. Empty tables give an empty result or gains against nothing.
    """
    spark, kind = docs.sparkSession, docs.schema[key].dataType
    features = stored(featured(docs, key, text, least, most, buckets), "features")
    gains = gains_of(bucket_counts(features, buckets), bucket_counts(featured(target, target_key, target_text, least, most, buckets), buckets))
    shared = spark.sparkContext.broadcast(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column(4).flatten().to_numpy()
            upto = np.zeros((2, len(counts) + 1), np.int64)
            np.cumsum(counts, out=upto[0, 1:])
            np.cumsum(counts * shared.value[batch.column(3).flatten().to_numpy()], out=upto[1, 1:])
            ends = batch.column(3).value_lengths().to_numpy().cumsum()
            first = np.concatenate(([0], ends))
            n, weight = np.diff(upto[:, first])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n), pa.array(weight)], names=["k", "row", "n_words", "n_features", "weight"])
        release()

    weighed = features.mapInArrow(weigh, typed("row long, n_words long, n_features long, weight long", 0, "k", kind))
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("k"), seed)).withColumn("able", F.col("n_words") >= min_words)
    placed = numbered(scored, [F.desc("able"), F.desc("score"), F.asc_nulls_last("k"), F.asc("row")], "place")
    drawn = percent * features.filter(F.col("n_words") >= min_words).count() // 100
    rank = F.when(F.col("able") & (F.col("place") < drawn), F.col("place") + 1).alias("rank")
    return placed.select(F.col("k").alias(key), "n_words", "n_features", "weight", "score", rank)
