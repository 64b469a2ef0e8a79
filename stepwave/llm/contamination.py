"""Benchmark passages in documents, found by a prefix-filtered join on rare shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .hashing import ALNUM, LOWER, windows, words
from .shared import begins_of, cut_by_bytes, keyed_texts, stored, typed

#: Words of a shingle; windows of fewer words have shingles of all their words.
SHINGLE = 3
#: Bits of the filter that documents' shingles pass before the join: at most 2 MB are broadcast.
LEAST_BITS, MOST_BITS = 20, 24


def folded(parts: list[bytes], lens: np.ndarray) -> tuple:
    """Lower-cased bytes, word begins, ends and hashes, and the first word of each document."""
    data = LOWER[np.frombuffer(b"".join(parts), np.uint8)]
    start, end, hashes = words(data, ALNUM)
    return data, start, end, hashes, np.searchsorted(start, begins_of(lens))


def inside(first: np.ndarray, size: int) -> np.ndarray:
    """Word positions where ``size`` words of one document start."""
    counts = np.diff(first)
    left = np.repeat(first[1:], counts) - np.arange(first[-1])
    return np.flatnonzero(left >= size)


def item_windows(benchmark: DataFrame, window: int, key: str, text: str) -> DataFrame:
    """Every window of every item: ``item``, ``words``, ``shingle`` and ``off`` (each shingle and its place)."""
    kind = benchmark.schema[key].dataType
    key_type = to_arrow_type(kind)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, lens, parts in cut_by_bytes(batches):
            data, start, end, hashes, first = folded(parts, lens)
            raw = data.tobytes()
            text_of = [raw[b:e].decode("utf-8", "replace") for b, e in zip(start.tolist(), end.tolist(), strict=True)]
            out = {"item": [], "words": [], "shingles": []}
            for i, name in enumerate(keys.to_pylist()):
                a, z = int(first[i]), int(first[i + 1])
                size = min(window, z - a)
                shingle = min(SHINGLE, size)
                for at in range(a, z - size + 1 if size else a):
                    places = np.arange(at, at + size - shingle + 1)
                    out["item"].append(name)
                    out["words"].append(text_of[at : at + size])
                    out["shingles"].append(windows(hashes, places, shingle).view(np.int64))
            types = (key_type, pa.list_(pa.string()), pa.list_(pa.int64()))
            columns = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=list(out))

    schema = typed("words array<string>, shingles array<long>", 0, "item", kind)
    found = stored(keyed_texts(benchmark, key, text).mapInArrow(cut, schema), "windows")
    return found.withColumn("window", F.xxhash64(F.lit(1), "words"))


def filter_of(shingles: DataFrame) -> tuple[int, bytes]:
    """A bit per range of hash values that holds any of ``shingles``; its size is bounded by ``MOST_BITS``."""
    n = shingles.count()
    bits = min(MOST_BITS, max(LEAST_BITS, (64 * n).bit_length()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << bits, bool)
        for batch in batches:
            seen[batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - bits)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(seen).tobytes()], pa.binary())], names=["bits"])

    total = np.zeros(1 << (bits - 3), np.uint8)
    for row in shingles.coalesce(4).mapInArrow(mark, "bits binary").collect():
        total |= np.frombuffer(row["bits"], np.uint8)
    return bits, total.tobytes()


def hits_of(hashes: np.ndarray, first: np.ndarray, sizes: list[int], bits: int, seen: np.ndarray) -> Iterator[tuple]:
    """Places and hashes of the shingles that pass the filter."""
    for size in sizes:
        at = inside(first, size)
        shingles = windows(hashes, at, size)
        hit = seen[shingles >> np.uint64(64 - bits)]
        yield at[hit], shingles[hit]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Words of documents that lie in an occurrence of a benchmark window.

    A window is ``window`` consecutive words of an item, or the whole item if it has fewer (but some). Shingles of
    items are ordered by how often they occur in all documents; a window can occur only where its rarest shingle
    does, so that one is joined. Length and place bounds come next, then the words are compared.

    Returns ``key``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` (item ids sorted as strings, joined by
    commas), ``contaminated`` and ``spans`` (word ranges of the occurrences). A null text has no words. Items without
    id mark words but are not listed; items that share an id count once; repeated documents are kept apart; null
    keys and other columns do not matter. Without documents the result is empty, without items nothing is hit.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType
    key_type = to_arrow_type(kind)
    rows = keyed_texts(docs, key, text)
    item_rows = item_windows(benchmark, window, item_key, item_text)
    unique = item_rows.groupBy("window", "words").agg(F.first("shingles").alias("shingles"))
    per_shingle = unique.select(F.explode("shingles").alias("shingle")).distinct()
    sizes = [r[0] for r in unique.select(F.least(F.size("words"), F.lit(SHINGLE)).alias("n")).distinct().collect()]
    bits, seen = filter_of(per_shingle)
    shared = spark.sparkContext.broadcast(seen)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.unpackbits(np.frombuffer(shared.value, np.uint8)).view(bool)
        for _, lens, parts in cut_by_bytes(batches):
            *_, hashes, first = folded(parts, lens)
            for _, found in hits_of(hashes, first, sizes, bits, flags):
                values, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], names=["shingle", "n"])

    frequency = rows.mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    ranked = (
        unique.select("window", "words", F.posexplode("shingles").alias("off", "shingle"))
        .join(frequency, "shingle")  # a shingle that no document has rules its windows out
        .groupBy("window", "words")
        .agg(F.count(F.lit(1)).alias("present"), F.min(F.struct("n", "shingle", "off")).alias("rarest"))
        .filter(F.col("present") == F.size("words") - F.least(F.size("words"), F.lit(SHINGLE)) + 1)
        .select("window", "words", "rarest.shingle", "rarest.off")
    )
    prefixes = stored(ranked, "prefixes")
    prefix_bits, prefix_seen = filter_of(prefixes.select("shingle").distinct())
    prefix_shared = spark.sparkContext.broadcast(prefix_seen)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.unpackbits(np.frombuffer(prefix_shared.value, np.uint8)).view(bool)
        base, done = TaskContext.get().partitionId() << 36, 0
        names = ["row", "key", "n_words", "place", "shingle", "around", "begin"]
        for keys, lens, parts in cut_by_bytes(batches):
            data, start, end, hashes, first = folded(parts, lens)
            rows_ = base + done + np.arange(len(keys))
            done += len(keys)
            none = pa.nulls(len(keys))
            columns = [
                pa.array(rows_), keys, pa.array(np.diff(first)),
                none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.list_(pa.string())), none.cast(pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            raw = None
            for at, shingles in hits_of(hashes, first, sizes, prefix_bits, flags):
                if not len(at):
                    continue
                raw = raw or data.tobytes()
                doc = np.searchsorted(first, at, side="right") - 1
                a = np.maximum(at - window + 1, first[doc])
                z = np.minimum(at + window, first[doc + 1])
                for i in range(0, len(at), 20_000):
                    part = slice(i, i + 20_000)
                    around = [
                        [raw[start[w] : end[w]].decode("utf-8", "replace") for w in range(b, e)]
                        for b, e in zip(a[part].tolist(), z[part].tolist(), strict=True)
                    ]
                    d = doc[part]
                    columns = [
                        pa.array(rows_[d]), pa.nulls(len(d)).cast(key_type), pa.array(np.diff(first)[d]),
                        pa.array(at[part] - first[d]), pa.array(shingles[part].view(np.int64)),
                        pa.array(around, pa.list_(pa.string())), pa.array(a[part] - first[d]),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = typed("row long, n_words long, place long, shingle long, around array<string>, begin long", 1, "key", kind)
    looked = stored(rows.mapInArrow(look, schema), "hits")
    documents = looked.filter("place IS NULL").select("row", "key", "n_words")
    start = F.col("place") - F.col("off")
    length = F.size("words")
    found = (
        looked.filter("place IS NOT NULL")
        .select("row", "n_words", "place", "shingle", "around", "begin")
        .join(prefixes, "shingle")
        .filter((length <= F.col("n_words")) & (start >= 0) & (start + length <= F.col("n_words")))
        .filter(F.slice("around", (start - F.col("begin") + 1).cast("int"), length) == F.col("words"))
        .select("row", start.alias("start"), (start + length).alias("stop"), "window", "words")
    )
    found = stored(found, "occurrences")
    before = Window.partitionBy("row").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.select("row", "start", "stop").distinct().withColumn("reached", F.coalesce(F.max("stop").over(before), F.lit(0)))
    covered = spans.groupBy("row").agg(
        F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("start", "reached"))).alias("n_hit"),
        F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"),
    )
    named = found.select("row", "window", "words").distinct().join(item_rows.select("window", "words", "item"), ["window", "words"])
    items = named.groupBy("row").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return (
        documents.join(covered, "row", "left")
        .join(items, "row", "left")
        .select(
            F.col("key").alias(key),
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(ids).cast("long").alias("n_items"),
            F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
            "spans",
        )
    )
