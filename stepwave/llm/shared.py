"""Tables in the shared folder, packs of documents, and exchanges of keys between packs.

A pack is one row that holds a few megabytes of whole documents, compressed. Operators that need counts or
matches over the whole corpus let every pack state its distinct keys (sorted 64-bit hashes), dealt into buckets
by key range; a bucket is reduced with numpy in one task, and each pack gets an answer for its keys in their order.
A key reaches its bucket at most once per pack, however often it occurs, so no key makes a task large.
"""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PACK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
MIN_BUCKETS = 192
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
MESSAGE = "bucket int, pack long, body binary"
_SQUEEZE, _OPEN = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor reaches; only local sessions that name none get a folder of their own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = (Path.cwd() / "spark-warehouse" / "shared").as_uri()
    return folder


@contextmanager
def letting_go(spark: SparkSession) -> Iterator[None]:
    """What is written inside needs the shuffle files behind it no longer."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written once as a table in the shared folder; cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with letting_go(spark):
        df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def release() -> None:
    """Give freed memory back to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def cut_by_bytes(batches: Iterator[pa.RecordBatch], size: int = PACK_BYTES) -> Iterator[tuple[pa.Array, np.ndarray, list[bytes]]]:
    """Groups of whole documents of about ``size`` bytes: keys, lengths, and their bytes with a line feed after each."""
    keys, lens, parts, total = [], [], [], 0
    for batch in batches:
        data, offsets = texts(batch.column(1))
        begin = 0
        for i in range(batch.num_rows):
            lens.append(int(offsets[i + 1] - offsets[i]))
            parts += (data[offsets[i] : offsets[i + 1]].tobytes(), b"\n")
            total += lens[-1]
            if total >= size or len(lens) >= 65536:
                keys.append(batch.column(0).slice(begin, i + 1 - begin))
                yield pa.concat_arrays(keys), np.array(lens, np.int64), parts
                keys, lens, parts, total, begin = [], [], [], 0, i + 1
        if begin < batch.num_rows:
            keys.append(batch.column(0).slice(begin))
    if lens:
        yield pa.concat_arrays(keys), np.array(lens, np.int64), parts
    release()


def one_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def keyed_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))


def bucketed(df: DataFrame, name: str, key: str, compression: str = "none") -> DataFrame:
    """``df`` stored like ``stored`` does, in buckets of ``key``: joins on it move only the other side."""
    spark = df.sparkSession
    name = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{shared_folder(spark)}/{name}"
    with letting_go(spark):
        df.write.option("compression", compression).option("path", path).bucketBy(buckets, key).saveAsTable(name)
    return spark.table(name)


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = PACK_BYTES) -> DataFrame:
    """Store ``docs`` as packs: ``pack``, ``keys`` (one per document, nulls kept), ``lens``, ``size``, ``body``.

    A null text counts as an empty one. Each document ends with a line feed that is not counted in ``lens``.
    """
    kind = docs.schema[key].dataType

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        base = TaskContext.get().partitionId() << 32
        for count, (keys, lens, parts) in enumerate(cut_by_bytes(batches, size)):
            columns = [
                pa.array([base | count], pa.int64()),
                one_list(keys),
                pa.array([lens.tobytes()], pa.binary()),
                pa.array([int(lens.sum())], pa.int64()),
                pa.array([squeeze.compress(b"".join(parts))], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["pack", "keys", "lens", "size", "body"])

    schema = typed("pack long, lens binary, size long, body binary", 1, "keys", T.ArrayType(kind))
    rows = keyed_texts(docs, key, text).mapInArrow(pack, schema)
    return stored(rows, "packs", "none")


def begins_of(lens: np.ndarray) -> np.ndarray:
    """Where documents of these lengths begin when a line feed follows each; one more entry than documents."""
    begins = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens + 1, out=begins[1:])
    return begins


def opened(body: bytes, lens: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a pack and where its documents begin; one more entry than documents."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
    return data, begins_of(np.frombuffer(lens, np.int64))


def typed(ddl: str, at: int, name: str, kind: T.DataType) -> T.StructType:
    """The columns of ``ddl`` with one more at place ``at``, whose type may have names that DDL would have to quote."""
    columns = list(T._parse_datatype_string(ddl).fields)
    return T.StructType([*columns[:at], T.StructField(name, kind), *columns[at:]])


def per_pack(packs: DataFrame, function: Callable, schema: str | T.StructType) -> DataFrame:
    """Rows that ``function(row: dict)`` yields as dicts for each pack; columns as in ``schema``."""
    names = (T._parse_datatype_string(schema) if isinstance(schema, str) else schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}
                for out in function(row):
                    yield pa.RecordBatch.from_arrays([out[n] for n in names], names=names)
        release()

    return packs.mapInArrow(run, schema)


def messages(pack: int, keys: np.ndarray, buckets: int, *columns: np.ndarray) -> dict[str, pa.Array]:
    """Sorted ``keys`` with aligned columns, one message per bucket (a range of keys)."""
    limits = (np.arange(buckets + 1, dtype=np.uint64) * np.uint64(2**32) + np.uint64(buckets - 1)) // np.uint64(buckets)
    cuts = np.searchsorted(keys >> np.uint64(32), limits)
    full = np.flatnonzero(cuts[1:] > cuts[:-1])
    return {
        "bucket": pa.array(full, pa.int32()),
        "pack": pa.array(np.full(len(full), pack), pa.int64()),
        "body": pa.array([b"".join(c[cuts[b] : cuts[b + 1]].tobytes() for c in (keys, *columns)) for b in full], pa.binary()),
    }


def fields(body: bytes, *kinds) -> list[np.ndarray]:
    """The aligned columns of a message."""
    n = len(body) // sum(np.dtype(k).itemsize for k in kinds)
    out, at = [], 0
    for kind in kinds:
        out.append(np.frombuffer(body, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def answered(asked: DataFrame, reduce: Callable, *kinds) -> DataFrame:
    """For every message an answer with one value per key.

    ``reduce(columns, ends, packs)`` gets the columns of all messages of a bucket, joined in the order of
    ``packs``, with the end of each message, and returns one value per key.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pack")
        parts = [fields(b, *kinds) for b in rows["body"]]
        columns = [np.concatenate([p[j] for p in parts]) for j in range(len(kinds))]
        ends = np.cumsum([len(p[0]) for p in parts])
        values = reduce(columns, ends, rows["pack"].to_numpy())
        answers = [v.tobytes() for v in np.split(values, ends[:-1])]
        return pd.DataFrame({"bucket": rows["bucket"].to_numpy(), "pack": rows["pack"].to_numpy(), "body": answers})

    return asked.groupBy("bucket").applyInPandas(run, MESSAGE)


def gathered(answers: DataFrame, name: str) -> DataFrame:
    """Per pack its answers in the order of its keys, as an array column ``name``."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("bucket", "body"))), lambda x: x["body"])
    return answers.groupBy("pack").agg(ordered.alias(name))


def joined(bodies: list | None, kind) -> np.ndarray:
    return np.frombuffer(b"".join(bodies or []), kind)


def in_planes(x: np.ndarray) -> bytes:
    """Rows of ``x`` compressed, all their first bytes, then all their second ones and so on."""
    return _SQUEEZE.compress(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()) if len(x) else b""


def out_of_planes(bodies: list | None, kind, width: int = 1) -> np.ndarray:
    """What ``in_planes`` made of rows of ``width`` values each, joined."""
    size = np.dtype(kind).itemsize * width
    parts = [np.frombuffer(_OPEN.decompress(b), np.uint8).reshape(size, -1).T for b in bodies or [] if b]
    return np.concatenate(parts).reshape(-1).view(kind) if parts else np.zeros(0, kind)


def bucket_count(total_bytes: int, size: int = BUCKET_BYTES) -> int:
    return max(MIN_BUCKETS, -(-int(total_bytes) // size))


def text_bytes(packs: DataFrame) -> int:
    return packs.agg(F.sum("size")).first()[0] or 0
