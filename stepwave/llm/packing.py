"""Packing of token sequences with first-fit decreasing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import begins_of, cut_by_bytes, keyed_texts, one_list, stored, typed
from .tokens import tokenizer_of

#: Sequences that a group of documents fills, about.
GROUP_SEQUENCES = 512
PIECES = "pack long, doc int, start long, length long, doc_tokens long, sequence_id long, offset long"


class FirstFit:
    """A tournament tree over the free room of bins: finds the first bin with enough room in logarithmic time."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(bins - 1, 0).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def put(self, size: int) -> int:
        """The first bin with room for ``size``, which it takes."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        found = at - self.leaves
        room[at] -= size
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
        return found


def pack_sizes(sizes: list[int], capacity: int, least_piece: int = 16) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(item, start, length, sequence, offset)`` that hold all items in sequences of ``capacity``.

    Items longer than a sequence first fill whole ones. The rest is placed by first-fit decreasing; then the
    emptiest sequences are cut up to fill gaps of at least ``least_piece`` in others. What is left in the end is
    cut into sequences whose lengths are powers of two, which need no padding.
    """
    out, sequence, rest = [], 0, []
    for item, size in enumerate(sizes):
        whole = size - size % capacity
        for start in range(0, whole, capacity):
            out.append((item, start, capacity, sequence, 0))
            sequence += 1
        if size > whole:
            rest.append((size - whole, item, whole))
    rest.sort(key=lambda r: (-r[0], r[1]))
    tree, bins = FirstFit(len(rest), capacity), []
    for size, item, start in rest:
        at = tree.put(size)
        if at == len(bins):
            bins.append([])
        bins[at].append((item, start, size))
    bins.sort(key=lambda b: -sum(p[2] for p in b))
    used = [sum(p[2] for p in b) for b in bins]
    first, last = 0, len(bins) - 1
    while first < last:
        gap = capacity - used[first]
        if gap < least_piece:
            first += 1
            continue
        item, start, size = bins[last].pop()
        take = min(size, gap)
        if size > take:
            bins[last].append((item, start + take, size - take))
        bins[first].append((item, start, take))
        used[first] += take
        used[last] -= take
        if not bins[last]:
            last -= 1
    for at in range(last + 1):
        open_end = at == last and used[at] <= capacity - least_piece
        left = 0
        offset = 0
        for item, start, size in bins[at]:
            while size:
                if open_end and left == 0:
                    left = 1 << (used[at].bit_length() - 1)
                    used[at] -= left
                    sequence, offset = sequence + (offset > 0), 0
                take = min(size, left) if open_end else size
                out.append((item, start, take, sequence, offset))
                start, size, offset = start + take, size - take, offset + take
                left -= take if open_end else 0
        sequence += 1
    return out


def pack_documents(
    docs: DataFrame, path: str, end_id: int = 2, capacity: int = 4096, key: str = "doc_id", text: str = "text", seed: int = 7
) -> DataFrame:
    """Pack the token ids of all documents, each followed by ``end_id``, into sequences of ``capacity``.

    Documents are dealt into random groups of a bounded number of sequences; each group is packed by itself from
    lengths alone (first-fit decreasing over a tournament tree). Every id lies in exactly one piece.

    Returns per piece ``key``, ``start``, ``length``, ``ids_crc32`` (unsigned, over little-endian 32-bit ids),
    ``doc_tokens``, ``sequence_id``, ``offset`` and ``ids``. A null text counts as empty (one end id); repeated rows
    and null keys are documents of their own; an empty table gives an empty one.
    """
    kind = docs.schema[key].dataType

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, squeeze = tokenizer_of(path), zstandard.ZstdCompressor(level=1)
        base = TaskContext.get().partitionId() << 32
        for count, (keys, lens, parts) in enumerate(cut_by_bytes(batches)):
            ids, first = tokenizer.encode(np.frombuffer(b"".join(parts), np.uint8), begins_of(lens))
            ids = np.insert(ids, first[1:], end_id).astype("<u4")
            body = squeeze.compress(ids.view(np.uint8).reshape(-1, 4).T.tobytes())  # bytes of equal weight together
            columns = [
                pa.array([base | count], pa.int64()),
                one_list(keys),
                pa.array([np.diff(first) + 1], pa.list_(pa.int64())),
                pa.array([body], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["pack", "keys", "sizes", "body"])

    schema = typed("pack long, sizes array<long>, body binary", 1, "keys", T.ArrayType(kind))
    packs = stored(keyed_texts(docs, key, text).mapInArrow(encode, schema), "ids", "none")
    total = packs.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    groups = max(1, -(-total // (capacity * GROUP_SEQUENCES)))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["pack", "doc"])
        found = np.array(pack_sizes(rows["size"].tolist(), capacity), np.int64).reshape(-1, 5)
        item = found[:, 0]
        columns = {
            "pack": rows["pack"].to_numpy()[item],
            "doc": rows["doc"].to_numpy()[item],
            "start": found[:, 1],
            "length": found[:, 2],
            "doc_tokens": rows["size"].to_numpy()[item],
            "sequence_id": (int(rows["group"].iloc[0]) << 24) + found[:, 3],
            "offset": found[:, 4],
        }
        return pd.DataFrame(columns)

    lengths = packs.select("pack", F.posexplode("sizes").alias("doc", "size"))
    dealt = lengths.withColumn("group", F.pmod(F.xxhash64(F.lit(seed), "pack", "doc"), F.lit(groups)))
    pieces = dealt.groupBy("group").applyInPandas(pack, PIECES)
    names = ["doc", "start", "length", "doc_tokens", "sequence_id", "offset"]
    per_pack = pieces.groupBy("pack").agg(F.collect_list(F.struct(*names)).alias("pieces"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = zstandard.ZstdDecompressor().decompress(batch.column("body")[i].as_py())
                ids = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()
                sizes = batch.column("sizes")[i].values.to_numpy()
                first = np.concatenate(([0], np.cumsum(sizes)))
                piece = batch.column("pieces")[i].values
                values = {n: piece.field(n).to_numpy() for n in names}
                begin = first[values["doc"]] + values["start"]
                cuts = list(zip(begin.tolist(), (begin + values["length"]).tolist(), strict=True))
                bodies = [ids[b:e].tobytes() for b, e in cuts]
                keys = batch.column("keys")[i].values.take(pa.array(values["doc"]))
                columns = [
                    keys,
                    *(pa.array(values[n], pa.int64()) for n in names[1:3]),
                    pa.array([zlib.crc32(b) for b in bodies], pa.int64()),
                    *(pa.array(values[n], pa.int64()) for n in names[3:]),
                    pa.array(bodies, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[key, *names[1:3], "ids_crc32", *names[3:], "ids"])

    columns_of = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    out = typed(columns_of, 0, key, kind)
    return packs.join(per_pack, "pack").select("keys", "sizes", "body", "pieces").mapInArrow(cut, out)
