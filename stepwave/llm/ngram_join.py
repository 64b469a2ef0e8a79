"""Near-duplicate documents by the Jaccard similarity of their word n-gram sets."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .components import components
from .hashing import NOT_SPACE, mixed, windows, words
from .shared import opened, packed, per_pack, stored, typed

#: Different sets of one tile; larger candidate groups are compared tile by tile.
TILE = 500
HASH_BITS = np.uint64(48)


def banding(threshold: float, recall: float, most_hashes: int = 128) -> tuple[int, int]:
    """Bands and rows per band: the most rows with which pairs at ``threshold`` still share a band with ``recall``."""
    best = None
    for rows in range(1, most_hashes + 1):
        share = threshold**rows
        bands = 1 if share >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-share)) if share > 1e-12 else most_hashes + 1
        if bands * rows <= most_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("no banding reaches this recall with so few hashes")
    return best


def gram_sets(data: np.ndarray, begins: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """48-bit hashes of the distinct n-grams of all documents, sorted inside each, and where each set begins.

    A document of fewer words, but some, has one n-gram of all its words.
    """
    start, _, hashes = words(data, NOT_SPACE)
    first = np.searchsorted(start, begins)
    counts = np.diff(first)
    left = np.repeat(first[1:], counts) - np.arange(len(hashes))
    at = np.flatnonzero(left >= n)
    doc = np.searchsorted(first, at, side="right") - 1
    grams = windows(hashes, at, n)
    for d in np.flatnonzero((counts > 0) & (counts < n)):
        grams = np.append(grams, windows(hashes, first[d : d + 1], int(counts[d])))
        doc = np.append(doc, d)
    keys = np.unique((doc.astype(np.uint64) << HASH_BITS) | (grams >> (np.uint64(64) - HASH_BITS)))
    return keys & ((np.uint64(1) << HASH_BITS) - np.uint64(1)), np.searchsorted(keys >> HASH_BITS, np.arange(len(counts) + 1, dtype=np.uint64))


def band_hashes(grams: np.ndarray, first: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash per document and band of its MinHash values; documents without n-grams are left out."""
    full = np.flatnonzero(np.diff(first))
    short = (mixed(grams) >> np.uint64(32)).astype(np.uint32)
    rng = np.random.default_rng(11)
    out = np.zeros((len(full), bands), np.uint64)
    for band in range(bands):
        value = np.full(len(full), band + 1, np.uint64)
        for _ in range(rows):
            a, b = rng.integers(0, 2**32, 2, dtype=np.uint32)
            least = np.minimum.reduceat((short ^ b) * (a | np.uint32(1)), first[full])
            value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + least)
        out[:, band] = value
    return out


def linked(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs reach ``threshold``: intersections of all pairs as products of incidence matrices, by column blocks."""
    sizes = np.array([len(s) for s in sets])
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    both = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.bincount(column, minlength=len(values)) > 1
    keep = shared[column]
    row, column = row[keep], (np.cumsum(shared) - 1)[column[keep]]
    width = max(256, (8 << 20) // max(len(sets), 1) // 4)
    for at in range(0, int(shared.sum()), width):
        a, z = np.searchsorted(column, (at, at + width))
        block = np.zeros((len(sets), width), np.float32)
        block[row[a:z], column[a:z] - at] = 1
        both += block @ block.T
    either = sizes[:, None] + sizes[None, :] - both
    return both >= threshold * either - 1e-6


def local_roots(linked_: np.ndarray) -> np.ndarray:
    """For each row the smallest row of its component."""
    label = np.arange(len(linked_))
    while True:
        new = np.where(linked_, label[None, :], len(label)).min(axis=1)
        new = np.minimum(label, new)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def tiles_of(groups: DataFrame, nodes: DataFrame, tile: int) -> DataFrame:
    """The nodes of all tiles (``root``, ``i``, ``j``), and the ``task`` that compares a tile.

    A component of at most ``tile`` nodes is one tile, and such tiles share tasks of about 500 nodes; a larger one is cut
    into blocks of about ``tile`` nodes, and each tile of two blocks is a task of its own.
    """
    tasks = max(256, groups.count() // 500)
    sizes = groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("blocks"))
    members = groups.join(sizes, "root").join(nodes, "node").withColumn("block", F.pmod(F.xxhash64(F.lit(3), "node"), F.col("blocks")).cast("int"))
    shared = F.struct(F.pmod(F.xxhash64("root"), F.lit(tasks)).alias("root"), F.lit(-1).alias("i"), F.lit(-1).alias("j"))
    return (
        members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .withColumn("task", F.when(F.col("blocks") > 1, F.struct("root", "i", "j")).otherwise(shared))
        .drop("blocks", "other")
    )


def near_duplicates(
    docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999, key: str = "doc_id", text: str = "text", tile: int = TILE
) -> DataFrame:
    """Classes of documents whose word ``n``-gram sets have a Jaccard similarity of at least ``threshold``.

    Documents with equal sets become one node first. MinHash bands (counts chosen for ``recall`` at the threshold)
    give candidates; nodes joined by shared bands are compared on their full sets, large groups of them in tiles
    of about ``2 * tile`` sets, so no group meets in one task and no pair is written out.

    Returns one row per document: ``key``, ``class_id`` (the smallest key of its component of links), ``class_size``,
    ``n_links`` (documents with at least the threshold), ``first`` (true for one document of each class). Documents
    without words (null or empty) are alone in their class. Repeated rows are copies of each other; a null key
    counts as larger than others; other columns do not matter; an empty table gives an empty one.
    """
    _, classes = classified(docs, n, threshold, recall, key, text, tile)
    first = (F.col("row") == F.col("top.row")).alias("first")
    return classes.select(F.col("key").alias(key), F.col("top.key").alias("class_id"), "class_size", "n_links", first)


def drop_near_duplicates(
    docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999, key: str = "doc_id", text: str = "text", tile: int = TILE
) -> DataFrame:
    """``docs`` with one document of each class of ``near_duplicates``: the one with the smallest ``key``."""
    others = [c for c in docs.columns if c != text]
    body = F.struct(F.col(f"`{key}`"), *(F.col(f"`{c}`") for c in others if c != key), F.col(f"`{text}`").isNull())
    rows = docs.select(body.alias("doc"), F.col(f"`{text}`").alias("text"))
    packs, classes = classified(rows, n, threshold, recall, "doc", "text", tile)
    key_type = to_arrow_type(rows.schema["doc"].dataType)
    kept = classes.filter(F.col("row") == F.col("top.row")).groupBy("pack").agg(F.collect_list("row").alias("kept"))

    def read(row):
        data, begins = opened(row["body"], row["lens"])
        raw = data.tobytes()
        at = np.sort(np.array(row["kept"], np.int64) & 0xFFFF)
        texts = [raw[begins[i] : begins[i + 1] - 1] for i in at]
        yield {"doc": pa.array([row["keys"][i] for i in at], key_type), "text": pa.array(texts, pa.binary()).cast(pa.string())}

    schema = typed("text string", 0, "doc", rows.schema["doc"].dataType)
    found = per_pack(packs.join(kept, "pack"), read, schema)
    values = {c: F.col("doc").getField(c) for c in others}
    values[text] = F.when(~F.col("doc").getField(rows.schema["doc"].dataType.names[-1]), F.col("text"))
    return found.select(*(values[c].alias(c) for c in docs.columns))


def classified(docs: DataFrame, n: int, threshold: float, recall: float, key: str, text: str, tile: int) -> tuple[DataFrame, DataFrame]:
    """Packs of ``docs``, and for each document its row and pack, its class and the class's first document."""
    bands, rows = banding(threshold, recall)
    kind = docs.schema[key].dataType
    key_type = to_arrow_type(kind)
    packs = packed(docs, key, text)

    def row_ids(pack: int, count: int) -> np.ndarray:
        return ((pack >> 32) << 40) + ((pack & 0xFFFFFFFF) << 16) + np.arange(count)

    def sign(row):
        data, begins = opened(row["body"], row["lens"])
        grams, first = gram_sets(data, begins, n)
        sizes = np.diff(first)
        full = sizes > 0
        one, two = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
        if full.any():
            one[full] = np.add.reduceat(mixed(grams), first[:-1][full])
            two[full] = np.add.reduceat(mixed(grams ^ np.uint64(0x5DEECE66D)), first[:-1][full])
        hashes = np.zeros((len(sizes), bands), np.uint64)
        if full.any():
            hashes[full] = band_hashes(grams, first, bands, rows)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * bands), pa.array(hashes.view(np.int64).ravel()))
        yield {
            "row": pa.array(row_ids(row["pack"], len(sizes))),
            "pack": pa.array(np.full(len(sizes), row["pack"])),
            "key": pa.array(row["keys"], key_type),
            "size": pa.array(sizes),
            "one": pa.array(one.view(np.int64)),
            "two": pa.array(two.view(np.int64)),
            "bands": flat,
        }

    def read_sets(row):
        data, begins = opened(row["body"], row["lens"])
        grams, first = gram_sets(data, begins, n)
        wanted = np.array(sorted(row["wanted"]), np.int64)
        at = wanted & 0xFFFF
        yield {
            "node": pa.array(wanted),
            "grams": pa.array([grams[first[i] : first[i + 1]].tobytes() for i in at], pa.binary()),
        }

    def compare(rows_: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, i, j), group in rows_.groupby(["root", "i", "j"], sort=False):
            sets = [np.frombuffer(g, np.uint64) for g in group["grams"]]
            nodes, block, copies = (group[c].to_numpy() for c in ("node", "block", "copies"))
            order = np.argsort(nodes)
            nodes, block, copies, sets = nodes[order], block[order], copies[order], [sets[o] for o in order]
            link = linked(sets, threshold)
            np.fill_diagonal(link, False)
            if i != j:
                link &= block[:, None] != block[None, :]  # pairs inside a block belong to its own tile
            out.append(pd.DataFrame({"node": nodes, "other": nodes[local_roots(link)], "links": link @ copies}))
        return pd.concat(out)

    schema = typed("row long, pack long, size long, one long, two long, bands array<long>", 2, "key", kind)
    signed = stored(per_pack(packs, sign, schema), "signatures")
    some = signed.filter("size > 0")
    nodes = some.groupBy("one", "two", "size").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"))
    nodes = stored(nodes, "nodes")
    signatures = some.select("row", "pack", "bands").join(nodes.select(F.col("node").alias("row"), "copies"), "row")
    shares = signatures.select(F.col("row").alias("node"), F.explode("bands").alias("band"))
    buckets = shares.groupBy("band").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    edges = shares.join(buckets.select("band", "least"), "band").filter("node > least")
    groups = stored(components(edges.select(F.col("node").alias("a"), F.col("least").alias("b"))), "groups")

    wanted = groups.join(signed.select(F.col("row").alias("node"), "pack"), "node").groupBy("pack").agg(F.collect_list("node").alias("wanted"))
    sets = stored(per_pack(packs.join(wanted, "pack"), read_sets, "node long, grams binary"), "sets")
    tiles = tiles_of(groups, nodes.select("node", "copies").join(sets, "node"), tile)
    compared = tiles.groupBy("task").applyInPandas(compare, "node long, other long, links long")
    compared = stored(compared, "links")
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(compared.select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = nodes.join(links, "node", "left").join(classes, "node", "left")
    named = named.select("one", "two", "size", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    rows_of = signed.select("row", "pack", "key", "size", "one", "two").join(named, ["one", "two", "size"], "left")
    rows_of = stored(rows_of.select("row", "pack", "key", F.coalesce("root", "row").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "classes")
    order = F.struct(F.col("key").isNull(), "key", "row")
    tops = rows_of.groupBy("root").agg(F.min(order).alias("top"), F.count(F.lit(1)).alias("class_size"))
    return packs, rows_of.join(tops, "root")
