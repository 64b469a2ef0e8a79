"""Removal of word sequences that occur elsewhere, found by difference-cover anchors."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from .hashing import NOT_SPACE, covered, windows, words
from .shared import MESSAGE, answered, bucket_count, gathered, joined, messages, opened, packed, per_pack, stored, text_bytes, typed

#: Difference covers by their modulus: every residue is a difference of two members.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}


def modulus(window: int) -> int:
    """The largest modulus that leaves anchors of at least two fifths of a window (windows of 3 words up)."""
    return max([m for m in COVERS if window - m + 1 >= max(1, 2 * window // 5)], default=0)


def tokens(row: dict) -> tuple:
    """Words of a pack: bytes, document begins, word begins and ends, hashes, first word of each document."""
    data, begins = opened(row["body"], row["lens"])
    start, end, hashes = words(data, NOT_SPACE)
    return data, begins, start, end, hashes, np.searchsorted(start, begins)


def places(hashes: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows inside a document, and their place in it."""
    counts = np.diff(first)
    place = np.arange(len(hashes)) - np.repeat(first[:-1], counts)
    inside = place + length <= np.repeat(counts, counts)
    starts = np.flatnonzero(inside)
    return starts, place[starts]


def anchors(hashes: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the anchors at cover positions, of documents that have a window."""
    m = modulus(window)
    size = window - m + 1 if m else window
    starts, place = places(hashes, first, size)
    long_enough = np.repeat(np.diff(first) >= window, np.diff(first))[starts]
    chosen = np.isin(place % m, COVERS[m]) & long_enough if m else long_enough
    starts = starts[chosen]
    return starts, windows(hashes, starts, size)


def candidates(repeated: np.ndarray, hashes: np.ndarray, first: np.ndarray, window: int) -> np.ndarray:
    """Starts of the windows that hold a repeated anchor: two equal windows always share an aligned one."""
    reach = max(modulus(window), 1)
    counts = np.diff(first)
    begin = np.repeat(first[:-1], counts)[repeated]
    from_ = np.maximum(repeated - reach + 1, begin)
    step = np.bincount(from_, minlength=len(hashes) + 1) - np.bincount(repeated + 1, minlength=len(hashes) + 1)
    near = np.cumsum(step[: len(hashes)]) > 0
    starts, _ = places(hashes, first, window)
    return starts[near[starts]]


def distinct(key: np.ndarray, second: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys, whether each occurs more than once, and the place of every input among them."""
    order = np.argsort(key, kind="stable") if second is None else np.lexsort((second, key))
    k = key[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    if second is not None:
        s = second[order]
        new[1:] |= s[1:] != s[:-1]
    heads = np.flatnonzero(new)
    many = np.diff(np.append(heads, len(k))) > 1
    where = np.empty(len(k), np.int64)
    where[order] = np.cumsum(new) - 1
    return (k[heads], many, where) if second is None else (k[heads], s[heads], many, where)


def seen_elsewhere(columns: list[np.ndarray], ends: np.ndarray, packs: np.ndarray) -> np.ndarray:
    """1 for keys that another message has too, or that occur more than once in their own."""
    *key, many = columns
    order = np.argsort(key[0], kind="stable") if len(key) == 1 else np.lexsort(key[::-1])
    same = np.ones(max(len(many) - 1, 0), bool)
    for k in key:
        same &= k[order][1:] == k[order][:-1]
    found = many[order] > 0
    found[1:] |= same
    found[:-1] |= same
    out = np.empty(len(many), np.uint8)
    out[order] = found
    return out


def window_keys(hashes: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """96 bits per window: a 64-bit key and 32 bits of an independent hash."""
    return windows(hashes, starts, window), windows(hashes, starts, window, 1).astype(np.uint32)


def repeated_windows(row: dict, window: int, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Candidate windows of a pack whose anchors were answered."""
    starts, keys = anchors(hashes, first, window)
    _, _, where = distinct(keys)
    hit = joined(row["anchors"], np.uint8)[where] > 0 if len(keys) else np.zeros(0, bool)
    return candidates(starts[hit], hashes, first, window)


def remove_repeats(docs: DataFrame, window: int = 35, key: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """Remove every word inside a window of ``window`` words that also starts anywhere else.

    Anchors (short windows at positions of a difference cover) are hashed for all documents; any two equal
    windows share an anchor at the same offset. Windows are extended from anchors that repeat and compared
    by 96-bit hashes; everything is judged on the input.

    Returns ``key``, ``n_words``, ``n_removed``, ``kept_sha256`` and, with ``keep_text``, ``kept`` (the remaining
    words joined by one space). A null text has no words and stays null. Repeated rows repeat each other; null
    keys and other columns (any names) do not matter. An empty table gives an empty one.
    """
    if window < 1:
        raise ValueError("window must be at least 1")
    packs = packed(docs, key, text)
    size = text_bytes(packs)
    buckets = bucket_count(size // 3)
    id_type = to_arrow_type(docs.schema[key].dataType)
    columns_of = "n_words long, n_removed long, kept_sha256 string" + (", kept string" if keep_text else "")
    schema = typed(columns_of, 0, key, docs.schema[key].dataType)

    def state_anchors(row):
        *_, hashes, first = tokens(row)
        _, keys = anchors(hashes, first, window)
        keys, many, _ = distinct(keys)
        if len(keys):
            yield messages(row["pack"], keys, buckets, many)

    def state_windows(row):
        *_, hashes, first = tokens(row)
        starts = repeated_windows(row, window, hashes, first)
        keys, second, many, _ = distinct(*window_keys(hashes, starts, window))
        if len(keys):
            yield messages(row["pack"], keys, buckets, second, many)

    def finish(row):
        data, begins, start, end, hashes, first = tokens(row)
        starts = repeated_windows(row, window, hashes, first)
        *_, where = distinct(*window_keys(hashes, starts, window))
        answer = joined(row["windows"], np.uint8)
        hit = answer[where] > 0 if len(starts) else np.zeros(0, bool)
        gone = covered(starts[hit], window, len(hashes))
        stay = ~gone
        step = np.zeros(len(data) + 2, np.int8)
        step[start[stay]] += 1
        step[end[stay] + 1] -= 1
        out = data.copy()
        out[end[stay]] = 32
        keep = np.cumsum(step[: len(data)], dtype=np.int8) > 0
        places_ = np.concatenate(([0], np.cumsum(keep)))[begins]
        kept = out[keep].tobytes()
        pieces = [kept[a : max(a, b - 1)] for a, b in zip(places_[:-1], places_[1:], strict=True)]
        removed = np.concatenate(([0], np.cumsum(gone)))[first]
        columns = {
            key: pa.array(row["keys"], id_type),
            "n_words": pa.array(np.diff(first), pa.int64()),
            "n_removed": pa.array(np.diff(removed), pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in pieces], pa.string()),
        }
        if keep_text:
            columns["kept"] = pa.array(pieces, pa.binary()).cast(pa.string())
        yield columns

    first_answers = gathered(answered(per_pack(packs, state_anchors, MESSAGE), seen_elsewhere, np.uint64, bool), "anchors")
    known = stored(packs.select("pack").join(first_answers, "pack", "left"), "anchors")
    asked = per_pack(packs.join(known, "pack", "left"), state_windows, MESSAGE)
    second = gathered(answered(asked, seen_elsewhere, np.uint64, np.uint32, bool), "windows")
    answers = stored(known.join(second, "pack", "left"), "windows")
    return per_pack(packs.join(answers, "pack", "left"), finish, schema)

