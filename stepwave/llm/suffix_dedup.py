"""Removal of byte strings that occur elsewhere, decided by run-length indexes.

An index of the whole corpus would not fit one task. Documents are therefore cut into super-windows: runs of
neighbouring windows that have the same smallest k-gram (by hash, the leftmost one). Equal windows have equal
smallest k-grams, so only super-windows of one k-gram can share a window, and they meet in one index. K-grams that
occur once, and super-windows of which all copies are identical, are settled by their hashes before.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .hashing import BASE, BYTE_VALUES, SEGMENT, covered, inverse, mixed, powers, windows
from .run_index import END, RunIndex, words_at
from .shared import MESSAGE, answered, bucket_count, fields, gathered, joined, messages, opened, packed, per_pack, release, stored, text_bytes, typed
from .substring_dedup import distinct, seen_elsewhere

#: Bytes of one index; super-windows of one k-gram always share one.
INDEX_BYTES = 1 << 19
#: K-grams in more different super-windows than this are settled window by window instead, by 96-bit hashes.
MOST_CONTENTS = 2_000
NONE, COPY, COPY_SENDS, SENDS, SENDS_WINDOWS, COPY_SENDS_WINDOWS = range(6)
PLACE = np.uint64((1 << 23) - 1)
FIRST_MIX, SECOND_MIX = np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F)


def multiplier(i: int) -> np.uint64:
    """An odd 64-bit number for the i-th part of a k-gram."""
    return np.uint64((0x165667B19E3779F9 + 2 * i * 0x27D4EB2F165667C5) % 2**64)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes (at least 8) from every position that has them."""
    word = words_at(data)[: max(len(data) - 7, 0)] * FIRST_MIX
    word ^= word >> np.uint64(29)
    word *= SECOND_MIX
    word ^= word >> np.uint64(32)
    n = max(len(data) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for i, at in enumerate([*range(0, size - 8, 8), size - 8]):
        out += word[at : at + n] * multiplier(i)
    return mixed(out)


def super_windows(data: np.ndarray, begins: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Start, number of windows, k-gram hash and content hash of all super-windows of a pack's documents."""
    n, reach = len(data), length - gram + 1
    found = []
    valid_step = np.zeros(n + 1, np.int8)
    stop = np.maximum(begins[1:] - 1 - length + 1, begins[:-1])
    some = stop > begins[:-1]
    valid_step[begins[:-1][some]] += 1
    valid_step[stop[some]] -= 1
    valid = np.cumsum(valid_step[:n], dtype=np.int8) > 0
    for at in range(0, n, SEGMENT):
        piece = data[at : at + SEGMENT + length - 1]
        hashes = gram_hashes(piece, gram)
        if len(hashes) < reach:
            continue
        least = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
        span = 1
        while span * 2 <= reach:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < reach:
            least = np.minimum(least[: -(reach - span)], least[reach - span :])
        place = (least & PLACE).astype(np.int32)
        ok = valid[at : at + len(place)]
        ok = ok if len(ok) == len(place) else np.append(ok, np.zeros(len(place) - len(ok), bool))
        new = ok.copy()
        new[1:] &= (place[1:] != place[:-1]) | ~ok[:-1]
        start = np.flatnonzero(new)
        if not len(start):
            continue
        size = np.add.reduceat(ok, start, dtype=np.int64)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[piece] * powers(BASE, len(piece)), out=sums[1:])
        content = mixed((sums[start + size + length - 1] - sums[start]) * powers(inverse(BASE), len(piece))[start])
        found.append((start + at, size, mixed(hashes[place[start]]), content))  # minima crowd at the low end
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def judged(columns: list[np.ndarray], ends: np.ndarray, packs: np.ndarray, most_contents: int) -> np.ndarray:
    """What each pack has to do with each of its distinct super-windows."""
    gram, content, many = columns
    order = np.lexsort((content, gram))
    g, c, n = gram[order], content[order], 1 + many[order].astype(np.int64)
    new_gram = np.ones(len(g), bool)
    new_gram[1:] = g[1:] != g[:-1]
    new = new_gram.copy()
    new[1:] |= c[1:] != c[:-1]
    of_gram, of_content = np.cumsum(new_gram) - 1, np.cumsum(new) - 1
    contents = np.bincount(of_gram, weights=new)[of_gram]
    copies = np.bincount(of_content, weights=n)[of_content] > 1
    several, common = contents > 1, contents > most_contents
    code = np.full(len(g), NONE, np.uint8)
    code[copies] = COPY
    code[several & ~copies] = SENDS
    code[several & copies & new] = COPY_SENDS
    code[common & ~copies] = SENDS_WINDOWS
    code[common & copies & new] = COPY_SENDS_WINDOWS
    out = np.empty(len(g), np.uint8)
    out[order] = code
    return out


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each start, one after the other."""
    total = np.concatenate(([0], np.cumsum(sizes)))
    return np.arange(total[-1]) + np.repeat(starts - total[:-1], sizes)


def indexed(gram: np.ndarray, size: np.ndarray, text: bytes, length: int) -> np.ndarray:
    """One flag per window: whether it occurs elsewhere among these super-windows. Sorted into indexes by k-gram."""
    begin = np.concatenate(([0], np.cumsum(size + length - 1)))
    first = np.concatenate(([0], np.cumsum(size)))
    order = np.argsort(gram, kind="stable")
    out = np.zeros(first[-1], bool)
    data = np.frombuffer(text, np.uint8)
    filled = np.cumsum((size + length)[order])
    new = np.ones(len(order), bool)
    new[1:] = gram[order][1:] != gram[order][:-1]
    heads = np.flatnonzero(new)
    cuts, base = [0], 0
    for i, head in enumerate(heads):  # an index takes whole k-grams
        stop = heads[i + 1] if i + 1 < len(heads) else len(order)
        if filled[stop - 1] - base > INDEX_BYTES and head > cuts[-1]:
            cuts.append(int(head))
            base = filled[head - 1]
    cuts.append(len(order))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        chosen = order[a:b]
        sizes = size[chosen] + length - 1
        at = np.concatenate(([0], np.cumsum(sizes + 1)))
        body = np.full(at[-1], END, np.uint8)
        body[ranges(at[:-1], sizes)] = data[ranges(begin[chosen], sizes)]
        longest = RunIndex(body).matching_statistics()
        out[ranges(first[chosen], size[chosen])] = longest[ranges(at[:-1], size[chosen])] >= length
    return out


def remove_long_matches(
    docs: DataFrame, length: int = 200, key: str = "doc_id", text: str = "text", keep_text: bool = True, most_contents: int = MOST_CONTENTS
) -> DataFrame:
    """Remove every byte inside a string of ``length`` bytes that also starts anywhere else (same document included).

    Strings are judged on the input and never cross documents. Returns ``key``, ``n_bytes``, ``n_removed``,
    ``n_spans`` (maximal removed runs), ``kept_sha256`` and, with ``keep_text``, ``spans`` (begin and end of the
    removed runs) and ``kept``: the remaining bytes as text, without bytes of characters cut in two.
    A null text counts as empty, repeated rows repeat each other, null keys and other columns do not matter; an
    empty table gives an empty one. ``length`` must be at least 16.
    """
    if length < 16:
        raise ValueError("length must be at least 16")
    gram = min(32, max(8, length // 6))
    if length - gram > 250:
        gram = length - 250
    packs = packed(docs, key, text)
    size = text_bytes(packs)
    buckets, parts = bucket_count(size // 5), bucket_count(size, 2 << 20)
    kind = docs.schema[key].dataType
    key_type = to_arrow_type(kind)

    def state(row):
        data, begins = opened(row["body"], row["lens"])
        start, count, grams, content = super_windows(data, begins, length, gram)
        keys, contents, many, where = distinct(grams, content)
        if len(keys):
            yield messages(row["pack"], keys, buckets, contents, many)
        kept = np.diff(start, prepend=0).astype("<i4").tobytes() + count.astype(np.uint8).tobytes() + where.astype("<i4").tobytes()
        body = zstandard.ZstdCompressor(level=1).compress(kept)
        yield {"bucket": pa.array([-1], pa.int32()), "pack": pa.array([row["pack"]], pa.int64()), "body": pa.array([body], pa.binary())}

    def remembered(row):
        raw = zstandard.ZstdDecompressor().decompress(row["state"])
        n = len(raw) // 9
        start = np.cumsum(np.frombuffer(raw, "<i4", n).astype(np.int64))
        count = np.frombuffer(raw, np.uint8, n, 4 * n).astype(np.int64)
        where = np.frombuffer(raw, "<i4", n, 5 * n)
        code = joined(row["codes"], np.uint8)
        sample = np.zeros(len(code), np.int64)
        sample[where[::-1]] = np.arange(n)[::-1]
        return start, count, where, code, sample

    def window_keys(data, start, count):
        """96-bit keys of the windows of these super-windows."""
        keys, second = np.zeros(count.sum(), np.uint64), np.zeros(count.sum(), np.uint32)
        done = 0
        for at in range(0, len(start), 4096):  # bounded intermediate arrays
            s, c = start[at : at + 4096], count[at : at + 4096]
            body = data[ranges(s, c + length - 1)]
            local = ranges(np.concatenate(([0], np.cumsum(c + length - 1)))[:-1], c)
            values = BYTE_VALUES[body]
            keys[done : done + len(local)] = windows(values, local, length)
            second[done : done + len(local)] = windows(values, local, length, 1).astype(np.uint32)
            done += len(local)
        return keys, second

    def send(row):
        start, count, where, code, sample = remembered(row)
        data, begins = opened(row["body"], row["lens"])
        chosen = sample[(code == SENDS) | (code == COPY_SENDS)]
        if len(chosen):
            _, _, grams, _ = chosen_grams(data, start[chosen], count[chosen], length, gram)
            order = np.argsort(grams, kind="stable")
            yield text_messages(row["pack"], data, grams[order], start[chosen][order], count[chosen][order], parts, length)
        chosen = sample[(code == SENDS_WINDOWS) | (code == COPY_SENDS_WINDOWS)]
        if len(chosen):
            keys, second, many, _ = distinct(*window_keys(data, start[chosen], count[chosen]))
            out = messages(row["pack"], keys, parts, second, many)
            out["bucket"] = pa.array(out["bucket"].to_numpy() + parts, pa.int32())
            yield out

    def match(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pack")
        if rows["bucket"].iloc[0] >= parts:
            split = [fields(b, np.uint64, np.uint32, bool) for b in rows["body"]]
            columns = [np.concatenate(c) for c in zip(*split, strict=True)]
            ends = np.cumsum([len(p[0]) for p in split])
            answers = [v.tobytes() for v in np.split(seen_elsewhere(columns, ends, rows["pack"].to_numpy()), ends[:-1])]
        else:
            grams, sizes, bodies = [], [], []
            for b in rows["body"]:
                n = int(np.frombuffer(b, "<i8", 1)[0])
                grams.append(np.frombuffer(b, np.uint64, n, 8))
                sizes.append(np.frombuffer(b, np.uint8, n, 8 + 8 * n).astype(np.int64))
                bodies.append(b[8 + 9 * n :])
            flags = indexed(np.concatenate(grams), np.concatenate(sizes), b"".join(bodies), length)
            ends = np.cumsum([s.sum() for s in sizes])
            answers = [v.astype(np.uint8).tobytes() for v in np.split(flags, ends[:-1])]
        release()
        return pd.DataFrame({"bucket": rows["bucket"].to_numpy(), "pack": rows["pack"].to_numpy(), "body": answers})

    def finish(row):
        start, count, where, code, sample = remembered(row)
        data, begins = opened(row["body"], row["lens"])
        first = np.concatenate(([0], np.cumsum(count[sample])))
        flag = np.repeat((code == COPY) | (code == COPY_SENDS) | (code == COPY_SENDS_WINDOWS), count[sample])
        sent = np.flatnonzero((code == SENDS) | (code == COPY_SENDS))
        if len(sent):
            chosen = sample[sent]
            _, _, grams, _ = chosen_grams(data, start[chosen], count[chosen], length, gram)
            order = np.argsort(grams, kind="stable")
            flag[ranges(first[sent][order], count[chosen][order])] |= joined(row["texts"], np.uint8) > 0
        sent = np.flatnonzero((code == SENDS_WINDOWS) | (code == COPY_SENDS_WINDOWS))
        if len(sent):
            *_, place = distinct(*window_keys(data, start[sample[sent]], count[sample[sent]]))
            flag[ranges(first[sent], count[sample[sent]])] |= joined(row["windows"], np.uint8)[place] > 0
        hit = ranges(start, count)[flag[ranges(first[where], count)]]
        gone = covered(hit, length, len(data))
        edges = np.diff(gone.astype(np.int8), prepend=0)
        begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        spans = np.searchsorted(begin, begins)
        removed = np.concatenate(([0], np.cumsum(gone)))[begins]
        raw = data.tobytes()
        pieces = []
        for i in range(len(begins) - 1):
            a, z = int(begins[i]), int(begins[i + 1]) - 1
            cuts = [a, *np.stack((begin, end), 1)[spans[i] : spans[i + 1]].ravel().tolist(), z]
            pieces.append(b"".join(raw[cuts[j] : cuts[j + 1]] for j in range(0, len(cuts), 2)))
        columns = {
            key: pa.array(row["keys"], key_type),
            "n_bytes": pa.array(np.diff(begins) - 1, pa.int64()),
            "n_removed": pa.array(np.diff(removed), pa.int64()),
            "n_spans": pa.array(np.diff(spans), pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in pieces], pa.string()),
        }
        if keep_text:
            inside = np.stack((begin, end), 1) - np.repeat(begins[:-1], np.diff(spans))[:, None]
            columns["spans"] = pa.array([inside[spans[i] : spans[i + 1]].tolist() for i in range(len(begins) - 1)], pa.list_(pa.list_(pa.int64())))
            columns["kept"] = pa.array([p.decode("utf-8", "ignore") for p in pieces], pa.string())
        yield columns

    columns_of = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema = typed(columns_of + (", spans array<array<long>>, kept string" if keep_text else ""), 0, key, kind)
    stated = stored(per_pack(packs, state, MESSAGE), "super-windows", "none")
    states = stated.filter("bucket < 0").select("pack", F.col("body").alias("state"))
    codes = gathered(answered(stated.filter("bucket >= 0"), partial(judged, most_contents=most_contents), np.uint64, np.uint64, bool), "codes")
    known = stored(states.join(codes, "pack", "left"), "codes")
    asked = per_pack(packs.join(known, "pack"), send, MESSAGE)
    spread = asked.repartition(max(parts // 4, 1), "bucket")  # small messages, much work: sizes should not merge tasks
    answers = stored(spread.groupBy("bucket").applyInPandas(match, MESSAGE), "matches")
    by_text = gathered(answers.filter(F.col("bucket") < parts), "texts")
    by_window = gathered(answers.filter(F.col("bucket") >= parts), "windows")
    replies = known.join(by_text, "pack", "left").join(by_window, "pack", "left")
    return per_pack(packs.join(replies, "pack"), finish, schema)


def chosen_grams(data: np.ndarray, start: np.ndarray, count: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """The mixed hash of the smallest k-gram of each of these super-windows, which is that of its first window."""
    out = np.zeros(len(start), np.uint64)
    for at in range(0, len(start), 8192):
        s = start[at : at + 8192]
        body = data[s[:, None] + np.arange(length)]
        hashes = gram_hashes(body.ravel(), gram)
        grid = np.zeros(body.size, np.uint64)
        grid[: len(hashes)] = hashes
        grid = grid.reshape(-1, length)[:, : length - gram + 1]
        least = np.argmin((grid & ~PLACE) | np.arange(grid.shape[1], dtype=np.uint64), axis=1)
        out[at : at + 8192] = mixed(grid[np.arange(len(s)), least])
    return start, count, out, out


def text_messages(pack: int, data: np.ndarray, grams: np.ndarray, start: np.ndarray, count: np.ndarray, parts: int, length: int) -> dict:
    """Super-windows with their text, sorted by k-gram, one message per bucket."""
    limits = (np.arange(parts + 1, dtype=np.uint64) * np.uint64(2**32) + np.uint64(parts - 1)) // np.uint64(parts)
    cuts = np.searchsorted(grams >> np.uint64(32), limits)
    full = np.flatnonzero(cuts[1:] > cuts[:-1])
    bodies = []
    for b in full:
        a, z = cuts[b], cuts[b + 1]
        text = data[ranges(start[a:z], count[a:z] + length - 1)].tobytes()
        bodies.append(np.int64(z - a).tobytes() + grams[a:z].tobytes() + count[a:z].astype(np.uint8).tobytes() + text)
    return {"bucket": pa.array(full, pa.int32()), "pack": pa.array(np.full(len(full), pack), pa.int64()), "body": pa.array(bodies, pa.binary())}
