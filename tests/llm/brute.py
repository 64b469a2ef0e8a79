"""Plain versions of the corpus operators for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

SPACE = rb"[^\x20\x09-\x0D]+"
ALNUM = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def raw(text):
    return (text or "").encode()


def hits(items, length, places):
    """Flags of the items inside any run of ``length`` from one of ``places``."""
    out = [0] * len(items)
    for i in places:
        out[i : i + length] = [1] * length
    return out


def repeats(sequences, length):
    """For each sequence the flags of what lies inside a run of ``length`` that also starts elsewhere."""
    seen = Counter(s[i : i + length] for s in sequences for i in range(len(s) - length + 1))
    return [hits(s, length, [i for i in range(len(s) - length + 1) if seen[s[i : i + length]] > 1]) for s in sequences]


def substring_dedup(rows, window):
    words = [tuple(re.findall(SPACE, raw(t))) for _, t in rows]
    out = []
    for (key, _), w, g in zip(rows, words, repeats(words, window), strict=True):
        kept = b" ".join(x for x, gone in zip(w, g, strict=True) if not gone)
        out.append((key, len(w), sum(g), hashlib.sha256(kept).hexdigest()))
    return out


def suffix_dedup(rows, length):
    texts = [raw(t) for _, t in rows]
    out = []
    for (key, _), b, g in zip(rows, texts, repeats(texts, length), strict=True):
        kept = bytes(x for x, gone in zip(b, g, strict=True) if not gone)
        spans = sum(1 for i in range(len(g)) if g[i] and (i == 0 or not g[i - 1]))
        out.append((key, len(b), sum(g), spans, hashlib.sha256(kept).hexdigest()))
    return out


def contamination(rows, items, window):
    wanted = {}
    for item, text in items:
        w = re.findall(ALNUM, raw(text).translate(LOWER))
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            wanted.setdefault(tuple(w[i : i + size]), set()).add(item)
    out = []
    for key, text in rows:
        w = re.findall(ALNUM, raw(text).translate(LOWER))
        found, hit = set(), [0] * len(w)
        for size in {len(x) for x in wanted}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in wanted:
                    found |= wanted[tuple(w[i : i + size])]
                    hit[i : i + size] = [1] * size
        names = sorted(str(x) for x in found if x is not None)
        out.append((key, len(w), sum(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), any(hit)))
    return out


def near_duplicates(rows, n, threshold):
    """(key, class members, links) of each row, by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = re.findall(SPACE, raw(text))
        sets.append({tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set())
    linked = [
        {j for j in range(len(rows)) if j != i and sets[i] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])}
        for i in range(len(rows))
    ]
    label = list(range(len(rows)))
    for _ in rows:
        label = [min([label[i], *(label[j] for j in linked[i])]) for i in range(len(rows))]
    return [(rows[i][0], label.count(label[i]), len(linked[i])) for i in range(len(rows))]


def resampling(rows, targets, least, most, buckets, percent, min_words, seed):
    """(key, words, features, weight, score, rank) of each row, counted with dictionaries."""

    def grams(text):
        w = re.findall(ALNUM, raw(text).translate(LOWER))
        return len(w), [zlib.crc32(b" ".join(w[i : i + n])) % buckets for n in range(least, most + 1) for i in range(len(w) - n + 1)]

    found = [grams(t) for _, t in rows]
    source = Counter(b for _, g in found for b in g)
    target = Counter(b for _, t in targets for b in grams(t)[1])
    s, t = float(sum(source.values())), float(sum(target.values()))
    gain = lambda b: math.floor(1000 * math.log((target[b] + 1.0) * (s + buckets) / ((source[b] + 1.0) * (t + buckets))))
    out = []
    for (key, _), (n, g) in zip(rows, found, strict=True):
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(b) for b in g)
        out.append([key, n, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[5] = rank
    return [tuple(r) for r in out]


def best_fit(sizes, capacity, bins):
    """Bin of each group of falling sizes, one by one into the fitting bin with the least room; None if one fits nowhere."""
    room, out = [capacity] * bins, []
    for size in sizes:
        fits = [i for i in range(bins) if room[i] >= size]
        if not fits:
            return None
        at = min(fits, key=lambda i: (room[i], i))
        room[at] -= size
        out.append(at)
    return out
