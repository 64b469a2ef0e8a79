"""Hashes of words, windows and byte strings over whole packs, with numpy."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

SEGMENT = 1 << 20
#: Longer words are hashed by BLAKE2: sums modulo 2^64 are equal for certain pairs of words of 1,024 bytes.
LONG_WORD = 64
_RNG = np.random.default_rng(20240229)
BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
WINDOW_BASES = (np.uint64(0xD1342543DE82EF95), np.uint64(0xF1357AEA2E62A9C5))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if len(known) <= SEGMENT + 4096:
            _POWERS[int(base)] = known
    return known[:n]


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def words(data: np.ndarray, part_of_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and hash of every run of bytes that ``part_of_word`` (256 flags) allows."""
    begins, ends, hashes = [], [], []
    at, n = 0, len(data)
    while at < n:
        stop = min(n, at + SEGMENT)
        while stop < n and part_of_word[data[stop - 1]]:  # a segment ends with a byte outside words
            rest = np.flatnonzero(~part_of_word[data[stop : stop + 4096]])
            stop = min(n, stop + (int(rest[0]) + 1 if len(rest) else 4096))
        piece = data[at:stop]
        inside = part_of_word[piece]
        edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
        b, e = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        if len(b):
            values = BYTE_VALUES[piece]
            values *= powers(BASE, len(piece))
            values[~inside] = 0
            h = mixed(np.add.reduceat(values, b) * powers(inverse(BASE), len(piece))[b])
            for i in np.flatnonzero(e - b > LONG_WORD):
                h[i] = int.from_bytes(blake2b(piece[b[i] : e[i]].tobytes(), digest_size=8).digest(), "little")
            begins.append(b + at)
            ends.append(e + at)
            hashes.append(h)
        at = stop
    if not begins:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(begins), np.concatenate(ends), np.concatenate(hashes)


def windows(hashes: np.ndarray, starts: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """Hash of the ``length`` values from each start; every window must lie inside ``hashes``."""
    base = WINDOW_BASES[which]
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum((mixed(hashes) if which else hashes) * powers(base, len(hashes)), out=sums[1:])
    return mixed((sums[starts + length] - sums[starts]) * powers(inverse(base), len(hashes) + 1)[starts])


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Flags of the ``n`` places inside any of the runs of ``length`` from ``starts``."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1) if len(starts) < 1000 else np.add(step, np.bincount(starts, minlength=n + 1), out=step, casting="unsafe")
    ends = starts + length
    step -= np.bincount(ends, minlength=n + 1).astype(np.int32)
    return np.cumsum(step[:n]) > 0


def flags(pattern_bytes: bytes, inside: bool) -> np.ndarray:
    """256 flags: the given bytes have the value ``inside``, the others the opposite."""
    out = np.full(256, not inside)
    out[np.frombuffer(pattern_bytes, np.uint8)] = inside
    return out


#: Words are what stands between blank, tab, line feed, vertical tab, form feed and carriage return.
NOT_SPACE = flags(b" \t\n\x0b\x0c\r", False)
#: Words are letters, digits and all bytes beyond ASCII.
ALNUM = flags(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100), *range(0x41, 0x5B)]), True)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
