"""A run-length index of a text: suffix order, run-compressed Burrows-Wheeler transform, matching statistics."""

from __future__ import annotations

import numpy as np

#: Ends every part of a text; no UTF-8 text has this byte.
END = 0xFF


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every position of ``text`` as one little-endian number; zeros beyond the end."""
    padded = np.zeros(len(text) + 8, np.uint8)
    padded[: len(text)] = text
    return np.ndarray((len(text) + 1,), "<u8", padded, strides=(1,))


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling from eight bytes on; only groups that are still tied are sorted again."""
    n = len(text)
    first = words_at(text)[:n].byteswap()
    order = np.argsort(first)
    step = 8
    new = np.ones(n, bool)
    new[1:] = first[order][1:] != first[order][:-1]
    rank = np.zeros(n + 1, np.int64)  # rank[n] = 0: the empty suffix; others count from 1
    heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = heads + 1
    alone = new & np.append(new[1:], True)
    tied = np.flatnonzero(~alone)
    while len(tied):
        at = order[tied]
        group = rank[at]
        follow = rank[np.minimum(at + step, n)]
        again = np.argsort(group * np.int64(n + 2) + follow)
        at, group, follow = at[again], group[again], follow[again]
        order[tied] = at
        new = np.ones(len(tied), bool)
        new[1:] = (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])
        rank[at] = np.maximum.accumulate(np.where(new, tied, 0)) + 1
        alone = new & np.append(new[1:], True)
        tied = tied[~alone]
        step *= 2
    return order


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes at ``a`` and at ``b``."""
    n, words = len(text), words_at(text)
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    done = 0
    while len(live):
        x, y = a[live] + done, b[live] + done
        differ = words[np.minimum(x, n)] ^ words[np.minimum(y, n)]
        lowest = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, (np.log2(np.maximum(lowest, 1).astype(np.float64)) // 8).astype(np.int64))
        same = np.minimum(same, n - np.maximum(x, y))
        out[live] += same
        live = live[same == 8]
        done += 8
    return out


class RunIndex:
    """The runs of a text's Burrows-Wheeler transform with text positions sampled at their ends.

    ``heads`` are the text positions of the suffixes that begin a run, ``tails`` of those that end one. At a run's
    border the common prefix of the two neighbours is stored; everywhere else it follows, as inside a run it
    shrinks by one from one text position to the next.
    """

    def __init__(self, text: np.ndarray):
        order = suffix_order(text)
        before = text[order - 1]
        border = np.flatnonzero(before[1:] != before[:-1]) + 1
        self.size = len(text)
        self.symbols = before[np.concatenate(([0], border))] if len(text) else before
        self.heads, self.tails = order[border], order[border - 1]
        self.first, self.last = (order[:1], order[-1:])
        # Position 0 has no preceding symbol: the neighbours of its suffix are stored as well.
        zero = int(np.flatnonzero(order == 0)[0]) if len(text) else 0
        self.border = np.concatenate((border, [r for r in (zero, zero + 1) if 0 < r < len(order)])).astype(np.int64)
        self.upper, self.lower = order[self.border - 1], order[self.border]
        self.common = common_prefix(text, self.upper, self.lower)

    @property
    def runs(self) -> int:
        return len(self.symbols)

    def matching_statistics(self) -> np.ndarray:
        """For every position, streamed in text order, the length of its longest match with any other position."""
        return np.maximum(self._along(self.lower, self.first), self._along(self.upper, self.last))

    def _along(self, sampled: np.ndarray, none: np.ndarray) -> np.ndarray:
        here = np.arange(self.size)
        value = np.full(self.size, -1, np.int64)
        value[none] = 0
        np.maximum.at(value, sampled, self.common)
        source = np.maximum.accumulate(np.where(value >= 0, here, 0))
        return np.maximum(np.where(value[source] >= 0, value[source], 0) - (here - source), 0)


def longest_elsewhere(parts: list[bytes]) -> np.ndarray:
    """Matching statistics of ``parts`` (each followed by one end byte) among themselves; matches may pass an end byte."""
    text = np.frombuffer(b"".join(p + bytes([END]) for p in parts), np.uint8)
    return RunIndex(text).matching_statistics()
