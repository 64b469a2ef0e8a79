"""Best-fit-decreasing bin packing of runs of equal sizes, with the open bins in a balanced tree."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass


class Node:
    __slots__ = ("key", "left", "level", "right", "spans")

    def __init__(self, key: int, spans: list[tuple[int, int]]):
        self.key, self.spans, self.level, self.left, self.right = key, spans, 1, None, None


def skew(node: Node) -> Node:
    left = node.left
    if left is not None and left.level == node.level:
        node.left, left.right = left.right, node
        return left
    return node


def split(node: Node) -> Node:
    right = node.right
    if right is not None and right.right is not None and right.right.level == node.level:
        node.right, right.left = right.left, node
        right.level += 1
        return right
    return node


class Bins:
    """Spans of bins (first, count) by remaining capacity: an AA tree, so every step takes logarithmic time."""

    def __init__(self, capacity: int, bins: int):
        self.root = None
        self.put(capacity, (0, bins))

    def tightest(self, size: int) -> tuple[int, tuple[int, int]] | None:
        """The least remaining capacity that holds ``size``, and a span of bins that have it."""
        node, best = self.root, None
        while node is not None:
            if node.key >= size:
                node, best = node.left, node
            else:
                node = node.right
        return None if best is None else (best.key, best.spans[-1])

    def put(self, key: int, span: tuple[int, int]) -> None:
        self.root = self._put(self.root, key, span)

    def _put(self, node: Node | None, key: int, span: tuple[int, int]) -> Node:
        if node is None:
            return Node(key, [span])
        if key == node.key:
            node.spans.append(span)
            node.spans.sort(reverse=True)  # the first bins are taken first
            return node
        if key < node.key:
            node.left = self._put(node.left, key, span)
        else:
            node.right = self._put(node.right, key, span)
        return split(skew(node))

    def take(self, key: int) -> None:
        """Remove the span that ``tightest`` named."""
        self.root = self._take(self.root, key, False)

    def _take(self, node: Node | None, key: int, whole: bool) -> Node | None:
        if key < node.key:
            node.left = self._take(node.left, key, whole)
        elif key > node.key:
            node.right = self._take(node.right, key, whole)
        elif len(node.spans) > 1 and not whole:
            node.spans.pop()
            return node
        elif node.left is None:
            return node.right
        elif node.right is None:
            return node.left
        else:
            other = node.right
            while other.left is not None:
                other = other.left
            node.key, node.spans = other.key, other.spans
            node.right = self._take(node.right, other.key, True)
        return self._levelled(node)

    @staticmethod
    def _levelled(node: Node) -> Node:
        level = 1 + min(node.left.level if node.left else 0, node.right.level if node.right else 0)
        if level < node.level:
            node.level = level
            if node.right is not None and node.right.level > level:
                node.right.level = level
        node = skew(node)
        if node.right is not None:
            node.right = skew(node.right)
            if node.right.right is not None:
                node.right.right = skew(node.right.right)
        node = split(node)
        if node.right is not None:
            node.right = split(node.right)
        return node


@dataclass(frozen=True)
class Placed:
    """``count`` groups from place ``first`` on go to the bins from ``bin`` on, ``each`` to one bin."""

    first: int
    count: int
    bin: int
    each: int


def best_fit(runs: Iterable[tuple[int, int]], capacity: int, bins: int, at: int = 0) -> list[Placed] | None:
    """Pack ``runs`` (size, count) of falling sizes into ``bins`` bins; None if they do not hold them.

    As if groups came one by one, each to the fitting bin with the least room (of equal ones the first): after one
    group a bin is the tightest of all that still fit, so it takes as many of the run as it can, and bins with equal room
    do so alike. The steps grow with the number of different sizes, not of groups.
    """
    tree, out = Bins(capacity, bins), []
    for size, count in runs:
        while count:
            found = tree.tightest(size)
            if found is None:
                return None
            room, (first, n) = found
            each = room // size
            full = min(n, count // each)
            tree.take(room)
            if full:
                out.append(Placed(at, full * each, first, each))
                tree.put(room - size * each, (first, full))
                at, count, first, n = at + full * each, count - full * each, first + full, n - full
            if n and 0 < count < each:
                out.append(Placed(at, count, first, count))
                tree.put(room - size * count, (first, 1))
                at, count, first, n = at + count, 0, first + 1, n - 1
            if n:
                tree.put(room, (first, n))
    return out


def into_shards(runs: list[tuple[int, int]], shards: int) -> list[Placed]:
    """Pack all ``runs`` into ``shards`` bins whose fills are as equal as whole groups allow.

    Groups above an even share of what is left get a bin of their own. The others go by best fit at the least
    capacity, searched from an even share upwards, that holds them; that of the even share and the largest group always does.
    """
    out, at, bins = [], 0, shards
    runs, total = list(runs), sum(s * n for s, n in runs)
    while runs and bins > 1 and runs[0][0] * bins > total:
        size, count = runs[0]
        out.append(Placed(at, 1, shards - bins, 1))
        at, bins, total = at + 1, bins - 1, total - size
        runs[:1] = [(size, count - 1)] if count > 1 else []
    if not runs:
        return out
    low = max(-(-total // bins), runs[0][0]) - 1  # no packing can do with this
    step, found, high = 1, None, None
    while found is None:
        high = low + step
        found = best_fit(runs, high, bins, at)
        if found is None:
            low, step = high, 2 * step
    while high - low > 1:
        middle = (low + high) // 2
        better = best_fit(runs, middle, bins, at)
        low, high, found = (low, middle, better) if better is not None else (middle, high, found)
    return out + [Placed(p.first, p.count, p.bin + shards - bins, p.each) for p in found]


def into_capacity(runs: list[tuple[int, int]], capacity: int) -> list[Placed]:
    """Pack all ``runs`` into as many bins of ``capacity`` as best fit needs; a larger group has a bin of its own."""
    over = [(s, n) for s, n in runs if s > capacity]
    alone = sum(n for _, n in over)
    out = [Placed(0, alone, 0, 1)] if alone else []
    rest = runs[len(over) :]
    found = best_fit(rest, capacity, sum(n for _, n in rest) or 1, alone)
    return out + [Placed(p.first, p.count, p.bin + alone, p.each) for p in found]
