"""Greedy scans over sorted arrays of times.

A scan keeps an anchor time and emits the items far enough from it.  Two rules exist:

* restart: the anchor is the first item after an emission, an item more than ``gap`` later is emitted;
* follow: the anchor is the last emitted item, the first item is always emitted, and an item exactly
  ``gap`` later qualifies.

Spark groups and sorts the items; the jumps from one emission to the next, which no window frame can
express, are taken here on whole Arrow arrays.  Native array functions give the same but take some
microseconds per item, far more than a jump.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Workers get this module's functions themselves, so they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NO_ANCHOR = -(1 << 63)


@dataclass(frozen=True)
class Rule:
    gap: int
    follow: bool = False

    def reach(self, times: np.ndarray, anchors) -> np.ndarray:
        """Position of the first item that each anchor makes the scan emit."""
        return np.searchsorted(times, anchors + self.gap, side="left" if self.follow else "right")

    def jumps(self, times: np.ndarray) -> list[int]:
        """The same for the items themselves as anchors; always a later position."""
        return np.maximum(self.reach(times, times), np.arange(1, len(times) + 1)).tolist()

    def begin(self, times: np.ndarray, anchor: int, jumps: list[int]) -> tuple[int, int]:
        """Position of the first emission and the anchor before it."""
        if anchor != NO_ANCHOR:
            return int(self.reach(times, anchor)), anchor
        return (0, NO_ANCHOR) if self.follow else (jumps[0], int(times[0]))

    def proceed(self, times: np.ndarray, at: int, jumps: list[int]) -> tuple[int, int]:
        """Position of the emission after the one at ``at`` and the anchor in between."""
        start = at if self.follow else at + 1
        return (jumps[start], int(times[start])) if start < len(times) else (len(times), NO_ANCHOR)


def emitted_positions(times: Column, anchor: Column, rule: Rule) -> Column:
    """Positions of the emitted items, from 0; ``anchor`` is the time carried in."""

    @F.pandas_udf("array<int>")
    def scan(arrays: pd.Series, anchors: pd.Series) -> pd.Series:
        found = []
        for values, carried in zip(arrays, anchors):
            jumps, out = rule.jumps(values), []
            at, _ = rule.begin(values, carried, jumps)
            while at < len(values):
                out.append(at)
                at, _ = rule.proceed(values, at, jumps)
            found.append(out)
        return pd.Series(found, dtype=object)

    return scan(times, anchor)


def transitions(times: Column, rule: Rule) -> Column:
    """What a scan of one slice does to the anchor: ``fresh``, the anchor it leaves when none is carried
    in, and ``heads`` with ``exits``: a carried anchor takes the exit of the first head that it reaches,
    or stays as it is when it reaches none.

    A carried anchor lies within ``gap`` before the first item, so only the items up to the first one
    more than ``gap`` after the first item can be heads.  Of neighbours with one exit the last is listed.
    """

    @F.pandas_udf("fresh bigint, heads array<bigint>, exits array<bigint>")
    def scan(arrays: pd.Series) -> pd.DataFrame:
        found = []
        for values in arrays:
            jumps, known = rule.jumps(values), {}

            def leave(at: int, anchor: int) -> int:
                path = []
                while at < len(values) and at not in known:
                    path.append(at)
                    at, anchor = rule.proceed(values, at, jumps)
                anchor = known.get(at, anchor)
                known.update(dict.fromkeys(path, anchor))
                return anchor

            count = min(int(np.searchsorted(values, values[0] + rule.gap, side="right")) + 1, len(values))
            exits = np.array([leave(i, NO_ANCHOR) for i in range(count)], dtype=np.int64)
            last = np.append(exits[1:] != exits[:-1], True)
            found.append((leave(*rule.begin(values, NO_ANCHOR, jumps)), values[:count][last], exits[last]))
        return pd.DataFrame(found, columns=["fresh", "heads", "exits"])

    return scan(times)


def entry_anchors(moves: DataFrame, keys, rule: Rule) -> DataFrame:
    """The anchor on entry to each slice, from the slices' transitions in order.

    Only an anchor is kept while the summaries of a group stream past; nothing of a group is gathered.
    """
    schema = T.StructType([*(moves.schema[k] for k in (*keys, "slice")), T.StructField("anchor", T.LongType())])
    width = len(keys)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, anchor = None, NO_ANCHOR
        for batch in batches:
            entries = []
            for *place, fresh, heads, exits in batch.itertuples(index=False, name=None):
                if place[:width] != group:
                    group, anchor = place[:width], NO_ANCHOR
                entries.append((*place, anchor))
                if anchor == NO_ANCHOR:
                    anchor = fresh
                else:
                    at = rule.reach(heads, anchor)
                    anchor = int(exits[at]) if at < len(heads) else anchor
            yield pd.DataFrame(entries, columns=schema.names)

    ordered = moves.select(*keys, "slice", "fresh", "heads", "exits").repartition(*keys)
    return ordered.sortWithinPartitions(*keys, "slice").mapInPandas(fold, schema)
