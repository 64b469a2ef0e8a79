"""Online users, session counters and attribution as state per user over a stream of connection events."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

# Workers get this module's functions themselves, so they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE = StructType(
    [
        StructField("session_no", LongType()),
        StructField("counter", LongType()),
        StructField("inferences", LongType()),
    ]
)
OUTPUT = StructType(
    [
        StructField("userID", StringType()),
        StructField("index", LongType()),
        StructField("timeMs", LongType()),
        StructField("kind", StringType()),
        StructField("session_no", LongType()),
        StructField("counter", LongType()),
        StructField("accepted", BooleanType()),
        StructField("position", LongType()),
    ]
)


def in_session(marks: np.ndarray, stops: np.ndarray, carried: int) -> np.ndarray:
    """Marked rows of its session up to each row; ``carried`` were in the first session before."""
    upto = np.cumsum(marks)
    begin = np.searchsorted(stops, np.arange(stops[-1] + 1))  # first row of each session
    earlier = (upto - marks)[begin]
    earlier[0] -= carried
    return upto - earlier[stops]


class Lifecycle(StatefulProcessor):
    """Keeps three numbers per user; ``counter`` 0 means offline."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entry = handle.getValueState("entry", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        session, counter, inferences = self.entry.get() if self.entry.exists() else (0, 0, 0)
        # The rows of one user in one micro-batch: the source's rate limit bounds them.
        events = pd.concat([chunk[["timeMs", "index", "kind"]] for chunk in rows], ignore_index=True)
        events = events.sort_values(["timeMs", "index", "kind"], ignore_index=True)
        kinds = {kind: (events["kind"] == kind).to_numpy() for kind in ("point", "inference", "stop")}
        stops = np.cumsum(kinds["stop"]) - kinds["stop"]  # strictly before the event
        counters = in_session(kinds["point"], stops, counter)
        accepted = kinds["inference"] & (counters > 0)
        positions = in_session(accepted, stops, inferences)
        still_open = not kinds["stop"][-1]
        self.entry.update(
            (
                session + int(kinds["stop"].sum()),
                int(counters[-1]) if still_open else 0,
                int(positions[-1]) if still_open else 0,
            )
        )
        shown = lambda values, where, kind: pd.Series(values, dtype=kind).where(where)
        yield pd.DataFrame(
            {
                "userID": key[0],
                "index": events["index"],
                "timeMs": events["timeMs"],
                "kind": events["kind"],
                "session_no": session + stops,
                "counter": shown(counters, kinds["point"], "Int64"),
                "accepted": shown(accepted, kinds["inference"], "boolean"),
                "position": shown(positions, accepted, "Int64"),
            }
        )

    def close(self) -> None:
        pass


def tracked(events: DataFrame) -> DataFrame:
    """Events (``userID, index, timeMs, kind``) with session, point counter and inference outcome.

    Needs the RocksDB state store.
    """
    return events.groupBy("userID").transformWithStateInPandas(
        statefulProcessor=Lifecycle(), outputStructType=OUTPUT, outputMode="Append", timeMode="None"
    )
