"""Sessions of connections out of a stream: points wait in state, by groups of connections, until their stop comes."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from ..schema import EVENT_POINTS, EVENT_STOP, READING_FIELDS, SCOPE_MS
from ..sinks.writers import export_sessions
from ..sources import lines
from .scopes import Sink, _started

# Workers get this module's functions themselves, so they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Connections share state by groups of this number, so that a group's work is done on arrays and not one by one.
GROUPS = 1024
LONGS, TEXTS = T.ArrayType(T.LongType()), T.ArrayType(T.StringType())
CONNECTION = T.StructType(
    [T.StructField("uuid", T.StringType()), T.StructField("session_no", T.LongType()), T.StructField("active", T.LongType())]
)
OPEN = T.StructType([T.StructField("part", T.LongType()), T.StructField("uuids", TEXTS)])
#: The session each connection of a group is in, the connections in each part, and the number of the next part.
ENTRY = T.StructType(
    [T.StructField("connections", T.ArrayType(CONNECTION)), T.StructField("open", T.ArrayType(OPEN)), T.StructField("following", T.LongType())]
)
PART_KEY = T.StructType([T.StructField("part", T.LongType())])
#: Messages of one Arrow batch, column by column.
PART = T.StructType(
    [
        T.StructField("uuid", TEXTS),
        T.StructField("arrival", LONGS),
        T.StructField("message", LONGS),
        T.StructField("points", T.ArrayType(TEXTS)),
    ]
)
OUTPUT = T.StructType(
    [
        T.StructField("uuid", T.StringType()),
        T.StructField("session_no", T.LongType()),
        T.StructField("place", T.LongType()),
        T.StructField("closed", T.BooleanType()),
        T.StructField("point", T.StringType()),
    ]
)


class Connections(StatefulProcessor):
    """Messages of open sessions of a group of connections in parts, which are read when a stop comes for one of them.

    Texts are in memory one part at a time; of the messages of ended sessions their order and number of points are.
    """

    def __init__(self, idle_ms: int | None) -> None:
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", ENTRY)
        self.parts = handle.getMapState("parts", PART_KEY, PART)

    def _known(self) -> tuple[dict[str, int], dict[str, int], dict[int, set[str]], int]:
        """Session and last activity of each connection, the connections of each part, and the number of the next part."""
        connections, held, following = self.entry.get() or ([], [], 0)
        session = {uuid: number for uuid, number, _ in connections}
        return session, {uuid: at for uuid, _, at in connections}, {part: set(of) for part, of in held}, following

    def _keep(self, session, active, held, following) -> None:
        connections = [(uuid, number, active[uuid]) for uuid, number in session.items()]
        self.entry.update((connections, [(part, sorted(of)) for part, of in sorted(held.items())], following))
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if active:
                self.handle.registerTimer(min(active.values()) + self.idle_ms)

    def _ended(self, session: dict[str, int], held: dict[int, set[str]], stops: pd.DataFrame, closed: bool) -> Iterator[pd.DataFrame]:
        """Rows of the messages up to the last of its connection's ``stops``; others stay, in the parts they were in."""
        ended = pd.Index(stops["uuid"].unique())
        names = set(ended)
        read = [part for part in sorted(held) if not held[part].isdisjoint(names)]
        orders = [(ended.get_indexer(stops["uuid"]), stops["arrival"].to_numpy(np.int64), np.zeros(len(stops), np.int64), np.zeros(len(stops), np.int64))]
        for part in read:
            uuid, arrival, message, points = self.parts.getValue((part,))
            order = (ended.get_indexer(uuid), np.array(arrival, np.int64), np.array(message, np.int64), np.array([len(p) for p in points], np.int64))
            orders.append(tuple(column[order[0] >= 0] for column in order))
        owner, arrival, message, size = (np.concatenate(columns) for columns in zip(*orders))
        stop = np.arange(len(owner)) < len(stops)
        by = np.lexsort((message, stop, arrival, owner))  # a stop comes last of its arrival
        passed = np.cumsum(stop[by])
        start = np.searchsorted(owner[by], np.arange(len(ended)))
        number = passed - (passed - stop[by])[start][owner[by]]
        upto = np.cumsum(size[by]) - size[by]
        new = np.ones(len(by), bool)
        new[1:] = (owner[by][1:] != owner[by][:-1]) | (number[1:] != number[:-1])
        run = np.flatnonzero(new)[np.cumsum(new) - 1]
        sessions, before = np.empty(len(by), np.int64), np.empty(len(by), np.int64)
        sessions[by], before[by] = number, upto - upto[run]
        left = sessions < np.bincount(owner[stop], minlength=len(ended))[owner]
        first = np.array([session.get(uuid, 0) for uuid in ended], np.int64)
        at = len(stops)
        for part in read:
            columns = self.parts.getValue((part,))
            uuid, points = columns[0], columns[3]
            mine = np.flatnonzero(ended.get_indexer(uuid) >= 0)
            here = slice(at, at + len(mine))
            at += len(mine)
            out = np.zeros(len(uuid), bool)
            out[mine] = left[here]
            sizes, begins = size[here][left[here]], before[here][left[here]]
            if sizes.sum():
                shown = np.flatnonzero(out)
                texts = np.array([p for i in shown for p in points[i]], object)
                places = np.arange(1, len(texts) + 1) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begins, sizes)
                yield pd.DataFrame(
                    {
                        "uuid": np.repeat(np.array(uuid, object)[shown], sizes),
                        "session_no": np.repeat((first[owner[here]] + sessions[here])[left[here]], sizes),
                        "place": places,
                        "closed": closed,
                        "point": texts,
                    }
                ).astype({"uuid": object, "point": object})
            if out.all():
                self.parts.removeKey((part,))
                del held[part]
            elif out.any():
                stays = np.flatnonzero(~out)
                kept = tuple([column[i] for i in stays] for column in columns)
                self.parts.updateValue((part,), kept)
                held[part] = set(kept[0])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        session, active, held, following = self._known()
        now, stopped = timerValues.getCurrentProcessingTimeInMs(), []
        for chunk in rows:
            for uuid in chunk["uuid"].unique():
                active[uuid] = now
                session.setdefault(uuid, 0)
            stop = chunk["stop"].to_numpy(bool)
            stopped.append(chunk.loc[stop, ["uuid", "arrival"]])
            sent = chunk[~stop]
            if len(sent):
                texts = [list(points) for points in sent["filled"]]
                self.parts.updateValue((following,), (sent["uuid"].tolist(), sent["arrival"].tolist(), sent["message"].tolist(), texts))
                held[following] = set(sent["uuid"])
                following += 1
        stops = pd.concat(stopped)
        if len(stops):
            yield from self._ended(session, held, stops, True)
            for uuid, n in stops["uuid"].value_counts().items():
                session[uuid] += int(n)
        self._keep(session, active, held, following)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Connections that have been silent: their open sessions are shown as not closed, and their state ends."""
        session, active, held, following = self._known()
        silent = [uuid for uuid, at in active.items() if at <= expiredTimerInfo.getExpiryTimeInMs() - self.idle_ms]
        if silent:
            stops = pd.DataFrame({"uuid": np.array(silent, object), "arrival": np.iinfo(np.int64).max})
            yield from self._ended(session, held, stops, False)
        for uuid in silent:
            del session[uuid], active[uuid]
        self._keep(session, active, held, following)

    def close(self) -> None:
        pass


def session_rows(
    messages: DataFrame, arrival: str = "arrival", message: str | None = None, idle_ms: int | None = None, groups: int = GROUPS
) -> DataFrame:
    """Points of the sessions of a stream of decoded messages, as ``uuid, session_no, place, closed, point``.

    The rows of ``connection_points`` that are ``closed``, each in the batch in which the stop comes, if a connection's
    messages come in the order of their batches.  One that comes after the stop it belongs before counts to the session
    then open.  ``arrival`` is a number, and ``message`` one that tells messages of one arrival apart; without
    one, their order is not defined.  With ``idle_ms`` a connection from which nothing came for that long shows
    its open session with ``closed`` false and starts anew.  Messages without ``uuid`` or arrival belong to no connection.

    State lies by ``groups`` groups of connections, a number that must stay the same for the life of a checkpoint.
    Needs the RocksDB state store.
    """
    kind = F.coalesce("event", F.lit(""))
    filled = F.when(kind == EVENT_POINTS, F.filter("points", lambda p: F.length(p) > 0))
    rows = messages.filter(kind.isin(EVENT_POINTS, EVENT_STOP) & F.col("uuid").isNotNull() & F.col(arrival).isNotNull())
    rows = rows.select(
        F.pmod(F.xxhash64("uuid"), F.lit(groups)).alias("group"),
        "uuid",
        F.col(arrival).cast("bigint").alias("arrival"),
        F.coalesce(F.col(message) if message else F.lit(0), F.lit(0)).cast("bigint").alias("message"),
        (kind == EVENT_STOP).alias("stop"),
        F.coalesce(filled, F.array().cast("array<string>")).alias("filled"),
    )
    return rows.groupBy("group").transformWithStateInPandas(
        statefulProcessor=Connections(idle_ms),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="None" if idle_ms is None else "ProcessingTime",
    )


def session_readings(sessions: DataFrame) -> DataFrame:
    """Readings of ``session_rows``, as ``closed_readings`` gives them; points that are no readings are left out."""
    read = lines.parsed(sessions, "point").filter(F.col("problem").isNull())
    return read.select("uuid", "session_no", "place", *READING_FIELDS)


def each_closed_session(sessions: DataFrame, sink: Sink, checkpoint: str, interval_ms: int | None = SCOPE_MS) -> DataStreamWriter:
    """Hand the readings of the sessions closed in a batch, and its number, to ``sink``."""

    def run(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            sink(session_readings(batch.filter("closed")), number)
        finally:
            batch.unpersist()

    return _started(sessions, run, checkpoint, interval_ms)


def exported(path: str, folders: int | None = None) -> Sink:
    """A sink that exports every batch to a folder of its own, so that a retried batch adds nothing."""
    return lambda rows, number: export_sessions(rows, path, folders=folders, batch=number)
