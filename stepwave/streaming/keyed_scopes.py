"""Scopes as keyed state: each user's own clock closes their scopes, and a batch writes only rows of its own users' groups."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from ..schema import READING, READING_FIELDS, SCOPE_MS
from .scopes import AHEAD_MS, Sink, Transform, _started

# Workers get this module's functions themselves, so they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Users share state by groups of this number, so that a group's work is done on arrays and not user by user.
GROUPS = 1024
NEVER = np.iinfo(np.int64).min
USER = T.StructType([T.StructField("userID", T.StringType()), T.StructField("closed", T.LongType()), T.StructField("active", T.LongType())])
OPEN = T.StructType(
    [T.StructField("scope", T.LongType()), T.StructField("part", T.LongType()), T.StructField("users", T.ArrayType(T.StringType()))]
)
#: The clock of each user of a group, the users in each part of an open scope, and the number of the next part.
CLOCK = T.StructType(
    [T.StructField("users", T.ArrayType(USER)), T.StructField("open", T.ArrayType(OPEN)), T.StructField("following", T.LongType())]
)
PART_KEY = T.StructType([T.StructField("scope", T.LongType()), T.StructField("part", T.LongType())])
#: The readings of one scope that came in one Arrow batch, column by column.
PART = T.StructType([T.StructField(f, T.ArrayType(READING[f].dataType)) for f in READING_FIELDS])
KINDS = OVER, LATE, AHEAD, INCOMPLETE = "over", "late", "clock ahead", "incomplete"
OUTPUT = T.StructType([*(READING[f] for f in READING_FIELDS), T.StructField("kind", T.StringType())])


class Scopes(StatefulProcessor):
    """Parts of open scopes by scope and number, for a group of users; those of whom a scope is over leave its parts.

    Only parts that hold such a user are read, one at a time.
    """

    def __init__(self, scope_ms: int, delay_ms: int, hold_ahead: bool, idle_ms: int | None) -> None:
        self.scope_ms, self.delay_ms, self.hold_ahead, self.idle_ms = scope_ms, delay_ms, hold_ahead, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.clock = handle.getValueState("clock", CLOCK)
        self.parts = handle.getMapState("parts", PART_KEY, PART)

    def _known(self) -> tuple[dict[str, int], dict[str, int], dict[tuple[int, int], set[str]], int]:
        """Clock and last activity of each user, the users of each part, and the number of the next part."""
        users, held, following = self.clock.get() or ([], [], 0)
        closed = {user: NEVER if at is None else at for user, at, _ in users}
        return closed, {user: at for user, _, at in users}, {(scope, part): set(of) for scope, part, of in held}, following

    def _keep(self, closed, active, held, following) -> None:
        users = [(user, None if at == NEVER else at, active[user]) for user, at in closed.items()]
        self.clock.update((users, [(*part, sorted(of)) for part, of in sorted(held.items())], following))

    def _shown(self, rows: pd.DataFrame, kind: str) -> pd.DataFrame:
        shown = rows.assign(kind=kind)[[*READING_FIELDS, "kind"]]
        return shown.astype({"userID": object, "kind": object})

    def _leave(self, held: dict[tuple[int, int], set[str]], over: Callable[[str, int], bool]) -> Iterator[pd.DataFrame]:
        """The readings of users for whom ``over(user, end of scope)``; those of others stay in their part."""
        for part in sorted(held):
            end = (part[0] + 1) * self.scope_ms
            gone = {user for user in held[part] if over(user, end)}
            if not gone:
                continue
            rows = pd.DataFrame(dict(zip(READING_FIELDS, self.parts.getValue(part))))
            leaves = rows["userID"].isin(gone).to_numpy()
            yield self._shown(rows[leaves], OVER)
            held[part] -= gone
            if held[part]:
                self._put(part, rows[~leaves])
            else:
                self.parts.removeKey(part)
                del held[part]

    def _put(self, part: tuple[int, int], rows: pd.DataFrame) -> None:
        self.parts.updateValue(part, tuple(rows[f].tolist() for f in READING_FIELDS))

    def _wait(self, active: dict[str, int], held: dict[tuple[int, int], set[str]]) -> None:
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if held:
                self.handle.registerTimer(min(active[user] for of in held.values() for user in of) + self.idle_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        closed, active, held, following = self._known()
        now = timerValues.getCurrentProcessingTimeInMs()
        seen: dict[str, int] = {}
        for chunk in rows:
            if not self.hold_ahead and chunk["ahead"].any():
                yield self._shown(chunk[chunk["ahead"]], AHEAD)
                chunk = chunk[~chunk["ahead"]]
            place, users = pd.factorize(chunk["userID"])
            active.update((user, now) for user in users)
            times = chunk["timeMs"].to_numpy(np.int64)
            scopes = times // self.scope_ms
            own = ~chunk["ahead"].to_numpy(bool)
            newest = np.full(len(users), NEVER)
            np.maximum.at(newest, place[own], times[own])
            for user, at in zip(users, newest.tolist()):
                if at != NEVER:
                    seen[user] = max(at, seen.get(user, NEVER))
            before = np.array([closed.setdefault(user, NEVER) for user in users], np.int64)
            late = (scopes + 1) * self.scope_ms <= before[place]
            if late.any():
                yield self._shown(chunk[late], LATE)
            for scope, part in chunk[~late].groupby(scopes[~late], sort=False):
                self._put((int(scope), following), part)
                held[int(scope), following] = set(part["userID"])
                following += 1
        for user, at in seen.items():
            closed[user] = max(closed[user], at - self.delay_ms)
        yield from self._leave(held, lambda user, end: end <= closed[user])
        self._keep(closed, active, held, following)
        self._wait(active, held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Users who have been silent: all their scopes are over."""
        closed, active, held, following = self._known()
        until = expiredTimerInfo.getExpiryTimeInMs() - self.idle_ms
        for (scope, _), users in held.items():
            for user in users:
                if active[user] <= until:
                    closed[user] = max(closed[user], (scope + 1) * self.scope_ms)
        yield from self._leave(held, lambda user, end: active[user] <= until)
        self._keep(closed, active, held, following)
        self._wait(active, held)

    def close(self) -> None:
        pass


def scoped(
    readings: DataFrame,
    scope_ms: int = SCOPE_MS,
    delay_ms: int = 0,
    ahead_ms: int = AHEAD_MS,
    hold_ahead: bool = True,
    idle_ms: int | None = None,
    groups: int = GROUPS,
) -> DataFrame:
    """Every reading of a stream once, with its ``kind``, at the latest when its scope is over.

    A scope of a user is ``over`` once a reading of this user more than ``delay_ms`` past its end was seen, or, with
    ``idle_ms``, when nothing came from them for that long.  What comes for it afterwards is ``late``.  A reading
    more than ``ahead_ms`` ahead of its arrival (column ``arrival``, a timestamp; without one, or where it is null, the
    time of its micro-batch) closes nothing; it waits for its scope, or is shown at once as ``clock ahead`` without
    ``hold_ahead``.  A row with a null in any field of a reading is shown at once as ``incomplete``.

    State: the readings of open scopes in parts of one Arrow batch each, and the clocks of the users, by ``groups``
    groups of users; a part is written again when the scope is over for some of its users only.  ``groups`` must stay the
    same for the life of a checkpoint.  Needs the RocksDB state store.
    """
    arrived = [F.col("arrival")] if "arrival" in readings.columns else []
    arrival = F.coalesce(*arrived, F.current_timestamp())
    ahead = F.col("timeMs") > F.unix_millis(arrival) + ahead_ms
    whole = F.lit(True)
    for field in READING_FIELDS:
        whole = whole & F.col(field).isNotNull()
    group = F.pmod(F.xxhash64("userID"), F.lit(groups)).alias("group")
    timed = readings.filter(whole).select(group, *READING_FIELDS, ahead.alias("ahead"))
    kept = timed.groupBy("group").transformWithStateInPandas(
        statefulProcessor=Scopes(scope_ms, delay_ms, hold_ahead, idle_ms),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="None" if idle_ms is None else "ProcessingTime",
    )
    others = readings.filter(~whole).select(*READING_FIELDS, F.lit(INCOMPLETE).alias("kind"))
    return kept.unionByName(others)


def each_user_scope(
    readings: DataFrame,
    sink: Sink,
    checkpoint: str,
    transform: Transform | None = None,
    interval_ms: int | None = SCOPE_MS,
    scope_ms: int = SCOPE_MS,
    delay_ms: int = 0,
    ahead_ms: int = AHEAD_MS,
    idle_ms: int | None = None,
    late: Sink | None = None,
    quarantine: Sink | None = None,
) -> DataStreamWriter:
    """As ``scopes.each_scope`` with a clock for each user (``scoped``), so that none closes the scopes of others.

    ``quarantine`` takes the readings with a clock ahead and incomplete ones, with their ``problem``.  Without it clocks
    ahead wait for their scope and incomplete ones go where late ones go: to ``late``, or through ``transform``.
    """
    rows = scoped(readings, scope_ms, delay_ms, ahead_ms, quarantine is None, idle_ms)

    def run(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            kind, fields = F.col("kind"), [F.col(f) for f in READING_FIELDS]
            if quarantine is not None:
                quarantine(batch.filter(kind.isin(AHEAD, INCOMPLETE)).select(*fields, kind.alias("problem")), number)
            shown = [OVER] if late is not None else [OVER, LATE]
            if late is not None:
                late(batch.filter(kind.isin([LATE] if quarantine is not None else [LATE, INCOMPLETE])).select(*fields), number)
            elif quarantine is None:
                shown.append(INCOMPLETE)
            over = batch.filter(kind.isin(shown)).select(*fields)
            sink(transform(over) if transform else over, number)
        finally:
            batch.unpersist()

    return _started(rows, run, checkpoint, interval_ms)


def open_readings(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Readings of the scopes that were open after the last batch of a stopped stream, from its state."""
    state = spark.read.format("statestore").option("stateVarName", "parts").load(checkpoint)
    columns = F.arrays_zip(*(F.col(f"user_map_value.{f}").alias(f) for f in READING_FIELDS))
    return state.select(F.explode(columns).alias("row")).select("row.*").select(*READING_FIELDS)
