"""Sessions, online users and attribution from connection events.

Events carry ``userID, index, timeMs`` and ``kind`` (connect, point, inference, stop).  A point opens
an entry for its user, a stop closes it, a connect does neither.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import EVENT_POINTS, EVENT_STOP, READING_FIELDS
from ..sources import lines
from .joins import join_frequent
from .ordered import Ordered, in_order, with_context

# Total: of events that tie in time and index a stop comes last.
ORDER = ("timeMs", "index", "kind")


def is_kind(kind: str) -> Column:
    return F.col("kind") == kind


def events_by_user(events: DataFrame, max_rows: int | None = None, key: str = "userID") -> Ordered:
    return in_order(events, (key,), ORDER, max_rows)


def with_sessions(data: Ordered) -> Ordered:
    """Add ``session_no`` (stops strictly before the event), ``online`` (a point came since the last stop)
    and ``n_stops`` (all stops of the user)."""
    stop = is_kind("stop").cast("int")
    state = F.when(is_kind("point"), F.lit(True)).when(is_kind("stop"), F.lit(False))
    seen = with_context(data, running={"session_no": stop}, carry={"online": state}, total={"n_stops": stop})
    rows = seen.rows.withColumns(
        {"session_no": F.col("session_no") - stop, "online": F.coalesce("online", F.lit(False))}
    )
    return seen.with_rows(rows)


def numbered_in_session(data: Ordered, name: str) -> DataFrame:
    """Number the rows of every session from 1 in order."""
    sessions = replace(data, keys=(*data.keys, "session_no"))
    return with_context(sessions, running={name: F.lit(1)}).rows


def session_points(events: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Every point with its session and its running number there, from 1."""
    data = with_sessions(events_by_user(events, max_rows))
    rows = numbered_in_session(data.with_rows(data.rows.filter(is_kind("point"))), "counter")
    return rows.select("userID", "session_no", "counter", "index", "timeMs")


def session_messages(events: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Messages per user and session where every event is a message of its own.

    Neither the closing stop nor inferences, which reach no connection, are counted.
    """
    data = with_sessions(events_by_user(events.filter(~is_kind("inference")), max_rows))
    counted = F.count_if(~is_kind("stop")).alias("n_messages")
    return data.rows.groupBy("userID", "session_no").agg(counted)


def connection_messages(messages: DataFrame, arrival: str = "arrival", max_rows: int | None = None) -> DataFrame:
    """Decoded messages per connection (``uuid``) and session, whatever they hold; the closing stop is not counted.

    Of messages with one arrival the stop comes last.  Messages without ``uuid`` belong to no connection.
    """
    stop = (F.coalesce("event", F.lit("")) == EVENT_STOP).cast("int").alias("stop")
    rows = messages.select("uuid", F.col(arrival).alias("arrival"), stop)
    seen = with_context(in_order(rows, ("uuid",), ("arrival", "stop"), max_rows), running={"session_no": F.col("stop")})
    sessions = seen.rows.withColumn("session_no", F.col("session_no") - F.col("stop"))
    return sessions.groupBy("uuid", "session_no").agg(F.sum(1 - F.col("stop")).alias("n_messages"))


def connection_points(
    messages: DataFrame, arrival: str = "arrival", message: str | None = None, max_rows: int | None = None
) -> DataFrame:
    """Every non-empty point of the decoded messages as ``uuid, session_no, place, closed, point``.

    ``place`` counts the points of a session from 1 and ``closed`` tells whether a stop ended it.  Messages are in the
    order of ``arrival``, then of ``message``, a sequence number, or, without one, of their points; a stop comes last
    of its arrival.  Sessions are found on messages, before their points become rows.  Messages without ``uuid``
    or arrival belong to no connection.
    """
    kind = F.coalesce("event", F.lit(""))
    filled = F.when(kind == EVENT_POINTS, F.filter("points", lambda p: F.length(p) > 0))
    stop = (kind == EVENT_STOP).cast("int")
    rows = messages.filter(kind.isin(EVENT_POINTS, EVENT_STOP)).select(
        "uuid",
        F.col(arrival).alias("arrival"),
        stop.alias("stop"),
        *([] if message is None else [F.col(message).alias("message")]),
        F.coalesce(filled, F.array().cast("array<string>")).alias("filled"),
    )
    order = ("arrival", "stop", "filled" if message is None else "message")
    size = F.size("filled").cast("bigint")
    data = in_order(rows, ("uuid",), order, max_rows)
    data = with_context(data, running={"stops": F.col("stop"), "upto": size}, total={"n_stops": F.col("stop")})
    # The points of earlier sessions, known at each stop; a stop itself has none.
    seen = with_context(data, carry={"earlier": F.when(F.col("stop") == 1, F.col("upto"))}).rows
    first = F.col("upto") - size - F.coalesce("earlier", F.lit(0))
    placed = F.transform("filled", lambda p, i: F.struct((first + i + 1).alias("place"), p.alias("point")))
    return seen.filter("stop = 0").select(
        "uuid", F.col("stops").alias("session_no"), (F.col("stops") < F.col("n_stops")).alias("closed"), F.inline(placed)
    )


def closed_readings(
    messages: DataFrame, arrival: str = "arrival", message: str | None = None, max_rows: int | None = None
) -> DataFrame:
    """Readings of the sessions that a stop ended, with ``uuid, session_no, place``: the rows ``export_sessions`` takes.

    Points that are no readings are left out; ``lines.parsed`` and ``lines.quarantined`` over ``connection_points``
    list them.
    """
    rows = connection_points(messages, arrival, message, max_rows).filter("closed")
    read = lines.parsed(rows, "point").filter(F.col("problem").isNull())
    return read.select("uuid", "session_no", "place", *READING_FIELDS)


def online_users(events: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Users with a point since their last stop, with the open session and its number of points."""
    rows = with_sessions(events_by_user(events, max_rows)).rows
    held = rows.filter(is_kind("point") & (F.col("session_no") == F.col("n_stops")))
    return held.groupBy("userID", "session_no").agg(F.count(F.lit(1)).alias("counter"))


def online_ids(events: DataFrame) -> DataFrame:
    """Ids of the users online after the last event; partial aggregation only, no ordering of histories."""
    relevant = events.filter(is_kind("point") | is_kind("stop"))
    last = relevant.groupBy("userID").agg(F.max_by("kind", F.struct(*ORDER)).alias("kind"))
    return last.filter(is_kind("point")).select("userID")


def known_only(inferences: DataFrame, online: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Inferences of users that are online."""
    return join_frequent(inferences, online, ["userID"], "left_semi", max_rows)


def unknown_only(inferences: DataFrame, online: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Inferences of users that are not online."""
    return join_frequent(inferences, online, ["userID"], "left_anti", max_rows)


def attributed(events: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Inferences with ``accepted``: whether their user was online when they arrived."""
    rows = with_sessions(events_by_user(events, max_rows)).rows.filter(is_kind("inference"))
    return rows.drop("n_stops", "slice", "slices").withColumnRenamed("online", "accepted")


def inference_lists(events: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Accepted inferences in arrival order, numbered per user and session; ``open`` marks the lists still held."""
    data = with_sessions(events_by_user(events, max_rows))
    accepted = data.with_rows(data.rows.filter(is_kind("inference") & F.col("online")))
    kept = [c for c in events.columns if c != "kind"]
    held = (F.col("session_no") == F.col("n_stops")).alias("open")
    return numbered_in_session(accepted, "position").select(*kept, "session_no", "position", held)
