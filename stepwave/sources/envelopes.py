"""JSON messages: connection events and inference records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import in_order, with_context
from ..schema import CONFIDENCE_FIELD, ENVELOPE, EVENT_CONNECT, EVENT_POINTS, EVENT_STOP, INFERENCE_WIRE, POINTS_FIELD
from .lines import user_of


def decoded(messages: DataFrame, column: str = "value") -> DataFrame:
    """Add ``event``, ``uuid``, ``userid`` and the point array ``points``; all NULL for a broken message."""
    row = F.struct(
        F.col("_m.event").alias("event"),
        F.col("_m.data.uuid").alias("uuid"),
        F.col("_m.data.userid").alias("userid"),
        F.col(f"_m.data.{POINTS_FIELD}").alias("points"),
    )
    # Generated as one row, so that a filter on the event does not decode the message again.
    body = F.from_json(column, ENVELOPE)
    return messages.withColumn("_m", body).select(*messages.columns, F.inline(F.array(row)))


def with_route(events: DataFrame) -> DataFrame:
    """Add ``route``, the event type; messages of no known type are ``other`` and only count."""
    known = F.col("event").isin(EVENT_CONNECT, EVENT_POINTS, EVENT_STOP)
    return events.withColumn("route", F.when(known, F.col("event")).otherwise("other"))


def connects(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event") == EVENT_CONNECT).drop("points", "userid")


def stops(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event") == EVENT_STOP).drop("points")


def others(events: DataFrame) -> DataFrame:
    return with_route(events).filter(F.col("route") == "other").drop("points", "route")


def points(events: DataFrame) -> DataFrame:
    """One row per non-empty point of the point messages.

    ``pos`` is its position in the message and ``previous`` the non-empty point before it there.
    """
    kept = [c for c in events.columns if c not in ("points", "event", "userid")]
    placed = F.transform("points", lambda p, i: F.struct(i.alias("pos"), p.alias("point")))
    filled = events.filter(F.col("event") == EVENT_POINTS).select(
        *kept, F.filter(placed, lambda p: F.length(p["point"]) > 0).alias("_points")
    )
    before = lambda i: F.get("_points", i - 1)["point"]
    linked = F.transform(
        "_points",
        lambda p, i: F.struct(p["pos"].alias("pos"), p["point"].alias("point"), before(i).alias("previous")),
    )
    return filled.select(*kept, F.inline(linked))


def order_violations(message_points: DataFrame, field: int = 0) -> DataFrame:
    """Points whose number in ``field`` is smaller than that of the previous point of their message.

    Field 0 is the index, field 2 the time.  The check stays inside a message, so nothing is shuffled.
    """
    number = lambda line: F.get(F.split(line, ","), F.lit(field)).try_cast("bigint")
    checked = message_points.withColumns({"current": number("point"), "last": number("previous")})
    return checked.filter(F.col("current") < F.col("last"))


def connection_events(events: DataFrame, arrival: str = "arrival", fill_users: bool = True) -> DataFrame:
    """Points, stops and connects as ``userID, index, timeMs, kind``, the input of the session operators.

    ``timeMs`` is the message's arrival and ``index`` the place of the point in it.  A stop may name no
    user; with ``fill_users`` it closes the user last seen under its ``uuid``.  Messages without ``uuid`` keep
    their rows and fill nothing.
    """

    def rows_of(user: Column, kind: str, place: Column) -> Column:
        return F.struct(place.cast("bigint").alias("index"), user.alias("userID"), F.lit(kind).alias("kind"))

    filled = F.filter("points", lambda p: F.length(p) > 0)
    rows = (
        F.when(F.col("event") == EVENT_POINTS, F.transform(filled, lambda p, i: rows_of(user_of(p), "point", i)))
        .when(F.col("event") == EVENT_STOP, F.array(rows_of(F.col("userid"), "stop", F.lit(0))))
        .when(F.col("event") == EVENT_CONNECT, F.array(rows_of(F.col("uuid"), "connect", F.lit(0))))
    )
    flat = events.select("uuid", F.col(arrival).alias("timeMs"), F.inline(rows))
    if fill_users:
        # Rows without a uuid get groups of their own kind, spread by content, so that none of them is left out.
        alone = F.concat(F.lit("-"), F.xxhash64("timeMs", "index", "userID").cast("string"))
        flat = flat.withColumn("owner", F.coalesce(F.concat(F.lit("u"), "uuid"), alone))
        seen = F.when((F.col("kind") == "point") & F.col("uuid").isNotNull(), F.col("userID"))
        order = ("timeMs", "index", "kind", "userID")
        flat = with_context(in_order(flat, ("owner",), order), carry={"seen": seen}).rows
        flat = flat.withColumn("userID", F.coalesce("userID", "seen"))
    return flat.select("userID", "index", "timeMs", "kind")


def inferences(records: DataFrame, column: str = "value") -> DataFrame:
    """Typed inference records; fields that do not parse are NULL."""
    body = F.from_json(column, INFERENCE_WIRE)
    kept = [c for c in records.columns if c != column]
    return records.withColumn("_r", body).select(
        *kept,
        F.col(f"_r.{CONFIDENCE_FIELD}").try_cast("double").alias(CONFIDENCE_FIELD),
        F.col("_r.inferred_user_id").try_cast("int").alias("inferred_user_id"),
        F.col("_r.actual_user_id").alias("actual_user_id"),
    )
