"""Live-feed views over the readings: what a reader of a user's feed gets, as queries with cursors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scan import Rule
from ..schema import THROTTLE_MS
from .joins import join_frequent
from .ordered import in_order, with_context
from .peaks import ORDER, greedy


def live_feed(readings: DataFrame) -> DataFrame:
    return readings.select("userID", "index", "vSum", "timeMs")


def as_messages(feed: DataFrame) -> DataFrame:
    """The feed with ``message``, the JSON text sent to a subscriber; both values are strings there."""
    message = F.struct(F.col("vSum").cast("string").alias("xyz"), F.col("timeMs").cast("string").alias("timestamp"))
    return feed.withColumn("message", F.to_json(message))


def unread(feed: DataFrame, cursors: DataFrame | None = None) -> DataFrame:
    """Points after each user's cursor (``userID, read_ms``: one row per user); all points without cursors."""
    if cursors is None:
        return feed
    joined = join_frequent(feed, cursors, ["userID"], "left")
    return joined.filter(F.col("read_ms").isNull() | (F.col("timeMs") > F.col("read_ms"))).drop("read_ms")


def front(feed: DataFrame, cursors: DataFrame | None = None) -> DataFrame:
    """Oldest unread point per user and the size of the backlog."""
    oldest = F.min_by(F.struct("index", "vSum", "timeMs"), F.struct(*ORDER))
    groups = unread(feed, cursors).groupBy("userID")
    return groups.agg(oldest.alias("oldest"), F.count(F.lit(1)).alias("backlog")).select("userID", "oldest.*", "backlog")


def tail(feed: DataFrame, since_ms: int) -> DataFrame:
    """Points that arrive after a subscription at ``since_ms``."""
    return feed.filter(F.col("timeMs") > since_ms)


def every_nth(feed: DataFrame, n: int = 1, max_rows: int | None = None) -> DataFrame:
    """The first and then every ``n``-th point of a user."""
    data = with_context(in_order(feed, ("userID",), ORDER, max_rows), running={"_count": F.lit(1)})
    return data.rows.filter((F.col("_count") - 1) % n == 0).select(*feed.columns)


def throttled(feed: DataFrame, gap_ms: int = THROTTLE_MS, max_rows: int | None = None) -> DataFrame:
    """Points at least ``gap_ms`` after the last point sent to the same user's feed."""
    data = in_order(feed, ("userID",), ORDER, max_rows)
    return greedy(data, Rule(gap_ms, follow=True), ("timeMs", "index", "vSum")).rows.select(
        "userID", "index", "vSum", "timeMs"
    )


def users_sorted(readings: DataFrame) -> DataFrame:
    """Readings per user, users in text order."""
    return readings.groupBy("userID").agg(F.count(F.lit(1)).alias("n_readings")).orderBy("userID")
