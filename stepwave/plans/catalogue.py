"""The registered queries: every operator over the whole supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import from_text, norm
from ..operators import feed, models, peaks, resample, scoring, segments, sessions
from ..operators.ordered import in_order, with_context
from ..schema import AXES, CONFIDENCE_FIELD, EVENT_CONNECT, EVENT_POINTS, EVENT_STOP, POINTS_FIELD, READING_FIELDS
from ..session import cut, new_folder
from ..sinks.writers import to_line, vector_texts
from ..sources import envelopes, lines, tables
from . import pipeline, replay

DAY_MS = 86_400_000
SCOPE_MS = 10 * DAY_MS  # The supplied events are hours apart, so scopes are days instead of seconds.
FEED_GAP_MS = 6 * 3_600_000
FEED_NTH = 25
FEED_SINCE_MS = 1_705_363_200_000
MESSAGE_POINTS = 20
MODEL_SHARPNESS = 0.001
BLOCK_EVENTS = 400
KEYS = ("userID",)

Query = Callable[[SparkSession, str], DataFrame]


def rounded(value: Column, places: int = 6) -> Column:
    """Rounding that two engines agree on: values next to a tie are pushed off it first."""
    return F.round(value + F.lit(1e-9), places)


def _sum(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double"))


def _placed(vector: Column) -> Column:
    """Sum of the values times their places from 1: another order gives another number."""
    return F.round(_sum(F.transform(vector, lambda x, i: x.cast("double") * (i + 1))) + F.lit(1e-7), 4)


def _rounded_axes(df: DataFrame, *extra: str) -> DataFrame:
    return df.withColumns({c: rounded(F.col(c)) for c in (*AXES, *extra)})


def _user_rows(spark, d):
    return peaks.by_user(tables.readings(spark, d))


# Parsing


def lines_of(spark: SparkSession, folder: str) -> DataFrame:
    return tables.readings(spark, folder).select(to_line().alias("value"))


def parse_readings_csv(spark, d):
    payloads = lines_of(spark, d).select(F.concat(F.lit("\n "), "value", F.lit(" \n")).alias("value"))
    rows = lines.split_lines(payloads).filter(F.length("value") > 0)
    return _rounded_axes(lines.good(lines.parsed(rows)), "vSum")


def damaged_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as a faulty sender would write them, by event type; ``event_id`` tells them apart."""
    line = to_line()
    return tables.readings(spark, folder, F.col("event_id"), F.col("event_type")).select(
        "event_id",
        F.when(F.col("event_type") == "error", F.substring_index(line, ",", 5))
        .when(F.col("event_type") == "signup", F.concat(F.substring_index(line, ",", 6), F.lit(", NaN")))
        .when(F.col("event_type") == "view", F.concat(F.lit("x"), line))
        .when(F.col("event_type") == "purchase", F.concat(line, F.lit(", 9")))
        .otherwise(line)
        .alias("value"),
    )


def parse_quarantine(spark, d):
    return lines.quarantined(lines.parsed(damaged_lines(spark, d))).select("event_id", "problem")


def parse_damaged_good(spark, d):
    return _rounded_axes(lines.good(lines.parsed(damaged_lines(spark, d))), "vSum")


def line_keys(spark, d):
    return lines.keyed(lines_of(spark, d)).groupBy("userID").agg(F.count(F.lit(1)).alias("n_lines"))


def messages_of(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON message per event: connects, stops and point messages with an empty point beside the real one.

    About half of the stops name no user.
    """
    rows = tables.readings(spark, folder, tables.event_kind()).withColumn("line", to_line())
    event = (
        F.when(F.col("kind") == "connect", EVENT_CONNECT)
        .when(F.col("kind") == "stop", EVENT_STOP)
        .when(F.col("kind") == "point", EVENT_POINTS)
        .otherwise("inference")
    )
    points = F.when(F.col("kind") == "point", F.array(F.lit(""), F.col("line")))
    data = F.struct(
        F.col("userID").alias("uuid"),
        F.when((F.col("kind") == "stop") & (F.col("accY") < 50), F.col("userID")).alias("userid"),
        points.alias(POINTS_FIELD),
    )
    return rows.select("index", F.to_json(F.struct(event.alias("event"), data.alias("data"))).alias("value"))


def envelope_points(spark, d):
    rows = envelopes.points(envelopes.decoded(messages_of(spark, d)).drop("index"))
    parsed = lines.parsed(rows.withColumn("value", F.col("point")))
    return parsed.select("uuid", "pos", "index", "userID", "timeMs", rounded(F.col("vSum")).alias("vSum"))


def envelope_routes(spark, d):
    events = envelopes.with_route(envelopes.decoded(messages_of(spark, d)))
    return events.groupBy("uuid", "route").agg(F.count(F.lit(1)).alias("n_messages"))


def envelope_sessions(spark, d):
    """Session points straight from messages that arrive in the order of the events."""
    events = envelopes.connection_events(envelopes.decoded(messages_of(spark, d)), arrival="index")
    return sessions.session_points(events).select("userID", "session_no", "counter", F.col("timeMs").alias("arrival"))


def points_xyz4(spark, d):
    readings = tables.readings(spark, d)
    text = F.concat_ws(", ", *(F.col(c).cast("string") for c in ("timeMs", *AXES))).alias("point")
    typed = lines.parsed_xyz4(readings.select(F.col("userID").alias("uuid"), "index", text))
    return _rounded_axes(lines.good(typed), "vSum")


def vector_norm(spark, d):
    rows = tables.readings(spark, d)
    return rows.select("index", rounded(norm(F.col("accX"), F.col("accY"), F.col("accZ"))).alias("vSum"))


# Peaks and segments


def local_maxima(spark, d):
    rows = peaks.local_maxima(_user_rows(spark, d)).rows
    return rows.select("userID", "index", "timeMs", rounded(F.col("vSum")).alias("vSum"))


def local_maxima_no_warmup(spark, d):
    rows = peaks.local_maxima(_user_rows(spark, d), skip_warmup=False).rows
    return rows.select("userID", "index", "timeMs", rounded(F.col("vSum")).alias("vSum"))


def _cycle_peaks(spark, d, cycle_ms):
    found = peaks.numbered_peaks(peaks.cycle_peaks(_user_rows(spark, d), cycle_ms)).rows
    return found.select("userID", "cycle", "index", "timeMs")


def cycle_peaks(spark, d):
    return _cycle_peaks(spark, d, 1000)


def cycle_peaks_restarted(spark, d):
    """Readings whose index starts again with every day of their user."""
    daily = tables.readings(spark, d).withColumn("day", F.expr(f"timeMs div {DAY_MS}L"))
    placed = with_context(in_order(daily, ("day", "userID"), peaks.ORDER), running={"place": F.lit(1)}).rows
    rows = placed.withColumn("index", F.col("place") - 1).select(*READING_FIELDS)
    found = peaks.numbered_peaks(peaks.cycle_peaks(peaks.by_user(rows))).rows
    return found.select("userID", "cycle", "index", "timeMs")


def cycle_peaks_day_gap(spark, d):
    return _cycle_peaks(spark, d, DAY_MS)


def cycle_peaks_scoped(spark, d):
    data = peaks.by_user(tables.readings(spark, d), SCOPE_MS)
    found = peaks.numbered_peaks(peaks.cycle_peaks(data)).rows
    return found.select("scope", "userID", "cycle", "index", "timeMs")


def cycle_strongest(spark, d):
    rows = peaks.strongest_per_cycle(_user_rows(spark, d), DAY_MS)
    return rows.withColumn("vSum", rounded(F.col("vSum")))


def cycle_numbers(spark, d):
    return segments.cycle_numbers(_user_rows(spark, d)).select("userID", "index", "timeMs", "cycle")


def segment_rows(spark, d):
    rows = segments.segments(_user_rows(spark, d))
    return rows.select("userID", "segment_no", "index", "timeMs", "first_ms", "last_ms")


def segment_rows_scoped(spark, d):
    rows = segments.segments(peaks.by_user(tables.readings(spark, d), SCOPE_MS))
    return rows.select("scope", "userID", "segment_no", "index", "timeMs")


def segment_stats(spark, d):
    return segments.segment_stats(segments.segments(_user_rows(spark, d), DAY_MS), KEYS)


def group_counts(spark, d):
    return segments.group_counts(_user_rows(spark, d))


def too_short_segments(spark, d):
    """Segments of the whole table with clocks slowed down four million times, so that many have no grid."""
    readings = tables.readings(spark, d).withColumn("timeMs", F.expr("timeMs div 4000000L"))
    return resample.too_short(segments.segments(peaks.by_user(readings), 2), KEYS)


# Resampling


def resampled_long(spark, d):
    return _rounded_axes(pipeline.grid_points(tables.readings(spark, d)))


def resampled_long_day_gap(spark, d):
    return _rounded_axes(pipeline.grid_points(tables.readings(spark, d), cycle_ms=DAY_MS))


def resampled_vectors(spark, d):
    rows = pipeline.sample_vectors(tables.readings(spark, d))
    sums = {f"sum_{a}": rounded(_sum(F.col(a))) for a in AXES}
    return rows.select(
        "userID",
        "segment_no",
        F.size("accX").alias("n_points"),
        *(v.alias(n) for n, v in sums.items()),
        *(_placed(F.col(a)).alias(f"placed_{a}") for a in AXES),
    )


def resampled_vectors_scoped(spark, d):
    rows = pipeline.sample_vectors(tables.readings(spark, d), SCOPE_MS)
    sums = (rounded(_sum(F.col(a))).alias(f"sum_{a}") for a in AXES)
    placed = (_placed(F.col(a)).alias(f"placed_{a}") for a in AXES)
    return rows.select("scope", "userID", "segment_no", F.size("accX").alias("n_points"), *sums, *placed)


def vector_text(spark, d):
    texts = vector_texts(pipeline.sample_vectors(tables.readings(spark, d)), KEYS)
    back = texts.select("userID", "segment_no", *(from_text(F.col(a)).alias(a) for a in AXES))
    sums = (F.round(_sum(F.col(a)), 2).alias(f"sum_{a}") for a in AXES)
    placed = (_placed(F.col(a)).alias(f"placed_{a}") for a in AXES)
    return back.select("userID", "segment_no", F.size("accX").alias("n_points"), *sums, *placed)


def tensor_shape(spark, d):
    rows = scoring.with_tensor(pipeline.sample_vectors(tables.readings(spark, d)))
    values = lambda c: F.transform("tensor", lambda p: p[c])
    channel = lambda c: F.round(_sum(values(c)), 2)
    return rows.select(
        "userID",
        "segment_no",
        F.size("tensor").alias("n_points"),
        F.size(F.get("tensor", 0)).alias("n_channels"),
        *(channel(i).alias(f"sum_{a}") for i, a in enumerate(AXES)),
        *(_placed(values(i)).alias(f"placed_{a}") for i, a in enumerate(AXES)),
        channel(len(AXES)).alias("sum_zero"),
    )


# Scoring and inferences


def classes_of(spark: SparkSession, folder: str) -> DataFrame:
    """The known identity of each user: three classes."""
    users = tables.table(spark, folder, "events").select("user_id").distinct()
    return users.select(F.col("user_id").cast("string").alias("userID"), (F.col("user_id") % 3 + 1).cast("int").alias("class"))


def identities_of(spark: SparkSession, folder: str) -> DataFrame:
    return tables.table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("inferred_user_id"), F.col("n_name").alias("inferred_users_name")
    )


def class_centroids(spark, d):
    centers = scoring.centroids(pipeline.grid_points(tables.readings(spark, d)), classes_of(spark, d))
    return centers.select("class", "k", *(rounded(F.col(f"c_{a}")).alias(f"c_{a}") for a in AXES))


def score_centroid(spark, d):
    scored = pipeline.identified(pipeline.grid_points(tables.readings(spark, d)), classes_of(spark, d))
    return scored.select(
        "userID", "segment_no", "inferred_user_id", rounded(F.col(CONFIDENCE_FIELD)).alias(CONFIDENCE_FIELD)
    )


def score_names(spark, d):
    points = pipeline.grid_points(tables.readings(spark, d))
    rows = pipeline.inferences(points, classes_of(spark, d), identities_of(spark, d))
    return rows.select("actual_user_id", "segment_no", "inferred_user_id", "inferred_users_name", "known")


def score_model(spark, d):
    """A model file made from the centroids, read back and run on the executors."""
    vectors = cut(pipeline.sample_vectors(tables.readings(spark, d)))
    centers = scoring.centroids(scoring.points_of(vectors, KEYS), classes_of(spark, d))
    path = new_folder(spark, "model")
    models.write_channel_model(centers, path, MODEL_SHARPNESS)
    load = models.model_file(spark, f"{path}/part-*", models.open_channel_model)
    scored = scoring.with_choice(scoring.score_with(vectors, load))
    return scored.select(
        "userID", "segment_no", "inferred_user_id", rounded(F.col(CONFIDENCE_FIELD)).alias(CONFIDENCE_FIELD)
    )


def inference_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Inference records as JSON text with the event's id and time beside them."""
    events = tables.table(spark, folder, "events").filter(F.col("event_type") == "view")
    record = F.struct(
        (F.col("value") / 100).cast("string").alias(CONFIDENCE_FIELD),
        F.get_json_object("props", "$.k").alias("inferred_user_id"),
        F.col("user_id").cast("string").alias("actual_user_id"),
    )
    return events.select("event_id", F.to_json(record).alias("value"))


def inference_names(spark, d):
    records = envelopes.inferences(inference_messages(spark, d))
    rows = scoring.named(records, identities_of(spark, d))
    return rows.withColumn(CONFIDENCE_FIELD, rounded(F.col(CONFIDENCE_FIELD)))


def _attributed(spark, d, accepted):
    rows = sessions.attributed(tables.lifecycle(spark, d))
    kept = F.col("accepted") if accepted else ~F.col("accepted")
    return rows.filter(kept).select("userID", "index", "timeMs", "session_no")


def inference_accepted(spark, d):
    return _attributed(spark, d, True)


def inference_rejected(spark, d):
    return _attributed(spark, d, False)


def _arrived(spark, d):
    return tables.lifecycle(spark, d).filter(sessions.is_kind("inference")).select("userID", "index", "timeMs")


def inference_known_users(spark, d):
    return sessions.known_only(_arrived(spark, d), sessions.online_ids(tables.lifecycle(spark, d)))


def inference_unknown_users(spark, d):
    return sessions.unknown_only(_arrived(spark, d), sessions.online_ids(tables.lifecycle(spark, d)))


def inference_lists(spark, d):
    return sessions.inference_lists(tables.lifecycle(spark, d))


# Sessions and feeds


def online_users(spark, d):
    return sessions.online_users(tables.lifecycle(spark, d))


def online_ids(spark, d):
    return sessions.online_ids(tables.lifecycle(spark, d))


def session_points(spark, d):
    return sessions.session_points(tables.lifecycle(spark, d))


def session_messages(spark, d):
    return sessions.session_messages(tables.lifecycle(spark, d))


def block_messages(spark: SparkSession, d: str) -> DataFrame:
    """Message texts: two connections per user; all readings of a block of events reach one in a single message, beside a
    connect, a stop or another message of the same arrival."""
    kind = tables.event_kind()
    rows = tables.readings(spark, d, kind).withColumns(
        {
            "uuid": F.concat_ws("-", "userID", F.col("index") % 2),
            "arrival": F.expr(f"index div {BLOCK_EVENTS}L"),
            "line": to_line(),
        }
    )
    event = F.when(F.col("kind") == "point", EVENT_POINTS).otherwise(F.col("kind"))
    points = F.transform(F.array_sort(F.collect_list(F.struct("index", "line"))), lambda p: p["line"])
    data = F.struct("uuid", F.when(F.col("kind") == "point", points).alias(POINTS_FIELD))
    return rows.groupBy("uuid", "arrival", "kind").agg(
        F.to_json(F.struct(event.alias("event"), data.alias("data"))).alias("value")
    )


def connection_blocks(spark: SparkSession, d: str) -> DataFrame:
    return envelopes.decoded(block_messages(spark, d).select("arrival", "value"))


def connection_messages(spark, d):
    return sessions.connection_messages(connection_blocks(spark, d))


def session_export_rows(spark, d):
    return _rounded_axes(sessions.closed_readings(connection_blocks(spark, d)), "vSum")


def order_violations(spark, d):
    """Messages of twenty readings, which arrive in the order of their second axis."""
    readings = tables.readings(spark, d).withColumn("message_id", F.expr(f"index div {MESSAGE_POINTS}L"))
    points = F.transform(
        F.array_sort(F.collect_list(F.struct("accY", "index", to_line().alias("line")))), lambda p: p["line"]
    )
    data = F.struct(F.lit("u").alias("uuid"), points.alias(POINTS_FIELD))
    packed = readings.groupBy("message_id").agg(
        F.to_json(F.struct(F.lit(EVENT_POINTS).alias("event"), data.alias("data"))).alias("value")
    )
    received = envelopes.points(envelopes.decoded(packed).drop("value"))
    found = envelopes.order_violations(received)
    return found.select("message_id", "pos", F.col("current").alias("index"), F.col("last").alias("previous"))


def live_feed(spark, d):
    rows = feed.live_feed(tables.readings(spark, d))
    return rows.withColumn("vSum", rounded(F.col("vSum")))


def live_messages(spark, d):
    """Feed messages read back, so that the text form of a number does not matter."""
    rows = feed.as_messages(feed.live_feed(tables.readings(spark, d)))
    return rows.select(
        "userID",
        "index",
        rounded(F.get_json_object("message", "$.xyz").cast("double")).alias("xyz"),
        F.get_json_object("message", "$.timestamp").alias("timestamp"),
    )


def live_front(spark, d):
    rows = feed.front(feed.live_feed(tables.readings(spark, d)))
    return rows.withColumn("vSum", rounded(F.col("vSum")))


def live_front_after_stop(spark, d):
    """Oldest point after each user's last stop: the cursor is that stop."""
    stops = tables.lifecycle(spark, d).filter(sessions.is_kind("stop"))
    cursors = stops.groupBy("userID").agg(F.max("timeMs").alias("read_ms"))
    rows = feed.front(feed.live_feed(tables.readings(spark, d)), cursors)
    return rows.withColumn("vSum", rounded(F.col("vSum")))


def live_tail(spark, d):
    rows = feed.tail(feed.live_feed(tables.readings(spark, d)), FEED_SINCE_MS)
    return rows.withColumn("vSum", rounded(F.col("vSum")))


def decimate_nth(spark, d):
    return feed.every_nth(feed.live_feed(tables.readings(spark, d)), FEED_NTH).select("userID", "index", "timeMs")


def throttle_gap(spark, d):
    return feed.throttled(feed.live_feed(tables.readings(spark, d)), FEED_GAP_MS).select("userID", "index", "timeMs")


def users_sorted(spark, d):
    return feed.users_sorted(tables.readings(spark, d))


# Streams


def stream_scopes(spark, d):
    """Segments of every scope by a stream over lines that is stopped and started again, with state per user."""

    def transform(batch):
        rows = segments.segments(peaks.by_user(batch, SCOPE_MS))
        return rows.select("scope", "userID", "segment_no", "index", "timeMs")

    return replay.scoped_replay(tables.readings(spark, d), transform, SCOPE_MS)


def stream_sessions(spark, d):
    """The rows of ``session_export_rows`` by a stream of messages, each in the batch of its stop."""
    return _rounded_axes(replay.sessions_replay(block_messages(spark, d)), "vSum")


QUERIES: dict[str, Query] = {
    "parse_readings_csv": parse_readings_csv,
    "parse_quarantine": parse_quarantine,
    "parse_damaged_good": parse_damaged_good,
    "line_keys": line_keys,
    "envelope_points": envelope_points,
    "envelope_routes": envelope_routes,
    "envelope_sessions": envelope_sessions,
    "points_xyz4": points_xyz4,
    "vector_norm": vector_norm,
    "local_maxima": local_maxima,
    "local_maxima_no_warmup": local_maxima_no_warmup,
    "cycle_peaks": cycle_peaks,
    "cycle_peaks_restarted": cycle_peaks_restarted,
    "cycle_peaks_day_gap": cycle_peaks_day_gap,
    "cycle_peaks_scoped": cycle_peaks_scoped,
    "cycle_strongest": cycle_strongest,
    "cycle_numbers": cycle_numbers,
    "segments": segment_rows,
    "segments_scoped": segment_rows_scoped,
    "segment_stats": segment_stats,
    "group_counts": group_counts,
    "too_short_segments": too_short_segments,
    "resampled_long": resampled_long,
    "resampled_long_day_gap": resampled_long_day_gap,
    "resampled_vectors": resampled_vectors,
    "resampled_vectors_scoped": resampled_vectors_scoped,
    "vector_text": vector_text,
    "tensor_shape": tensor_shape,
    "class_centroids": class_centroids,
    "score_centroid": score_centroid,
    "score_names": score_names,
    "score_model": score_model,
    "inference_names": inference_names,
    "inference_accepted": inference_accepted,
    "inference_rejected": inference_rejected,
    "inference_known_users": inference_known_users,
    "inference_unknown_users": inference_unknown_users,
    "inference_lists": inference_lists,
    "online_users": online_users,
    "online_ids": online_ids,
    "session_points": session_points,
    "session_messages": session_messages,
    "connection_messages": connection_messages,
    "session_export_rows": session_export_rows,
    "order_violations": order_violations,
    "live_feed": live_feed,
    "live_messages": live_messages,
    "live_front": live_front,
    "live_front_after_stop": live_front_after_stop,
    "live_tail": live_tail,
    "decimate_nth": decimate_nth,
    "throttle_gap": throttle_gap,
    "users_sorted": users_sorted,
    "stream_scopes": stream_scopes,
    "stream_sessions": stream_sessions,
}


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Fixed-length vectors of every segment."""
    return pipeline.sample_vectors(tables.readings(spark, folder))
