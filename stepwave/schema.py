"""Column layouts and parameters shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# Wire field names, event tags and constants that inputs and results depend on.
READING_FIELDS = ("index", "userID", "timeMs", "accX", "accY", "accZ", "vSum")
EVENT_CONNECT = "connect"
EVENT_POINTS = "gait"
EVENT_STOP = "stop"
POINTS_FIELD = "gait"
CONFIDENCE_FIELD = "confidency"
CYCLE_MS = 1000
GRID_POINTS = 128
DECIMAL_PLACES = 8
SCOPE_MS = 10_000
THROTTLE_MS = 200
ZERO_CHANNELS = 3
WARMUP_POSITIONS = (0, 3)

DAY_MS = 86_400_000
AXES = ("accX", "accY", "accZ")

READING = T.StructType(
    [
        T.StructField("index", T.LongType()),
        T.StructField("userID", T.StringType()),
        T.StructField("timeMs", T.LongType()),
        T.StructField("accX", T.DoubleType()),
        T.StructField("accY", T.DoubleType()),
        T.StructField("accZ", T.DoubleType()),
        T.StructField("vSum", T.DoubleType()),
    ]
)

ENVELOPE = T.StructType(
    [
        T.StructField("event", T.StringType()),
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField("uuid", T.StringType()),
                    T.StructField("userid", T.StringType()),
                    T.StructField(POINTS_FIELD, T.ArrayType(T.StringType())),
                ]
            ),
        ),
    ]
)

# Numbers arrive as JSON strings or as JSON numbers; both read as STRING and are cast afterwards.
INFERENCE_WIRE = T.StructType(
    [
        T.StructField(CONFIDENCE_FIELD, T.StringType()),
        T.StructField("inferred_user_id", T.StringType()),
        T.StructField("actual_user_id", T.StringType()),
    ]
)
