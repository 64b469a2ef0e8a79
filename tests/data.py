"""Small inputs for the tests."""

import random

from pyspark.sql import types as T

from stepwave.schema import READING

EVENT = T.StructType(
    [
        T.StructField("userID", T.StringType()),
        T.StructField("index", T.LongType()),
        T.StructField("timeMs", T.LongType()),
        T.StructField("kind", T.StringType()),
    ]
)


def reading(index, user, time, v, x=0.0, y=0.0, z=0.0):
    return {"index": index, "userID": user, "timeMs": time, "accX": x, "accY": y, "accZ": z, "vSum": float(v)}


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[f] for f in READING.names) for r in rows], READING)


def events(spark, rows):
    return spark.createDataFrame([(r["userID"], r["index"], r["timeMs"], r["kind"]) for r in rows], EVENT)


def walk(seed, sizes, step=(1, 400), start=1_574_812_000_000, ties=0.1):
    """Irregular readings per user; ``sizes`` maps users to counts."""
    rng, rows = random.Random(seed), []
    for user, size in sizes.items():
        time = start + rng.randrange(1000)
        for _ in range(size):
            time += 0 if rng.random() < ties else rng.randint(*step)
            x, y, z = (round(rng.uniform(-10, 10), 6) for _ in range(3))
            rows.append(reading(len(rows), user, time, rng.randrange(40), x, y, z))
    rng.shuffle(rows)
    return rows


def connection_events(seed, sizes):
    rng, rows = random.Random(seed), []
    for user, size in sizes.items():
        time = 0
        for _ in range(size):
            time += rng.randrange(0, 50)
            kind = rng.choices(["point", "inference", "connect", "stop"], [5, 3, 1, 1])[0]
            rows.append({"userID": user, "index": len(rows), "timeMs": time, "kind": kind})
    rng.shuffle(rows)
    return rows


def first_fixture(step=300):
    """One user, thirty readings; the readings at positions 0 and 3 must never take part."""
    strength = [99, 1, 5, 99, 1] + [5 if p % 2 else 1 for p in range(5, 30)]
    return [reading(p, "u", step * p, v) for p, v in enumerate(strength)]
