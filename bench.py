"""Time the headline queries over one table set; prints one JSON line.

``queries`` holds the first run of each, ``building`` the part of it before the plan stands, ``warm`` the median of
the runs after it.
"""

from __future__ import annotations

import json
import os
import sys
import time
from functools import partial
from statistics import median

from pyspark.sql import SparkSession

from stepwave.operators.resample import samples
from stepwave.operators.scoring import centroids, scorer, with_choice
from stepwave.plans.catalogue import QUERIES, classes_of, lines_of
from stepwave.plans.pipeline import grid_points
from stepwave.session import cut, tuned
from stepwave.streaming import scopes
from stepwave.streaming.scopes import readings_of

WARM_RUNS = 3
HEADLINE = (
    "parse_readings_csv",
    "envelope_points",
    "local_maxima",
    "cycle_peaks",
    "cycle_peaks_scoped",
    "segments",
    "resampled_long",
    "resampled_vectors",
    "tensor_shape",
    "score_centroid",
    "inference_accepted",
    "session_points",
    "live_front",
    "throttle_gap",
)


def micro_batch(spark: SparkSession, folder: str):
    """All lines of the table as one micro-batch: a function that parses, cuts, resamples and scores them."""
    lines = cut(lines_of(spark, folder))
    classes = classes_of(spark, folder)
    score = scorer(centroids(grid_points(readings_of(lines)), classes))

    def run():
        points = scopes.grid_per_batch()(readings_of(lines))
        return with_choice(score(samples(points, ("userID",))))

    return run


def timed(query) -> tuple[float, float]:
    """Seconds until the plan stands, and in all."""
    begin = time.perf_counter()
    rows = query()
    built = time.perf_counter()
    rows.write.format("noop").mode("overwrite").save()
    return round(built - begin, 3), round(time.perf_counter() - begin, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stepwave-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = tuned(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["live_feed"](spark, folder).write.format("noop").mode("overwrite").save()  # start-up is not measured
    runs = {name: partial(QUERIES[name], spark, folder) for name in names}
    if not sys.argv[1:]:
        runs["micro_batch"] = micro_batch(spark, folder)
    seconds, planning, warm = {}, {}, {}
    for name, query in runs.items():
        taken = [timed(query) for _ in range(1 + WARM_RUNS)]
        planning[name], seconds[name] = taken[0]
        warm[name] = median(total for _, total in taken[1:])
    spark.stop()
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    scale = float(scale) if scale.replace(".", "").isdigit() else folder
    result = {"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}
    print(json.dumps(result | {"building": planning, "warm": warm}))


if __name__ == "__main__":
    main()
