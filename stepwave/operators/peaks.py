"""Local maxima and cycle peaks of the signal strength per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scan import NO_ANCHOR, Rule, emitted_positions, entry_anchors, transitions
from ..schema import CYCLE_MS, WARMUP_POSITIONS
from ..session import cut
from .ordered import Ordered, in_order, with_context

# Total for everything peaks depend on: rows that tie in all three are alike to them.
ORDER = ("timeMs", "index", "vSum")


def scoped(readings: DataFrame, scope_ms: int | None) -> DataFrame:
    """Add ``scope``, the tumbling range of event time a group is limited to; NULL for the whole history."""
    scope = F.lit(None).cast("bigint") if scope_ms is None else F.expr(f"timeMs div {int(scope_ms)}L")
    return readings.withColumn("scope", scope)


def by_user(readings: DataFrame, scope_ms: int | None = None, max_rows: int | None = None) -> Ordered:
    """Readings grouped by user, and by scope where one is given, in time order."""
    head = max(WARMUP_POSITIONS) + 1
    if scope_ms is None:
        return in_order(readings, ("userID",), ORDER, max_rows, head)
    return in_order(scoped(readings, scope_ms), ("scope", "userID"), ORDER, max_rows, head)


def without_warmup(data: Ordered, positions=WARMUP_POSITIONS) -> Ordered:
    """Hide the given positions (0-based, in order) of every group."""
    number = F.row_number().over(data.window)
    position = number - 1
    if data.sliced:
        # The first rows of a sliced group know their place; equal rows share one slice and count on from it.
        copy = number - F.rank().over(data.window)
        position = F.when(F.col("slices") > 1, F.col("place") + copy).otherwise(position)
    numbered = data.rows.withColumn("_position", position)
    shown = numbered.filter(F.col("_position").isNull() | ~F.col("_position").isin(*positions))
    return data.with_rows(shown.drop("_position", "place"))


def local_maxima(data: Ordered, skip_warmup: bool = True) -> Ordered:
    """Readings stronger than both neighbours, with ``next_ms``, the time of the following reading.

    A maximum is never directly before a hidden reading, except the one at position 2, which cannot
    become a cycle peak; ``next_ms`` of a cycle peak is therefore exact.
    """
    kept = without_warmup(data) if skip_warmup else data
    seen = with_context(
        kept, prev={"before": F.col("vSum")}, next={"after": F.col("vSum"), "next_ms": F.col("timeMs")}
    )
    rows = seen.rows.filter((F.col("before") < F.col("vSum")) & (F.col("after") < F.col("vSum")))
    return seen.with_rows(rows.select(*data.keys, *data.slice_columns, *ORDER, "next_ms"))


def greedy(data: Ordered, rule: Rule, columns: tuple[str, ...]) -> Ordered:
    """Run a greedy scan over every group; one row per emitted item with ``timeMs`` and ``columns``.

    The items of one group (or of one slice of a large group) form one sorted array.  For a large
    group every slice first states where each possible entry leaves it, those statements are followed
    in slice order, and each slice is then scanned from its own entry.
    """
    fields = ("timeMs", *(c for c in columns if c != "timeMs"))
    group = [*data.part, "slices"] if data.sliced else list(data.part)
    packed = data.rows.groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("items")
    )
    if data.sliced:
        packed = cut(packed)
        large = packed.filter(F.col("slices") > 1).select(*data.part, F.col("items.timeMs").alias("times"))
        moves = large.withColumn("move", transitions(F.col("times"), rule)).select(*data.part, "move.*")
        packed = packed.join(entry_anchors(moves, data.keys, rule), list(data.part), "left")
    else:
        packed = packed.withColumn("anchor", F.lit(NO_ANCHOR))
    places = emitted_positions(F.col("items.timeMs"), F.coalesce("anchor", F.lit(NO_ANCHOR)), rule)
    taken = F.transform("places", lambda p: F.get("items", p))
    emitted = packed.withColumn("places", places).select(*group, F.explode(taken).alias("item"))
    return data.with_rows(emitted.select(*group, "item.*"))


def cycle_peaks(data: Ordered, cycle_ms: int = CYCLE_MS, skip_warmup: bool = True) -> Ordered:
    """The first local maximum more than ``cycle_ms`` after the anchor, which then restarts; see ``Rule``.

    An index that is emitted twice in one scope counts once, at its first place.  Over whole histories a
    counter may restart, so there every emission counts.
    """
    maxima = local_maxima(data, skip_warmup)
    peaks = greedy(maxima, Rule(cycle_ms), (*ORDER, "next_ms"))
    # Without slices one shuffle by group serves this count and every later window over the peaks.
    rows = peaks.rows if data.sliced else peaks.rows.repartition(*data.keys)
    if "scope" in data.keys:
        first = F.min(F.struct("timeMs", "vSum", "next_ms", *data.slice_columns)).alias("first")
        rows = rows.groupBy(*data.keys, "index").agg(first).select(*data.keys, "index", "first.*")
    return peaks.with_rows(cut(rows) if data.sliced else rows)


def numbered_peaks(peaks: Ordered) -> Ordered:
    """Add ``cycle``, the 1-based number of the peak in its group."""
    return with_context(peaks, running={"cycle": F.lit(1)})


def strongest_per_cycle(data: Ordered, cycle_ms: int = CYCLE_MS, skip_warmup: bool = True) -> DataFrame:
    """The strongest local maximum of every completed cycle; the earliest wins a tie."""
    maxima = local_maxima(data, skip_warmup)
    peaks = numbered_peaks(cycle_peaks(data, cycle_ms, skip_warmup))
    marked = with_cycles(maxima, peaks, {"done": F.col("cycle")})
    best = F.max_by(F.struct("index", "timeMs", "vSum"), F.struct("vSum", -F.col("timeMs"), -F.col("index")))
    cycle = [*data.keys, "cycle"]
    strongest = marked.rows.withColumn("cycle", F.coalesce("done", F.lit(0)) + 1).groupBy(*cycle).agg(best.alias("best"))
    completed = strongest.join(peaks.rows.select(*cycle), cycle, "left_semi")
    return completed.select(*cycle, "best.*")


def with_cycles(data: Ordered, peaks: Ordered, values: dict) -> Ordered:
    """Give every row ``values`` of the last peak strictly before it, NULL where there is none.

    Peaks join the rows as marker rows and one running window hands their values on.  In a large
    group the marker is repeated at the start of each later slice up to the one with the next peak.
    """
    marks = peaks.rows
    kind = F.struct(*(v.alias(n) for n, v in values.items()))
    if data.sliced:
        ahead = with_context(peaks, next={"_until": F.col("slice")}).rows
        until = F.coalesce("_until", F.col("slices") - 1)
        later = F.when(until > F.col("slice"), F.sequence(F.col("slice") + 1, until)).otherwise(
            F.array().cast("array<bigint>")
        )
        here = ahead.select(*data.part, "slices", *data.order, F.lit(1).alias("_mark"), kind.alias("_value"))
        start = ahead.select(
            *data.keys,
            F.explode(later).alias("slice"),
            "slices",
            *(F.lit(None).cast(data.rows.schema[o].dataType).alias(o) for o in data.order),
            F.lit(1).alias("_mark"),
            kind.alias("_value"),
        )
        marks = here.unionByName(start)
    else:
        marks = marks.select(*data.keys, *data.order, F.lit(1).alias("_mark"), kind.alias("_value"))
    rows = data.rows.withColumn("_mark", F.lit(0)).unionByName(marks, allowMissingColumns=True)
    so_far = (
        Window.partitionBy(*data.part)
        .orderBy(*data.order, "_mark")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    marked = rows.withColumn("_last", F.last("_value", ignorenulls=True).over(so_far)).filter(F.col("_mark") == 0)
    return data.with_rows(
        marked.select(*data.rows.columns, *(F.col(f"_last.{n}").alias(n) for n in values))
    )
