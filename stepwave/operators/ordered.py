"""Ordered groups that stay bounded: row context across slices of a large group.

A sequence operator sees the rows of one group (user, or user and scope) in time order.  A group
small enough for one task is handled by plain windows over its keys.  A group above ``max_rows``
is cut into time slices of about equal size; windows then run per slice, and a summary with one row per slice carries
what crosses a slice border.  Only summaries are ever ordered over a whole large group.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

MAX_GROUP_ROWS = 200_000
MAX_GROUP_ROWS_SETTING = "spark.stepwave.maxGroupRows"
MAX_BROADCAST_GROUPS = 10_000
SALTS = 256
PIECES = 256
MAX_SLICES = PIECES * 256
ACCURACY = 2_000


@dataclass(frozen=True)
class Ordered:
    """Rows with their group keys and the total order inside a group; ``order[0]`` is the time.

    ``large`` may give the rows of the sliced groups by a shorter way than filtering ``rows``.
    """

    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    sliced: bool = False
    large: DataFrame | None = None

    @property
    def part(self) -> tuple[str, ...]:
        return (*self.keys, "slice") if self.sliced else self.keys

    @property
    def slice_columns(self) -> tuple[str, ...]:
        return ("slice", "slices") if self.sliced else ()

    @property
    def window(self):
        return Window.partitionBy(*self.part).orderBy(*self.order)

    def with_rows(self, rows: DataFrame) -> "Ordered":
        return replace(self, rows=rows, large=None)


def group_limit(df: DataFrame, max_rows: int | None) -> int:
    """Largest group that one task takes: the argument, else the session's setting, else the default."""
    if max_rows is not None:
        return max_rows
    return int(df.sparkSession.conf.get(MAX_GROUP_ROWS_SETTING, str(MAX_GROUP_ROWS)))


def in_order(rows: DataFrame, keys, order, max_rows: int | None = None, head: int = 0) -> Ordered:
    """Prepare ``rows`` for the operators below, slicing the groups that exceed ``max_rows``.

    Rows without a key or a time belong to no group and are left out.  With ``head`` the first rows of a
    sliced group carry ``place``, their position from 0.
    """
    keys, order, max_rows = tuple(keys), tuple(order), group_limit(rows, max_rows)
    rows = rows.dropna(subset=[*keys, order[0]])
    large = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_rows)
    sample = large.limit(MAX_BROADCAST_GROUPS + 1).collect()
    if not sample:
        return Ordered(rows, keys, order)
    few = len(sample) <= MAX_BROADCAST_GROUPS
    groups = F.broadcast(rows.sparkSession.createDataFrame(sample, large.schema)) if few else large
    # Quantiles are approximate, so they are fixed once for every branch that uses them.
    starts = cut(_slice_starts(rows.join(groups, list(keys)), keys, order, max_rows, head))
    if few:
        joined = rows.join(F.broadcast(starts), list(keys), "left")
    else:
        # Too many large groups to broadcast: spread each of them over salted copies of its one row.
        salted = starts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64(*order), F.lit(SALTS)).cast("int")
        joined = rows.withColumn("salt", salt).join(salted, [*keys, "salt"], "left").drop("salt")
    if head:
        place = F.nullif(F.array_position("head", F.struct(*order)), F.lit(0)) - 1
        joined = joined.withColumn("place", place.cast("int")).drop("head")
    return Ordered(_with_slice(joined, order[0]), keys, order, sliced=True)


def _slice_starts(rows: DataFrame, keys, order, max_rows: int, head: int) -> DataFrame:
    """Start times of slices that hold about equally many rows, per large group.

    A group needing more than ``PIECES`` slices has each piece divided evenly into ``splits``.
    """
    time = order[0]
    quantiles = F.percentile_approx(time, [i / PIECES for i in range(1, PIECES)], ACCURACY)
    stats = rows.groupBy(*keys).agg(
        F.max("n").alias("n"), F.min(time).alias("t0"), F.max(time).alias("t1"), quantiles.alias("quantiles")
    )
    wanted = F.least(F.ceil(F.col("n") / max_rows), F.lit(MAX_SLICES))
    stride = F.greatest(F.floor(F.lit(PIECES) / wanted), F.lit(1))
    taken = F.filter("quantiles", lambda _, i: (i + 1) % stride == 0)
    starts = F.array_distinct(F.concat(F.array("t0"), taken))
    splits = F.ceil(wanted / PIECES).cast("bigint")
    result = stats.select(
        *keys, starts.alias("starts"), splits.alias("splits"), "t1", (F.size(starts) * splits).alias("slices")
    )
    if not head:
        return result
    # The rank filter keeps a few rows per task and group before anything is shuffled.
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    first = rows.select(*keys, *order).withColumn("rank", rank).filter(F.col("rank") <= head)
    heads = first.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order))).alias("head"))
    return result.join(heads, list(keys))


def _with_slice(rows: DataFrame, time: str) -> DataFrame:
    """Number the slice of every row; rows of small groups are all in slice 0."""
    at, steps = F.col(time), F.array(*(F.lit(1 << b) for b in reversed(range(PIECES.bit_length() - 1))))
    piece = F.aggregate(
        steps, F.lit(0), lambda p, step: F.when(F.get("starts", p + step) <= at, p + step).otherwise(p)
    )
    located = rows.withColumn("_piece", F.when(F.col("starts").isNotNull(), piece))
    start, end = F.get("starts", F.col("_piece")), F.get("starts", F.col("_piece") + 1)
    width = F.ceil((F.coalesce(end, F.col("t1") + 1) - start) / F.col("splits")).cast("bigint")
    located = located.withColumns({"_start": start, "_width": width})
    number = F.col("_piece") * F.col("splits") + F.floor((at - F.col("_start")) / F.col("_width"))
    return located.withColumns(
        {
            "slice": F.coalesce(number.cast("bigint"), F.lit(0).cast("bigint")),
            "slices": F.coalesce("slices", F.lit(1).cast("bigint")),
        }
    ).drop("starts", "splits", "t1", "_piece", "_start", "_width")


def with_context(
    data: Ordered,
    *,
    running: dict[str, Column] | None = None,
    prev: dict[str, Column] | None = None,
    next: dict[str, Column] | None = None,
    carry: dict[str, Column] | None = None,
    total: dict[str, Column] | None = None,
) -> Ordered:
    """Add values that depend on the other rows of the group.

    ``running``: sum up to and including the row.  ``prev`` / ``next``: value on the neighbour row,
    NULL at the ends of the group.  ``carry``: last non-NULL value at or before the row.
    ``total``: sum over the whole group.
    """
    running, prev, next, carry, total = running or {}, prev or {}, next or {}, carry or {}, total or {}
    so_far = data.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {name: F.sum(value).over(so_far) for name, value in running.items()}
    local |= {name: F.lag(value).over(data.window) for name, value in prev.items()}
    local |= {name: F.lead(value).over(data.window) for name, value in next.items()}
    local |= {name: F.last(value, ignorenulls=True).over(so_far) for name, value in carry.items()}
    local |= {name: F.sum(value).over(Window.partitionBy(*data.part)) for name, value in total.items()}
    rows = data.rows.withColumns(local)
    if not data.sliced:
        return data.with_rows(rows)

    position = F.struct(*data.order)
    source = data.rows if data.large is None else data.large
    summary = (
        source.filter(F.col("slices") > 1)
        .groupBy(*data.part)
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            *(F.sum(v).alias(f"_{n}") for n, v in running.items()),
            *(F.max_by(v, position).alias(f"_{n}") for n, v in prev.items()),
            *(F.min_by(v, position).alias(f"_{n}") for n, v in next.items()),
            *(F.max_by(v, F.when(v.isNotNull(), position)).alias(f"_{n}") for n, v in carry.items()),
            *(F.sum(v).alias(f"_{n}") for n, v in total.items()),
        )
    )
    slices = Window.partitionBy(*data.keys).orderBy("slice")
    before = slices.rowsBetween(Window.unboundedPreceding, -1)
    border = {f"_{n}": F.sum(f"_{n}").over(before) for n in running}
    border |= {f"_{n}": F.lag(f"_{n}").over(slices) for n in prev}
    border |= {f"_{n}": F.lead(f"_{n}").over(slices) for n in next}
    border |= {f"_{n}": F.last(f"_{n}", ignorenulls=True).over(before) for n in carry}
    border |= {f"_{n}": F.sum(f"_{n}").over(Window.partitionBy(*data.keys)) for n in total}
    border["_first"], border["_last"] = F.lit(1), F.col("_rows")
    # One select: every window reads the summary's own columns, not a column replaced before it.
    summary = summary.select(*data.part, *(value.alias(name) for name, value in border.items()))

    rows = rows.withColumn("_row", F.row_number().over(data.window)).join(summary, list(data.part), "left")
    at_first, at_last = F.col("_row") == F.col("_first"), F.col("_row") == F.col("_last")
    merged = {n: F.col(n) + F.coalesce(f"_{n}", F.lit(0)) for n in running}
    merged |= {n: F.when(at_first, F.col(f"_{n}")).otherwise(F.col(n)) for n in prev}
    merged |= {n: F.when(at_last, F.col(f"_{n}")).otherwise(F.col(n)) for n in next}
    merged |= {n: F.coalesce(n, f"_{n}") for n in carry}
    merged |= {n: F.coalesce(f"_{n}", n) for n in total}
    return data.with_rows(rows.withColumns(merged).drop("_row", *border))
