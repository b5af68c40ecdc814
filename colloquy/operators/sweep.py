"""Sweep line over time intervals: the continuous periods they cover and the gaps between.

Each interval is two events, +1 at its start and -1 at its end. Time is cut into cells, so that one entity, however many
intervals it has, is spread over as many tasks as it has cells:

1. Intervals are shuffled once, by (entity, cell). One that begins and ends in the same cell is one row; any other is
   two, one for each end, whatever its length.
2. Within a cell a running sum of the events gives the count relative to the cell's beginning.
3. One row per (entity, cell) holds the cell's sum and first event; a running sum over these gives the count at each
   cell's beginning and the first event after each cell. They number at most (span of time / cell) per entity.
4. Joined back, count 0 marks the end of a period, and the next event is the end of the gap.

Step 2 passes on only rows that can still turn out to be zero. Intervals that repeat change nothing, so rows delivered
twice need no separate de-duplication.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.session import cut

HOUR_MS = 3_600_000


def _zero_points(intervals: DataFrame, keys: list[str], start: str, end: str, cell_ms: int) -> DataFrame:
    """One row per end of a period: keys, __cell, __t (the end), __next (start of the next period, or null) and __first
    (the entity's first event)."""
    s, e = F.col(start), F.col(end)
    at = lambda c: F.floor(c / F.lit(cell_ms)).cast("bigint")
    none = F.lit(None).cast("bigint")
    part = lambda cell, a, b: F.struct(cell.alias("__cell"), a.alias("__s"), b.alias("__e"))
    halves = F.when(at(s) == at(e), F.array(part(at(s), s, e))).otherwise(F.array(part(at(s), s, none), part(at(e), none, e)))
    known = (e > s) & F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    # the join below asks for a cell that isn't null; saying so here keeps both uses of the shuffle alike, so it runs once
    rows = intervals.where(known).select(*keys, F.inline(halves)).where("__cell is not null").repartition(*keys, "__cell")
    event = lambda t, d: F.struct(t.alias("__t"), F.lit(d).alias("__d"))
    events = rows.select(*keys, "__cell", F.inline(F.filter(F.array(event(F.col("__s"), 1), event(F.col("__e"), -1)), lambda x: x["__t"].isNotNull())))

    cells = events.groupBy(*keys, "__cell").agg(F.sum("__d").alias("__sum"), F.min("__t").alias("__begin"))
    order = W.partitionBy(*keys).orderBy("__cell")
    cells = cells.select(
        *keys,
        "__cell",
        F.coalesce(F.sum("__sum").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__base"),
        F.lead("__begin").over(order).alias("__after"),
        F.first("__begin").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("__first"),
    )
    within = W.partitionBy(*keys, "__cell").orderBy("__t")
    points = events.select(*keys, "__cell", "__t", F.sum("__d").over(within).alias("__count"), F.lead("__t").over(within).alias("__lead"))
    points = points.where((F.col("__count") <= 0) & (F.col("__lead").isNull() | (F.col("__lead") > F.col("__t"))))
    return (
        points.join(cells, [*keys, "__cell"])
        .where(F.col("__count") + F.col("__base") == 0)
        .select(*keys, "__cell", "__t", F.coalesce("__lead", "__after").alias("__next"), "__first")
    )


def interval_gaps(intervals: DataFrame, keys: list[str], start: str, end: str, cell_ms: int = HOUR_MS) -> DataFrame:
    """The gaps between consecutive continuous periods of each entity: ``keys``, ``gap_start``, ``gap_end``.

    ``start`` and ``end`` are BIGINT columns. Intervals that touch form one period. Rows with a null key or bound, or
    whose end isn't after the start, are left out; an empty table gives an empty table; other columns, whatever their
    names, are ignored.
    """
    zero = _zero_points(intervals, keys, start, end, cell_ms)
    return zero.where(F.col("__next").isNotNull()).select(*keys, F.col("__t").alias("gap_start"), F.col("__next").alias("gap_end"))


def covered_periods(intervals: DataFrame, keys: list[str], start: str, end: str, cell_ms: int = HOUR_MS) -> DataFrame:
    """The continuous periods of each entity: ``keys``, ``period_start``, ``period_end``. Rules as in interval_gaps."""
    zero = cut(_zero_points(intervals, keys, start, end, cell_ms))
    last = zero.groupBy(*keys, "__cell").agg(F.max("__next").alias("__last"))
    before = W.partitionBy(*keys).orderBy("__cell").rowsBetween(W.unboundedPreceding, -1)
    last = last.select(*keys, "__cell", F.max("__last").over(before).alias("__earlier"))
    begun = F.lag("__next").over(W.partitionBy(*keys, "__cell").orderBy("__t"))
    return zero.join(last, [*keys, "__cell"]).select(*keys, F.coalesce(begun, "__earlier", "__first").alias("period_start"), F.col("__t").alias("period_end"))
