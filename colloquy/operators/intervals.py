"""Joins of intervals that overlap, as equi-joins on entity and cell of time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells of an interval at most, but for one at each end, and how many widths of cells there are.
CELLS, LEVELS = 64, 5


def overlap_join(left: DataFrame, right: DataFrame, key: str, cell_ms: int = 60_000) -> DataFrame:
    """Pairs of intervals of the same ``key`` that overlap by more than a point: key, l_start, l_end, r_start, r_end, and
    ``start``/``end`` of what they share.

    Both sides have ``start_ms``/``end_ms``. Each interval is put into all cells it touches, and a pair is kept only in
    the cell where what they share begins: so no pair is found twice, no cross product of a key arises, and a key's work
    is spread over its cells. An interval of more than CELLS cells has cells CELLS times as wide, and so on, so that none
    has more than a few; where there are such, pairs are looked for at each width that occurs, the wider of the two. Rows
    with a null key or bound, or without length, meet nothing.
    """
    wide = lambda level: cell_ms * CELLS**level
    span = F.col("end_ms") - F.col("start_ms")
    level = F.lit(0)
    for k in range(1, LEVELS):
        level = F.when(span > wide(k - 1) * CELLS, k).otherwise(level)

    def sided(df: DataFrame, side: str) -> DataFrame:
        return df.where("end_ms > start_ms").select(key, F.col("start_ms").alias(f"{side}_start"), F.col("end_ms").alias(f"{side}_end"), level.alias(f"{side}_level"))

    def celled(df: DataFrame, side: str, k: int) -> DataFrame:
        cells = F.explode(F.sequence(F.floor(F.col(f"{side}_start") / wide(k)), F.floor((F.col(f"{side}_end") - 1) / wide(k))))
        return df.where(F.col(f"{side}_level") <= k).select("*", cells.alias("__cell"))

    a, b = sided(left, "l"), sided(right, "r")
    levels = sorted({0} | {r[0] for side, df in (("l", a), ("r", b)) for r in df.select(f"{side}_level").where(F.col(f"{side}_level") > 0).distinct().collect()})  # LEVELS at most
    start, end = F.greatest("l_start", "r_start"), F.least("l_end", "r_end")
    found = []
    for k in levels:
        pairs = celled(a, "l", k).join(celled(b, "r", k), [key, "__cell"]).where((end > start) & (F.floor(start / wide(k)) == F.col("__cell")) & (F.greatest("l_level", "r_level") == k))
        found.append(pairs.select(key, "l_start", "l_end", "r_start", "r_end", start.alias("start"), end.alias("end")))
    return reduce(DataFrame.unionByName, found)


def overlap_total(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Per key the time that intervals of both sides share, summed over pairs."""
    return overlap_join(left, right, key).groupBy(key).agg(F.sum(F.col("end") - F.col("start")).alias("overlap_ms"), F.count("*").alias("n_pairs"))


def short_overlapping(left: DataFrame, right: DataFrame, key: str, least_ms: int = 200, most_ms: int = 1_000) -> DataFrame:
    """Intervals of ``left`` of ``least_ms`` to ``most_ms``, both included, that overlap any of ``right``."""
    short = left.where((F.col("end_ms") - F.col("start_ms")).between(least_ms, most_ms))
    return overlap_join(short, right, key).select(key, F.col("l_start").alias("start_ms"), F.col("l_end").alias("end_ms")).distinct()
