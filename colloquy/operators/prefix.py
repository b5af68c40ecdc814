"""Running sums and hot-key joins that never put one group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def running_before(df: DataFrame, keys: list[str], cell: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """Adds ``name``: per ``keys``, the sum of ``value`` over the rows before this one, in the order (cell, order).

    ``cell`` is a column that divides each group's order into stretches of bearable size, such as a day or some bits of a
    hash. Sums within cells and sums over whole cells are added up, so a group is spread over its cells. ``order`` must
    be total within a cell. Rows with a null key are left out.
    """
    at = [*keys, cell]
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    df = df.withColumn("__value", value)
    cells = df.groupBy(*at).agg(F.sum("__value").alias("__sum"))
    over = (W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))).orderBy(cell).rowsBetween(W.unboundedPreceding, -1)
    cells = cells.select(*at, F.coalesce(F.sum("__sum").over(over), F.lit(0)).alias("__base"))
    inner = W.partitionBy(*at).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    df = df.withColumn("__within", F.coalesce(F.sum("__value").over(inner), F.lit(0)))
    return df.join(cells, at).withColumn(name, F.col("__within") + F.col("__base")).drop("__within", "__base", "__value")


def join_hot(big: DataFrame, small: DataFrame, key: str, count: str, hot: int) -> DataFrame:
    """Inner join of ``big`` with ``small``, which has one row per ``key`` and, in ``count``, big's number of such rows.

    Keys with ``hot`` rows or more are joined by broadcast: there are at most (rows of big) / ``hot`` of them, so choose
    it as a share of these rows. All other keys are joined by shuffle, where none can weigh a partition down.
    """
    often, rest = F.broadcast(small.where(F.col(count) >= hot)), small.where(F.col(count) < hot)
    return big.join(often, key).unionByName(big.join(F.broadcast(often.select(key)), key, "left_anti").join(rest, key))


#: At most this many keys are broadcast as hot, whatever the number of rows; a task holds keys of fewer rows than LEAST_HOT.
MOST_HOT, LEAST_HOT = 1_000, 50_000


def hot_from(rows: int) -> int:
    """The least count of a hot key: with it, at most MOST_HOT of ``rows`` rows' keys are hot, and none that is small."""
    return max(LEAST_HOT, -(-rows // MOST_HOT))


def with_previous(df: DataFrame, keys: list[str], cell: str, order: list[str], values: list[str], name: str) -> DataFrame:
    """Adds ``name``: a struct of the previous row's ``values`` per ``keys`` in the order (cell, order), null at the first.

    Like lag(), but a group is spread over its cells; only each cell's last row is compared between cells.
    """
    at, row = [*keys, cell], F.struct(*values)
    last = df.groupBy(*at).agg(F.max_by(row, F.struct(*order)).alias("__last"))
    last = last.select(*at, F.lag("__last").over((W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))).orderBy(cell)).alias("__earlier"))
    own = F.lag(row).over(W.partitionBy(*at).orderBy(*order))
    return df.withColumn("__own", own).join(last, at).withColumn(name, F.coalesce("__own", "__earlier")).drop("__own", "__earlier")
