"""First and last wins, anti-joins against ledgers, upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.operators.prefix import hot_from, join_hot
from colloquy.session import cut


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given total order; null keys are keys like any other. Planned with a group limit
    before the shuffle, so a hot key sends one row a partition."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def with_copy_number(df: DataFrame, keys: list[str], order: list[Column], name: str = "copy_no") -> DataFrame:
    """Adds ``name``: an earlier row has the same keys. By the keys' first row, found by a partial aggregate and joined with
    hot keys apart, so a key with a third of all rows weighs no partition down. Null keys are keys like any other."""
    # cut: the rows are counted, aggregated and joined, and what they come from must not run for each
    keyed = cut(df.withColumn("__key", F.struct(*keys)).withColumn("__order", F.struct(*order)))
    first = keyed.groupBy("__key").agg(F.min("__order").alias("__first"), F.count("*").alias("__n"))
    return join_hot(keyed, first, "__key", "__n", hot_from(keyed.count())).withColumn(name, F.col("__order") != F.col("__first")).drop("__key", "__order", "__first", "__n")


def pending(rows: DataFrame, ledger: DataFrame, key: str, done: tuple[str, ...] | None = None) -> DataFrame:
    """Rows whose key the ledger doesn't have, or has only with a status other than ``done`` (None: any is done)."""
    seen = ledger if done is None else ledger.where(F.col("status").isin(*done))
    return rows.join(seen.select(key).distinct(), key, "left_anti")


def upsert(ledger: DataFrame, updates: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The ledger with the updates merged in: per key the row that is last in ``order``. Partial aggregates, no sort."""
    rest = [c for c in ledger.columns if c != key]
    both = ledger.unionByName(updates.select(*ledger.columns))
    last = both.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return last.select(key, *[F.col(f"__row.{c}").alias(c) for c in rest])


def insert_missing(ledger: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """The ledger with the updates of keys it doesn't have; the first of equal new keys, by all columns, is taken."""
    new = keep_first(updates.join(ledger.select(key), key, "left_anti").select(*ledger.columns), [key], [F.col(c) for c in ledger.columns])
    return ledger.unionByName(new)
