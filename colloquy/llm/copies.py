"""Duplicates hidden by formatting differences (problem 5).

Records are reduced to a canonical key, range-partitioned by (key, id) and sorted within partitions, which spills to
disk as needed. Equal keys then lie side by side and one scan finds them, comparing full keys, not hashes. As the id is
part of the range key, a key with a third of all rows fills many partitions; only the first and the last run of a partition
can go on in another one, and only their keys, two a partition at most, are compared between partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions.keys import URL_IDENTITY_SQL, url_identity
from colloquy.session import cut, read_table

SCANNED = "origin string, key string, id bigint, first_id bigint, edge boolean"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (origin, key, id): drops repeats of an id and adds the run's first id. At the end come the edges: the
    first and the last run of the partition, one row each."""
    last: tuple | None = None  # origin, key, id, first_id of the row before
    opening: tuple | None = None  # origin, key, first_id of the partition's first run

    def table(origin, key, ids, first, edge: bool) -> pa.RecordBatch:
        return pa.record_batch([origin, key, pa.array(ids, pa.int64()), pa.array(first, pa.int64()), pa.array([edge] * len(ids), pa.bool_())], ["origin", "key", "id", "first_id", "edge"])

    for b in batches:
        n = b.num_rows
        if not n:
            continue
        origin, key, ids = b.column("origin"), b.column("key"), b.column("id").to_numpy()
        change = np.ones(n, dtype=bool)
        if n > 1:
            change[1:] = pc.or_(pc.not_equal(key.slice(1), key.slice(0, n - 1)), pc.not_equal(origin.slice(1), origin.slice(0, n - 1))).to_numpy(zero_copy_only=False)
        goes_on = last is not None and last[:2] == (origin[0].as_py(), key[0].as_py())
        starts = np.flatnonzero(change)
        first = ids[starts].copy()
        if goes_on:
            first[0] = last[3]
        first = np.repeat(first, np.diff(np.r_[starts, n]))
        fresh = change.copy()
        fresh[1:] |= ids[1:] != ids[:-1]
        if goes_on:
            fresh[0] = ids[0] != last[2]
        opening = opening or (origin[0].as_py(), key[0].as_py(), int(first[0]))
        last = (origin[n - 1].as_py(), key[n - 1].as_py(), int(ids[-1]), int(first[-1]))
        yield table(origin, key, ids, first, False).filter(pa.array(fresh))
    if last is not None:
        ends = {opening, (last[0], last[1], last[3])}
        yield table(pa.array([e[0] for e in ends]), pa.array([e[1] for e in ends]), [e[2] for e in ends], [e[2] for e in ends], True)


def hidden_copies(records: DataFrame, partitions: int | None = None) -> DataFrame:
    """``records``: origin, key, id. Result: each id once with the smallest id of its (origin, key) as ``first_id``.

    Null keys are left out: they are the same as none. An id that repeats within its key counts once. Empty in, empty
    out. The partitions' edges are compared through a broadcast table of at most two rows a partition. The keys are made once and
    written to the shared folder, as the range partitioning reads them twice.
    """
    pick = cut(records.select(F.col("origin").cast("string").alias("origin"), F.col("key").cast("string").alias("key"), F.col("id").cast("bigint").alias("id")).dropna())
    by = ["origin", "key", "id"]
    ranged = pick.repartitionByRange(partitions, *by) if partitions else pick.repartitionByRange(*by)
    scanned = cut(ranged.sortWithinPartitions(*by).mapInArrow(_scan, SCANNED))
    heads = scanned.where("edge").groupBy("origin", "key").agg(F.min("first_id").alias("head_id"))
    joined = scanned.where("not edge").join(F.broadcast(heads), ["origin", "key"], "left")
    return joined.select("origin", "key", "id", F.coalesce("head_id", "first_id").alias("first_id"))


def _urls(spark: SparkSession, d: str) -> DataFrame:
    a = read_table(spark, d, "audio_items").select(F.lit("audio_items").alias("origin"), url_identity(F.col("audio_url")).alias("key"), F.col("item_id").alias("id"))
    return a.unionByName(read_table(spark, d, "source_records").select(F.lit("source_records").alias("origin"), url_identity(F.col("url")).alias("key"), F.col("record_id").alias("id")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return hidden_copies(_urls(spark, d)).where(F.col("id") != F.col("first_id")).select("origin", "first_id", F.col("id").alias("copy_id"))


def p5_records(spark: SparkSession, d: str) -> DataFrame:
    """One record per url, with the number of its copies (1: there is no other)."""
    return hidden_copies(_urls(spark, d)).groupBy("origin", "first_id").agg(F.count("*").alias("copies"))


_KEYED = f"""
WITH u AS (SELECT DISTINCT 'audio_items' AS origin, item_id AS id, {URL_IDENTITY_SQL.format(c="audio_url")} AS k FROM audio_items WHERE audio_url IS NOT NULL
 UNION SELECT 'source_records', record_id, {URL_IDENTITY_SQL.format(c="url")} FROM source_records WHERE url IS NOT NULL),
f AS (SELECT origin, id, min(id) OVER (PARTITION BY origin, k) AS first_id FROM u)
"""
SQL = {
    "p5_found": _KEYED + "SELECT origin, first_id, id AS copy_id FROM f WHERE id <> first_id",
    "p5_records": _KEYED + "SELECT origin, first_id, count(*) AS copies FROM f GROUP BY origin, first_id",
}
QUERIES = {"p5_found": p5_found, "p5_records": p5_records}
