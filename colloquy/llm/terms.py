"""Frequency of every distinct term (problem 6).

Heavy-light aggregation. Terms that are common in a bounded sample are broadcast; each task counts these in local arrays
where the rows are read and sends one row per term it met. All other terms are summed within a task and shuffled. The two
tables are united. The sample decides only which way a term goes, never its count: both ways are exact.

Rows that repeat an id must not count twice, and only those cross the network: a pass over the ids alone finds the ids of
two rows or more and writes them into a Bloom filter of fixed size. Rows it knows nothing of are counted on the spot; the
others, with the few it takes for repeats wrongly, are made distinct by shuffle and counted then.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.repeats import Repeats, repeats
from colloquy.session import cut, read_table

#: Rows of the sample in which heavy terms are looked for, the least share of them that makes a term heavy, and so,
#: at most terms-per-item / share of them are broadcast.
SAMPLE_ROWS, HEAVY_SHARE, MOST_HEAVY = 20_000, 0.005, 4_096
#: Light terms a task holds before it passes their sums on.
MOST_LIGHT = 200_000
SPACE = re.compile(r"\s+")


def tag_terms(*documents: str | None) -> list[str]:
    """Terms, in lower case and with single spaces, of the objects in the ``tags`` lists of JSON objects, repeats kept.
    What is null, no valid JSON, no object, or has no list of tags gives none; so do tags that are no objects and terms
    that are no strings or blank."""
    out = []
    for text in documents:
        if not text or '"tags"' not in text and "\\" not in text:
            continue
        try:
            tags = json.loads(text)
        except (ValueError, RecursionError):
            continue
        tags = tags.get("tags") if isinstance(tags, dict) else None
        for tag in tags if isinstance(tags, list) else ():
            term = tag.get("term") if isinstance(tag, dict) else None
            if isinstance(term, str) and (term := SPACE.sub(" ", term).strip().lower()):
                # half a surrogate pair can be escaped in JSON, but isn't text
                out.append(term if term.isascii() else term.encode("utf-8", "replace").decode("utf-8"))
    return out


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of each row."""
    for b in batches:
        rows = zip(*(b.column(k).to_pylist() for k in range(2, b.num_columns)), strict=True)
        yield pa.record_batch([pa.array([t for row in rows for t in set(tag_terms(*row))], pa.string())], ["term"])


LIGHT, HEAVY, REPEATED = range(3)
COUNTED = pa.schema([("way", pa.int32()), ("term", pa.string()), ("occurrences", pa.int64()), ("items", pa.int64()), ("id", pa.int64()), ("digest", pa.binary()), ("terms", pa.list_(pa.string()))])


def _digest(row: tuple) -> bytes:
    h = hashlib.blake2b(digest_size=16)
    for text in row:
        h.update(b"-" if text is None else b"+%d " % len(text) + text.encode("utf-8", "surrogatepass"))
    return h.digest()


def count_terms(batches: Iterator[pa.RecordBatch], heavy: list[str], ids: Repeats) -> Iterator[pa.RecordBatch]:
    """Rows of id, hash of the id and fields, as rows of COUNTED: of heavy terms one each, of light ones one each time
    MOST_LIGHT of them are held, of rows whose id may repeat the row itself."""
    at = {t: k for k, t in enumerate(heavy)}
    occurrences, items = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    light, light_items = Counter(), Counter()

    def table(n: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in COUNTED], schema=COUNTED)

    def sums(way: int, terms: list[str], n: list[int], of: list[int]) -> pa.RecordBatch:
        return table(len(terms), way=pa.array([way] * len(terms), pa.int32()), term=pa.array(terms, pa.string()), occurrences=pa.array(n, pa.int64()), items=pa.array(of, pa.int64()))

    for b in batches:
        again = ids.may_repeat(b.column(1).to_numpy())
        held: tuple[list, list, list] = ([], [], [])
        for item, twice, *row in zip(b.column(0).to_pylist(), again.tolist(), *(b.column(k).to_pylist() for k in range(2, b.num_columns)), strict=True):
            terms = tag_terms(*row)
            if twice:
                if terms:
                    for column, value in zip(held, (item, _digest(tuple(row)), terms), strict=True):
                        column.append(value)
                continue
            for t, n in Counter(terms).items():
                if (k := at.get(t)) is None:
                    light[t] += n
                    light_items[t] += 1
                else:
                    occurrences[k] += n
                    items[k] += 1
        if held[0]:
            yield table(len(held[0]), way=pa.array([REPEATED] * len(held[0]), pa.int32()), id=pa.array(held[0], pa.int64()), digest=pa.array(held[1], pa.binary()), terms=pa.array(held[2], pa.list_(pa.string())))
        if len(light) >= MOST_LIGHT:
            yield sums(LIGHT, list(light), list(light.values()), [light_items[t] for t in light])
            light, light_items = Counter(), Counter()
    yield sums(LIGHT, list(light), list(light.values()), [light_items[t] for t in light])
    met = np.flatnonzero(occurrences)
    yield sums(HEAVY, [heavy[k] for k in met], occurrences[met].tolist(), items[met].tolist())


def term_counts(items: DataFrame, item_id: str, fields: list[str]) -> DataFrame:
    """``term``, ``occurrences``, ``items``: how often each tag term occurs in the JSON ``fields``, and in how many items."""
    return counted_terms(items, item_id, fields)[0]


def counted_terms(items: DataFrame, item_id: str, fields: list[str]) -> tuple[DataFrame, int]:
    """term_counts(), and the number of items.

    Rows with the same id are one item. Those that are equal in the fields, too, count once; those that differ each add
    their terms to the item. Rows with a null id are left out. Empty in, empty out. Columns other than those named are
    not read. JSON is parsed where it is read, once for each row and once more for the sample's.
    """
    spark = items.sparkSession
    key = F.col(item_id).cast("bigint")
    rows = items.where(F.col(item_id).isNotNull()).select(key.alias("id"), F.xxhash64(key).alias("h"), *[F.col(f).cast("string").alias(f"field_{k}") for k, f in enumerate(fields)])
    found = repeats(rows.select("id", "h"))
    sample = rows if found.rows <= SAMPLE_ROWS else rows.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(found.rows)) < SAMPLE_ROWS)
    seen = sample.mapInArrow(_terms, "term string").groupBy("term").count()
    least = max(2, int(HEAVY_SHARE * min(found.rows, SAMPLE_ROWS)))
    heavy = [r["term"] for r in seen.where(F.col("count") >= least).orderBy(F.desc("count"), "term").limit(MOST_HEAVY).collect()]
    shared = spark.sparkContext.broadcast((heavy, found))  # a filter of fixed size and at most MOST_HEAVY terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from count_terms(batches, *shared.value)

    # cut: the three ways read what was counted, so that rows are read and parsed once
    counted = cut(rows.mapInArrow(run, "way int, term string, occurrences bigint, items bigint, id bigint, digest binary, terms array<string>"))
    sums = lambda df: df.groupBy("term").agg(F.sum("occurrences").alias("occurrences"), F.sum("items").alias("items"))
    light, heavy_ = (sums(counted.where(F.col("way") == w)) for w in (LIGHT, HEAVY))
    distinct = counted.where(F.col("way") == REPEATED).groupBy("id", "digest").agg(F.first("terms").alias("terms"))
    pairs = distinct.select("id", F.explode("terms").alias("term")).groupBy("id", "term").agg(F.count("*").alias("occurrences"))
    again = pairs.groupBy("term").agg(F.sum("occurrences").alias("occurrences"), F.count("*").alias("items"))
    return sums(light.unionByName(heavy_).unionByName(again)), found.keys


def mark_terms(counts: DataFrame, n_items: int, rare_items: int = 2, common_share: float = 0.2) -> DataFrame:
    """Adds ``mark``: 'rare' (in at most ``rare_items`` items), 'common' (in more than ``common_share`` of ``n_items``),
    else null. A term that is both is 'rare'."""
    return counts.withColumn("mark", F.when(F.col("items") <= rare_items, "rare").when(F.col("items") > common_share * n_items, "common"))


def _marked(spark: SparkSession, d: str) -> DataFrame:
    return mark_terms(*counted_terms(read_table(spark, d, "audio_items"), "item_id", ["feed_meta", "entry_meta"]))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _marked(spark, d).where(F.col("mark").isNotNull()).select("term", "mark")


def p6_terms(spark: SparkSession, d: str) -> DataFrame:
    return _marked(spark, d)


_TERMS = r"""
WITH i AS (SELECT DISTINCT item_id, feed_meta, entry_meta FROM audio_items),
m AS (SELECT item_id, feed_meta AS j FROM i UNION ALL SELECT item_id, entry_meta FROM i),
v AS (SELECT item_id, CASE WHEN json_valid(j) THEN j END AS j FROM m),
g AS (SELECT item_id, unnest(CAST(CASE WHEN json_type(j, '$.tags') = 'ARRAY' THEN json_extract(j, '$.tags') END AS JSON[])) AS tag FROM v WHERE j IS NOT NULL),
t AS (SELECT item_id, lower(trim(regexp_replace(json_extract_string(tag, '$.term'), '[\s\p{Z}]+', ' ', 'g'))) AS term FROM g WHERE json_type(tag) = 'OBJECT' AND json_type(tag, '$.term') = 'VARCHAR'),
c AS (SELECT term, count(*) AS occurrences, count(DISTINCT item_id) AS items FROM t WHERE term <> '' GROUP BY term),
k AS (SELECT *, CASE WHEN items <= 2 THEN 'rare' WHEN items > 0.2 * (SELECT count(DISTINCT item_id) FROM audio_items) THEN 'common' END AS mark FROM c)
"""
SQL = {"p6_found": _TERMS + "SELECT term, mark FROM k WHERE mark IS NOT NULL", "p6_terms": _TERMS + "SELECT term, occurrences, items, mark FROM k"}
QUERIES = {"p6_found": p6_found, "p6_terms": p6_terms}
