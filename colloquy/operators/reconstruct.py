"""From a manifest back to clips: stable shards, episode groups, and clips of decoded waves."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions import exprs as E
from colloquy.operators.dedup import pending


def stable_shard(url: Column, shards: int) -> Column:
    """The shard of a normalized url: the first 8 bytes of its BLAKE2b, big-endian, modulo ``shards``. The same in every
    language; where that doesn't matter, xxhash64 needs no Python. Null stays null."""

    @F.pandas_udf("bigint")
    def of(urls: pd.Series) -> pd.Series:
        return urls.map(lambda u: None if u is None else int.from_bytes(hashlib.blake2b(u.encode("utf-8"), digest_size=8).digest(), "big") % shards)

    return of(E.normalize_url(url))


def episode_groups(manifest: DataFrame, done: DataFrame | None = None, shards: int = 1, index: int = 0) -> DataFrame:
    """Per ``audio_url`` (as it stands; rows without one are left out) the dialogues still to be made, in order of index:
    audio_url, dialogues (array of dlg_key, dialogue_idx, start, end). An episode's dialogues are bounded by its length."""
    rows = manifest.where(F.coalesce("audio_url", F.lit("")) != "").withColumn("dlg_key", E.dialogue_key(E.episode_key(F.col("audio_url")), F.col("dialogue_idx").cast("string")))
    if shards > 1:
        rows = rows.where(stable_shard(F.col("audio_url"), shards) == index)
    if done is not None:
        rows = pending(rows, done, "dlg_key")
    one = F.struct("dialogue_idx", "dlg_key", F.col("episode_start_sec").alias("start_sec"), F.col("episode_end_sec").alias("end_sec"))
    return rows.groupBy("audio_url").agg(F.array_sort(F.collect_list(one)).alias("dialogues"))


def clips(waves: DataFrame, key: str, wave: str, rate: str, start: str, end: str) -> DataFrame:
    """``key``, ``clip``, ``error``: the samples between two times, cut off, not rounded; an empty span is an error, not a
    failure."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, errors = [], []
            for samples, hz, s, e in zip(b.column("__wave"), *(b.column(c).to_pylist() for c in ("__rate", "__start", "__end")), strict=True):
                got = samples.values.to_numpy(zero_copy_only=False)[max(0, int(s * hz)) : max(0, int(e * hz))] if samples.is_valid and None not in (hz, s, e) else np.zeros(0, np.float32)
                out.append(got.astype(np.float32) if len(got) else None)
                errors.append(None if len(got) else "empty span")
            yield pa.record_batch([b.column("__key"), pa.array(out, pa.list_(pa.float32())), pa.array(errors, pa.string())], ["key", "clip", "error"])

    rows = waves.select(F.col(key).cast("string").alias("__key"), F.col(wave).alias("__wave"), F.col(rate).alias("__rate"), F.col(start).alias("__start"), F.col(end).alias("__end"))
    return rows.mapInArrow(run, "key string, clip array<float>, error string").withColumnRenamed("key", key)
