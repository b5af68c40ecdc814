"""Reconstruction, metadata and partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import exprs as E
from colloquy.operators import reconstruct as R
from colloquy.plans.curation import _MAN, _norm, manifest_export
from colloquy.session import read_table


def stable_partition(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "episodes")
    return e.select("episode_key", R.stable_shard(F.col("audio_url"), 16).alias("shard"))


def episode_groups(spark: SparkSession, d: str) -> DataFrame:
    g = R.episode_groups(manifest_export(spark, d).where("dialogue_idx is not null"))
    return g.select("audio_url", F.size("dialogues").alias("n"), F.array_join(F.transform("dialogues", lambda x: x["dlg_key"]), ",").alias("keys"))


def clip_lengths(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "separation_tasks").where("dlg_wav is not null").select("task_id", "dlg_wav", "wav_rate", F.lit(1.5).cast("double").alias("s"), F.lit(61.3).cast("double").alias("e"))
    return R.clips(t, "task_id", "dlg_wav", "wav_rate", "s", "e").select("task_id", F.coalesce(F.size("clip"), F.lit(0)).alias("n")).distinct()


def sample_spans(spark: SparkSession, d: str) -> DataFrame:
    t = read_table(spark, d, "separation_tasks").where("dlg_start is not null").select("task_id", "dlg_start").distinct()
    return t.select("task_id", E.sample_index(F.col("dlg_start")).alias("first_sample"))


def device_index(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "separation_tasks").select("task_id", "device").distinct().select("task_id", E.gpu_index(F.col("device")).alias("gpu_id"))


def probe_coercion(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "episodes")
    probe = F.to_json(F.struct(F.struct(F.col("duration_sec").cast("string").alias("duration"), F.lit("64000").alias("bit_rate")).alias("format"), F.array(F.struct("sample_rate", F.col("bit_rate").cast("string").alias("bit_rate"))).alias("streams")))
    return e.select("episode_key", E.probe_info(probe).alias("p")).select("episode_key", "p.*")


def review_sample(spark: SparkSession, d: str) -> DataFrame:
    """The first 100 dialogues by key, for review by ear."""
    return read_table(spark, d, "separation_tasks").select("dlg_key").distinct().orderBy("dlg_key").limit(100)


SQL = {
    "episode_groups": f"WITH {_MAN}, k AS (SELECT audio_url, dialogue_idx, sha1({_norm('audio_url')}) || '_' || printf('%04d', dialogue_idx) AS dlg_key FROM man WHERE dialogue_idx IS NOT NULL) SELECT audio_url, CAST(count(*) AS INTEGER) AS n, string_agg(dlg_key, ',' ORDER BY dialogue_idx, dlg_key) AS keys FROM k GROUP BY 1",
    "clip_lengths": "SELECT DISTINCT task_id, greatest(0, least(len(dlg_wav), CAST(floor(61.3::DOUBLE * wav_rate) AS BIGINT)) - least(len(dlg_wav), CAST(floor(1.5::DOUBLE * wav_rate) AS BIGINT))) AS n FROM separation_tasks WHERE dlg_wav IS NOT NULL",
    "sample_spans": "SELECT DISTINCT task_id, CAST(trunc(dlg_start * 16000) AS BIGINT) AS first_sample FROM separation_tasks WHERE dlg_start IS NOT NULL",
    "device_index": "SELECT DISTINCT task_id, TRY_CAST(nullif(split_part(device, ':', 2), '') AS INTEGER) AS gpu_id FROM separation_tasks",
    "probe_coercion": "SELECT episode_key, coalesce(duration_sec, 0) AS duration, sample_rate, coalesce(bit_rate, 64000) AS bit_rate FROM episodes",
    "review_sample": "SELECT DISTINCT dlg_key FROM separation_tasks ORDER BY dlg_key LIMIT 100",
}
QUERIES = {f.__name__: f for f in (stable_partition, episode_groups, clip_lengths, sample_spans, device_index, probe_coercion, review_sample)}
