"""Classification of dialogue samples, reports over it, and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.functions import exprs as E
from colloquy.operators.dedup import keep_first, with_copy_number


def classified(samples: DataFrame) -> DataFrame:
    """Adds ``reason``: dup, music, too_long or kept, in this order. ``samples``: sample_id, audio_url, dialogue_idx,
    duration_sec, episode_duration_sec, terms (arrays of tag terms). A null dialogue_idx counts as -1, a null url as ''."""
    keyed = samples.withColumn("__url", F.coalesce("audio_url", F.lit(""))).withColumn("__idx", F.coalesce("dialogue_idx", F.lit(-1)))
    marked = with_copy_number(keyed, ["__url", "__idx"], [F.col("sample_id")], "__dup").drop("__url", "__idx")
    reason = F.when(F.col("__dup"), "dup").when(E.is_music(F.col("terms")), "music").when(E.too_long(F.col("duration_sec"), F.col("episode_duration_sec")), "too_long").otherwise("kept")
    return marked.withColumn("reason", reason).drop("__dup")


def reason_report(classed: DataFrame) -> DataFrame:
    """Samples and ms by reason, and over all ('total')."""
    ms = F.coalesce(F.round(F.col("duration_sec") * 1000).cast("bigint"), F.lit(0))
    both = classed.select("reason", ms.alias("ms")).groupingSets([["reason"], []], "reason").agg(F.count("*").alias("samples"), F.sum("ms").alias("ms"), F.grouping_id().alias("__all"))
    return both.select(F.when(F.col("__all") == 1, "total").otherwise(F.col("reason")).alias("reason"), "samples", "ms")


def top_terms(classed: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` terms of most samples for each reason, each once a sample; ties by term."""
    terms = classed.select("reason", F.explode(E.sample_terms(F.col("terms"))).alias("term")).groupBy("reason", "term").agg(F.count("*").alias("samples"))
    rank = F.row_number().over(W.partitionBy("reason").orderBy(F.desc("samples"), "term"))
    return terms.withColumn("rank", rank).where(F.col("rank") <= k)


def manifest(samples: DataFrame) -> DataFrame:
    """Metadata rows of dialogues, named by their place in the episode; those without a url are left out."""
    names = {"lang": "language", "rss_url": "rss_url", "audio_url": "audio_url", "dialogue_idx": "dialogue_idx", "dlg_start": "episode_start_sec", "dlg_end": "episode_end_sec", "duration_sec": "duration_sec", "episode_duration_sec": "episode_duration_sec"}
    return samples.where(F.coalesce("audio_url", F.lit("")) != "").select(*[F.col(a).alias(b) for a, b in names.items()])


def write_manifest(rows: DataFrame, folder: str) -> None:
    """Gzipped JSON lines, one folder for each base language, files of the usual size: a language with most rows is split."""
    base = E.base_lang(F.col("language"))
    rows.withColumn("base_lang", base).hint("rebalance", "base_lang").write.partitionBy("base_lang").option("compression", "gzip").mode("overwrite").json(folder)


def write_manifest_part(rows: DataFrame, folder: str, part: int) -> None:
    """A part of the manifest, such as that of one run, as gzipped JSON lines; written again, it replaces itself."""
    rows.write.option("compression", "gzip").mode("overwrite").json(f"{folder}/part={part:05d}")


def read_manifest_parts(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows of all parts with the number of their ``part``. Raises where there is none."""
    return spark.read.schema(f"{schema}, part int").json(folder)


def reduce_manifest(parts: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of several parts, the first of equal ``keys`` by part, then ``order``, and one row with how many there were
    (``rows``), remain (``kept``) and were ``dropped``. Equal are keys themselves, not their hashes."""
    kept = keep_first(parts, keys, [F.col("part"), *map(F.col, order)])
    counts = parts.agg(F.count("*").alias("rows")).crossJoin(F.broadcast(kept.agg(F.count("*").alias("kept"))))  # one row each
    return kept, counts.withColumn("dropped", F.col("rows") - F.col("kept"))


def language_counts(rows: DataFrame) -> DataFrame:
    """Rows and ms by base language; null durations are 0."""
    ms = F.coalesce(F.round(F.col("duration_sec") * 1000).cast("bigint"), F.lit(0))
    return rows.groupBy(E.base_lang(F.col("language")).alias("base_lang")).agg(F.count("*").alias("n"), F.sum(ms).alias("ms"))
