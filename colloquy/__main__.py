"""python -m colloquy PHASE [--config FILE] [--set NAME=VALUE ...]: phases over the tables in ``data``, written to ``output``.

``end2end`` is the whole flow: sources; recordings of the languages wanted, good enough and up to the hours wanted; their dialogues; separation into shards; scores; curation; the manifest and the metrics. A second run over
the same output goes on: dialogues whose shards are there aren't separated again.
"""

from __future__ import annotations

import argparse
import sys
import time
from collections.abc import Iterator
from dataclasses import asdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy import config as C
from colloquy.functions import exprs as E
from colloquy.functions.waves import decode_wav, encode_wav, mono
from colloquy.models import run_stage
from colloquy.operators import curate, reconstruct, sequence
from colloquy.operators.dedup import keep_first, pending
from colloquy.plans import curation, dialogues, metrics
from colloquy.session import build_session, cut, read_table
from colloquy.sources.labels import markdown_table, speaker_labels, write_labels, write_reports, write_text
from colloquy.sources.shards import list_shards, read_shards, repair_shards, write_shards

def collect(spark: SparkSession, c: C.Config) -> dict[str, DataFrame]:
    sources = curation.source_priority_union(spark, c.data).where(E.lang_matches(E.normalize_lang(F.col("lang")), c.languages))
    return {"sources": sources, "source_stats": sources.groupBy("lang").agg(F.count("*").alias("n"))}


def chosen_episodes(spark: SparkSession, c: C.Config) -> DataFrame:
    """Episodes with their verdict; those with 'ok' are to be made: of recordings in the languages wanted, at most
    episode_limit a feed, good enough, and the first of them, by key, up to target_hours."""
    heard = curation.items(spark, c.data).where("audio_url is not null").select("item_id", "audio_url", "rss_url", E.normalize_lang(F.col("lang")).alias("lang"))
    heard = heard.where(E.lang_matches(F.col("lang"), c.languages))
    if c.episode_limit is not None:
        cell = F.floor(F.col("item_id") / 100_000)
        ranked = sequence.take_until(heard.withColumn("__cell", cell).withColumn("__one", F.lit(1)), ["rss_url"], "__cell", ["item_id"], "__one", c.episode_limit)
        heard = ranked.drop("__cell", "__one")
    episodes = read_table(spark, c.data, "episodes").join(heard.select("audio_url").distinct(), "audio_url", "left_semi")
    verdict = E.quality_status(F.col("duration_sec"), F.col("sample_rate"), F.col("bit_rate"), c.max_minutes * 60, c.min_sample_rate, c.min_bit_rate)
    judged = cut(episodes.select("episode_key", "audio_url", "duration_sec", verdict.alias("status")))
    ok = judged.where("status = 'ok'")
    if c.target_hours is not None:
        placed = ok.withColumn("__cell", F.substring("episode_key", 1, 2)).withColumn("__ms", F.round(F.col("duration_sec") * 1000).cast("bigint"))
        taken = sequence.take_until(placed, [], "__cell", ["episode_key"], "__ms", round(c.target_hours * 3_600_000)).select("episode_key")
        late = ok.join(taken, "episode_key", "left_anti").withColumn("status", F.lit("skipped_target"))
        ok = ok.join(taken, "episode_key", "left_semi").unionByName(late)
    return ok.unionByName(judged.where("status <> 'ok'"))


def choose(spark: SparkSession, c: C.Config) -> dict[str, DataFrame]:
    episodes = cut(chosen_episodes(spark, c))
    ms = F.round(F.col("duration_sec") * 1000).cast("bigint")
    return {"episodes": episodes, "episode_stats": episodes.groupBy("status").agg(F.count("*").alias("n"), F.sum(ms).alias("ms"))}


def _ok(spark: SparkSession, c: C.Config) -> DataFrame:
    """Keys of the episodes to be made: those that choose() wrote, or, where it didn't run, those it would choose."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{c.output}/episodes")
    there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    rows = spark.read.schema("episode_key string, status string").json(f"{c.output}/episodes") if there else chosen_episodes(spark, c)
    return rows.where("status = 'ok'").select("episode_key")


def segment(spark: SparkSession, c: C.Config) -> dict[str, DataFrame]:
    turns = dialogues.turns(spark, c.data).join(_ok(spark, c), "episode_key", "left_semi")
    found = sequence.valid_dialogues(turns, round(c.gap_seconds * 1000), c.max_speaker_share, round(c.min_dialogue_seconds * 1000), round(c.max_dialogue_seconds * 1000))
    write_labels(speaker_labels(turns.distinct()), f"{c.output}/labels")
    return {"dialogues": sequence.episodes_with(found, c.min_dialogues)}


def _tasks(spark: SparkSession, c: C.Config) -> DataFrame:
    """Dialogues to be separated, each once, of the episodes to be made."""
    tasks = keep_first(read_table(spark, c.data, "separation_tasks"), ["task_id"], [F.col("queued_at")])
    return tasks.join(_ok(spark, c), "episode_key", "left_semi")


def diarize(spark: SparkSession, c: C.Config) -> dict[str, DataFrame]:
    return {"turns": run_stage(_tasks(spark, c), c.diarization, "task_id", "dlg_wav", "wav_rate")}


def _stereo(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        made = [None if left is None else encode_wav(np.array([left, right], dtype=np.float32), rate) for left, right, rate in zip(b.column("left").to_pylist(), b.column("right").to_pylist(), b.column("wav_rate").to_pylist(), strict=True)]
        yield pa.record_batch([b.column("key"), b.column("meta"), pa.array(made, pa.binary()), b.column("diarization_error")], ["key", "meta", "audio", "diarization_error"])


def shard_samples(spark: SparkSession, c: C.Config, tasks: DataFrame, waves: tuple[str, str] = ("dlg_wav", "wav_rate")) -> DataFrame:
    """Samples to be written: both channels as audio, the metadata, and the error instead where there is one. Those already
    in the shards of the output are left out."""
    folder = f"{c.output}/shards"
    if list_shards(folder):
        tasks = pending(tasks, read_shards(spark, folder, content="meta").select(F.col("key").alias("dlg_key")), "dlg_key")
    parted = run_stage(tasks, c.separation, "dlg_key", *waves)
    meta = E.dialogue_meta("device", "dlg_start", "dlg_end", "dialogue_idx", "episode_key", "task_id")
    rows = parted.join(tasks.select("dlg_key", meta.alias("meta"), "wav_rate").dropDuplicates(["dlg_key"]), "dlg_key")
    error = F.when(F.col("error").isNotNull(), F.to_json(F.struct("error")))
    return rows.select(F.col("dlg_key").alias("key"), "meta", "left", "right", "wav_rate", error.alias("diarization_error")).mapInArrow(_stereo, "key string, meta string, audio binary, diarization_error string")


def separate(spark: SparkSession, c: C.Config) -> dict[str, DataFrame]:
    made = cut(shard_samples(spark, c, _tasks(spark, c)))
    write_shards(made, f"{c.output}/shards", writers=c.writers, max_bytes=c.shard_bytes)
    failed = made.where("diarization_error is not null").select("key", "diarization_error")
    return {"separation_stats": made.agg(F.count("*").alias("samples"), F.count_if(F.col("audio").isNull()).alias("without_audio")), "separation_errors": failed}


def rebuild(spark: SparkSession, c: C.Config) -> dict[str, DataFrame]:
    """From the manifest in the output back to shards: of each recording the dialogues not yet made are cut out of its wave,
    which is here that of a task of the recording, and separated."""
    schema = "language string, rss_url string, audio_url string, dialogue_idx int, episode_start_sec double, episode_end_sec double, duration_sec double, episode_duration_sec double"
    listed = spark.read.schema(schema).json(f"{c.output}/manifest").where("dialogue_idx is not null")
    groups = reconstruct.episode_groups(listed, shards=c.nodes, index=c.node)
    wanted = groups.select("audio_url", F.inline("dialogues")).withColumn("episode_key", E.episode_key(F.col("audio_url")))
    tasks = keep_first(read_table(spark, c.data, "separation_tasks"), ["task_id"], [F.col("queued_at")]).drop("dlg_key")
    found = tasks.join(wanted.select("episode_key", "dialogue_idx", "dlg_key"), ["episode_key", "dialogue_idx"])
    made = cut(shard_samples(spark, c, keep_first(found, ["dlg_key"], [F.col("task_id")])))
    write_shards(made, f"{c.output}/shards", writers=c.writers, max_bytes=c.shard_bytes)
    return {"rebuild_stats": made.agg(F.count("*").alias("samples"), F.count_if(F.col("diarization_error").isNotNull()).alias("errors"))}


def repair(spark: SparkSession, c: C.Config) -> dict[str, DataFrame]:
    return {"repaired": repair_shards(spark, c.data, f"{c.output}/repaired")}


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out, errors = [], []
        for content in b.column("content").to_pylist():
            try:
                channels, rate = decode_wav(content)
                out.append((mono(channels)[0], rate))
                errors.append(None)
            except ValueError as e:
                out.append((None, None))
                errors.append(str(e))
        yield pa.record_batch([b.column("path"), pa.array([w for w, _ in out], pa.list_(pa.float32())), pa.array([r for _, r in out], pa.int32()), pa.array(errors, pa.string())], ["path", "wave", "rate", "error"])


def files(spark: SparkSession, c: C.Config) -> dict[str, DataFrame]:
    """Wave files below ``data``, or one: turns and labels of each, its two tracks in a shard, and a row of a manifest. A file
    that can't be read is a row with its error."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").option("recursiveFileLookup", "true").load(c.data).select("path", "content")
    waves = cut(found.mapInArrow(_decoded, "path string, wave array<float>, rate int, error string").withColumn("key", F.concat_ws("_", E.safe_name(F.regexp_extract("path", "([^/]*?)[.][^.]*$", 1)), E.short_key(F.sha1("path")))))
    heard = run_stage(waves, c.diarization, "key", "wave", "rate")
    turns = heard.select(F.col("key").alias("episode_key"), F.posexplode("turns").alias("turn_id", "t")).select("episode_key", "turn_id", F.col("t.speaker").alias("speaker"), *[F.round(F.col(f"t.{x}") * 1000).cast("bigint").alias(f"{x}_ms") for x in ("start", "end")])
    turns = cut(turns)
    write_labels(speaker_labels(turns), f"{c.output}/labels")
    length = F.coalesce(F.size("wave") / F.col("rate"), F.lit(0.0))
    parted = run_stage(waves.where("error is null"), c.separation, "key", "wave", "rate").drop("error")
    meta = F.to_json(F.struct("path", length.alias("duration_sec")))
    rows = parted.join(waves.select("key", meta.alias("meta"), F.col("rate").alias("wav_rate")), "key").withColumn("diarization_error", F.lit(None).cast("string"))
    write_shards(rows.select("key", "meta", "left", "right", "wav_rate", "diarization_error").mapInArrow(_stereo, "key string, meta string, audio binary, diarization_error string"), f"{c.output}/shards", writers=c.writers, max_bytes=c.shard_bytes)
    spoken = turns.groupBy(F.col("episode_key").alias("key")).agg(F.count("*").alias("n_turns"), F.count_distinct("speaker").alias("n_speakers"), F.max("end_ms").alias("last_ms"))
    return {"file_manifest": waves.select("key", "path", length.alias("duration_sec"), "error").join(spoken, "key", "left").fillna(0, ["n_turns", "n_speakers"])}


def score(spark: SparkSession, c: C.Config) -> dict[str, DataFrame]:
    return {"scores": run_stage(_tasks(spark, c), c.scorer, "task_id", "dlg_wav", "wav_rate")}


def curate_phase(spark: SparkSession, c: C.Config) -> dict[str, DataFrame]:
    classed = cut(curate.classified(curation.samples(spark, c.data)))
    report = curate.reason_report(classed)
    write_text(spark, f"{c.output}/stats_table.md", markdown_table(report.orderBy("reason"), ["reason", "samples", "ms"]))
    return {"report": report, "top_terms": curate.top_terms(classed), "kept": classed.where("reason = 'kept'").drop("terms")}


def manifest(spark: SparkSession, c: C.Config) -> dict[str, DataFrame]:
    rows = curation.manifest_export(spark, c.data)
    curate.write_manifest(rows, f"{c.output}/manifest")
    return {"manifest_counts": curate.language_counts(rows)}


def benchmark(spark: SparkSession, c: C.Config) -> dict[str, DataFrame]:
    return {"metrics": metrics.leading_channel_metrics(spark, c.data), "summary": metrics.leading_benchmark_summary(spark, c.data), "turn_taking": dialogues.leading_turn_taking_stats(spark, c.data)}


PHASES = {
    "collect": [collect], "choose": [choose], "segment": [segment], "diarize": [diarize], "separate": [separate], "score": [score], "filter": [curate_phase], "manifest": [manifest], "benchmark": [benchmark],
    "reconstruct": [rebuild], "files": [files], "repair": [repair], "end2end": [collect, choose, segment, diarize, separate, score, curate_phase, manifest, benchmark],
}

#: Settings that a step reads besides data, output and spark.
CHOICE = {"languages", "episode_limit", "target_hours", "max_minutes", "min_sample_rate", "min_bit_rate"}
READS = {
    collect: {"languages"}, choose: CHOICE, segment: CHOICE | {"gap_seconds", "max_speaker_share", "min_dialogue_seconds", "max_dialogue_seconds", "min_dialogues"}, diarize: CHOICE | {"diarization"}, score: CHOICE | {"scorer"},
    files: {"diarization", "separation", "shard_bytes", "writers"}, separate: CHOICE | {"separation", "shard_bytes", "writers"}, rebuild: {"separation", "shard_bytes", "writers", "nodes", "node"},
}


def unread(phase: str, c: C.Config) -> list[str]:
    """Settings that differ from their defaults but change nothing: of end2end those that none of its steps reads, of a
    phase alone those that no phase reads, so that phases can share a file."""
    steps = PHASES[phase] if phase == "end2end" else READS
    read = {"data", "output", "spark"}.union(*(READS.get(s, set()) for s in steps))
    given, usual = asdict(c), asdict(C.Config())
    return [k for k, v in given.items() if k not in read and v != usual[k]]


def run(spark: SparkSession, phase: str, c: C.Config) -> None:
    """The phase's steps, their reports, the settings, and a log of the steps with their seconds, errors included."""
    log: list[tuple[str, str, float]] = []
    write_text(spark, f"{c.output}/resolved_config.json", C.resolved(c))
    try:
        for step in PHASES[phase]:
            began = time.time()
            try:
                write_reports(c.output, **step(spark, c))
                log.append((step.__name__, "ok", time.time() - began))
            except Exception as e:
                log.append((step.__name__, f"{type(e).__name__}: {e}".splitlines()[0], time.time() - began))
                raise
    finally:
        write_text(spark, f"{c.output}/run_log.txt", "".join(f"{name}\t{sec:.1f}\t{status}\n" for name, status, sec in log))


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="colloquy", description=__doc__)
    parser.add_argument("phase", choices=sorted(PHASES))
    parser.add_argument("--config")
    parser.add_argument("--set", action="append", default=[], metavar="NAME=VALUE")
    given = parser.parse_args(args)
    c = C.load(given.config, given.set)
    if ignored := unread(given.phase, c):
        parser.error(f"{given.phase} doesn't read {', '.join(ignored)}")
    run(build_session("colloquy", None, **c.spark), given.phase, c)
    return 0


if __name__ == "__main__":
    sys.exit(main())
