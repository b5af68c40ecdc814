"""Sources and sinks over the tables: allowlists, entries, shards, labels, manifests, and the values of small functions."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import exprs as E
from colloquy.functions.keys import SPEAKER_NUMBER_SQL, speaker_number, usable_bounds
from colloquy.functions.waves import decode_wav, encode_wav
from colloquy.operators import curate as C
from colloquy.operators.reconstruct import stable_shard
from colloquy.plans.curation import _ITM, _MAN, _REC, _SMP, _norm, _path, items, manifest_export, records, samples
from colloquy.plans.dialogues import turns
from colloquy.plans.metrics import SQL as METRICS
from colloquy.session import checkpoint_dir, cut, read_table
from colloquy.sources import allowlist, labels
from colloquy.sources.feeds import entry_audio, source_entries
from colloquy.sources.shards import assemble, read_shards, repair_shards, write_shards


def _folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared one."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _typed(spark: SparkSession, d: str) -> DataFrame:
    """The records of known types, those without one among them."""
    kind = F.lower(F.trim("source_type"))
    return records(spark, d).withColumn("kind", kind).where(F.coalesce("kind", F.lit("rss")).isin(*allowlist.TYPES))


def _listed(rows: DataFrame) -> DataFrame:
    return rows.select("line_no", "source_type", "url", "language", "show_name", "priority")


def allowlist_lines(spark: SparkSession, d: str) -> DataFrame:
    """The source records written as lines of JSON, each at the line of its id (bigint, as ids are), and read as an allowlist."""
    line = F.to_json(F.struct("source_id", F.col("kind").alias("source_type"), "url", F.col("lang").alias("language"), "show_name", "license_notes", F.col("priority").cast("string").alias("priority")))
    return _listed(allowlist.parse_lines(_typed(spark, d).select((F.col("record_id") - 1).alias("at"), line.alias("line"))))


def allowlist_structured(spark: SparkSession, d: str) -> DataFrame:
    """The same as objects, videos under youtube.videos, feeds under rss.urls."""
    video = F.col("kind") == "youtube"
    source = F.struct(
        "source_id", F.col("lang").alias("language"), "show_name", "license_notes", "priority",
        F.when(video, F.struct(F.array("url").alias("videos"))).alias("youtube"),
        F.when(~F.coalesce(video, F.lit(False)), F.struct(F.array("url").alias("urls"))).alias("rss"),
    )
    texts = _typed(spark, d).where("url <> ''").select(F.to_json(F.struct(F.array(source).alias("sources"))).alias("value"), (F.col("record_id") - 1).alias("at"))
    return _listed(allowlist.parse_structured(texts))


def entry_audio_urls(spark: SparkSession, d: str) -> DataFrame:
    """Entries with the recording as an enclosure, the feed as a link and the recording again as media."""
    href = lambda c: F.array(F.struct(F.col(c).alias("href")))
    entries = items(spark, d).select("item_id", href("audio_url").alias("enclosures"), F.array(F.struct(F.lit("enclosure").alias("rel"), F.col("rss_url").alias("href"))).alias("links"), F.array(F.struct(F.lit(None).cast("string").alias("url"), F.col("audio_url").alias("href"))).alias("media_content"))
    return entry_audio(entries)


def source_items(spark: SparkSession, d: str) -> DataFrame:
    """Entries of sources by their type: items stand for entries, those of Vietnamese feeds for videos."""
    i = items(spark, d).where("rss_url is not null")
    kinds = i.groupBy(F.col("rss_url").alias("source_id")).agg(F.when(F.min(F.lower(F.trim("lang"))) == "vi", "YouTube").otherwise("rss").alias("kind"))
    entries = i.select(F.col("rss_url").alias("source_id"), F.col("audio_url").alias("url"), F.lit(600).alias("duration"), F.col("item_id").alias("pos"))
    return source_entries(kinds, entries, 20, 3_000.0)


def _waves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [encode_wav(w.values.to_numpy(zero_copy_only=False), hz) if w.is_valid and len(w.values) and hz else None for w, hz in zip(b.column("dlg_wav"), b.column("wav_rate").to_pylist(), strict=True)]
        yield pa.record_batch([b.column("key"), b.column("meta"), pa.array(found, pa.binary())], ["key", "meta", "audio"])


def _heard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [decode_wav(x) if x else None for x in b.column("audio").to_pylist()]
        peaks = [None if g is None else int(round(float(abs(g[0]).max()) * 32_768)) for g in got]
        yield pa.record_batch([b.column("key"), b.column("meta"), pa.array([None if g is None else g[0].shape[1] for g in got], pa.int64()), pa.array([None if g is None else g[1] for g in got], pa.int64()), pa.array(peaks, pa.int64())], ["key", "meta", "n", "rate", "peak"])


def _shards(spark: SparkSession, d: str) -> str:
    """The tasks as shards: waves as audio, 2 MB a shard."""
    tasks = read_table(spark, d, "separation_tasks").select("task_id", "dlg_key", "dialogue_idx", "wav_rate", "dlg_wav").dropDuplicates(["task_id"])
    meta = F.to_json(F.struct("task_id", "dialogue_idx", "dlg_key"))
    made = tasks.select(F.col("dlg_key").alias("key"), meta.alias("meta"), "dlg_wav", "wav_rate").mapInArrow(_waves, "key string, meta string, audio binary")
    folder = _folder(spark, "shards")
    write_shards(made, folder, writers=4, max_bytes=2_000_000)
    return folder


def shard_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Samples written to shards and read again, audio decoded."""
    back = read_shards(spark, _shards(spark, d)).select("key", "meta", "audio").mapInArrow(_heard, "key string, meta string, n bigint, rate bigint, peak bigint")
    return back.select("key", F.get_json_object("meta", "$.task_id").cast("bigint").alias("task_id"), "n", "rate", "peak")


def shard_metadata(spark: SparkSession, d: str) -> DataFrame:
    """The same shards, of which only metadata is read, strictly."""
    back = read_shards(spark, _shards(spark, d), content="meta", tolerant=False)
    return back.select("key", F.get_json_object("meta", "$.dialogue_idx").cast("int").alias("dialogue_idx"))


def member_assembly(spark: SparkSession, d: str) -> DataFrame:
    """The shards' members as rows, put together to samples again."""
    rows = read_shards(spark, _shards(spark, d), content="members")
    made = assemble(rows, "path", "pos", "name", "data")
    return made.select("key", F.array_join(F.map_keys("members"), ",").alias("extensions"))


def shard_repair(spark: SparkSession, d: str) -> DataFrame:
    """Whole shards rewritten: their members, and that none was cut off."""
    done = cut(repair_shards(spark, _shards(spark, d), _folder(spark, "repaired")))
    return done.agg(F.sum("n_files").alias("members"), F.count_if("truncated").alias("truncated"))


def label_sink(spark: SparkSession, d: str) -> DataFrame:
    """The label lines as they were written and read again."""
    folder = _folder(spark, "labels")
    labels.write_labels(labels.speaker_labels(turns(spark, d).distinct()), folder)
    return spark.read.parquet(folder).select("episode_key", "track", "line")


def manifest_parts(spark: SparkSession, d: str) -> DataFrame:
    """Two runs' parts of the manifest, the second with all of the first again, reduced to one."""
    rows = cut(manifest_export(spark, d))
    folder = _folder(spark, "parts")
    for part in range(2):
        C.write_manifest_part(rows, folder, part)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    kept, counts = C.reduce_manifest(C.read_manifest_parts(spark, folder, schema), ["audio_url", "dialogue_idx"], ["rss_url"])
    return kept.groupBy(E.base_lang(E.normalize_lang(F.col("language"))).alias("base_lang")).agg(F.count("*").alias("n")).crossJoin(F.broadcast(counts))  # one row


def raw_turns(spark: SparkSession, d: str) -> DataFrame:
    """Turns in the forms models give them in, by the last digit of their id: objects, lists, text, and objects of other
    names; read as one."""
    s = read_table(spark, d, "segments").where(usable_bounds(F.col("start_sec"), F.col("end_sec"))).select("seg_id", F.format_string("SPEAKER_%02d", F.coalesce(speaker_number(F.col("speaker")), F.lit(0))).alias("who"), "start_sec", "end_sec").distinct()
    a, z, kind = F.col("start_sec"), F.col("end_sec"), F.col("seg_id") % 4
    listed = F.concat(F.lit("["), a.cast("string"), F.lit(","), z.cast("string"), F.lit(',"'), F.col("who"), F.lit('"]'))
    raw = (
        F.when(kind == 0, F.to_json(F.struct(F.col("who").alias("speaker"), a.alias("start"), z.alias("end"))))
        .when(kind == 1, listed)
        .when(kind == 2, F.concat_ws(" ", a.cast("string"), z.cast("string"), F.col("who")))
        .otherwise(F.to_json(F.struct(F.col("who").alias("label"), a.alias("begin"), z.alias("end_time"))))
    )
    return s.select("seg_id", E.parse_raw_turn(raw).alias("t")).select("seg_id", "t.*")


def metadata_scalars(spark: SparkSession, d: str) -> DataFrame:
    """Small values of a sample's metadata."""
    s = samples(spark, d)
    ms = F.coalesce(F.round(F.col("duration_sec") * 1000).cast("bigint"), F.lit(0))
    return s.select(
        "sample_id", E.metadata_language(F.lit(None).cast("string"), F.col("lang")).alias("language"), E.short_key(F.col("episode_key")).alias("short_key"), E.hours_text(ms).alias("length"),
        E.counted_duration(F.col("duration_sec"), F.col("episode_duration_sec"), F.col("dialogue_idx").isNotNull()).alias("counted"), E.counted_duration(F.col("duration_sec"), F.col("episode_duration_sec")).alias("first_known"),
    )


def dialogue_metadata(spark: SparkSession, d: str) -> DataFrame:
    """The metadata of dialogues as JSON, and what is read from it."""
    t = read_table(spark, d, "separation_tasks").select("task_id", "dlg_start", "dlg_end", "dialogue_idx", "device", "episode_key").distinct()
    made = t.select("task_id", E.dialogue_meta("device", "dlg_start", "dlg_end", "dialogue_idx", "episode_key").alias("m"))
    get = lambda p, kind: F.get_json_object("m", p).cast(kind)
    return made.select("task_id", get("$.dialogue_idx", "int").alias("idx"), get("$.gpu_id", "int").alias("gpu_id"), get("$.dialogue_duration_sec", "double").alias("duration_sec"), get("$.episode_key", "string").alias("episode_key"))


def video_addresses(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "events").select("event_id", E.watch_url(F.col("event_id").cast("string")).alias("url"))


#: Texts with their shard of 16, by the definition of BLAKE2b.
KNOWN_SHARDS = [("a", 15), ("https://example.org/a.mp3", 14), ("Tiếng Việt", 15), ("日本語", 8), ("x" * 40, 14)]


def stable_values(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(t,) for t, _ in KNOWN_SHARDS], "text string").select("text", stable_shard(F.col("text"), 16).alias("shard"))


_TYPED = f"{_REC}, typ AS (SELECT *, lower(trim(source_type)) AS kind FROM rec), kno AS (SELECT *, coalesce(kind, 'rss') AS source_type_, {_norm('url')} AS u FROM typ WHERE coalesce(kind, 'rss') IN ('rss', 'youtube'))"
_LISTED = "SELECT CAST(record_id AS INTEGER) AS line_no, source_type_ AS source_type, u AS url, lower(coalesce(nullif(lang, ''), 'vi')) AS language, coalesce(show_name, '') AS show_name, coalesce(priority, 0) AS priority FROM {t} QUALIFY row_number() OVER (PARTITION BY u ORDER BY record_id) = 1"
_AUDIO = "regexp_matches(lower({p}), '\\.(" + "|".join(E.AUDIO_EXTENSIONS) + ")\\z')"
_MS = "CAST(coalesce(round(duration_sec * 1000), 0) AS BIGINT)"
SQL = {
    "allowlist_lines": f"WITH {_TYPED} {_LISTED.format(t='kno')}",
    "allowlist_structured": f"WITH {_TYPED}, ful AS (SELECT * FROM kno WHERE url <> '') {_LISTED.format(t='ful')}",
    "entry_audio_urls": f"""WITH {_ITM}, e AS (SELECT item_id, 0 AS k, audio_url AS u FROM itm UNION ALL SELECT item_id, 1, rss_url FROM itm UNION ALL SELECT item_id, 2, audio_url FROM itm)
      SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY k) - 1 AS INTEGER) AS audio_pos, u AS audio_url FROM e WHERE {_AUDIO.format(p=_path("u"))}""",
    "source_items": f"""WITH {_ITM}, i AS (SELECT *, CASE WHEN min(lower(trim(lang))) OVER (PARTITION BY rss_url) = 'vi' THEN 'youtube' ELSE 'rss' END AS kind FROM itm WHERE rss_url IS NOT NULL),
      v AS (SELECT *, row_number() OVER (PARTITION BY rss_url ORDER BY item_id) AS p FROM i WHERE kind = 'rss' OR coalesce(audio_url, '') <> '')
      SELECT rss_url AS source_id, kind, CASE WHEN kind = 'rss' OR regexp_matches(audio_url, '^https?://') THEN audio_url ELSE 'https://www.youtube.com/watch?v=' || audio_url END AS url, 600.0::DOUBLE AS duration, item_id AS pos FROM v
      WHERE (kind = 'youtube' AND p <= 5) OR (kind = 'rss' AND p <= 20 AND {_AUDIO.format(p=_path("audio_url"))})""",
    "shard_roundtrip": """SELECT dlg_key AS key, task_id, CASE WHEN len(dlg_wav) > 0 THEN CAST(len(dlg_wav) AS BIGINT) END AS n, CASE WHEN len(dlg_wav) > 0 THEN CAST(wav_rate AS BIGINT) END AS rate,
      CASE WHEN len(dlg_wav) > 0 THEN CAST(least(32767, round_even(list_max(list_transform(dlg_wav, lambda x: coalesce(abs(x), 0)))::DOUBLE * 32768, 0)) AS BIGINT) END AS peak
      FROM separation_tasks QUALIFY row_number() OVER (PARTITION BY task_id) = 1""",
    "shard_metadata": "SELECT DISTINCT dlg_key AS key, dialogue_idx FROM separation_tasks",
    "member_assembly": "SELECT DISTINCT dlg_key AS key, CASE WHEN len(dlg_wav) > 0 THEN 'audio.mp3,meta.json' ELSE 'meta.json' END AS extensions FROM separation_tasks",
    "shard_repair": "WITH t AS (SELECT DISTINCT dlg_key, len(dlg_wav) > 0 AS heard FROM separation_tasks) SELECT count(*) + count(*) FILTER (heard) AS members, CAST(0 AS BIGINT) AS truncated FROM t",
    "label_sink": METRICS["label_files"],
    "manifest_parts": f"""WITH {_MAN}, b AS (SELECT *, replace(lower(trim(coalesce(language, ''))), '_', '-') AS l FROM man)
      SELECT CASE WHEN l = '' THEN 'unknown' WHEN starts_with(l, 'ja') THEN 'ja' WHEN starts_with(l, 'en') THEN 'en' ELSE l END AS base_lang, count(*) AS n, 2 * (SELECT count(*) FROM man) AS rows, (SELECT count(*) FROM man) AS kept, (SELECT count(*) FROM man) AS dropped FROM b GROUP BY 1""",
    "raw_turns": f"SELECT DISTINCT seg_id, printf('SPEAKER_%02d', coalesce({SPEAKER_NUMBER_SQL.format(c='speaker')}, 0)) AS speaker, start_sec AS start, end_sec AS \"end\" FROM segments WHERE end_sec > start_sec",
    "metadata_scalars": f"""WITH {_SMP} SELECT sample_id, lower(coalesce(nullif(lang, ''), 'vi')) AS language, substr(episode_key, 1, 8) AS short_key,
      printf('%d:%02d:%02d', {_MS} // 3600000, ({_MS} // 1000) % 3600 // 60, ({_MS} // 1000) % 60) AS length, coalesce(CASE WHEN dialogue_idx IS NOT NULL THEN duration_sec ELSE episode_duration_sec END, 0) AS counted,
      coalesce(nullif(duration_sec, 0), nullif(episode_duration_sec, 0), 0) AS first_known FROM smp""",
    "dialogue_metadata": "SELECT DISTINCT task_id, dialogue_idx AS idx, TRY_CAST(nullif(split_part(device, ':', 2), '') AS INTEGER) AS gpu_id, dlg_end - dlg_start AS duration_sec, episode_key FROM separation_tasks",
    "video_addresses": "SELECT event_id, 'https://www.youtube.com/watch?v=' || event_id AS url FROM events",
    "stable_values": "SELECT * FROM (VALUES " + ", ".join(f"('{t}', CAST({n} AS BIGINT))" for t, n in KNOWN_SHARDS) + ") AS v(text, shard)",
}
QUERIES = {f.__name__: f for f in (allowlist_lines, allowlist_structured, entry_audio_urls, source_items, shard_roundtrip, shard_metadata, member_assembly, shard_repair, label_sink, manifest_parts, raw_turns, metadata_scalars, dialogue_metadata, video_addresses, stable_values)}
