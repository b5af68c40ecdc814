"""Streaming operators, run over the tables as streams of what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions.keys import millis, speaker_number, usable_bounds
from colloquy.plans.dialogues import _R, GAP
from colloquy.plans.dialogues import SQL as DIALOGUES
from colloquy.streaming import turns as T


#: Within how long a row may come again; state holds the ids of that time.
REDELIVERED = "30 days"


def streaming_once(spark: SparkSession, d: str) -> DataFrame:
    rows = T.read_stream(spark, f"{d}/segments.parquet").select("seg_id", "episode_key", "emitted_at")
    return T.run_available(T.once(rows, ["seg_id"], "emitted_at", REDELIVERED)).select("seg_id", "episode_key")


def streaming_progress(spark: SparkSession, d: str) -> DataFrame:
    rows = T.read_stream(spark, f"{d}/events.parquet").select("user_id", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    return T.last_of(T.run_available(T.progress(rows, "user_id", "cents"), "update"), "user_id")


def _turns(spark: SparkSession, d: str) -> DataFrame:
    rows = T.read_stream(spark, f"{d}/segments.parquet").where(usable_bounds(F.col("start_sec"), F.col("end_sec")))
    rows = rows.select("episode_key", F.col("seg_id").alias("turn_id"), speaker_number(F.col("speaker")).cast("string").alias("speaker"), millis(F.col("start_sec")).alias("start_ms"), millis(F.col("end_sec")).alias("end_ms"), "emitted_at").where("speaker is not null")
    return T.once(rows, ["turn_id"], "emitted_at", REDELIVERED)


def streaming_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs that later turns closed; the last one of each episode stays open."""
    return T.run_available(T.dialogue_runs(_turns(spark, d), GAP)).drop("__batch")


def streaming_runs_to_end(spark: SparkSession, d: str) -> DataFrame:
    """All runs: each episode ends after what is there now."""
    turns = _turns(spark, d).select("episode_key", "turn_id", "speaker", "start_ms", "end_ms")
    return T.run_to_end(turns, lambda rows: T.dialogue_runs(rows, GAP), "episode_key").drop("__batch")


def streaming_cutoff(spark: SparkSession, d: str) -> DataFrame:
    rows = T.read_stream(spark, f"{d}/events.parquet").select("user_id", "event_id", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    return T.until_target(rows, "user_id", "event_id", "cents", 500_000)


SQL = {
    "streaming_once": "SELECT DISTINCT seg_id, episode_key FROM segments",
    "streaming_progress": "SELECT user_id, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS amount FROM events GROUP BY 1",
    "streaming_cutoff": "WITH m AS (SELECT user_id, event_id, CAST(round(value * 100) AS BIGINT) AS cents FROM events), c AS (SELECT *, coalesce(sum(cents) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM m) SELECT user_id, event_id, cents FROM c WHERE b < 500000",
    # the last run of an episode stays open
    "streaming_runs": f"""WITH RECURSIVE {_R}, q AS (SELECT episode_key, group_no, run_no, count(*) AS n_turns, min(CAST(speaker AS VARCHAR)) AS speaker_a, max(CAST(speaker AS VARCHAR)) AS speaker_b, min(s) AS start_ms, arg_max(e, (s, turn_id)) AS end_ms FROM r GROUP BY 1, 2, 3 HAVING count(DISTINCT speaker) = 2),
      z AS (SELECT episode_key, arg_max(group_no, (group_no, run_no)) AS group_no, arg_max(run_no, (group_no, run_no)) AS run_no FROM r GROUP BY 1)
      SELECT * FROM q WHERE NOT EXISTS (SELECT 1 FROM z WHERE z.episode_key = q.episode_key AND z.group_no = q.group_no AND z.run_no = q.run_no)""",
    "streaming_runs_to_end": DIALOGUES["two_speaker_runs"],
}
QUERIES = {f.__name__: f for f in (streaming_once, streaming_progress, streaming_runs, streaming_runs_to_end, streaming_cutoff)}
