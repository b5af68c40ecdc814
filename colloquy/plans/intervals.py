"""Problem 2: continuous periods per speaker and per episode, and the gaps between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions.keys import SPEAKER_NUMBER_SQL, millis, speaker_number, usable_bounds
from colloquy.operators.sweep import covered_periods, interval_gaps
from colloquy.session import read_table

KEYS = ["episode_key", "speaker_no"]


def spoken_and_dialogues(spark: SparkSession, d: str) -> DataFrame:
    """Usable segments under their speaker's number, and usable tasks under -1."""
    seg, task = read_table(spark, d, "segments"), read_table(spark, d, "separation_tasks")
    seg = seg.where(usable_bounds(F.col("start_sec"), F.col("end_sec"))).select("episode_key", speaker_number(F.col("speaker")).alias("speaker_no"), millis(F.col("start_sec")).alias("s"), millis(F.col("end_sec")).alias("e"))
    task = task.where(usable_bounds(F.col("dlg_start"), F.col("dlg_end"))).select("episode_key", F.lit(-1).cast("bigint").alias("speaker_no"), millis(F.col("dlg_start")).alias("s"), millis(F.col("dlg_end")).alias("e"))
    return seg.where(F.col("speaker_no").isNotNull()).unionByName(task)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return interval_gaps(spoken_and_dialogues(spark, d), KEYS, "s", "e").select(*KEYS, F.col("gap_start").alias("gap_start_ms"), F.col("gap_end").alias("gap_end_ms"))


def p2_periods(spark: SparkSession, d: str) -> DataFrame:
    return covered_periods(spoken_and_dialogues(spark, d), KEYS, "s", "e").select(*KEYS, F.col("period_start").alias("period_start_ms"), F.col("period_end").alias("period_end_ms"))


_BASE = f"""
WITH iv AS (
 SELECT episode_key, {SPEAKER_NUMBER_SQL.format(c="speaker")} AS speaker_no,
  CAST(round(start_sec * 1000) AS BIGINT) AS s, CAST(round(end_sec * 1000) AS BIGINT) AS e FROM segments WHERE end_sec > start_sec
 UNION ALL
 SELECT episode_key, -1, CAST(round(dlg_start * 1000) AS BIGINT), CAST(round(dlg_end * 1000) AS BIGINT)
 FROM separation_tasks WHERE dlg_end > dlg_start),
m AS (SELECT *, max(e) OVER (PARTITION BY episode_key, speaker_no ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
 FROM (SELECT DISTINCT * FROM iv) WHERE speaker_no IS NOT NULL AND episode_key IS NOT NULL)
"""
SQL = {
    "p2_found": _BASE + "SELECT episode_key, speaker_no, reach AS gap_start_ms, s AS gap_end_ms FROM m WHERE s > reach",
    "p2_periods": _BASE + """, n AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER
     (PARTITION BY episode_key, speaker_no ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM m)
     SELECT episode_key, speaker_no, min(s) AS period_start_ms, max(e) AS period_end_ms FROM n GROUP BY episode_key, speaker_no, g""",
}
QUERIES = {"p2_found": p2_found, "p2_periods": p2_periods}
