"""Dialogue extraction and turn taking over the segments table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.functions.keys import SPEAKER_NUMBER_SQL, millis, speaker_number, usable_bounds
from colloquy.operators import sequence as S
from colloquy.operators.intervals import overlap_join, overlap_total, short_overlapping
from colloquy.operators.prefix import hot_from, join_hot
from colloquy.operators.sweep import covered_periods
from colloquy.session import cut, read_table

GAP, SHARE, LEAST, MOST, ENOUGH = 5_000, 0.8, 10_000, 120_000, 4


def turns(spark: SparkSession, d: str) -> DataFrame:
    """Usable turns with a speaker number, in ms; some come twice, which gap_groups() and unions don't mind."""
    seg = read_table(spark, d, "segments").where(usable_bounds(F.col("start_sec"), F.col("end_sec")))
    seg = seg.select("episode_key", F.col("seg_id").alias("turn_id"), speaker_number(F.col("speaker")).alias("speaker"), millis(F.col("start_sec")).alias("start_ms"), millis(F.col("end_sec")).alias("end_ms"))
    return seg.where("speaker is not null")


def gap_split(spark: SparkSession, d: str) -> DataFrame:
    return S.groups_of(S.gap_groups(turns(spark, d), GAP))


def two_speaker_runs(spark: SparkSession, d: str) -> DataFrame:
    return S.runs_of(S.two_speaker_scan(S.gap_groups(turns(spark, d), GAP), MOST))


def long_dialogue_chunks(spark: SparkSession, d: str) -> DataFrame:
    chunks = S.chunks_of(S.two_speaker_scan(S.gap_groups(turns(spark, d), GAP), MOST), LEAST, MOST)
    return chunks.select("episode_key", "group_no", "run_no", "chunk_no", "n_turns", "start_ms", "end_ms")


def speaker_balance(spark: SparkSession, d: str) -> DataFrame:
    t = turns(spark, d).distinct().groupBy("episode_key", "speaker").agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("ms"))
    t = t.groupBy("episode_key").agg(F.max("ms").alias("top_ms"), F.sum("ms").alias("total_ms"))
    return t.withColumn("balanced", S.is_balanced(F.col("top_ms"), F.col("total_ms"), SHARE))


def valid_dialogues(spark: SparkSession, d: str) -> DataFrame:
    return S.valid_dialogues(turns(spark, d), GAP, SHARE, LEAST, MOST)


def dialogues_of_rich_episodes(spark: SparkSession, d: str) -> DataFrame:
    return S.episodes_with(valid_dialogues(spark, d), ENOUGH)


def voice_activity(spark: SparkSession, d: str) -> DataFrame:
    t = turns(spark, d).select("episode_key", F.greatest("start_ms", F.lit(0)).alias("s"), F.greatest("end_ms", F.lit(0)).alias("e"))
    return covered_periods(t, ["episode_key"], "s", "e")


def interval_union(spark: SparkSession, d: str) -> DataFrame:
    return voice_activity(spark, d).select("episode_key", F.col("period_start").alias("start_ms"), F.col("period_end").alias("end_ms"))


def relabel_speakers(spark: SparkSession, d: str) -> DataFrame:
    return S.first_appearance(turns(spark, d).distinct())


def pack_chunks(spark: SparkSession, d: str) -> DataFrame:
    return S.pack_periods(voice_activity(spark, d), 60_000)


def tracks(spark: SparkSession, d: str) -> DataFrame:
    """The two leading speakers' tracks: continuous periods of speakers 0 and 1."""
    p = covered_periods(turns(spark, d).where("speaker in (0, 1)"), ["episode_key", "speaker"], "start_ms", "end_ms")
    return p.select("episode_key", "speaker", F.col("period_start").alias("start_ms"), F.col("period_end").alias("end_ms"))


def leading_tracks(spark: SparkSession, d: str) -> DataFrame:
    """As tracks(), of the two speakers with most turn time in an episode, whatever their numbers: 0 has most; of equal
    ones the lesser number comes first."""
    t = turns(spark, d).where("episode_key is not null").distinct().withColumn("__who", F.struct("episode_key", "speaker"))
    spoken = cut(t.groupBy("__who").agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("ms"), F.count("*").alias("n")))
    rank = F.row_number().over(W.partitionBy("__who.episode_key").orderBy(F.desc("ms"), "__who.speaker")) - 1  # over speakers
    two = spoken.select("__who", "n", rank.alias("track")).where("track < 2")
    hot = hot_from(spoken.agg(F.sum("n")).first()[0] or 0)
    p = covered_periods(join_hot(t.drop("speaker"), two, "__who", "n", hot).select("episode_key", F.col("track").alias("speaker"), "start_ms", "end_ms"), ["episode_key", "speaker"], "start_ms", "end_ms")
    return p.select("episode_key", "speaker", F.col("period_start").alias("start_ms"), F.col("period_end").alias("end_ms"))


def turn_exchanges(spark: SparkSession, d: str, t: DataFrame | None = None) -> DataFrame:
    return S.exchanges(t or tracks(spark, d)).groupBy("episode_key").agg(F.count("*").alias("exchanges"), F.count_if("overlaps").alias("overlapping"))


def overlap_duration(spark: SparkSession, d: str, t: DataFrame | None = None) -> DataFrame:
    t = t or cut(tracks(spark, d))
    return overlap_total(t.where("speaker = 0"), t.where("speaker = 1"), "episode_key")


def backchannels(spark: SparkSession, d: str, t: DataFrame | None = None) -> DataFrame:
    t = t or cut(tracks(spark, d))
    a, b = t.where("speaker = 0"), t.where("speaker = 1")
    return short_overlapping(a, b, "episode_key").withColumn("speaker", F.lit(0)).unionByName(short_overlapping(b, a, "episode_key").withColumn("speaker", F.lit(1)))


def turn_taking_stats(spark: SparkSession, d: str, t: DataFrame | None = None) -> DataFrame:
    """Per episode: exchanges and backchannels a minute, mean turn, share of simultaneous speech and of overlapping
    exchanges. The duration is the end of the last turn."""
    t = cut(t or tracks(spark, d))
    parts = [
        t.select("episode_key", F.lit(1).alias("n"), (F.col("end_ms") - F.col("start_ms")).alias("spoken"), F.col("end_ms").alias("duration")),
        S.exchanges(t).select("episode_key", F.lit(1).alias("exchanges"), F.col("overlaps").cast("int").alias("overlapping")),
        overlap_join(t.where("speaker = 0"), t.where("speaker = 1"), "episode_key").select("episode_key", (F.col("end") - F.col("start")).alias("overlap_ms")),
        backchannels(spark, d, t).select("episode_key", F.lit(1).alias("back")),
    ]
    columns = ["n", "spoken", "duration", "exchanges", "overlapping", "overlap_ms", "back"]
    whole = [p.select("episode_key", *[(F.col(c) if c in p.columns else F.lit(None)).cast("bigint").alias(c) for c in columns]) for p in parts]
    # one shuffle of partial sums instead of a join for each
    j = reduce(DataFrame.unionByName, whole).groupBy("episode_key").agg(*[F.coalesce((F.max if c == "duration" else F.sum)(c), F.lit(0)).alias(c) for c in columns])
    minutes = F.col("duration") / 60_000.0
    return j.select(
        "episode_key",
        (F.col("exchanges") / minutes).alias("exchanges_per_min"),
        (F.col("spoken") / F.col("n") / 1000.0).alias("mean_turn_sec"),
        (F.col("back") / minutes).alias("backchannels_per_min"),
        (F.col("overlap_ms") / F.col("duration") * 100.0).alias("simultaneous_pct"),
        F.when(F.col("exchanges") > 0, F.col("overlapping") / F.nullif(F.col("exchanges"), F.lit(0)) * 100.0).otherwise(0.0).alias("overlapping_pct"),
    )


def leading_turn_exchanges(spark: SparkSession, d: str) -> DataFrame:
    return turn_exchanges(spark, d, leading_tracks(spark, d))


def leading_overlap_duration(spark: SparkSession, d: str) -> DataFrame:
    return overlap_duration(spark, d, cut(leading_tracks(spark, d)))


def leading_backchannels(spark: SparkSession, d: str) -> DataFrame:
    return backchannels(spark, d, cut(leading_tracks(spark, d)))


def leading_turn_taking_stats(spark: SparkSession, d: str) -> DataFrame:
    return turn_taking_stats(spark, d, leading_tracks(spark, d))


_T = f"""
t AS MATERIALIZED (SELECT DISTINCT episode_key, seg_id AS turn_id, {SPEAKER_NUMBER_SQL.format(c="speaker")} AS speaker,
 CAST(round(start_sec * 1000) AS BIGINT) AS s, CAST(round(end_sec * 1000) AS BIGINT) AS e FROM segments
 WHERE end_sec > start_sec AND {SPEAKER_NUMBER_SQL.format(c="speaker")} IS NOT NULL AND episode_key IS NOT NULL)"""
_G = f"""
{_T},
l AS (SELECT *, lag(e) OVER (PARTITION BY episode_key ORDER BY s, turn_id) AS pe FROM t),
g AS MATERIALIZED (SELECT *, CAST(sum(CASE WHEN s - pe >= {GAP} THEN 1 ELSE 0 END) OVER (PARTITION BY episode_key ORDER BY s, turn_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS group_no FROM l)"""
_R = f"""
{_G},
k AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY episode_key, group_no ORDER BY s, turn_id) AS rn FROM g),
r AS (SELECT episode_key, group_no, rn, turn_id, speaker, s, e, speaker AS sa, CAST(NULL AS BIGINT) AS sb, 0 AS run_no, 0 AS chunk_no, s AS cf FROM k WHERE rn = 1
 UNION ALL
 SELECT k.episode_key, k.group_no, k.rn, k.turn_id, k.speaker, k.s, k.e,
  CASE WHEN third THEN k.speaker ELSE p.sa END, CASE WHEN third THEN NULL WHEN k.speaker <> p.sa AND p.sb IS NULL THEN k.speaker ELSE p.sb END,
  CASE WHEN third THEN p.run_no + 1 ELSE p.run_no END,
  CASE WHEN third THEN 0 WHEN p.e - p.cf >= {MOST} THEN p.chunk_no + 1 ELSE p.chunk_no END,
  CASE WHEN third THEN k.s WHEN p.e - p.cf >= {MOST} THEN p.e ELSE p.cf END
 FROM (SELECT r.*, k.speaker AS ns, (r.sb IS NOT NULL AND k.speaker <> r.sa AND k.speaker <> r.sb) AS third FROM r JOIN k ON k.episode_key = r.episode_key AND k.group_no = r.group_no AND k.rn = r.rn + 1) p
 JOIN k ON k.episode_key = p.episode_key AND k.group_no = p.group_no AND k.rn = p.rn + 1)"""
_C = f"""
{_R},
u AS (SELECT episode_key, group_no, run_no, min(s) AS rf, arg_max(e, (s, turn_id)) AS rt FROM r GROUP BY ALL HAVING count(DISTINCT speaker) = 2),
v AS (SELECT r.episode_key, r.group_no, r.run_no, CASE WHEN rt - rf > {MOST} THEN chunk_no ELSE 0 END AS chunk_no, CASE WHEN rt - rf > {MOST} THEN cf ELSE rf END AS start_ms, speaker, s, e, turn_id
 FROM r JOIN u USING (episode_key, group_no, run_no) WHERE rt - rf >= {LEAST}),
w AS (SELECT episode_key, group_no, run_no, chunk_no, start_ms, count(*) AS n_turns, arg_max(e, (s, turn_id)) AS end_ms FROM v GROUP BY ALL),
b AS (SELECT episode_key, group_no, run_no, chunk_no, max(ms) AS top, sum(ms) AS total FROM (SELECT episode_key, group_no, run_no, chunk_no, speaker, sum(e - s) AS ms FROM v GROUP BY ALL) GROUP BY ALL),
c AS (SELECT w.*, top, total FROM w JOIN b USING (episode_key, group_no, run_no, chunk_no) WHERE end_ms - start_ms >= {LEAST})"""
_V = f"""{_C},
d AS (SELECT episode_key, CAST(row_number() OVER (PARTITION BY episode_key ORDER BY group_no, run_no, chunk_no) - 1 AS BIGINT) AS dialogue_idx, group_no, run_no, chunk_no, n_turns, start_ms, end_ms
 FROM c WHERE total > 0 AND top / total <= {SHARE})"""
_PERIODS = """
m{x} AS (SELECT *, max(e) OVER (PARTITION BY {k} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM (SELECT DISTINCT {k}, s, e FROM {src})),
n{x} AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY {k} ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS part FROM m{x}),
p{x} AS MATERIALIZED (SELECT {k}, min(s) AS s, max(e) AS e FROM n{x} GROUP BY {k}, part)"""
_U = _T + "," + _PERIODS.format(x="u", k="episode_key", src="t")
_AB = _T + ", ab AS (SELECT * FROM t WHERE speaker IN (0, 1))," + _PERIODS.format(x="a", k="episode_key, speaker", src="ab")
_NUMBERED = "ab AS (SELECT * FROM t WHERE speaker IN (0, 1))"
_LEADING = """le AS (SELECT episode_key, speaker, CAST(row_number() OVER (PARTITION BY episode_key ORDER BY ms DESC, speaker) - 1 AS INTEGER) AS k FROM (SELECT episode_key, speaker, sum(e - s) AS ms FROM t GROUP BY 1, 2)),
ab AS (SELECT t.episode_key, t.turn_id, le.k AS speaker, t.s, t.e FROM t JOIN le ON le.episode_key = t.episode_key AND le.speaker = t.speaker WHERE k < 2)"""
_X = _AB + """,
x1 AS (SELECT *, lag(speaker) OVER w AS ps, lag(e) OVER w AS pe FROM pa WINDOW w AS (PARTITION BY episode_key ORDER BY s, e, speaker)),
ex AS (SELECT episode_key, count(*) AS exchanges, count(*) FILTER (s < pe) AS overlapping FROM x1 WHERE speaker <> ps GROUP BY 1),
ov AS (SELECT a.episode_key, CAST(sum(least(a.e, b.e) - greatest(a.s, b.s)) AS BIGINT) AS overlap_ms, count(*) AS n_pairs FROM pa a JOIN pa b ON a.episode_key = b.episode_key AND a.speaker = 0 AND b.speaker = 1 AND a.s < b.e AND b.s < a.e GROUP BY 1),
bc AS (SELECT episode_key, s AS start_ms, e AS end_ms, CAST(speaker AS INTEGER) AS speaker FROM pa a WHERE e - s BETWEEN 200 AND 1000 AND EXISTS (SELECT 1 FROM pa b WHERE b.episode_key = a.episode_key AND b.speaker <> a.speaker AND a.s < b.e AND b.s < a.e))"""

SQL = {
    "gap_split": f"WITH {_G} SELECT episode_key, group_no, count(*) AS n_turns, count(DISTINCT speaker) AS n_speakers, min(s) AS start_ms, arg_max(e, (s, turn_id)) AS end_ms FROM g GROUP BY 1, 2",
    "two_speaker_runs": f"WITH RECURSIVE {_R} SELECT episode_key, group_no, run_no, count(*) AS n_turns, CAST(min(CAST(speaker AS VARCHAR)) AS VARCHAR) AS speaker_a, max(CAST(speaker AS VARCHAR)) AS speaker_b, min(s) AS start_ms, arg_max(e, (s, turn_id)) AS end_ms FROM r GROUP BY 1, 2, 3 HAVING count(DISTINCT speaker) = 2",
    "long_dialogue_chunks": f"WITH RECURSIVE {_C} SELECT episode_key, group_no, run_no, chunk_no, n_turns, start_ms, end_ms FROM c",
    "speaker_balance": f"WITH {_T}, q AS (SELECT episode_key, speaker, CAST(sum(e - s) AS BIGINT) AS ms FROM t GROUP BY 1, 2) SELECT episode_key, max(ms) AS top_ms, CAST(sum(ms) AS BIGINT) AS total_ms, (sum(ms) > 0 AND max(ms) / sum(ms) <= {SHARE}) AS balanced FROM q GROUP BY 1",
    "valid_dialogues": f"WITH RECURSIVE {_V} SELECT * FROM d",
    "dialogues_of_rich_episodes": f"WITH RECURSIVE {_V} SELECT * FROM d WHERE episode_key IN (SELECT episode_key FROM d GROUP BY 1 HAVING count(*) >= {ENOUGH})",
    "interval_union": f"WITH {_U} SELECT episode_key, s AS start_ms, e AS end_ms FROM pu",
    "relabel_speakers": f"""WITH {_T}, f AS (SELECT episode_key, speaker, min((s, turn_id)) AS f, min(s) AS first_ms, count(*) AS n_turns FROM t GROUP BY 1, 2)
      SELECT episode_key, speaker, printf('SPEAKER_%02d', row_number() OVER (PARTITION BY episode_key ORDER BY f) - 1) AS label, first_ms, n_turns FROM f""",
    "pack_chunks": f"""WITH RECURSIVE {_U}, o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY episode_key ORDER BY s) AS rn FROM pu),
      z AS (SELECT episode_key, rn, s, e, s AS cs FROM o WHERE rn = 1 UNION ALL SELECT o.episode_key, o.rn, o.s, o.e, CASE WHEN o.e - z.cs > 60000 THEN o.s ELSE z.cs END FROM z JOIN o ON o.episode_key = z.episode_key AND o.rn = z.rn + 1)
      SELECT episode_key, cs AS chunk_start, max(e) AS chunk_end, count(*) AS n_periods FROM z GROUP BY 1, 2""",
    "turn_exchanges": f"WITH {_X} SELECT * FROM ex",
    "overlap_duration": f"WITH {_X} SELECT * FROM ov",
    "backchannels": f"WITH {_X} SELECT * FROM bc",
    "turn_taking_stats": f"""WITH {_X}, q AS (SELECT episode_key, count(*) AS n, CAST(sum(e - s) AS BIGINT) AS spoken, max(e) AS duration FROM pa GROUP BY 1), h AS (SELECT episode_key, count(*) AS back FROM bc GROUP BY 1)
      SELECT episode_key, coalesce(exchanges, 0) / (duration / 60000.0::DOUBLE) AS exchanges_per_min, spoken / n / 1000.0::DOUBLE AS mean_turn_sec, coalesce(back, 0) / (duration / 60000.0::DOUBLE) AS backchannels_per_min,
      coalesce(overlap_ms, 0) / duration * 100.0::DOUBLE AS simultaneous_pct, CASE WHEN coalesce(exchanges, 0) > 0 THEN overlapping / exchanges * 100.0::DOUBLE ELSE 0.0::DOUBLE END AS overlapping_pct
      FROM q LEFT JOIN ex USING (episode_key) LEFT JOIN ov USING (episode_key) LEFT JOIN h USING (episode_key)""",
}
SQL |= {f"leading_{n}": SQL[n].replace(_NUMBERED, _LEADING) for n in ("turn_exchanges", "overlap_duration", "backchannels", "turn_taking_stats")}
QUERIES = {f.__name__: f for f in (gap_split, two_speaker_runs, long_dialogue_chunks, speaker_balance, valid_dialogues, dialogues_of_rich_episodes, interval_union, relabel_speakers, pack_chunks, turn_exchanges, overlap_duration, backchannels, turn_taking_stats, leading_turn_exchanges, leading_overlap_duration, leading_backchannels, leading_turn_taking_stats)}
