"""Audio activity, channel metrics, embeddings and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import exprs as E
from colloquy.models import run_stage
from colloquy.operators import metrics as M
from colloquy.plans.dialogues import _AB, _LEADING, _NUMBERED, _U, leading_tracks, tracks, turns
from colloquy.session import read_table
from colloquy.sources.labels import speaker_labels


def _waves(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "separation_tasks").select("task_id", "wav_rate", "dlg_wav")


def activity_islands(spark: SparkSession, d: str) -> DataFrame:
    found = M.activity(_waves(spark, d), "task_id", "dlg_wav", "wav_rate").distinct()
    return found.select(F.col("task_id").cast("bigint").alias("task_id"), F.col("n").alias("stretches"), "frames")


def channel_metrics(spark: SparkSession, d: str, t: DataFrame | None = None) -> DataFrame:
    """Seconds spoken on either channel, null where there is none, their mean, and a status."""
    t = (t or tracks(spark, d)).groupBy("episode_key").agg(*[F.sum(F.when(F.col("speaker") == k, F.col("end_ms") - F.col("start_ms"))).alias(c) for k, c in ((0, "a"), (1, "b"))])
    e = read_table(spark, d, "episodes").select("episode_key", "bit_rate").join(t, "episode_key", "left")
    a, b = F.col("a") / 1000.0, F.col("b") / 1000.0
    return e.select("episode_key", a.alias("spoken_a"), b.alias("spoken_b"), E.mean_of(a, b).alias("spoken_mean"), E.metric_status(F.coalesce("a", "b").isNotNull(), F.col("bit_rate").isNull()).alias("metric_status"))


def benchmark_summary(spark: SparkSession, d: str, t: DataFrame | None = None) -> DataFrame:
    c = channel_metrics(spark, d, t).join(read_table(spark, d, "episodes").select("episode_key", F.round(F.col("duration_sec") * 1000).cast("bigint").alias("ms")), "episode_key")
    n, ok = F.count("*"), F.count_if(F.col("metric_status") == "ok")
    return c.agg(n.alias("samples"), F.sum(F.coalesce("ms", F.lit(0))).alias("ms"), ok.alias("ok"), F.count_if(F.col("metric_status") == "partial").alias("partial"), F.count_if(F.col("metric_status") == "unavailable").alias("unavailable"), F.when((n > 0) & (n == ok), "ok").otherwise("partial").alias("status"))


def leading_channel_metrics(spark: SparkSession, d: str) -> DataFrame:
    return channel_metrics(spark, d, leading_tracks(spark, d))


def leading_benchmark_summary(spark: SparkSession, d: str) -> DataFrame:
    return benchmark_summary(spark, d, leading_tracks(spark, d))


def embedding_consistency(spark: SparkSession, d: str) -> DataFrame:
    m = M.mean_pair_cosine(read_table(spark, d, "embeddings"), "label", "embedding")
    return m.select("label", "n", F.round("mean_cosine", 6).alias("mean_cosine"))


def embedding_distinctiveness(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "embeddings").select("vec_id", "embedding")
    pairs = e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other")), "vec_id")
    return pairs.select("vec_id", F.round(1 - M.cosine("embedding", "other"), 6).alias("distance"))


def speaker_linking(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "embeddings").select((F.col("vec_id") % 20).alias("episode"), F.floor(F.col("vec_id") / 100).cast("bigint").alias("chunk"), F.format_string("s%05d", "vec_id").alias("speaker"), "embedding")
    return M.link_speakers(e)


def label_files(spark: SparkSession, d: str) -> DataFrame:
    return speaker_labels(turns(spark, d).distinct()).select("episode_key", "track", "line")


def diarize_stage(spark: SparkSession, d: str) -> DataFrame:
    return run_stage(_waves(spark, d), "energy_diarize", "task_id", "dlg_wav", "wav_rate").select("task_id", F.size("turns").alias("n_turns"), "error")


def separate_stage(spark: SparkSession, d: str) -> DataFrame:
    return run_stage(_waves(spark, d), "energy_separate", "task_id", "dlg_wav", "wav_rate").select("task_id", F.size("left").alias("n_left"), F.size("right").alias("n_right"), "error")


def score_stage(spark: SparkSession, d: str) -> DataFrame:
    return run_stage(_waves(spark, d), "energy_score", "task_id", "dlg_wav", "wav_rate").select("task_id", F.col("metrics")["peak"].alias("peak"), "error")


_CH = f"""{_AB}, ch AS (SELECT episode_key, sum(CASE WHEN speaker = 0 THEN e - s END) AS a, sum(CASE WHEN speaker = 1 THEN e - s END) AS b FROM pa GROUP BY 1),
cm AS (SELECT episode_key, a / 1000.0::DOUBLE AS spoken_a, b / 1000.0::DOUBLE AS spoken_b, CASE WHEN a IS NULL THEN b / 1000.0::DOUBLE WHEN b IS NULL THEN a / 1000.0::DOUBLE ELSE (a / 1000.0::DOUBLE + b / 1000.0::DOUBLE) / 2 END AS spoken_mean,
 CASE WHEN coalesce(a, b) IS NULL THEN 'unavailable' WHEN bit_rate IS NULL THEN 'partial' ELSE 'ok' END AS metric_status, duration_sec FROM episodes LEFT JOIN ch USING (episode_key))"""
_LABEL = "({c} // 1000) || '.' || lpad(CAST({c} % 1000 AS VARCHAR), 3, '0')"
SQL = {
    "activity_islands": """WITH w AS (SELECT DISTINCT task_id, wav_rate, dlg_wav FROM separation_tasks WHERE dlg_wav IS NOT NULL AND wav_rate > 0),
      f AS (SELECT task_id, wav_rate, unnest(dlg_wav) AS x, generate_subscripts(dlg_wav, 1) AS i FROM w),
      r AS (SELECT task_id, wav_rate, i, sqrt(CAST(x AS DOUBLE) * CAST(x AS DOUBLE) + 1e-12) AS rms FROM f),
      q AS (SELECT task_id, quantile_cont(rms, 0.75) AS q, max(rms) AS m FROM r GROUP BY 1),
      a AS (SELECT r.task_id, wav_rate, i, rms > greatest(1e-4, q * 0.5, m * 0.05) AS act FROM r JOIN q USING (task_id) WHERE m > 1e-6),
      g AS (SELECT task_id, wav_rate, i, i - row_number() OVER (PARTITION BY task_id ORDER BY i) AS g FROM a WHERE act),
      l AS (SELECT task_id, wav_rate, min(i) - 1 AS s, max(i) AS e FROM g GROUP BY task_id, wav_rate, g HAVING (max(i) - min(i) + 1) / wav_rate >= 0.12::DOUBLE),
      m AS (SELECT *, s / wav_rate - lag(e) OVER (PARTITION BY task_id ORDER BY s) / wav_rate AS gap FROM l),
      n AS (SELECT *, sum(CASE WHEN gap <= 0.2::DOUBLE THEN 0 ELSE 1 END) OVER (PARTITION BY task_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS k FROM m),
      o AS (SELECT task_id, k, max(e) - min(s) AS frames FROM n GROUP BY 1, 2)
      SELECT w.task_id, count(k) AS stretches, CAST(coalesce(sum(frames), 0) AS BIGINT) AS frames FROM w LEFT JOIN o USING (task_id) GROUP BY 1""",
    "channel_metrics": f"WITH {_CH} SELECT episode_key, spoken_a, spoken_b, spoken_mean, metric_status FROM cm",
    "benchmark_summary": f"""WITH {_CH} SELECT count(*) AS samples, CAST(sum(coalesce(round(duration_sec * 1000), 0)) AS BIGINT) AS ms, count(*) FILTER (metric_status = 'ok') AS ok, count(*) FILTER (metric_status = 'partial') AS partial,
      count(*) FILTER (metric_status = 'unavailable') AS unavailable, CASE WHEN count(*) > 0 AND count(*) = count(*) FILTER (metric_status = 'ok') THEN 'ok' ELSE 'partial' END AS status FROM cm""",
    "embedding_consistency": """WITH p AS (SELECT a.label, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS c FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id),
      n AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1) SELECT n.label, n, round(avg(c), 6) AS mean_cosine FROM n LEFT JOIN p ON p.label = n.label GROUP BY n.label, n""",
    "embedding_distinctiveness": "SELECT a.vec_id, round(1 - list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS distance FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
    "label_files": f"""WITH {_U}, f AS (SELECT episode_key, speaker, min((s, turn_id)) AS f FROM t GROUP BY 1, 2),
      n AS (SELECT episode_key, speaker, printf('SPEAKER_%02d', row_number() OVER (PARTITION BY episode_key ORDER BY f) - 1) AS label FROM f),
      x AS (SELECT t.episode_key, label, {_LABEL.format(c="s")} || chr(9) || {_LABEL.format(c="e")} || chr(9) || label AS line FROM t JOIN n ON n.episode_key = t.episode_key AND n.speaker = t.speaker)
      SELECT episode_key, 'speakers' AS track, line FROM x UNION ALL SELECT episode_key, label, line FROM x
      UNION ALL SELECT episode_key, 'vad', {_LABEL.format(c="s")} || chr(9) || {_LABEL.format(c="e")} || chr(9) || 'speech' FROM pu""",
}
SQL |= {f"leading_{n}": SQL[n].replace(_NUMBERED, _LEADING) for n in ("channel_metrics", "benchmark_summary")}
#: Local speakers of two episodes, (episode, chunk, speaker, embedding, label): a voice comes again under
#: other names, one is between two, one can't be heard.
KNOWN_LINKS = [
    (1, 0, "a", [1.0, 0.0, 0.0], "SPEAKER_00"), (1, 0, "b", [0.0, 1.0, 0.0], "SPEAKER_01"), (1, 1, "a", [0.1, 0.9, 0.0], "SPEAKER_01"), (1, 1, "b", [0.9, 0.1, 0.1], "SPEAKER_00"), (1, 2, "a", None, "SPEAKER_UNK_02"),
    (1, 3, "a", [0.0, 0.1, 1.0], "SPEAKER_03"), (1, 4, "z", [0.5, 0.5, 0.5], "SPEAKER_04"), (2, 0, "a", [0.0, 0.0, 2.0], "SPEAKER_00"), (2, 1, "b", [0.0, 0.7, 0.7], "SPEAKER_00"), (2, 2, "c", [0.0, 1.0, 0.2], "SPEAKER_01"),
]


def known_links(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.createDataFrame([r[:4] for r in KNOWN_LINKS], "episode bigint, chunk bigint, speaker string, embedding array<float>")
    return M.link_speakers(rows)


SQL["known_links"] = "SELECT * FROM (VALUES " + ", ".join(f"(CAST({e} AS BIGINT), CAST({c} AS BIGINT), '{s}', '{label}')" for e, c, s, _, label in KNOWN_LINKS) + ") AS v(episode, chunk, speaker, label)"
_HEARD = "dlg_wav IS NOT NULL AND coalesce(wav_rate, 0) > 0"
SQL |= {
    "diarize_stage": f"""WITH i AS (SELECT task_id, stretches FROM ({SQL["activity_islands"]})) SELECT CAST(t.task_id AS VARCHAR) AS task_id, CASE WHEN {_HEARD} THEN CAST(coalesce(stretches, 0) AS INTEGER) END AS n_turns,
      CASE WHEN NOT ({_HEARD}) THEN 'ValueError: no wave' END AS error FROM separation_tasks t LEFT JOIN i ON i.task_id = t.task_id""",
    "separate_stage": f"SELECT CAST(task_id AS VARCHAR) AS task_id, CASE WHEN {_HEARD} THEN CAST(len(dlg_wav) AS INTEGER) END AS n_left, CASE WHEN {_HEARD} THEN CAST(len(dlg_wav) AS INTEGER) END AS n_right, CASE WHEN NOT ({_HEARD}) THEN 'ValueError: no wave' END AS error FROM separation_tasks",
    "score_stage": f"""SELECT CAST(task_id AS VARCHAR) AS task_id, CASE WHEN {_HEARD} THEN list_max(list_transform(dlg_wav, lambda x: abs(coalesce(x, 0))))::DOUBLE END AS peak,
      CASE WHEN NOT ({_HEARD}) THEN 'ValueError: no wave' WHEN len(dlg_wav) = 0 THEN 'ValueError: empty wave' END AS error FROM separation_tasks""",
}
QUERIES = {f.__name__: f for f in (activity_islands, channel_metrics, benchmark_summary, leading_channel_metrics, leading_benchmark_summary, embedding_consistency, embedding_distinctiveness, speaker_linking, known_links, label_files, diarize_stage, separate_stage, score_stage)}
