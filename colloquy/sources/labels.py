"""Label files, tables and JSON reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import exprs as E
from colloquy.operators.sequence import first_appearance
from colloquy.operators.sweep import covered_periods


def label_lines(rows: DataFrame, keep: list[str], label: str = "label") -> DataFrame:
    """``line``: start, end and label parted by tabs, three decimals; rows whose end isn't after the start are dropped.
    ``rows``: start_ms, end_ms."""
    line = F.concat_ws("\t", E.label_time(F.col("start_ms")), E.label_time(F.col("end_ms")), F.col(label))
    return rows.where("end_ms > start_ms").select(*keep, "start_ms", line.alias("line"))


def speaker_labels(turns: DataFrame) -> DataFrame:
    """Label lines of every episode: under ``track`` 'speakers' all turns, under each speaker's label its own, under 'vad'
    the time anyone speaks. Speakers are named by first appearance; starts before 0 count as 0 in 'vad'."""
    labels = first_appearance(turns).select("episode_key", "speaker", "label")
    named = turns.join(labels, ["episode_key", "speaker"])
    lines = label_lines(named, ["episode_key", "label"])
    vad = covered_periods(turns.where("end_ms > start_ms").select("episode_key", F.greatest("start_ms", F.lit(0)).alias("s"), F.greatest("end_ms", F.lit(0)).alias("e")), ["episode_key"], "s", "e")
    vad = label_lines(vad.select("episode_key", F.col("period_start").alias("start_ms"), F.col("period_end").alias("end_ms"), F.lit("speech").alias("label")), ["episode_key"])
    tracks = lines.select("episode_key", F.lit("speakers").alias("track"), "start_ms", "line").unionByName(lines.select("episode_key", F.col("label").alias("track"), "start_ms", "line"))
    return tracks.unionByName(vad.select("episode_key", F.lit("vad").alias("track"), "start_ms", "line"))


def write_labels(lines: DataFrame, folder: str) -> None:
    """Parquet sorted by episode, track and time within files of the usual size, so that an episode's lines are found by the
    files' statistics; as many files as the rows need, not one for each episode. label_text() has an episode's own files."""
    lines.select("episode_key", "track", "start_ms", "line").repartitionByRange("episode_key", "track", "start_ms").sortWithinPartitions("episode_key", "track", "start_ms", "line").write.mode("overwrite").parquet(folder)


def label_text(spark: SparkSession, folder: str, episode_key: str) -> dict[str, str]:
    """By track the label file of one episode, whose lines are few: a line each, a line end after the last."""
    rows = spark.read.parquet(folder).where(F.col("episode_key") == episode_key).orderBy("track", "start_ms", "line").collect()
    out: dict[str, str] = {}
    for r in rows:
        out[r["track"]] = out.get(r["track"], "") + r["line"] + "\n"
    return out


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, wherever the path leads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def markdown_table(rows: DataFrame, columns: list[str], limit: int = 1_000) -> str:
    """A table of a small report: null is empty, a float has four decimals. More than ``limit`` rows raise ValueError: a
    report that is read by eye isn't that long, and none is to be cut unseen."""
    shown = lambda v: "" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v)
    found = rows.select(*columns).limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"more than {limit} rows")
    body = ["| " + " | ".join(shown(r[c]) for c in columns) + " |" for r in found]
    return "\n".join(["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns), *body]) + "\n"


def write_reports(folder: str, **reports: DataFrame) -> None:
    """Each report as JSON lines in a folder of its name."""
    for name, df in reports.items():
        df.write.mode("overwrite").json(f"{folder}/{name}")
