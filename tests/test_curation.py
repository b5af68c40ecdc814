from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from colloquy.operators import curate, dedup
from colloquy.operators.prefix import join_hot, running_before, with_previous
from colloquy.sources import feeds
from colloquy.sources.allowlist import read_allowlist
from colloquy.sources.labels import label_text, markdown_table, speaker_labels, write_labels


def test_ledgers(spark):
    ledger = spark.createDataFrame([("a", "ok", 1), ("b", "error", 1)], "k string, status string, at int")
    new = spark.createDataFrame([("a", "error", 2), ("c", "ok", 1), ("c", "late", 3)], "k string, status string, at int")
    assert {tuple(r) for r in dedup.upsert(ledger, new, "k", ["at"]).collect()} == {("a", "error", 2), ("b", "error", 1), ("c", "late", 3)}
    assert {tuple(r) for r in dedup.insert_missing(ledger, new, "k").collect()} == {("a", "ok", 1), ("b", "error", 1), ("c", "late", 3)}
    todo = spark.createDataFrame([("a",), ("b",), ("z",)], "k string")
    assert {r.k for r in dedup.pending(todo, ledger, "k", ("ok",)).collect()} == {"b", "z"}
    assert {r.k for r in dedup.pending(todo, ledger, "k").collect()} == {"z"}


def test_classification_order(spark):
    rows = [(1, "u", 0, 5.0, 100.0, ["jazz"]), (2, "u", 0, 5.0, 100.0, []), (3, "v", None, 50.0, 100.0, ["talk"]), (4, "w", 1, 5.0, 100.0, [" talk ", "talk", ""]), (5, None, -1, 5.0, 0.0, [])]
    df = spark.createDataFrame(rows, "sample_id int, audio_url string, dialogue_idx bigint, duration_sec double, episode_duration_sec double, terms array<string>")
    classed = curate.classified(df)
    assert {r.sample_id: r.reason for r in classed.collect()} == {1: "music", 2: "dup", 3: "too_long", 4: "kept", 5: "kept"}
    report = {r.reason: (r.samples, r.ms) for r in curate.reason_report(classed).collect()}
    assert report == {"music": (1, 5000), "dup": (1, 5000), "too_long": (1, 50000), "kept": (2, 10000), "total": (5, 70000)}
    assert [tuple(r) for r in curate.top_terms(classed).where("reason = 'kept'").collect()] == [("kept", "talk", 1, 1)]


def test_manifest_sink(spark, tmp_path):
    rows = spark.createDataFrame([("ja-JP", "u"), ("en-us", "v"), ("enm", "w"), (None, "x")], "language string, audio_url string").withColumn("duration_sec", F.lit(1.0))
    curate.write_manifest(rows, str(tmp_path / "m"))
    assert {p.name for p in (tmp_path / "m").glob("base_lang=*")} == {"base_lang=ja", "base_lang=en", "base_lang=unknown"}
    assert {r.base_lang: r.n for r in curate.language_counts(rows).collect()} == {"ja": 1, "en": 2, "unknown": 1}


def test_feed_table_inference():
    assert feeds.likeliest_feeds({"t": ["id"], "feeds": ["id", "feedUrl", "Language"]}) == ("feeds", "feedUrl", "Language")
    assert feeds.likeliest_feeds({"feeds": ["url", "lang"], "podcast_feeds": ["url", "lang"]})[0] == "podcast_feeds"
    with pytest.raises(ValueError):
        feeds.likeliest_feeds({"t": ["url"]})


def test_prioritized(spark):
    ddl = "url string, lang string, source_id string, priority int, pos bigint"
    v = spark.createDataFrame([("v1", "vi", "a", 0, 1), ("v2", "vi", "b", 5, 2)], ddl)
    f = spark.createDataFrame([("v1", "en", "c", 0, 1), ("f", "en", "d", 0, 2), ("", "en", "x", 0, 3)], ddl)
    a = spark.createDataFrame([("f", "ja", "e", 9, 1), ("g", "ja", "f", 0, 2)], ddl)
    assert {(r.url, r.block) for r in feeds.prioritized(v, f, a).collect()} == {("v1", 0), ("v2", 0), ("f", 1), ("g", 2)}


def test_entries(spark):
    link = "array<struct<rel string, href string>>"
    df = spark.createDataFrame([(1, [("http://h/a.mp3",), (None,)], [("enclosure", "http://h/b.ogg"), ("alternate", "http://h/c.mp3")], [("", "http://h/d.wav"), ("http://h/e.html", None)]), (2, None, None, None)], f"id int, enclosures array<struct<href string>>, links {link}, media_content array<struct<url string, href string>>")
    assert [(r.id, r.audio_url) for r in feeds.entry_audio(df).orderBy("audio_pos").collect()] == [(1, "http://h/a.mp3"), (1, "http://h/b.ogg"), (1, "http://h/d.wav")]
    videos = spark.createDataFrame([("p", k, u, d) for k, (u, d) in enumerate([("https://x/a", "1200"), ("https://x/b", "1500"), ("c", "1200"), ("d", "900")])], "p string, at int, url string, duration string").withColumn("cell", F.lit(0))
    assert [r.url for r in feeds.video_entries(videos, "p", "cell", ["at"], None, 3600).orderBy("at").collect()][2:] == ["https://www.youtube.com/watch?v=c"]
    assert feeds.video_entries(videos, "p", "cell", ["at"], 0, None).count() == 1


def test_allowlists(spark, tmp_path):
    lines = tmp_path / "a.jsonl"
    lines.write_text('# note\n{"source_id": "a", "url": "HTTPS://Example.com/feed.xml#x"}\n\n{"source_id": "b", "language": "VI-vn", "url": "https://example.com/feed.xml"}\n{"url": "https://e.com/2", "priority": 3, "source_type": "YouTube"}\n')
    got = {r.source_id: (r.url, r.language, r.priority, r.source_type) for r in read_allowlist(spark, str(lines)).collect()}
    assert got == {"a": ("https://example.com/feed.xml", "vi", 0, "rss"), "allowlist_5": ("https://e.com/2", "vi", 3, "youtube")}
    tree = tmp_path / "b.json"
    tree.write_text(json.dumps({"sources": [{"source_id": "s", "youtube": {"playlists": ["HTTPS://Youtube.com/playlist?list=abc#section", "https://youtube.com/playlist?list=abc"], "channels": "https://youtube.com/c", "videos": ["https://youtube.com/v"]}}]}))
    assert sorted(r.url for r in read_allowlist(spark, str(tree)).collect()) == ["https://youtube.com/c", "https://youtube.com/playlist?list=abc", "https://youtube.com/v"]
    assert read_allowlist(spark, str(tmp_path / "none.jsonl")).count() == 0


def test_labels(spark, tmp_path):
    t = spark.createDataFrame([("e", 0, "raw_a", 0, 1250), ("e", 1, "raw_b", 1500, 2000), ("e", 2, "raw_a", 2000, 3000), ("e", 3, "raw_a", 3000, 3000)], "episode_key string, turn_id int, speaker string, start_ms bigint, end_ms bigint")
    lines = speaker_labels(t)
    assert [r.line for r in lines.where("track = 'vad'").orderBy("start_ms").collect()] == ["0.000\t1.250\tspeech", "1.500\t3.000\tspeech"]
    assert lines.where("track = 'SPEAKER_00'").count() == 2 and lines.where("track = 'speakers'").count() == 3
    write_labels(lines, str(tmp_path / "l"))
    files = label_text(spark, str(tmp_path / "l"), "e")
    assert files["vad"] == "0.000\t1.250\tspeech\n1.500\t3.000\tspeech\n" and set(files) == {"vad", "speakers", "SPEAKER_00", "SPEAKER_01"}
    with pytest.raises(ValueError, match="more than 2"):
        markdown_table(spark.range(3), ["id"], 2)
    assert markdown_table(spark.createDataFrame([(1, None, 0.5)], "a int, b string, c double"), ["a", "b", "c"]).splitlines()[-1] == "| 1 |  | 0.5000 |"


def test_prefix_helpers(spark):
    df = spark.createDataFrame([("g", c, o, v) for c, o, v in [(0, 1, 5), (0, 2, 1), (1, 1, 7), (3, 1, 2)]], "g string, cell int, o int, v int")
    got = running_before(df, ["g"], "cell", [F.col("o")], F.col("v"), "b").orderBy("cell", "o").collect()
    assert [r.b for r in got] == [0, 5, 6, 13]
    prev = with_previous(df, ["g"], "cell", ["o"], ["v"], "p").orderBy("cell", "o").collect()
    assert [r.p and r.p.v for r in prev] == [None, 5, 1, 7]
    small = df.groupBy("cell").agg(F.count("*").alias("n"))
    assert join_hot(df, small, "cell", "n", 2).count() == 4
