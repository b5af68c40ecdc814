from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from colloquy.functions import exprs as E
from colloquy.functions.keys import speaker_number, url_identity, usable_bounds


def values(spark, expression, inputs, kind="string"):
    df = spark.createDataFrame(list(enumerate(inputs)), f"i int, x {kind}")
    return [r.v for r in df.select("i", expression(F.col("x")).alias("v")).orderBy("i").collect()]


def test_languages(spark):
    assert values(spark, E.normalize_lang, ["EN", "ja_JP", None, " vi "]) == ["en", "ja-jp", "", "vi"]
    assert values(spark, lambda c: E.lang_matches(c, ["en", "JA", ""]), ["en", "en-us", "ja", "ja-jp", "fr", "english"]) == [True, True, True, True, False, False]
    assert values(spark, E.base_lang, ["ja-jp", "enm", "vi", "", None]) == ["ja", "en", "vi", "unknown", "unknown"]


def test_urls(spark):
    assert values(spark, E.normalize_url, ["HTTPS://Example.COM/Feed.xml#x", " http://u:P@H:80/a?B=C ", "http://h/a?", None]) == ["https://example.com/Feed.xml", "http://u:p@h:80/a?B=C", "http://h/a", None]
    urls = ["https://e.com/audio.mp3", "https://e.com/audio.m4a?token=abc", "https://e.com/audio.MP3", "https://e.com/page.html", "", None]
    assert values(spark, E.is_audio_url, urls) == [True, True, True, False, False, False]
    assert values(spark, E.watch_url, ["c", "https://x/y"]) == ["https://www.youtube.com/watch?v=c", "https://x/y"]
    assert values(spark, E.url_suffix, ["http://h/a/b.tar.gz?x.y", "http://h/a"]) == [".gz", ".bin"]
    assert values(spark, E.episode_key, ["http://H/é"]) == [hashlib.sha1("http://h/é".encode()).hexdigest()]


def test_keys(spark):
    assert values(spark, lambda c: E.dialogue_key(F.lit("k"), c), ["3", "12345", "x", None]) == ["k_0003", "k_12345", "k_0000", "k_0000"]
    assert values(spark, E.episode_of_dialogue, ["a_b_0001", "plain"]) == ["a_b", "plain"]
    assert values(spark, speaker_number, ["SPEAKER_03", "speaker #1", " Spk２ ", "１２", "", None, "nobody", "9" * 30]) == [3, 1, 2, 12, None, None, None, None]


def test_url_identity(spark):
    same = ["https://a.example/x-y/z.mp3?b=2&a=1", "HTTPS://A.example/x.y/z.mp3?a=1&b=2", "<https://a.example/x y/z.mp3?a=1;b=2>", "　https://a.example/xy//./z.mp3?b=2&a=1#"]
    keys = values(spark, url_identity, [*same, "https://a.example/xy/z2.mp3?a=1&b=2", None, "", "!?"])
    assert len(set(keys[:4])) == 1 and keys[4] not in keys[:4] and keys[5:] == [None, "", ""]


def test_music_terms(spark):
    meta = ['{"tags": [{"term": "Nhạc và karaoke"}]}', '{"tags": [{"term": "Popular science"}]}', '{"tags": null}', '{"tags": [{"term": ""}, 3, "x", null, {"term": 5}]}', '{"tags": [{"term": "po', None, '{"tags": [{"term": "r&b"}]}', '{"tags": [{"term": "talk"}]}']
    assert values(spark, lambda c: E.is_music(E.tag_terms(c)), meta) == [True, True, False, False, False, False, True, False]


def test_quality_and_too_long(spark):
    df = spark.createDataFrame([(0.0, 16000, 32000), (10800.0, 16000, 32000), (10800.5, 16000, 32000), (5.0, 15999, 32000), (5.0, 16000, 31999), (5.0, None, None), (None, 1, 1)], "d double, s int, b int")
    assert [r.v for r in df.select(E.quality_status(F.col("d"), F.col("s"), F.col("b")).alias("v")).collect()] == ["error", "ok", "skipped_duration", "skipped_low_quality", "skipped_low_quality", "ok", "error"]
    df = spark.createDataFrame([(1.0, 3.0), (0.9, 3.0), (None, 3.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    assert [r.v for r in df.select(E.too_long(F.col("a"), F.col("b")).alias("v")).collect()] == [True, False, False, False, False]


def test_means_and_status(spark):
    df = spark.createDataFrame([(0.91, 0.72), (None, 2.0), (float("nan"), 2.0), (None, float("inf"))], "a double, b double")
    got = [r.v for r in df.select(E.mean_of(F.col("a"), F.col("b")).alias("v")).collect()]
    assert got == [pytest.approx(0.815), 2.0, 2.0, None]
    df = spark.createDataFrame([(True, False), (True, True), (False, True)], "a boolean, b boolean")
    assert [r.v for r in df.select(E.metric_status(F.col("a"), F.col("b")).alias("v")).collect()] == ["ok", "partial", "unavailable"]


def test_text_forms(spark):
    assert values(spark, E.label_time, [0, 1250, 61_005], "bigint") == ["0.000", "1.250", "61.005"]
    assert values(spark, E.safe_name, ["a b/c", "._", "", "tệp-1.mp3"]) == ["a_b_c", "item", "item", "tệp-1.mp3"]
    got = values(spark, E.parse_turn, ["0.10 1.20 speaker_0", "1.5, 2.25, 7", "3 4", "x 1", ""])
    assert [tuple(x) if x else None for x in got] == [("speaker_0", 0.1, 1.2), ("7", 1.5, 2.25), ("SPEAKER_00", 3.0, 4.0), None, None]


def test_usable_bounds(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 1.0), (2.0, 1.0), (None, 1.0), (0.0, float("nan")), (0.0, float("inf"))], "a double, b double")
    assert [r.v for r in df.select(usable_bounds(F.col("a"), F.col("b")).alias("v")).collect()] == [True, False, False, False, False, False]
