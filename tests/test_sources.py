from __future__ import annotations

import sqlite3

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.functions import exprs as E
from colloquy.functions.waves import decode_wav, encode_wav, track_consistency, windowed_mean, windows
from colloquy.models import backend, long_diarization, packed, referenced_score, register
from colloquy.operators.curate import reduce_manifest
from colloquy.operators.dedup import with_copy_number
from colloquy.operators.metrics import linked_labels
from colloquy.plans.sources import QUERIES
from colloquy.session import read_table
from colloquy.sources.feeds import source_entries
from colloquy.sources.sqlite import feeds_of, read_sqlite, tables_of


def test_sqlite_feeds(spark, tmp_path):
    path = str(tmp_path / "f.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE notes (id INTEGER, text TEXT)")
        db.execute('CREATE TABLE "my feeds" (id INTEGER PRIMARY KEY, "Url" TEXT, Language TEXT)')
        db.executemany('INSERT INTO "my feeds" VALUES (?, ?, ?)', [(k * 3, f" http://x/{k} ", ["vi", "EN_us", "fr", None][k % 4]) for k in range(40)] + [(500, None, "vi"), (501, "", "vi")])
        db.execute("CREATE TABLE empty (url TEXT, lang TEXT)")
    assert list(tables_of(path)) == ["empty", "my feeds", "notes"]
    got = {(r.url, r.lang) for r in feeds_of(spark, path, ["vi", "en"]).collect()}
    assert got == {(f"http://x/{k}", "vi" if k % 4 == 0 else "en-us") for k in range(40) if k % 4 < 2}
    assert read_sqlite(spark, path, "my feeds", ["Url"], 7).count() == 42 and read_sqlite(spark, path, "empty", ["url"]).count() == 0


def test_sources_by_type(spark):
    sources = spark.createDataFrame([("v", "YouTube"), ("r", "rss")], "source_id string, kind string")
    entries = spark.createDataFrame([("v", f"id{k}", 100, k) for k in range(6)] + [("r", "http://x/a.mp3", None, 0), ("r", "http://x/a.html", None, 1), ("r", "http://x/b.mp3", None, 2)], "source_id string, url string, duration int, pos bigint")
    got = sorted((r.source_id, r.url) for r in source_entries(sources, entries, 2, 150.0).collect())
    assert got == [("r", "http://x/a.mp3"), ("v", "https://www.youtube.com/watch?v=id0"), ("v", "https://www.youtube.com/watch?v=id1")]
    other = spark.createDataFrame([("v", "tape")], "source_id string, kind string")
    with pytest.raises(Exception, match="unsupported source_type tape"):
        source_entries(other, entries, None, None).collect()


def test_waves_round_trip_and_windows():
    rng = np.random.default_rng(1)
    both = rng.uniform(-1, 1, (2, 500)).astype(np.float32)
    got, rate = decode_wav(encode_wav(both, 8_000))
    assert rate == 8_000 and np.abs(got - both).max() <= 1 / 32_768 and decode_wav(encode_wav(np.array([2.0, np.nan, -2.0]), 10))[0].tolist() == [[32_767 / 32_768, 0.0, -1.0]]
    assert windows(25, 1, 9, 1) == [(0, 9), (9, 18), (18, 25)] and windows(19, 2, 9, 1) == [(0, 18)] and windows(0, 2, 9, 1) == []
    assert windowed_mean(np.arange(20.0), 1, lambda w, r: {"a": w.mean(), "b": None if w[0] else 5.0}, 9, 1) == {"a": pytest.approx((4 + 13 + 18.5) / 3), "b": 5.0}
    assert windowed_mean(np.zeros(0), 1, lambda w, r: {"a": 1.0}) is None
    vectors = {0.0: [1, 0], 1.0: [0, 1], 2.0: [1, 1]}
    track = np.repeat([0.0, 1.0, 2.0], 20)
    assert track_consistency(track, 10, lambda w, r: vectors[w[0]]) == pytest.approx((0 + 2 * 2**-0.5) / 3)
    assert track_consistency(track[:15], 10, lambda w, r: [1.0]) == 1.0 and track_consistency(track[:5], 10, lambda w, r: [1.0]) is None


def test_long_diarization():
    assert packed([(0, 10), (11, 50), (55, 70), (75, 200)], 60) == [(0, 50), (55, 70), (75, 200)]
    tone = {"a": 0.2, "b": 0.9}

    def diarize():
        def run(wave, rate):
            if (wave == 0.5).any():
                raise ValueError("bad chunk")
            half = len(wave) // 2
            # local names say nothing across chunks
            first = wave[0]
            names = ("x", "y") if first == np.float32(tone["a"]) else ("y", "x")
            return ([{"speaker": names[0], "start": 0.0, "end": half / rate}, {"speaker": names[1], "start": half / rate, "end": len(wave) / rate}],)

        return run

    embed = lambda: lambda wave, rate: ([1.0, 0.0] if wave.mean() < 0.5 else [0.0, 1.0],)
    voice = lambda: lambda wave, rate: [(0.0, 4.0), (4.0, 8.0), (8.0, 10.0)]
    wave = np.repeat(np.array([tone["a"], tone["b"], tone["b"], tone["a"]], dtype=np.float32), 2_000)
    wave = np.r_[wave, np.full(2_000, 0.5, dtype=np.float32)]
    turns = long_diarization(voice, diarize, embed, max_chunk=4.0)()(wave, 1_000)[0]
    assert [(t["start"], t["end"], t["speaker"]) for t in turns] == [(0.0, 2.0, "SPEAKER_00"), (2.0, 4.0, "SPEAKER_01"), (4.0, 6.0, "SPEAKER_01"), (6.0, 8.0, "SPEAKER_00")]
    assert long_diarization(lambda: lambda w, r: [], diarize, embed)()(wave, 1_000) == ([],)
    broken = long_diarization(lambda: lambda w, r: 1 / 0, diarize, embed)()(wave[:4_000], 1_000)[0]
    assert [t["end"] for t in broken] == [2.0, 4.0]
    assert linked_labels([None, [1, 0], [0, 1], [], [1, 0.1]]) == ["SPEAKER_UNK_00", "SPEAKER_01", "SPEAKER_02", "SPEAKER_UNK_03", "SPEAKER_01"]


def test_backends_by_model_names():
    register("short", "embed", lambda: None, models=("maker/",))
    register("long", "embed", lambda: None, models=("maker/large-",))
    assert backend("Maker/Large-v2").models == ("maker/large-",) and backend("maker/x").models == ("maker/",)
    with pytest.raises(ValueError):
        backend("other/x")


def test_raw_turns_of_all_forms(spark):
    raw = ['{"speaker": "A", "begin": 1, "end_time": 2.5}', '{"start": 1}', '[1, 2, "B"]', "[1.5, 2]", "0.5 1.25 spk_2", "3, 4, 1", '"1 2 C"', "nothing", None, "[]", '{"start": "1", "end": "2", "label": 7}']
    df = spark.createDataFrame([(k, r) for k, r in enumerate(raw)], "k int, r string")
    got = {r.k: r.t and tuple(r.t) for r in df.select("k", E.parse_raw_turn(df.r).alias("t")).collect()}
    want = {0: ("A", 1.0, 2.5), 1: None, 2: ("B", 1.0, 2.0), 3: ("SPEAKER_00", 1.5, 2.0), 4: ("spk_2", 0.5, 1.25), 5: ("1", 3.0, 4.0), 6: ("C", 1.0, 2.0), 7: None, 8: None, 9: None, 10: ("7", 1.0, 2.0)}
    assert got == want


@pytest.mark.parametrize("least_hot", [50_000, 3])
def test_copies_of_a_hot_key(spark, monkeypatch, least_hot):
    from colloquy.operators import prefix

    monkeypatch.setattr(prefix, "LEAST_HOT", least_hot)
    rows = [(k, "" if k % 3 == 0 else f"u{k % 50}", -1 if k % 3 == 0 else None) for k in range(300)]
    df = spark.createDataFrame(rows, "id int, url string, idx int")
    got = {r.id: r.c for r in with_copy_number(df, ["url", "idx"], [df.id], "c").collect()}
    seen, want = set(), {}
    for k, u, i in rows:
        want[k] = (u, i) in seen
        seen.add((u, i))
    assert got == want


def test_manifest_of_several_parts(spark):
    rows = [(0, "a", 1, "x"), (1, "a", 1, "y"), (1, "a", 2, "y"), (2, None, 1, "z"), (1, None, 1, "y"), (0, "b", 1, "x")]
    kept, counts = reduce_manifest(spark.createDataFrame(rows, "part int, u string, i int, v string"), ["u", "i"], ["v"])
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(0, "a", 1, "x"), (1, "a", 2, "y"), (1, None, 1, "y"), (0, "b", 1, "x")], key=str)
    assert tuple(counts.first()) == (6, 4, 2)


def test_scores_against_a_reference():
    seen = []
    load = referenced_score(lambda: lambda w, r, hz: seen.append(r.tolist()) or {"d": float(np.abs(w - r).mean())}, np.array([0.5, 1.0]), 4)
    assert load()(np.array([0.5, 1.0, 0.5]), 4) == ([("d", 0.0)],) and seen == [[0.5, 1.0, 0.5]]
    assert len(load()(np.zeros(7), 8)) == 1 and len(seen[-1]) == 7
    with pytest.raises(ValueError):
        load()(np.zeros(0), 4)
    with pytest.raises(ValueError):
        referenced_score(lambda: None, np.zeros(0), 4)


def test_cached_downloads(tmp_path):
    from colloquy.sources.fetch import cached

    asked = []
    load = lambda url: asked.append(url) or b"content"
    path = cached("https://x.org/a/feeds.tgz?x=1", str(tmp_path / "c"), load)
    assert open(path, "rb").read() == b"content" and path.endswith("/feeds.tgz") and cached("https://x.org/a/feeds.tgz?x=1", str(tmp_path / "c"), load) == path and len(asked) == 1
    open(path, "wb").close()
    assert cached("https://x.org/a/feeds.tgz", str(tmp_path / "c"), load) == path and len(asked) == 2
    with pytest.raises(ValueError):
        cached("https://x.org/none", str(tmp_path / "c"), lambda url: b"")
    assert not (tmp_path / "c" / "none").exists()


def test_wave_files(spark, tmp_path):
    from colloquy import config as C
    from colloquy.__main__ import run
    from colloquy.sources.labels import label_text
    from colloquy.sources.shards import read_shards

    (tmp_path / "in").mkdir()
    loud, quiet = np.tile([0.9, -0.9], 400), np.zeros(400)
    (tmp_path / "in" / "Two talks.wav").write_bytes(encode_wav(np.r_[loud, quiet, quiet, loud * 0.5], 800))
    (tmp_path / "in" / "bad.wav").write_bytes(b"no wave")
    run(spark, "files", C.Config(data=str(tmp_path / "in"), output=str(tmp_path / "out"), writers=1))
    rows = {r.path.rpartition("/")[2]: r for r in spark.read.json(str(tmp_path / "out" / "file_manifest")).collect()}
    good = next(v for k, v in rows.items() if k.startswith("Two"))
    assert good.duration_sec == 3.0 and good.n_turns == 2 and rows["bad.wav"].error and rows["bad.wav"].n_turns == 0
    assert good.key.startswith("Two") and label_text(spark, str(tmp_path / "out" / "labels"), good.key)["vad"].count("speech") == 2
    sample = read_shards(spark, str(tmp_path / "out" / "shards")).collect()
    assert [s.key for s in sample] == [good.key] and decode_wav(sample[0].audio)[0].shape == (2, 2_400)


@pytest.mark.parametrize("name", ["allowlist_lines", "allowlist_structured"])
def test_allowlist_of_large_ids(spark, data, tmp_path, name):
    """Ids beyond those of an int give the same list, each record at the line of its id."""
    far = 10_000_000_000
    read_table(spark, data, "source_records").withColumn("record_id", F.col("record_id") + far).write.parquet(str(tmp_path / "source_records.parquet"))
    near, got = (sorted(map(tuple, QUERIES[name](spark, d).collect())) for d in (data, str(tmp_path)))
    assert near and got == [(at + far, *rest) for at, *rest in near]
