from __future__ import annotations

import hashlib
import io
import tarfile

import pytest
from pyspark.sql import functions as F

from colloquy.functions import exprs as E
from colloquy.operators import reconstruct as R
from colloquy.sources.feeds import entry_audio
from colloquy.sources.fetch import fetch_entries, unpack_database


def test_stable_shard(spark):
    df = spark.createDataFrame([("HTTP://H/a#x",), (None,)], "u string")
    want = int.from_bytes(hashlib.blake2b(b"http://h/a", digest_size=8).digest(), "big") % 7
    assert [r.s for r in df.select(R.stable_shard(F.col("u"), 7).alias("s")).collect()] == [want, None]


def test_groups_leave_out_what_is_done(spark):
    m = spark.createDataFrame([("u", 1, 0.0, 1.0), ("u", 0, 2.0, 3.0), ("v", 0, 0.0, 1.0), (None, 0, 0.0, 1.0)], "audio_url string, dialogue_idx bigint, episode_start_sec double, episode_end_sec double")
    done = spark.createDataFrame([(hashlib.sha1(b"v").hexdigest() + "_0000",)], "dlg_key string")
    assert [(r.audio_url, [x.dialogue_idx for x in r.dialogues]) for r in R.episode_groups(m, done).collect()] == [("u", [0, 1])]
    assert sum(R.episode_groups(m, None, 3, i).count() for i in range(3)) == 2


def test_clips(spark):
    df = spark.createDataFrame([("a", [0.0, 1.0, 2.0, 3.0], 2, 0.6, 1.9), ("b", [0.0], 2, 1.0, 1.0), ("c", None, 2, 0.0, 1.0)], "id string, w array<float>, r int, s double, e double")
    got = {r.id: (r.clip, r.error) for r in R.clips(df, "id", "w", "r", "s", "e").collect()}
    assert got == {"a": ([1.0, 2.0], None), "b": (None, "empty span"), "c": (None, "empty span")}


def test_probe_and_device(spark):
    df = spark.createDataFrame([('{"format": {"duration": "x", "bit_rate": "9"}, "streams": [{"sample_rate": "16000"}]}', "cuda:1"), ("{}", "cpu")], "p string, d string")
    got = df.select(E.probe_info(F.col("p")).alias("p"), E.gpu_index(F.col("d")).alias("g")).collect()
    assert [(tuple(r.p), r.g) for r in got] == [((0.0, 16000, 9), 1), ((0.0, None, None), None)]


def test_fetch_contract(spark):
    def load():
        def fetch(url):
            if "bad" in url:
                raise OSError("403")
            return [{"title": "t", "enclosures": [{"href": url + "/a.mp3"}], "links": None, "media_content": None}]

        return fetch

    got = fetch_entries(spark.createDataFrame([("http://ok",), ("http://ok",), ("http://bad",), (None,)], "u string"), "u", load)
    assert {r.url: r.error for r in got.collect()} == {"http://ok": None, "http://bad": "OSError: 403"}
    entries = got.select("url", F.inline("entries"))
    assert [r.audio_url for r in entry_audio(entries).collect()] == ["http://ok/a.mp3"]


def test_unpack(tmp_path):
    def make(name):
        with tarfile.open(tmp_path / "x.tgz", "w:gz") as tar:
            info = tarfile.TarInfo(name)
            info.size = 2
            tar.addfile(info, io.BytesIO(b"db"))
        return str(tmp_path / "x.tgz")

    assert unpack_database(make("in/feeds.db"), str(tmp_path / "o")).endswith("o/in/feeds.db")
    with pytest.raises(ValueError, match="unsafe"):
        unpack_database(make("../../evil.db"), str(tmp_path / "o"))
    with pytest.raises(ValueError, match="no database"):
        unpack_database(make("note.txt"), str(tmp_path / "o"))
