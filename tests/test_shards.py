from __future__ import annotations

import gzip
import io
import tarfile

import numpy as np
import pytest

from colloquy.functions import waves
from colloquy.models import backend, register, run_stage
from colloquy.operators import metrics
from colloquy.sources import shards


def archive(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wb") as gz, tarfile.open(fileobj=gz, mode="w") as tar:
        for name, content in members:
            info = tarfile.TarInfo(name)
            info.size = len(content)
            tar.addfile(info, io.BytesIO(content))


def test_round_trip(spark, tmp_path):
    rows = [(f"k{i}", f'{{"i": {i}, "t": "tiếng"}}', bytes([i]) * 50 if i % 2 else None, None, None) for i in range(9)]
    df = spark.createDataFrame(rows, "key string, meta string, audio binary, diarization string, diarization_error string")
    shards.write_shards(df, str(tmp_path / "s"), writers=2, max_bytes=150)
    names = sorted(p.name for p in (tmp_path / "s").iterdir())
    assert names == [f"{n:06d}.tar.gz" for n in range(len(names))] and len(names) > 2
    got = shards.read_shards(spark, str(tmp_path / "s"), tolerant=False)
    assert sorted((r.key, r.meta, bytes(r.audio) if r.audio else None) for r in got.collect()) == [(a, b, c) for a, b, c, _, _ in rows]
    assert {r.audio for r in shards.read_shards(spark, str(tmp_path / "s"), "meta").collect()} == {None}
    shards.write_shards(df.limit(1), str(tmp_path / "s"))
    assert len(list((tmp_path / "s").iterdir())) == len(names) + 1


def test_grouping_and_faults(spark, tmp_path):
    archive(tmp_path / "in" / "a" / "0.tar.gz", [("x.meta.json", b"{}"), ("x.audio.mp3", b"1"), ("x.audio.mp3", b"2"), ("y.meta.json", b"{}"), ("x.meta.json", b"{}"), ("nodot", b"")])
    big = [(f"s{i}.{e}", np.random.default_rng(i).bytes(3_000)) for i in range(6) for e in ("meta.json", "audio.mp3")]
    archive(tmp_path / "in" / "b" / "1.tar.gz", big)
    whole = (tmp_path / "in" / "b" / "1.tar.gz").read_bytes()
    (tmp_path / "in" / "b" / "1.tar.gz").write_bytes(whole[: len(whole) // 2])
    got = shards.read_shards(spark, str(tmp_path / "in")).orderBy("path", "pos").collect()
    first = [r for r in got if r.path.endswith("0.tar.gz")]
    assert [r.key for r in first] == ["x", "y", "x"] and bytes(first[0].audio) == b"2"
    assert 0 < len([r for r in got if r.path.endswith("1.tar.gz")]) < 6
    report = {r.path.rsplit("/", 1)[1]: r for r in shards.repair_shards(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()}
    assert report["1.tar.gz"].truncated and not report["0.tar.gz"].truncated
    assert shards.read_shards(spark, str(tmp_path / "out"), tolerant=False).count() >= 4
    with pytest.raises(Exception, match="1.tar.gz"):
        shards.read_shards(spark, str(tmp_path / "in"), tolerant=False).collect()
    assert shards.read_shards(spark, str(tmp_path / "nothing")).count() == 0


def test_assemble(spark):
    df = spark.createDataFrame([("s", k, n, d) for k, (n, d) in enumerate([("a.x", "1"), ("a.y", "2"), ("a.x", "3"), ("b.x", "4"), ("a.x", "5")])], "s string, at int, name string, data string")
    got = shards.assemble(df, "s", "at", "name", "data").orderBy("run_no").collect()
    assert [(r.key, r.members) for r in got] == [("a", {"x": "3", "y": "2"}), ("b", {"x": "4"}), ("a", {"x": "5"})]


def test_waves():
    import wave

    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(8_000), w.writeframes(np.array([0, 16_384, -32_768], "<i2").tobytes())
    channels, rate = waves.decode_wav(out.getvalue())
    assert rate == 8_000 and channels.tolist() == [[0.0, 0.5, -1.0]] and waves.stereo(channels).shape == (2, 3)
    with pytest.raises(ValueError):
        waves.decode_wav(b"")
    a = np.vstack([np.sin(np.arange(100)), np.cos(np.arange(100) / 3)]).astype(np.float32)
    chunks = [a[:, :60], a[::-1, 40:]]
    assert np.abs(np.corrcoef(waves.stitch(chunks, 60, 20, 100)[0], a[0])[0, 1]) > 0.99
    assert waves.pair(np.ones(10), 10, np.ones(40), 20).shape == (2, 10)


def test_activity_of_two_speakers():
    t = np.zeros((2, 4_000), np.float32)
    t[0, :1000] = t[0, 2000:3000] = t[1, 800:1400] = t[1, 3000:3600] = 0.5
    assert metrics.active_stretches(t[0], 1_000) == [(0, 50), (100, 150)] and metrics.active_stretches(t[1], 1_000) == [(40, 70), (150, 180)]
    assert metrics.active_stretches(np.zeros(0, np.float32), 1_000) == [] == metrics.active_stretches(np.zeros(500, np.float32), 1_000)


def test_embeddings(spark):
    rows = [("g", [1.0, 0.0]), ("g", [0.0, 2.0]), ("g", [3.0, 3.0]), ("h", [1.0, 1.0]), ("g", None), ("g", [0.0, 0.0])]
    got = {r.g: (r.n, r.mean_cosine) for r in metrics.mean_pair_cosine(spark.createDataFrame(rows, "g string, v array<double>"), "g", "v").collect()}
    assert got["g"] == (3, pytest.approx(2**0.5 / 3)) and got["h"] == (1, None)
    e = spark.createDataFrame([(1, 0, "a", [1.0, 0.0]), (1, 0, "b", [0.0, 1.0]), (1, 1, "a", [0.1, 1.0]), (1, 1, "b", None), (1, 2, "c", [-1.0, 0.1])], "episode bigint, chunk bigint, speaker string, embedding array<double>")
    got = {(r.chunk, r.speaker): r.label for r in metrics.link_speakers(e).collect()}
    assert got == {(0, "a"): "SPEAKER_00", (0, "b"): "SPEAKER_01", (1, "a"): "SPEAKER_01", (1, "b"): "SPEAKER_UNK_02", (2, "c"): "SPEAKER_03"}


def test_model_stages(spark):
    df = spark.createDataFrame([("a", [0.0] * 50 + [0.9] * 50, 10), ("b", None, 10), ("c", [0.5], 0)], "id string, w array<float>, r int")
    for name in ("energy_diarize", "energy_separate", "energy_score", "energy_embed"):
        got = {r.id: r.error for r in run_stage(df, name, "id", "w", "r").collect()}
        assert got["a"] is None and got["b"] and got["c"]
    turns = run_stage(df, "energy", "id", "w", "r").where("id = 'a'").first().turns
    assert [(t.start, t.end) for t in turns] == [(5.0, 10.0)]
    with pytest.raises(ValueError):
        backend("none")
    with pytest.raises(ValueError):
        register("x", "none", lambda: None)
