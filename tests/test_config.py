from __future__ import annotations

import json

import pytest

from colloquy import config as C


def test_precedence_and_unknown_names(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"dialogue": {"gap_seconds": 7, "min_dialogues": 2}, "spark": {"spark.x": "1"}}))
    c = C.load(str(path), ["gap_seconds=9", "target_hours=", "spark.y=2", "diarization=energy"])
    assert (c.gap_seconds, c.min_dialogues, c.target_hours, c.diarization) == (9, 2, None, "energy") and c.spark == {"spark.x": "1", "spark.y": "2"}
    assert json.loads(C.resolved(c))["gap_seconds"] == 9
    with pytest.raises(ValueError):
        C.load(None, ["nonsense=1"])


def test_phase(spark, data, tmp_path):
    from colloquy.__main__ import PHASES

    c = C.Config(data=data, output=str(tmp_path))
    for name in ("collect", "filter", "manifest"):
        for step in PHASES[name]:
            assert all(df.columns for df in step(spark, c).values())
    assert list((tmp_path / "manifest").glob("base_lang=*"))


def test_settings_that_change_nothing_are_refused(capsys):
    from colloquy.__main__ import main, unread

    for setting in ("nodes=3", "node=1"):
        with pytest.raises(SystemExit):
            main(["end2end", "--set", setting])
        assert setting.partition("=")[0] in capsys.readouterr().err
    c = C.load(None, ["gap_seconds=9", "diarization=other", "data=x", "spark.y=2", "nodes=2"])
    assert unread("diarize", c) == [] and unread("end2end", c) == ["nodes"]


def test_other_names_and_kinds():
    c = C.load(None, ["source.languages=vi, en", "audio.min_original_bitrate=64000", "dialogue_gap_seconds=7", "separation.backend=energy_separate", "episode_limit_per_feed=", "max_minutes=90"])
    assert (c.languages, c.min_bit_rate, c.gap_seconds, c.separation, c.episode_limit, c.max_minutes) == (["vi", "en"], 64_000, 7.0, "energy_separate", None, 90.0)
    for bad in ("writers=many", "writers=", "max_minutes=true"):
        with pytest.raises(ValueError):
            C.load(None, [bad])


def test_whole_flow_and_its_continuation(spark, data, tmp_path):
    from colloquy.__main__ import run
    from colloquy.sources.shards import read_shards

    c = C.Config(data=data, output=str(tmp_path), min_sample_rate=8_000, min_bit_rate=8_000, target_hours=0.5, writers=2, shard_bytes=200_000, diarization="energy_long", scorer="energy_windows")
    run(spark, "end2end", c)
    log = (tmp_path / "run_log.txt").read_text().splitlines()
    assert len(log) == 9 and all(x.endswith("\tok") for x in log)
    made = {r.key: r for r in read_shards(spark, str(tmp_path / "shards")).collect()}
    episodes = {json.loads(x)["episode_key"]: json.loads(x)["status"] for f in (tmp_path / "episodes").glob("*.json") for x in f.read_text().splitlines()}
    assert made and {json.loads(r.meta)["episode_key"] for r in made.values()} <= {k for k, v in episodes.items() if v == "ok"} and "skipped_target" in episodes.values()
    assert all(r.audio or json.loads(r.diarization_error)["error"] for r in made.values())
    assert (tmp_path / "stats_table.md").read_text().startswith("| reason |") and list((tmp_path / "manifest").glob("base_lang=*"))
    run(spark, "separate", c)
    assert read_shards(spark, str(tmp_path / "shards")).count() == len(made)
    run(spark, "reconstruct", c)
    assert read_shards(spark, str(tmp_path / "shards")).count() >= len(made)
    run(spark, "repair", C.Config(data=str(tmp_path / "shards"), output=str(tmp_path / "x")))
    assert read_shards(spark, str(tmp_path / "x" / "repaired")).count() >= len(made)
    with pytest.raises(ValueError, match="unknown backend"):
        run(spark, "separate", C.Config(data=data, output=str(tmp_path / "y"), separation="none"))
    assert "unknown backend" in (tmp_path / "y" / "run_log.txt").read_text()
