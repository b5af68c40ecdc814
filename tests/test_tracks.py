from __future__ import annotations

from colloquy.plans import dialogues


def test_leading_speakers_have_any_number(spark, tmp_path):
    turns = [("e", 1, "SPEAKER_00", 0.0, 1.0), ("e", 2, "SPEAKER_04", 1.0, 9.0), ("e", 3, "SPEAKER_02", 8.5, 14.0), ("e", 4, "SPEAKER_04", 13.0, 20.0), ("e", 4, "SPEAKER_04", 13.0, 20.0), ("f", 5, "SPEAKER_03", 0.0, 2.0)]
    spark.createDataFrame(turns, "episode_key string, seg_id bigint, speaker string, start_sec double, end_sec double").write.parquet(f"{tmp_path}/segments.parquet")
    got = sorted(map(tuple, dialogues.leading_tracks(spark, str(tmp_path)).collect()))
    assert got == [("e", 0, 1_000, 9_000), ("e", 0, 13_000, 20_000), ("e", 1, 8_500, 14_000), ("f", 0, 0, 2_000)]
    assert [tuple(r) for r in dialogues.leading_turn_exchanges(spark, str(tmp_path)).collect()] == [("e", 2, 2)]
    assert dialogues.turn_exchanges(spark, str(tmp_path)).count() == 0
