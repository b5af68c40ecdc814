from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from colloquy.operators import sequence as S

DDL = "episode_key string, turn_id bigint, speaker string, start_ms bigint, end_ms bigint"


def turns(spark, spec, episode="e"):
    """spec: 'A 0-10, B 13-20' in seconds."""
    rows = []
    for k, part in enumerate(filter(None, spec.split(", "))):
        who, span = part.split()
        a, b = span.split("-")
        rows.append((episode, k, who, int(float(a) * 1000), int(float(b) * 1000)))
    return spark.createDataFrame(rows, DDL)


@pytest.mark.parametrize(
    ("spec", "want"),
    [
        ("", []),
        ("A 0-10", [(0, 10)]),
        ("A 0-10, B 13-20", [(0, 20)]),
        ("A 0-10, B 15-20", [(0, 10), (15, 20)]),
        ("A 0-10, B 20-30", [(0, 10), (20, 30)]),
        ("A 0-5, B 6-10, A 20-25, B 26-30", [(0, 10), (20, 30)]),
        ("A 0-20, B 2-4, A 9-12", [(0, 4), (9, 12)]),
    ],
)
def test_gap_groups(spark, spec, want):
    got = S.groups_of(S.gap_groups(turns(spark, spec), 5_000)).orderBy("group_no").collect()
    assert [(r.start_ms // 1000, r.end_ms // 1000) for r in got] == want


def runs(spark, spec):
    got = S.runs_of(S.two_speaker_scan(S.gap_groups(turns(spark, spec), 30_000), 600_000)).orderBy("start_ms").collect()
    return [(r.start_ms // 1000, r.end_ms // 1000, r.speaker_a + r.speaker_b) for r in got]


def test_two_speaker_runs(spark):
    assert runs(spark, "A 0-2, B 2-4, A 4-6, C 6-8, A 8-10, B 10-12") == [(0, 6, "AB"), (6, 10, "AC")]
    assert runs(spark, "A 0-3, B 3-6, C 6-8, D 8-10, C 10-13, A 13-15") == [(0, 6, "AB"), (6, 13, "CD")]


def chunks(spark, spec, least, most):
    got = S.chunks_of(S.two_speaker_scan(S.gap_groups(turns(spark, spec), 5_000), most * 1000), least * 1000, most * 1000).orderBy("start_ms").collect()
    return [(r.start_ms // 1000, r.end_ms // 1000) for r in got]


def alternating(n):
    return ", ".join(f"{'AB'[k % 2]} {10 * k}-{10 * k + 10}" for k in range(n))


def test_long_runs_are_cut(spark):
    assert chunks(spark, alternating(10), 10, 35) == [(0, 40), (40, 80), (80, 100)]
    assert chunks(spark, alternating(9), 15, 35) == [(0, 40), (40, 80)]
    assert chunks(spark, alternating(3), 10, 35) == [(0, 30)]


def valid(spark, spec, **kw):
    got = S.valid_dialogues(turns(spark, spec), **kw).orderBy("dialogue_idx").collect()
    return [(r.dialogue_idx, r.start_ms // 1000, r.end_ms // 1000) for r in got]


def test_valid_dialogues(spark):
    assert valid(spark, "A 0-5, B 5-10, A 20-25, B 25-30") == [(0, 0, 10), (1, 20, 30)]
    assert valid(spark, "A 0-9, B 9-10, A 20-25, B 25-30") == [(0, 20, 30)]
    assert valid(spark, "A 0-8, B 8-10") == [(0, 0, 10)]
    assert valid(spark, "A 0-40, B 40-80", max_ms=35_000) == []
    assert valid(spark, "A 5-5, B 5-5", min_ms=0) == []


def test_group_numbers_over_cells_match_brute_force(spark):
    rnd = random.Random(1)
    rows = []
    for episode in "xyz":
        for k in range(150):
            s = rnd.randrange(0, 4 * S.HOUR_MS, 500)
            rows.append((episode, k, "A", s, s + rnd.choice([0, 500, 60_000, 2 * S.HOUR_MS])))
    want = {}
    for episode in "xyz":
        group, prev = 0, None
        for r in sorted((r for r in rows if r[0] == episode), key=lambda r: (r[3], r[1])):
            group += prev is not None and r[3] - prev >= 60_000
            want[episode, r[1]], prev = group, r[4]
    got = S.gap_groups(spark.createDataFrame(rows, DDL), 60_000).collect()
    assert {(r.episode_key, r.turn_id): r.group_no for r in got} == want


def test_first_appearance_and_episodes_with(spark):
    t = turns(spark, "raw_b 0-1.25, raw_a 1.5-2, raw_b 2-3")
    got = {r.speaker: r.label for r in S.first_appearance(t).collect()}
    assert got == {"raw_b": "SPEAKER_00", "raw_a": "SPEAKER_01"}
    both = t.unionByName(turns(spark, "A 0-1", "other"))
    assert {r.episode_key for r in S.episodes_with(both, 2).collect()} == {"e"}


def test_pack_periods(spark):
    p = spark.createDataFrame([("e", 0, 10), ("e", 20, 30), ("e", 35, 61), ("e", 200, 500)], "episode_key string, period_start bigint, period_end bigint")
    got = sorted((r.chunk_start, r.chunk_end, r.n_periods) for r in S.pack_periods(p, 60).collect())
    assert got == [(0, 30, 2), (35, 61, 1), (200, 500, 1)]


def test_take_until_keeps_the_crossing_row(spark):
    df = spark.createDataFrame([("u", k, d) for k, d in enumerate([1200, 1500, None, 1200, 900])], "u string, at bigint, d bigint").withColumn("cell", F.col("at") % 1 + F.floor(F.col("at") / 2))
    assert [r.at for r in S.take_until(df, ["u"], "cell", ["at"], "d", 3600).orderBy("at").collect()] == [0, 1, 2, 3]


def test_exchanges(spark):
    t = turns(spark, "A 0-2, B 1-3, B 4-5, A 6-7")
    got = [(r.speaker, r.overlaps) for r in S.exchanges(t).orderBy("start_ms").collect()]
    assert got == [("B", True), ("A", False)]


def scan(rows, gap, most):
    """Brute force: (group, run, chunk, chunk_from) of each turn of an episode, in order."""
    out, group, state, prev = [], -1, None, None
    for _, turn, who, start, end in sorted(set(rows), key=lambda r: (r[3], r[1])):
        if prev is None or start - prev >= gap:
            group, state = group + 1, [0, 0, start, {who}]
        elif who in state[3] or len(state[3]) < 2:
            state[3].add(who)
        else:
            state = [state[0] + 1, 0, start, {who}]
        out.append((turn, group, state[0], state[1], state[2]))
        if end - state[2] >= most:
            state[1], state[2] = state[1] + 1, end
        prev = end
    return out


@pytest.mark.parametrize("part_ms", [700, 5_000, 3_600_000])
@pytest.mark.parametrize("speakers", ["AB", "ABC", "ABCDE"])
def test_scan_in_parts_matches_one_scan(spark, part_ms, speakers):
    """A stream without a silence that has most turns, and others with some; in Arrow batches smaller than parts."""
    rnd = random.Random(len(speakers) + part_ms)
    rows, at = [], 0
    for k in range(700):
        # mostly by turns, so that two speakers go on for a while
        who = rnd.choice(speakers) if rnd.random() < 0.15 else speakers[k % 2]
        at += rnd.choice([30, 60, 90])
        rows.append(("stream", k, who, at, at + rnd.choice([10, 50, 120, 700])))
    for k in range(200):
        s = rnd.randrange(0, 90_000)
        rows.append(("other", 1_000 + k, rnd.choice(speakers), s, s + rnd.choice([10, 400])))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "23")
    try:
        got = S.two_speaker_scan(S.gap_groups(spark.createDataFrame(rows, DDL).repartition(3), 500), 2_000, part_ms).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    for episode in ("stream", "other"):
        want = scan([r for r in rows if r[0] == episode], 500, 2_000)
        assert sorted((r.turn_id, r.group_no, r.run_no, r.chunk_no, r.chunk_from) for r in got if r.episode_key == episode) == sorted(want)


@pytest.mark.parametrize("part_ms", [90, 1_000, 3_600_000])
def test_packing_in_parts_matches_one_pass(spark, part_ms):
    """A stream without a long silence that has most periods, one of periods longer than a chunk, one with long silences."""
    rnd = random.Random(part_ms)
    rows, want = [], []
    for name, gaps, lengths in (("stream", [1, 5, 20], [10, 30, 60]), ("long", [1, 40], [20, 150, 400]), ("sparse", [5, 300, 2_000], [10, 50])):
        at = rnd.randrange(-500, 500)
        begun = None
        for _ in range(400 if name == "stream" else 80):
            start = at + rnd.choice(gaps)
            at = start + rnd.choice(lengths)
            rows.append((name, start, at))
            if begun is None or at - begun > 120:
                begun = start
                want.append([name, begun, at, 0])
            want[-1][2], want[-1][3] = at, want[-1][3] + 1
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        got = S.pack_periods(spark.createDataFrame(rows + [(None, 1, 2)], "episode_key string, period_start bigint, period_end bigint").repartition(3), 120, part_ms).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert sorted(map(list, map(tuple, got))) == sorted(want)
