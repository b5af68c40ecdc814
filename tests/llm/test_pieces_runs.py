from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.llm.pieces import TurnCutter, audio_pieces, cut_offsets, pause_offsets, tiers_of
from colloquy.llm.runs import agglomerate, collapse_runs, edit_similarity

TASKS = "task_id bigint, dlg_key string, episode_key string, dialogue_idx int, dlg_start double, dlg_end double, wav_rate int, dlg_wav array<float>, queued_at int, piece_no string"
SEGMENTS = "episode_key string, start_sec double, end_sec double, total string"


def check(pieces, total, limit, overlap):
    assert pieces[0][0] == 0 and pieces[-1][1] == total
    for (a, b, _), (c, d, _) in zip(pieces, pieces[1:], strict=False):
        assert b - c == overlap and d > b and b - a <= limit
    assert pieces[-1][1] - pieces[-1][0] <= limit


def test_cuts_cover_and_overlap():
    rnd = random.Random(2)
    for _ in range(300):
        total, limit = rnd.randrange(0, 5_000), rnd.randrange(20, 900)
        overlap = rnd.randrange(0, limit // 2)
        free = np.array(sorted(rnd.sample(range(5_000), rnd.randrange(0, 60))), dtype=np.int64)
        pieces = cut_offsets(total, tiers_of((free, free), (free[::2], free[::2]), overlap), limit, overlap)
        check(pieces, total, limit, overlap)
        for start, end, hard in pieces[:-1]:
            inside = free[(free > start + overlap) & (free <= start + limit)]
            assert hard == (len(inside) == 0) and (hard or end in free)
    assert cut_offsets(10, [], 10, 2) == [(0, 10, False)] and cut_offsets(0, [], 10, 0) == [(0, 0, False)]
    with pytest.raises(ValueError):
        cut_offsets(10, [], 5, 5)


def test_pauses_match_brute_force():
    rnd = random.Random(7)
    for _ in range(200):
        turns = [(s := rnd.randrange(-20, 300), s + rnd.randrange(1, 60)) for _ in range(rnd.randrange(0, 12))]
        starts, ends = pause_offsets(250, turns)
        free = {t for a, b in zip(starts, ends, strict=True) for t in range(a, b + 1)}
        assert free & set(range(251)) == {t for t in range(251) if not any(a < t < b for a, b in turns)}
    far = cut_offsets(10**12, tiers_of(*[pause_offsets(10**12, [(5, 10**9)])] * 2, 2_000), 10**11, 2_000)
    check(far, 10**12, 10**11, 2_000)


def test_turns_that_stream_by_are_cut_alike():
    rnd = random.Random(3)
    for _ in range(300):
        total, limit = rnd.randrange(1, 3_000), rnd.randrange(20, 500)
        overlap = rnd.randrange(0, limit // 2)
        turns = sorted((s := rnd.randrange(-20, 3_000), s + rnd.randrange(1, 200)) for _ in range(rnd.randrange(0, 60)))
        cutter = TurnCutter(total, limit, overlap)
        for t in [*turns, *turns[-1:]]:
            cutter.add(*t)
        free = pause_offsets(total, turns)
        assert cutter.end() == cut_offsets(total, tiers_of(free, free, overlap), limit, overlap)


def test_a_task_with_a_third_of_all_turns(spark):
    """Two versions of it with other bounds, corrupt turns that last for years, and Arrow batches smaller than the task."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        turns = [("e", k * 20.0, k * 20.0 + 17.5, "x") for k in range(500)] + [("e", k * 400.0, k * 400.0 + 30.0, "x") for k in range(20)]
        tasks = [(k, f"t{k}", "e", 0, 10.0 * k, 10.0 * k + 650.0, 4, None, 1, "x") for k in range(1, 9)] + [(9, "hot", "e", 0, 3.0, 9_000.0, 4, None, 1, "x"), (10, "hot2", "e", 0, 5.0, 8_000.0, 4, None, 1, "x")]
        got = {}
        df = spark.createDataFrame(tasks, TASKS)
        for r in audio_pieces(df, spark.createDataFrame(turns, SEGMENTS)).orderBy("task_id", "piece_no").collect():
            got.setdefault(r.dlg_key, []).append((r.from_ms, r.to_ms, r.hard_cut))
        for task in tasks:
            s, e = round(task[4] * 1000), round(task[5] * 1000)
            own = [(round(a * 1000) - s, round(b * 1000) - s) for _, a, b, _ in turns if a * 1000 < e and b * 1000 > s]
            free = pause_offsets(e - s, own)
            assert got[task[1]] == cut_offsets(e - s, tiers_of(free, free, 2_000), 600_000, 2_000)
        years = turns + [("e", -(10.0**9), 10.0**9, "x")]
        hard = audio_pieces(df, spark.createDataFrame(years, SEGMENTS)).where("piece_no < n_pieces - 1").select("hard_cut").distinct().collect()
        assert [r.hard_cut for r in hard] == [True]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_audio_pieces(spark):
    wave = [0.5] * 2_500
    wave[2_300] = wave[2_301] = wave[2_292] = wave[2_293] = 0.0
    rows = [
        (1, "exact", "e", 0, 0.0, 1.0, 4, [0.5] * 2_400, 1, "x"),
        (2, "long", "e", 0, 0.0, 1.0, 4, wave, 1, "x"),
        (2, "long", "e", 0, 0.0, 1.0, 4, wave, 9, "x"),
        (3, "turns", "e", 0, 100.0, 800.001, 4, None, 1, "x"),
        (4, "swapped", "e", 0, 800.0, 100.0, 4, None, 1, "x"),
        (5, "none", "e", 0, None, 100.0, None, None, 1, "x"),
        (6, "empty", "e", 0, 0.0, 9.0, 4, [], 1, "x"),
        (7, "norate", "e", 0, 0.0, 700.0, None, [0.1], 1, "x"),
        (8, "nulls", None, None, None, None, 4, [None] * 2_401, 1, "x"),
        (None, "noid", "e", 0, 0.0, 900.0, 4, None, 1, "x"),
    ]
    segments = spark.createDataFrame([("e", 90.0, 500.0, "x"), ("e", 500.5, 900.0, "x"), ("e", None, 1.0, "x"), ("e", 5.0, 4.0, "x"), (None, 1.0, 2.0, "x")], SEGMENTS)
    got = {}
    for r in audio_pieces(spark.createDataFrame(rows, TASKS), segments).orderBy("task_id", "piece_no").collect():
        got.setdefault(r.dlg_key, []).append((r.from_ms, r.to_ms, r.hard_cut))
    assert got.pop("long") == [(0, 575_250, False), (573_250, 625_000, False)]
    assert got.pop("turns") == [(0, 400_500, False), (398_500, 700_001, False)]
    assert got.pop("exact") == [(0, 600_000, False)] and got.pop("empty") == [(0, 0, False)]
    assert len(got.pop("norate")) == 2 and len(got.pop("nulls")) == 2 and not got
    assert audio_pieces(spark.createDataFrame([], TASKS), segments.limit(0)).count() == 0


def brute_runs(rows, gap=None):
    out = []
    for entity in sorted({r[0] for r in rows}):
        prev = None
        for _, i, label, s, e in sorted({r for r in rows if r[0] == entity}, key=lambda r: (r[3], r[1])):
            if prev is not None and label is not None and label == prev and (gap is None or s - out[-1][7] <= gap):
                o = out[-1]
                o[2], o[4], o[6], o[7] = i, o[4] + 1, max(o[6], e), e
            else:
                out.append([entity, i, i, label, 1, s, e, e])
            prev = label
    return sorted(tuple(o[:7]) for o in out)


@pytest.mark.parametrize("gap", [None, 300])
def test_runs_match_brute_force(spark, gap):
    rnd = random.Random(4)
    rows = []
    for k in range(900):
        s = rnd.randrange(0, 20_000, 10)
        rows.append((rnd.choice("ab"), k, rnd.choice([1, 1, 1, 2, None]), s, s + rnd.choice([1, 50, 5_000])))
    rows += rows[:40]
    df = spark.createDataFrame([(*r, "x") for r in rows], "who string, i bigint, no bigint, s bigint, e bigint, entity string")
    for cell in (70, 1_000, 10**9):
        got = collapse_runs(df, "who", "i", "no", "s", "e", most_gap_ms=gap, cell_ms=cell).collect()
        assert sorted((tuple(r) for r in got), key=lambda t: t[:2]) == sorted(brute_runs(rows, gap), key=lambda t: t[:2])


def test_runs_over_many_arrow_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [("a", k, k // 7, k * 10, k * 10 + 5) for k in range(60)]
        df = spark.createDataFrame(rows, "who string, i bigint, no bigint, s bigint, e bigint")
        got = sorted(tuple(r)[1:5] for r in collapse_runs(df, "who", "i", "no", "s", "e", cell_ms=90).collect())
        assert got == [(k, min(k + 6, 59), k // 7, min(7, 60 - k)) for k in range(0, 60, 7)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_runs_of_nothing_and_of_nulls(spark):
    ddl = "who string, i bigint, no bigint, s bigint, e bigint"
    assert collapse_runs(spark.createDataFrame([], ddl), "who", "i", "no", "s", "e").count() == 0
    df = spark.createDataFrame([(None, 1, 1, 0, 5), ("a", None, 1, 0, 5), ("a", 1, 1, None, 5), ("a", 2, None, 3, 5), ("a", 3, None, 4, 5)], ddl)
    got = collapse_runs(df, "who", "i", "no", "s", "e").where(F.col("n") > 1)
    assert got.count() == 0


def brute_agglomeration(rows, least, most_gap):
    """Pair after pair, the most similar first, over whole sequences."""
    out = []
    for entity in sorted({r[0] for r in rows}):
        runs = [[(i, label, s, e)] for _, i, label, s, e in sorted({r for r in rows if r[0] == entity}, key=lambda r: (r[3], r[1]))]
        while True:
            best = None
            for k, (a, b) in enumerate(zip(runs, runs[1:], strict=False)):
                gap = b[0][2] - a[-1][3]
                if None in (a[0][1], b[0][1]) or most_gap is not None and gap > most_gap:
                    continue
                alike = min(edit_similarity(x[1], y[1]) for x in a for y in b)
                if alike >= least:
                    best = min(best or (1,), (-alike, gap, ((b[0][0] * 0x9E3779B97F4A7C15) % 2**64) >> 1, k))
            if best is None:
                break
            runs[best[3] : best[3] + 2] = [runs[best[3]] + runs[best[3] + 1]]
        for run in runs:
            n = Counter(x[1] for x in run)
            out.append((entity, run[0][0], run[-1][0], min(n, key=lambda x: (-n[x], str(x))), len(run), run[0][2], max(x[3] for x in run)))
    return sorted(out, key=lambda t: t[:2])


@pytest.mark.parametrize(("least", "gap"), [(0.5, None), (0.6, 300), (1.0, None)])
def test_near_identical_events_match_brute_force(spark, least, gap):
    """Divided into any cells and batches; one entity has most rows."""
    rnd = random.Random(11)
    names = ["intro", "intra", "into", "outro", "ultra", "in", "music", "musik", None]
    rows = []
    for k in range(500):
        s = rnd.randrange(0, 9_000, 10)
        rows.append((rnd.choice("aaab"), k, rnd.choice(names), s, s + rnd.choice([1, 50, 400])))
    want = brute_agglomeration(rows, least, gap)
    assert any(r[4] > 2 for r in want)
    df = spark.createDataFrame(rows, "who string, i bigint, what string, s bigint, e bigint").repartition(3)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for cell, batch in ((70, 10_000), (1_000, 7), (10**9, 5), (10**9, 10_000)):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
            got = collapse_runs(df, "who", "i", "what", "s", "e", similar=edit_similarity, least_similarity=least, most_gap_ms=gap, cell_ms=cell).collect()
            assert sorted((tuple(r) for r in got), key=lambda t: t[:2]) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_the_most_similar_pair_goes_first():
    """Once abcd and abce are one run, it is no more like zbce than abxx is like it, and goes with abxx, which keeps zbce out;
    if abce joins zbce first, abxx is left out."""
    labels = ["abxx", "abcd", "abce", "zbce"]
    near, gap, tie = np.ones(3, bool), np.zeros(3, np.int64), np.arange(3)
    similarity = np.array([edit_similarity(a, b) for a, b in zip(labels, labels[1:], strict=False)])
    assert similarity.tolist() == [0.5, 0.75, 0.75]
    run = lambda tie, waits: agglomerate([{x: 1} for x in labels], near, similarity, gap, tie, waits, edit_similarity, 0.5).tolist()
    assert run(tie, [False] * 4) == [True, False, False, True]
    assert run(tie[::-1], [False] * 4) == [True, True, False, False]
    waits = [False, False, False, True]
    assert run(tie[::-1], waits) == [True, True, True, True] and waits == [True, True, True, True]
    assert edit_similarity("", "") == 1.0 and edit_similarity("", "ab") == 0.0


def test_waiting_runs_are_few():
    """Of a long sequence in which all may merge, only what is near its ends waits for what lies beyond."""
    n, rnd = 20_000, np.random.default_rng(5)
    names = ["aaaaaaaa", "aaaaaaab", "aaaaaaba", "aaaaabaa"]
    labels = [{names[k]: 1} for k in rnd.integers(0, 4, n)]
    similarity = np.array([edit_similarity(*a, *b) for a, b in zip(labels, labels[1:], strict=False)])
    waits = [True] + [False] * (n - 2) + [True]
    starts = agglomerate(labels, np.ones(n - 1, bool), similarity, np.zeros(n - 1, np.int64), rnd.permutation(n - 1), waits, edit_similarity, 0.8)
    assert sum(w for w, s in zip(waits, starts.tolist(), strict=True) if s) < 60
