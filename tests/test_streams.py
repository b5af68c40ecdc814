from __future__ import annotations

import os
import random

import pyarrow as pa
import pyarrow.parquet as pq

from colloquy.plans import dialogues, streams
from colloquy.streaming import turns as T


def passing(rows, target):
    """Brute force: (user, event, cents) in order, null users as one user."""
    sums, out = {}, []
    for user, event, cents in rows:
        if sums.get(user, 0) < target:
            out.append((user, event, cents))
        sums[user] = sums.get(user, 0) + (cents or 0)
    return out


def by_text(rows):
    return sorted(map(repr, rows))


def test_cutoff_of_a_user_with_more_rows_than_an_arrow_batch(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(7 if k % 3 else None if k % 5 == 0 else k % 11, k * 9, float(rnd.randrange(-20, 90))) for k in range(36_000)]
    want = passing([(u, e, int(v * 100)) for u, e, v in rows], 500_000)
    rnd.shuffle(rows)
    users, events, values = zip(*rows, strict=True)
    os.mkdir(tmp_path / "events.parquet")
    pq.write_table(pa.table({"user_id": pa.array(users, pa.int64()), "event_id": pa.array(events, pa.int64()), "value": pa.array(values, pa.float64())}), tmp_path / "events.parquet/a.parquet")
    got = [tuple(r) for r in streams.streaming_cutoff(spark, str(tmp_path)).collect()]
    assert by_text(got) == by_text(want)


def test_cutoff_over_batches(spark, tmp_path):
    rnd, all_rows = random.Random(4), []
    os.mkdir(tmp_path / "rows")
    for part in range(4):
        rows = [(rnd.choice(["a", "b", None]), part * 100_000 + k * 700, rnd.choice([None, -3, 5, 20])) for k in range(120)] + [(f"only{part}", None, 4)]
        all_rows += rows
        mixed = rnd.sample(rows, len(rows))
        path = tmp_path / f"rows/{part}.parquet"
        pq.write_table(pa.table([pa.array(c, t) for c, t in zip(zip(*mixed, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)], ["k", "i", "n"]), path)
        os.utime(path, (1_700_000_000 + part, 1_700_000_000 + part))
    stream = T.read_stream(spark, str(tmp_path / "rows"), files_per_trigger=1)
    got = [tuple(r) for r in T.until_target(stream, "k", "i", "n", 400).collect()]
    assert by_text(got) == by_text(passing(all_rows, 400))


def test_last_runs_are_emitted(spark, data):
    """The stream to its end has all that the batch query has, the runs that streaming_runs leaves open among it."""
    got = sorted(map(tuple, streams.streaming_runs_to_end(spark, data).collect()))
    want = sorted(map(tuple, dialogues.two_speaker_runs(spark, data).select("episode_key", "group_no", "run_no", "n_turns", "speaker_a", "speaker_b", "start_ms", "end_ms").collect()))
    assert got == want and len(got) > streams.streaming_runs(spark, data).count()


def test_idle_episodes_close_and_leave_no_state(spark, tmp_path):
    """Episodes without a mark of the end close once the watermark has passed their last turn by an hour."""
    from pyspark.sql import functions as F

    os.mkdir(tmp_path / "rows")
    ddl = "episode_key string, turn_id bigint, speaker string, start_ms bigint, end_ms bigint, at timestamp"
    for part in range(4):
        hour = f"2026-01-01 0{part * 2}:00:00"
        rows = [(f"e{part}", k, "ab"[k % 2], k * 1_000, k * 1_000 + 900) for k in range(4)]
        df = spark.createDataFrame(rows, ddl.rpartition(",")[0]).withColumn("at", F.lit(hour).cast("timestamp")).coalesce(1)
        df.write.parquet(str(tmp_path / f"part{part}"))
        file = next((tmp_path / f"part{part}").glob("*.parquet"))
        os.rename(file, tmp_path / f"rows/{part}.parquet")
        os.utime(tmp_path / f"rows/{part}.parquet", (1_700_000_000 + part, 1_700_000_000 + part))
    stream = T.read_stream(spark, str(tmp_path / "rows"), files_per_trigger=1).withWatermark("at", "1 minute")
    closed = T.run_available(T.dialogue_runs(stream, 5_000, ("at", 3_600_000)))
    assert sorted((r.episode_key, r.n_turns, r.end_ms) for r in closed.collect()) == [(f"e{k}", 4, 3_900) for k in range(3)]
