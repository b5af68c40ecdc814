from __future__ import annotations

import random

from pyspark.sql import functions as F

from colloquy.operators.intervals import overlap_join, overlap_total, short_overlapping
from colloquy.operators.sweep import covered_periods, interval_gaps

DDL = "k string, s bigint, e bigint, __extra int"


def union(rows):
    """Brute force: periods by key."""
    out = {}
    for k in {r[0] for r in rows if r[0] is not None}:
        periods = []
        for s, e in sorted((r[1], r[2]) for r in rows if r[0] == k and r[1] is not None and r[2] is not None and r[2] > r[1]):
            if periods and s <= periods[-1][1]:
                periods[-1][1] = max(periods[-1][1], e)
            else:
                periods.append([s, e])
        out[k] = periods
    return out


def test_random_intervals_match_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    for _ in range(600):
        s = rnd.randrange(0, 3_000)
        rows.append((rnd.choice("abc"), s, s + rnd.choice([1, 5, 20, 900, 0, -3]), 1))
    rows += [(None, 1, 2, 1), ("a", None, 5, 1), ("a", 5, None, 1), rows[0], rows[0], ("neg", -500, -100, 1), ("neg", -100, 40, 1), ("neg", 50, 60, 1)]
    df = spark.createDataFrame(rows, DDL)
    want = union(rows)
    for cell in (7, 100, 10_000):
        got = sorted(tuple(r) for r in covered_periods(df, ["k"], "s", "e", cell).collect())
        assert got == sorted((k, a, b) for k, ps in want.items() for a, b in ps)
        gaps = sorted(tuple(r) for r in interval_gaps(df, ["k"], "s", "e", cell).collect())
        assert gaps == sorted((k, x[1], y[0]) for k, ps in want.items() for x, y in zip(ps, ps[1:], strict=False))


def test_touching_nested_and_far_intervals(spark):
    df = spark.createDataFrame([("a", 0, 10, 1), ("a", 10, 20, 1), ("a", 2, 5, 1), ("a", 10**15, 10**15 + 1, 1)], DDL)
    assert [tuple(r) for r in interval_gaps(df, ["k"], "s", "e").collect()] == [("a", 20, 10**15)]


def test_empty(spark):
    df = spark.createDataFrame([], DDL)
    assert interval_gaps(df, ["k"], "s", "e").count() == 0 and covered_periods(df, ["k"], "s", "e").count() == 0


def test_overlap_join_finds_each_pair_once(spark):
    rnd = random.Random(5)
    sides = [[(rnd.choice("ab"), s := rnd.randrange(0, 400_000), s + rnd.choice([0, 300, 5_000, 200_000])) for _ in range(80)] for _ in range(2)]
    left, right = (spark.createDataFrame(x, "k string, start_ms bigint, end_ms bigint") for x in sides)
    want = sorted((a[0], max(a[1], b[1]), min(a[2], b[2])) for a in sides[0] for b in sides[1] if a[0] == b[0] and min(a[2], b[2]) > max(a[1], b[1]))
    assert sorted((r.k, r.start, r.end) for r in overlap_join(left, right, "k").collect()) == want
    total = {r.k: r.overlap_ms for r in overlap_total(left, right, "k").collect()}
    assert total == {k: sum(e - s for x, s, e in want if x == k) for k in {x[0] for x in want}}
    assert short_overlapping(left, right, "k", 300, 300).where(F.col("end_ms") - F.col("start_ms") != 300).count() == 0


def test_overlaps_of_intervals_of_any_length(spark):
    """Some last a thousand cells and more, one key has most rows; against all pairs."""
    rnd = random.Random(5)

    def some(n):
        out = []
        for _ in range(n):
            s = rnd.randrange(-5_000, 200_000)
            out.append((rnd.choice("aaab"), s, s + rnd.choice([0, -1, 1, 40, 700, 9_000, 190_000, 3_000_000])))
        return out

    left, right = some(150), some(150) + [(None, 1, 5), ("a", None, 5)]
    make = lambda rows: spark.createDataFrame(rows, "k string, start_ms bigint, end_ms bigint")
    got = sorted(tuple(r) for r in overlap_join(make(left), make(right), "k", 10).collect())
    want = sorted((k, s, e, a, b, max(s, a), min(e, b)) for k, s, e in left for q, a, b in right if q == k and None not in (a, b) and e > s and b > a and min(e, b) > max(s, a))
    assert got == want and any(r[2] - r[1] > 100_000 for r in got)
    assert overlap_join(make(left).limit(0), make(right), "k", 10).count() == 0
