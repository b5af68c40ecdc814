from __future__ import annotations

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.functions.keys import url_identity
from colloquy.llm import repeats, terms
from colloquy.llm.copies import hidden_copies
from colloquy.llm.repeats import Repeats
from colloquy.llm.splits import SHARES, Flow, allocate, in_eighths, linked_groups, split_groups, split_items, star_components
from colloquy.operators import prefix


def test_copies_over_many_partitions(spark):
    rnd = random.Random(6)
    rows = [("o", "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(300)}", i) for i in range(1_500)]
    rows += rows[:200] + [("other", "hot", 7), ("o", None, 9_999), ("o", "", 10_000), ("o", "", 10_001)]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, "x") for r in rows], "origin string, key string, id bigint, first_id string")
    first = {}
    for o, k, i in rows:
        if k is not None:
            first[o, k] = min(i, first.get((o, k), i))
    want = sorted({(o, k, i, first[o, k]) for o, k, i in rows if k is not None})
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch in ("10000", "7"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            for n in (1, 9):
                assert sorted(tuple(r) for r in hidden_copies(df, n).collect()) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert hidden_copies(df.limit(0)).count() == 0


def test_copies_of_an_id_that_repeats_for_batches(spark):
    """One id redelivered for several Arrow batches, at the start, in the middle and at the end of a partition."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        for hot in ("a", "m", "z"):
            for times in range(13, 36):
                rows = [("o", "h", 1), ("o", "h", 2), ("o", "n", 3), ("o", "n", 4)] + [("o", hot, 50)] * times + [("o", hot, 51)]
                first = {}
                for _, k, i in rows:
                    first[k] = min(i, first.get(k, i))
                got = hidden_copies(spark.createDataFrame(rows, "origin string, key string, id bigint"), 1)
                assert sorted(tuple(r) for r in got.collect()) == sorted({(o, k, i, first[k]) for o, k, i in rows})
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def components(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {x: find(x) for x in parent}


def test_star_components(spark):
    rnd = random.Random(8)
    chain = [(k, k + 1) for k in range(1_000, 1_040)]
    pairs = chain + [(5_000, k) for k in range(5_001, 5_300)] + [(a, b) for a, b in ((rnd.randrange(200), rnd.randrange(200)) for _ in range(90)) if a != b]
    got = {r.node: r.root for r in star_components(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()}
    assert got == {x: r for x, r in components(pairs).items() if x != r}
    assert star_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_linked_groups(spark):
    items = [(1, "f1", "u1", "vi"), (2, "F1 ", "u2", "vi"), (3, "f2", "U2", "en"), (4, None, "u3", None), (5, None, "u-3", "en"), (6, None, None, "ja"), (7, None, None, "ja"), (8, "f3", None, "ja"), (9, "f3", "u9", "ja"), (3, "f2", "U2", "en"), (None, "f1", "u1", "vi"), (10, None, "u1", "vi")]
    df = spark.createDataFrame([(*r, "x") for r in items], "id bigint, rss string, url string, lang string, feed string")
    rows, feeds = linked_groups(df, "id", (url_identity(F.col("rss")), url_identity(F.col("url"))), F.col("lang"))
    joined = rows.join(feeds.select("feed", "group_id").distinct(), "feed")
    got = {}
    for r in joined.collect():
        got.setdefault(r.group_id, set()).add(r.item_id)
    assert got == {1: {1, 2, 3, 10}, 4: {4, 5}, 6: {6}, 7: {7}, 8: {8, 9}}
    splits = {r.group_id: r.split for r in split_groups(feeds).collect()}
    assert set(splits) == set(got) and set(splits.values()) <= set(SHARES)
    empty = linked_groups(df.limit(0), "id", (F.col("rss"), F.col("url")), F.col("lang"))
    assert split_groups(empty[1]).count() == 0 == empty[0].count()


def deviations(sizes, profiles, out, shares):
    """Items above the quota by (label, split) and by split, over all bundles."""
    items = (out * sizes[:, None]).astype(float)
    own = items.sum(axis=1, keepdims=True) * shares
    return profiles.T @ (items - own), (items - own).sum(axis=0)


def cost(sizes, profiles, out, shares):
    by_label, by_split = deviations(sizes, profiles, out, shares)
    return (by_label**2).sum() + (by_split**2).sum()


def test_flow_of_one_size_is_optimal():
    """Against every way to place the components, starting from any deviations."""
    rng = np.random.default_rng(4)
    shares = np.array([0.6, 0.25, 0.15])
    for _ in range(60):
        labels, size = int(rng.integers(1, 4)), int(rng.integers(1, 9))
        counts = rng.integers(0, 5, labels)
        by_label, by_split = rng.normal(0, 12, (labels, 3)), rng.normal(0, 12, 3)
        placed = Flow(counts, size, by_label, by_split).solve(shares)
        assert (placed.sum(axis=1) == counts).all() and (placed >= 0).all()
        total = lambda x: ((by_label + size * x) ** 2).sum() + ((by_split + size * x.sum(axis=0)) ** 2).sum()  # noqa: B023, E731
        ways = [[(i, j, c - i - j) for i in range(c + 1) for j in range(c + 1 - i)] for c in counts.tolist()]
        best = min(total(np.array(w)) for w in itertools.product(*ways))
        assert total(placed) == pytest.approx(best)


def test_cycles_through_three_splits_are_cancelled():
    flow = Flow(np.array([1, 1, 1]), 1, np.array([[9.0, 0, 9], [9, 9, 0], [0, 9, 9]]), np.zeros(3))
    for label, split in ((0, 0), (1, 1), (2, 2)):
        flow.place(label, split)
    flow.cancel()
    assert flow.placed.tolist() == [[0, 1, 0], [0, 0, 1], [1, 0, 0]]


def test_allocation_meets_quotas_by_split_and_label():
    rng = np.random.default_rng(1)
    sizes, counts = np.array([1, 2, 3, 5, 8, 40, 200, 333] * 3), np.array([4_000, 900, 400, 90, 60, 9, 2, 1] * 3)
    profiles = np.repeat(np.eye(3), 8, axis=0)
    mixed = rng.dirichlet(np.ones(3), 4)
    sizes, counts, profiles = np.r_[sizes, 40, 40, 8, 3], np.r_[counts, 3, 1, 7, 50], np.r_[profiles, mixed]
    shares = np.array([0.8, 0.1, 0.1])
    out = allocate(sizes, profiles, counts, shares)
    assert (out.sum(axis=1) == counts).all() and (out >= 0).all()
    by_label, by_split = deviations(sizes, profiles, out, shares)
    assert np.abs(by_split).max() <= 1 and np.abs(by_label).max() <= 2
    assert allocate(np.array([7]), np.eye(1), np.array([1]), shares).tolist() == [[1, 0, 0]]
    assert allocate(np.array([7]), np.array([[0.5, 0.5]]), np.array([1]), shares).tolist() == [[1, 0, 0]]


def test_allocation_is_near_the_best_of_all():
    """A few small bundles: the cost of all sizes together against brute force."""
    rng = np.random.default_rng(2)
    shares = np.array([0.5, 0.5])
    for _ in range(30):
        sizes = np.sort(rng.choice(np.arange(1, 7), 3, replace=False))
        sizes[0] = 1
        profiles = np.eye(2)[rng.integers(0, 2, 3)]
        counts = np.array([rng.integers(4, 8), rng.integers(1, 4), rng.integers(1, 4)])
        best = min(cost(sizes, profiles, np.array([(i, c - i) for i, c in zip(w, counts, strict=True)]), shares) for w in itertools.product(*[range(c + 1) for c in counts.tolist()]))
        assert cost(sizes, profiles, allocate(sizes, profiles, counts, shares), shares) <= best + 2 * sizes.max() ** 2


def test_sizes_of_millions_end():
    """Costs of 10^15 and more, whose rounding must not be taken for cycles; the quotas are met all the same."""
    rng = np.random.default_rng(8)
    sizes = np.unique(np.r_[1, 2, 3, rng.integers(4, 5_000, 40), rng.integers(10**6, 10**8, 30)])
    sizes = np.tile(sizes, 4)
    counts = np.maximum(1, (10**7 / sizes).astype(np.int64) * rng.integers(0, 3, len(sizes)))
    counts[sizes <= 3] = 10**8
    profiles = np.repeat(np.eye(4), len(sizes) // 4, axis=0)
    shares = np.array([0.8, 0.1, 0.1])
    out = allocate(sizes, profiles, counts, shares)
    by_label, by_split = deviations(sizes, profiles, out, shares)
    assert (out.sum(axis=1) == counts).all() and np.abs(by_split).max() < 2 and np.abs(by_label).max() < 4


def test_few_large_groups():
    """As far off the quotas as with the best of all ways."""
    sizes, shares = np.array([59, 57, 33, 18, 16, 12, 5]), np.array([0.8, 0.1, 0.1])
    profiles, counts = np.ones((7, 1)), np.ones(7, dtype=np.int64)
    out = allocate(sizes, profiles, counts, shares)
    best = min(cost(sizes, profiles, np.eye(3, dtype=np.int64)[list(w)], shares) for w in itertools.product(range(3), repeat=7))
    assert cost(sizes, profiles, out, shares) == pytest.approx(best)


def test_eighths(spark):
    rows = [(1, [("en", 1)]), (2, [("en", 1), ("vi", 1)]), (3, [("en", 1), ("es", 1), ("vi", 1)]), (4, [("en", 97), ("es", 1), ("vi", 2)])]
    df = spark.createDataFrame(rows, "id int, parts array<struct<label: string, n: bigint>>").select("id", in_eighths(F.col("parts")).alias("e"))
    got = {r.id: [tuple(x) for x in r.e] for r in df.collect()}
    assert got == {1: [("en", 8)], 2: [("en", 4), ("vi", 4)], 3: [("en", 2), ("es", 3), ("vi", 3)], 4: [("en", 8)]}


@pytest.mark.parametrize("least_hot", [50_000, 1])
def test_split_items_with_a_hot_feed(spark, monkeypatch, least_hot):
    """A feed with a third of all rows, by either way of joining; nulls, repeats and clashing columns."""
    monkeypatch.setattr(prefix, "LEAST_HOT", least_hot)
    rnd = random.Random(3)
    rows = [(k, "hot" if k % 3 == 0 else f"f{rnd.randrange(200)}", f"u{rnd.randrange(4_000)}", rnd.choice(["vi", "en", None]), "x") for k in range(1_200)]
    rows += rows[:30] + [(5_000, None, None, "vi", "x"), (5_001, None, "u1", "vi", "x"), (None, "hot", "u2", "vi", "x")]
    df = spark.createDataFrame(rows, "id bigint, rss string, url string, lang string, group_id string")
    got = split_items(df, "id", (F.col("rss"), F.col("url")), F.col("lang")).collect()
    roots = components([(f"i{r[0]}", f"{c}{r[k]}") for r in rows if r[0] is not None for k, c in ((1, "f"), (2, "u")) if r[k] is not None])
    sets = {}
    for r in rows:
        if r[0] is not None:
            sets.setdefault(roots.get(f"i{r[0]}", r[0]), set()).add(r[0])
    assert {(r.item_id, r.group_id) for r in got} == {(i, min(s)) for s in sets.values() for i in s} and len(got) == 1_202
    assert len({(r.group_id, r.split) for r in got}) == len(sets)
    assert split_items(df.limit(0), "id", (F.col("rss"), F.col("url")), F.col("lang")).count() == 0


def test_splits_of_many_groups(spark):
    rows = [(g, "vi" if g % 3 else "en", 1 + g % 4) for g in range(2_000)]
    got = split_groups(spark.createDataFrame(rows, "group_id bigint, label string, n bigint")).collect()
    total = sum(r[2] for r in rows)
    for name, share in SHARES.items():
        assert abs(sum(r.n for r in got if r.split == name) - share * total) <= 4
    assert len({r.group_id for r in got}) == 2_000


def test_term_counts(spark):
    tags = ["", "  ", "Jazz", "jazz ", "indie \n games", "café", None, 5]
    rnd = random.Random(9)
    rows, want, items = [], Counter(), Counter()
    import json

    for i in range(400):
        own = [rnd.choice(["talk", "Talk", "sleep", f"one{i}"]) for _ in range(rnd.randrange(4))] + [rnd.choice(tags)]
        text = json.dumps({"tags": [{"term": t} for t in own] + ["x", None, {"label": 1}]})
        rows.append((i, text, rnd.choice([None, "", "{", '{"tags": 3}', "[1]", '{"tags": {"term": "no"}}', text[:-3]])))
        clean = [" ".join(t.split()).lower() for t in own if isinstance(t, str) and t.strip()]
        want.update(clean)
        items.update(set(clean))
    rows += rows[:50] + [(None, rows[0][1], None)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "id bigint, a string, b string, term string")
    got = {r.term: (r.occurrences, r["items"]) for r in terms.term_counts(df, "id", ["a", "b"]).collect()}
    assert got == {t: (n, items[t]) for t, n in want.items()}
    assert terms.term_counts(df.limit(0), "id", ["a", "b"]).count() == 0


@pytest.mark.parametrize("heavy", [[], ["talk"], ["talk", "sleep", "absent"]])
def test_heavy_and_light_counts_agree(heavy):
    import pyarrow as pa

    doc = lambda *ts: '{"tags": [%s]}' % ", ".join('{"term": "%s"}' % t for t in ts)
    batch = pa.record_batch([pa.array([1, 1, 2, 3]), pa.array([10, 10, 20, 30]), pa.array([doc("talk", "a", "talk"), doc("talk"), doc("talk", "sleep"), None])], ["id", "h", "field_0"])
    none = Repeats(4, 3, np.zeros(64, dtype=np.uint64))
    occurrences, items, ways = Counter(), Counter(), {}
    for out in terms.count_terms(iter([batch, batch.slice(2)]), heavy, none):
        for r in out.to_pylist():
            occurrences[r["term"]] += r["occurrences"]
            items[r["term"]] += r["items"]
            ways[r["term"]] = r["way"]
    assert occurrences == {"talk": 5, "a": 1, "sleep": 2} and items == {"talk": 4, "a": 1, "sleep": 2}
    assert {t for t, w in ways.items() if w == terms.HEAVY} == set(heavy) & set(ways)


@pytest.mark.parametrize("turned", [False, True])
@pytest.mark.parametrize("bits", [1 << 25, 64])
def test_rows_of_one_id_that_differ_all_count(spark, monkeypatch, turned, bits):
    """Whatever the order of rows; an id with a third of all rows, some of them equal; a filter that is full."""
    monkeypatch.setattr(repeats, "FILTER_BITS", bits)
    doc = lambda *ts: '{"tags": [%s]}' % ", ".join('{"term": "%s"}' % t for t in ts)
    rows = [(1, doc("a"), None), (1, doc("b"), None), (1, doc("a"), None)] + [(7, doc("hot", f"h{k % 5}"), doc("x")) for k in range(300)] + [(k, doc("x"), None) for k in range(100, 700)]
    want = {"a": (1, 1), "b": (1, 1), "hot": (5, 1), "x": (605, 601), **{f"h{k}": (1, 1) for k in range(5)}}
    df = spark.createDataFrame(rows[::-1] if turned else rows, "id bigint, a string, b string").repartition(3)
    got, n = terms.counted_terms(df, "id", ["a", "b"])
    assert {r.term: (r.occurrences, r["items"]) for r in got.collect()} == want and n == 602


def test_marks(spark):
    df = spark.createDataFrame([("a", 1, 1), ("b", 9, 3), ("c", 9, 5)], "term string, occurrences bigint, items bigint")
    assert {r.term: r.mark for r in terms.mark_terms(df, 20).collect()} == {"a": "rare", "b": None, "c": "common"}
