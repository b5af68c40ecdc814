"""Repeated consecutive events in sequences (problem 4).

Adjacent agglomeration: the runs of an entity form a linked list, and a priority queue holds the pairs of neighbours
that meet the limits, most similar first; the top pair is merged, the similarities of the new run to its neighbours are
updated, until no pair is left. Runs are as similar as the two least similar labels in them (complete linkage), so a run
can't drift, and a merge never brings two runs nearer to each other. That is what lets a long sequence be worked on in
parts:

1. Events are shuffled by (entity, cell of time), and each part is agglomerated by itself. What a part's first and last run
   would do is unknown, as they may have nearer neighbours beyond it; so is what a run would do that would merge with such
   a run next. Those runs are left open; all others are final. Runs of the same single label merge in any case.
2. Only open runs go on, a few per part whatever the number of events, are shuffled by entity and agglomerated as they
   stream by.

Of equally similar pairs the nearer in time goes first, then one chosen by a hash of its event; as such an order goes up
and down, runs that wait for their neighbours in turn are few.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions.keys import SPEAKER_NUMBER_SQL, millis, speaker_number, usable_bounds
from colloquy.session import cut, read_table

FIELDS = {
    "entity": pa.string(), "order_ms": pa.int64(), "first_id": pa.int64(), "last_id": pa.int64(), "label": pa.string(), "variants": pa.string(), "n": pa.int64(), "start_ms": pa.int64(), "end_ms": pa.int64(), "meet_ms": pa.int64(),
    "opens": pa.bool_(), "closes": pa.bool_(), "follows": pa.bool_(), "waits": pa.bool_(),
}
SCHEMA = pa.schema(list(FIELDS.items()))
RUN = ", ".join(f"{k} {({pa.string(): 'string', pa.int64(): 'bigint', pa.bool_(): 'boolean'})[t]}" for k, t in FIELDS.items())


def same(a: str, b: str) -> float:
    return float(a == b)


@lru_cache(maxsize=100_000)
def edit_similarity(a: str, b: str) -> float:
    """1 less the edit distance as a part of the longer label."""
    if a == b:
        return 1.0
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return 1 - row[-1] / max(len(a), len(b))


def agglomerate(labels: list[dict[str, int]], near: np.ndarray, similarity: np.ndarray, gap: np.ndarray, tie: np.ndarray, waits: list[bool], similar: Callable[[str, str], float], least: float) -> np.ndarray:
    """Where runs begin, as a mask over n runs; ``labels`` (their counts) and ``waits`` of a run's first place are
    brought up to date.

    Of the n - 1 neighbours: whether they may merge at all, the similarity of their labels, the gap and the order of ties.
    ``waits``: a run that may yet merge with one that isn't here; those that would merge with it next wait, too.
    """
    n = len(labels)
    starts = np.ones(n, dtype=bool)
    at = np.flatnonzero(near & (similarity >= least))
    linked = np.full(max(0, n - 1), -1.0)
    linked[at] = similarity[at]
    linked = linked.tolist()
    queue = list(zip((-similarity[at]).tolist(), gap[at].tolist(), tie[at].tolist(), at.tolist(), strict=True))
    heapq.heapify(queue)
    gaps, ties = gap.tolist(), tie.tolist()
    head, tail = list(range(n)), list(range(n))  # linked list: a run's first place, known at its last, and its last, known at its first

    def update(place: int, a: dict, b: dict) -> None:
        """The runs that meet at ``place`` are also no more similar than a and b."""
        if 0 <= place < n - 1 and linked[place] >= 0:
            low = min(linked[place], min(similar(x, y) for x in a for y in b))
            if low < linked[place]:
                linked[place] = low if low >= least else -1.0
                if low >= least:
                    heapq.heappush(queue, (-low, gaps[place], ties[place], place))

    while queue:
        weight, _, _, place = heapq.heappop(queue)
        if -weight != linked[place]:
            continue  # no longer so similar
        linked[place] = -1.0
        left, right = head[place], place + 1
        alike = len(labels[left]) == 1 and labels[left].keys() == labels[right].keys()
        if (waits[left] or waits[right]) and not alike:
            waits[left] = waits[right] = True
            continue
        last = tail[right]
        if not alike:
            before = head[left - 1] if left else None
            if before is not None:
                update(left - 1, labels[before], labels[right])
            if last < n - 1:
                update(last, labels[left], labels[last + 1])
        for x, m in labels[right].items():
            labels[left][x] = labels[left].get(x, 0) + m
        waits[left] = waits[left] or waits[right]
        starts[right] = False
        tail[left], head[last] = last, left
    return starts


def _collapse(similar: Callable[[str, str], float], least: float, most_gap: float | None, final: bool):
    """mapInArrow over rows sorted by (entity, part unless final, order_ms, first_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if not final:  # a part ends with its batch
                yield from merged(parts_of(batch), True).to_batches()
                continue
            table = pa.Table.from_batches([pa.RecordBatch.from_arrays(batch.columns, schema=SCHEMA)])
            done = merged(pa.concat_tables([carried, table]) if carried is not None else table, True)
            waits = done.column("waits").to_numpy()
            yield from done.filter(pa.array(~waits)).to_batches()
            carried = done.filter(pa.array(waits))
        if carried is not None and carried.num_rows:
            yield from merged(carried, False).to_batches()

    def parts_of(batch: pa.RecordBatch) -> pa.Table:
        """Events as runs of one; where parts open and close, and which event follows one of its part."""
        c = {k: batch.column(k) for k in batch.schema.names}
        cell = c["cell"].to_numpy()
        entity = c["entity"].dictionary_encode().indices.to_numpy()
        new = np.r_[True, (cell[1:] != cell[:-1]) | (entity[1:] != entity[:-1])]
        n = batch.num_rows
        own = {
            "entity": c["entity"], "order_ms": c["start_ms"], "first_id": c["id"], "last_id": c["id"], "label": c["label"], "variants": pa.nulls(n, pa.string()), "n": pa.array(np.ones(n, np.int64)), "start_ms": c["start_ms"], "end_ms": c["end_ms"],
            "meet_ms": c["end_ms"], "opens": pa.array(new), "closes": pa.array(np.r_[new[1:], True]), "follows": pa.array(~new), "waits": pa.array(np.zeros(n, bool)),
        }
        return pa.Table.from_arrays([own[k] for k in FIELDS], schema=SCHEMA)

    def merged(t: pa.Table, more: bool) -> pa.Table:
        """The table's runs, agglomerated; those wait that may go on where it ends: in a part at both its ends, in the final
        pass where ``more`` rows of the entity may come."""
        t = t.combine_chunks()
        c = {k: t.column(k).to_numpy() for k in ("order_ms", "first_id", "meet_ms", "opens", "closes", "follows", "n")}
        encoded = t.column("label").combine_chunks().dictionary_encode()
        names, code = encoded.dictionary.to_pylist(), encoded.indices.fill_null(-1).to_numpy().astype(np.int64)
        entity = t.column("entity").combine_chunks().dictionary_encode().indices.to_numpy()
        together = np.where(c["opens"][1:], c["closes"][:-1], c["follows"][1:])
        gap = c["order_ms"][1:] - c["meet_ms"][:-1]
        near = (entity[1:] == entity[:-1]) & together & (code[1:] >= 0) & (code[:-1] >= 0)
        if most_gap is not None:
            near &= gap <= most_gap
        labels: list[dict[str, int]] = [{names[k]: m} if k >= 0 else {} for k, m in zip(code.tolist(), c["n"].tolist(), strict=True)]
        several = np.flatnonzero(t.column("variants").is_valid().to_numpy())
        for k, v in zip(several.tolist(), t.column("variants").take(pa.array(several)).to_pylist(), strict=True):
            labels[k] = json.loads(v)
        similarity = np.where(code[1:] == code[:-1], 1.0, 0.0)
        odd = np.flatnonzero(near & (code[1:] != code[:-1]))
        if len(odd) and similar is not same:
            pairs, place = np.unique(code[odd] * len(names) + code[odd + 1], return_inverse=True)
            similarity[odd] = np.array([similar(names[p // len(names)], names[p % len(names)]) for p in pairs.tolist()])[place]
        for k in np.flatnonzero(near & (np.isin(np.arange(len(near)), several) | np.isin(np.arange(len(near)) + 1, several))).tolist():
            similarity[k] = min(similar(x, y) for x in labels[k] for y in labels[k + 1])
        waits = np.zeros(len(code), dtype=bool)
        if not final:
            waits = c["opens"] | c["closes"]
        elif more:
            waits[-1] = code[-1] >= 0
        tie = (c["first_id"][1:].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(1)
        held = waits.tolist()
        starts = agglomerate(labels, near, similarity, gap, tie.astype(np.int64), held, similar, least)
        first = np.flatnonzero(starts)
        last = np.r_[first[1:], len(starts)] - 1
        kept = [labels[k] for k in first.tolist()]
        wait = np.array([held[k] for k in first.tolist()])
        if final and more:  # what isn't carried on can't be gone back to: a waiting run needs those that follow it
            wait = np.cumsum(wait) > 0
        follows = ~c["opens"][first] & (np.r_[False, wait[:-1]] if not final else True)  # a final run lies between otherwise
        begin, end = t.take(pa.array(first)), t.take(pa.array(last))
        out = {
            "entity": begin["entity"], "order_ms": begin["order_ms"], "first_id": begin["first_id"], "last_id": end["last_id"], "label": pa.array([min(v, key=lambda x: (-v[x], x)) if v else None for v in kept], pa.string()),
            "variants": pa.array([json.dumps(v) if len(v) > 1 else None for v in kept], pa.string()), "n": pa.array(np.add.reduceat(c["n"], first)), "start_ms": pa.array(np.minimum.reduceat(t["start_ms"].to_numpy(), first)), "end_ms": pa.array(np.maximum.reduceat(t["end_ms"].to_numpy(), first)),
            "meet_ms": end["meet_ms"], "opens": begin["opens"], "closes": end["closes"], "follows": pa.array(follows), "waits": pa.array(wait),
        }
        return pa.table({k: out[k] for k in FIELDS}).cast(SCHEMA)

    return run


def collapse_runs(events: DataFrame, entity: str, event_id: str, label: str, start_ms: str, end_ms: str, similar: Callable[[str, str], float] = same, least_similarity: float = 1.0, most_gap_ms: int | None = None, cell_ms: int = 3_600_000) -> DataFrame:
    """Each run of consecutive events with the same label, or with ``similar`` ones, as one row.

    ``events`` has the columns named: a string entity, a BIGINT id, a label of any type (null: belongs to no run and
    interrupts any), BIGINT start and end in ms, by which, then id, the events of an entity are ordered. Result: entity,
    first_id, last_id, label (the run's most frequent one, of equals the least as a string), n, start_ms, end_ms (first
    start, latest end), in which events outside any run are runs of one. ``similar`` compares two labels as strings, in
    either order, 0 to 1, which is for equal ones only; all labels of a run are at least ``least_similarity`` alike. ``most_gap_ms`` bounds the silence
    from one event's end to the next one's start (None: any). Rows with a null entity, id, start or end are left out; rows
    that repeat in all these columns count once. Empty in, empty out.
    """
    kind = events.schema[label].dataType
    pick = events.select(F.col(entity).cast("string").alias("entity"), F.col(event_id).cast("bigint").alias("id"), F.col(label).cast("string").alias("label"), F.col(start_ms).cast("bigint").alias("start_ms"), F.col(end_ms).cast("bigint").alias("end_ms"))
    pick = pick.dropna(subset=["entity", "id", "start_ms", "end_ms"])
    rows = pick.withColumn("cell", F.floor(F.col("start_ms") / F.lit(cell_ms)).cast("bigint")).repartition("entity", "cell").distinct()
    parts = cut(rows.sortWithinPartitions("entity", "cell", "start_ms", "id").mapInArrow(_collapse(similar, least_similarity, most_gap_ms, False), RUN))
    edges = parts.where("waits").repartition("entity").sortWithinPartitions("entity", "order_ms", "first_id").mapInArrow(_collapse(similar, least_similarity, most_gap_ms, True), RUN)
    out = parts.where(~F.col("waits")).unionByName(edges)
    return out.select("entity", "first_id", "last_id", F.col("label").cast(kind).alias("label"), "n", "start_ms", "end_ms")


def _turn_runs(spark: SparkSession, d: str) -> DataFrame:
    seg = read_table(spark, d, "segments").where(usable_bounds(F.col("start_sec"), F.col("end_sec")))
    seg = seg.select("episode_key", "seg_id", speaker_number(F.col("speaker")).alias("no"), millis(F.col("start_sec")).alias("s"), millis(F.col("end_sec")).alias("e"))
    return collapse_runs(seg, "episode_key", "seg_id", "no", "s", "e")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    runs = _turn_runs(spark, d).where((F.col("n") > 1) & F.col("label").isNotNull())
    return runs.select(F.col("first_id").alias("first_seg_id"), F.col("last_id").alias("last_seg_id"))


def p4_turns(spark: SparkSession, d: str) -> DataFrame:
    """All usable turns, runs collapsed, with the number of turns and the duration."""
    return _turn_runs(spark, d).select(F.col("entity").alias("episode_key"), F.col("label").alias("speaker_no"), F.col("first_id").alias("first_seg_id"), F.col("last_id").alias("last_seg_id"), F.col("n").alias("n_turns"), "start_ms", (F.col("end_ms") - F.col("start_ms")).alias("duration_ms"))


_RUNS = f"""
WITH s AS (SELECT DISTINCT episode_key, seg_id, start_sec, end_sec, {SPEAKER_NUMBER_SQL.format(c="speaker")} AS no FROM segments WHERE end_sec > start_sec),
l AS (SELECT *, lag(no) OVER w AS prev FROM s WINDOW w AS (PARTITION BY episode_key ORDER BY start_sec, seg_id)),
g AS (SELECT *, sum(CASE WHEN no = prev THEN 0 ELSE 1 END) OVER (PARTITION BY episode_key ORDER BY start_sec, seg_id ROWS UNBOUNDED PRECEDING) AS g FROM l),
r AS (SELECT episode_key, g, max(no) AS no, arg_min(seg_id, (start_sec, seg_id)) AS a, arg_max(seg_id, (start_sec, seg_id)) AS z, count(*) AS n,
 CAST(round(min(start_sec) * 1000) AS BIGINT) AS s, CAST(round(max(end_sec) * 1000) AS BIGINT) AS e FROM g GROUP BY episode_key, g)
"""
SQL = {
    "p4_found": _RUNS + "SELECT a AS first_seg_id, z AS last_seg_id FROM r WHERE n > 1",
    "p4_turns": _RUNS + "SELECT episode_key, no AS speaker_no, a AS first_seg_id, z AS last_seg_id, n AS n_turns, s AS start_ms, e - s AS duration_ms FROM r",
}
QUERIES = {"p4_found": p4_found, "p4_turns": p4_turns}
