"""Splitting oversized items at natural boundaries (problem 1).

An item is a sequence of units with sizes. Prefix sums of the sizes give each unit's offset; the offsets at which the
item may be cut without harm are a sorted boundary array. From a piece's start the last boundary within the limit is
found by binary search; the next piece starts the overlap before it; where no boundary would bring the item forward, the
piece is cut hard at the limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.functions.keys import millis, usable_bounds
from colloquy.session import read_table


#: Sorted, disjoint, closed ranges of offsets: their starts and their ends. A single offset is both.
Ranges = tuple[np.ndarray, np.ndarray]


def cut_offsets(total: int, tiers: list[Ranges], limit: int, overlap: int) -> list[tuple[int, int, bool]]:
    """(start, end, hard) of each piece of an item of ``total``, in the unit of the offsets.

    ``tiers``: ranges of offsets to cut at, best first. Pieces are at most ``limit`` long, consecutive ones share exactly
    ``overlap``, and together they cover the item. A piece ends at the last boundary within the limit, that of the first
    tier that has one in the second half of the piece, else of the last tier if that brings the item forward; else it is
    cut hard at the limit. An item within the limit is one piece; an item of 0 is one empty piece. Raises ValueError
    unless 0 <= overlap < limit.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and less than limit")
    pieces, start = [], 0
    while total - start > limit:
        end, hard = next_cut(start, tiers, limit, overlap)
        pieces.append((start, end, hard))
        start = end - overlap
    return [*pieces, (start, total, False)]


def next_cut(start: int, tiers: list[Ranges], limit: int, overlap: int) -> tuple[int, bool]:
    """Where the piece that begins at ``start`` ends, and whether that is a hard cut."""
    for (starts, ends), least in [*((a, max(overlap, limit // 2)) for a in tiers), *((a, overlap) for a in tiers[-1:])]:
        k = int(np.searchsorted(starts, start + limit, side="right")) - 1
        if k >= 0 and (last := min(int(ends[k]), start + limit)) > start + least:
            return last, False
    return start + limit, True


class TurnCutter:
    """cut_offsets() of an item whose turns come by and by, in order of their starts: what lies behind is forgotten."""

    def __init__(self, total: int, limit: int, overlap: int):
        self.total, self.limit, self.overlap = total, limit, overlap
        self.pieces: list[tuple[int, int, bool]] = []
        self.start = self.reach = 0
        self.free: list[tuple[int, int]] = []

    def add(self, a: int, b: int) -> None:
        """A turn; the offsets at which none is under way are those of pause_offsets()."""
        if a >= self.reach:
            self.free.append((self.reach, a))
        self.reach = max(self.reach, b)
        while self.total - self.start > self.limit and a >= self.start + self.limit:
            self.cut()

    def cut(self) -> None:
        both = np.array(self.free, dtype=np.int64).reshape(-1, 2)
        free = (both[:, 0], both[:, 1])
        end, hard = next_cut(self.start, tiers_of(free, free, self.overlap), self.limit, self.overlap)
        self.pieces.append((self.start, end, hard))
        self.start = end - self.overlap
        self.free = [r for r in self.free if r[1] >= self.start]

    def end(self) -> list[tuple[int, int, bool]]:
        if self.reach <= self.total:
            self.free.append((self.reach, self.total))
        while self.total - self.start > self.limit:
            self.cut()
        return [*self.pieces, (self.start, self.total, False)]


def common(a: Ranges, b: Ranges) -> Ranges:
    """What two sets of ranges share."""
    out, i, j = [], 0, 0
    while i < len(a[0]) and j < len(b[0]):
        start, end = max(a[0][i], b[0][j]), min(a[1][i], b[1][j])
        if start <= end:
            out.append((start, end))
        if a[1][i] < b[1][j]:
            i += 1
        else:
            j += 1
    both = np.array(out, dtype=np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def tiers_of(free: Ranges, safe: Ranges, overlap: int) -> list[Ranges]:
    """Tiers from offsets that are in order (``free``) and those of them well clear of any harm (``safe``). A cut has two
    places, the piece's end and, the overlap before it, the next one's start; first those with both in order."""

    def both(r: Ranges) -> Ranges:
        if r[0] is r[1]:  # single offsets
            points = r[0][np.isin(r[0] - overlap, r[0], assume_unique=True)]
            return points, points
        return common(r, (r[0] + overlap, r[1] + overlap))

    return [both(safe), both(free), safe, free]


def silent_offsets(wave: np.ndarray, silence: float) -> tuple[Ranges, Ranges]:
    """The values of a peak wave in which nobody speaks, and those of them that follow another such."""
    quiet = np.nan_to_num(wave) <= silence
    free, safe = np.flatnonzero(quiet), np.flatnonzero(quiet & np.r_[False, quiet[:-1]])
    return (free, free), (safe, safe)


def pause_offsets(total: int, turns: list[tuple[int, int]]) -> Ranges:
    """The offsets at which no turn is under way; the turns are (start, end) from the item's start. Between turns that
    touch there is one."""
    starts, ends, reach = [], [], 0
    for a, b in sorted(turns):
        if a >= reach:
            starts.append(reach)
            ends.append(a)
        reach = max(reach, b)
    if reach <= total:
        starts.append(reach)
        ends.append(total)
    return np.array(starts, dtype=np.int64), np.array(ends, dtype=np.int64)


#: Sizes of cells of time, each four times the one before.
LEVELS = 10
PIECES = "task_id bigint, dlg_key string, episode_key string, piece_no int, n_pieces int, from_ms bigint, to_ms bigint, total_ms bigint, hard_cut boolean, by_wave boolean"


def audio_pieces(tasks: DataFrame, segments: DataFrame, limit_sec: float = 600.0, overlap_sec: float = 2.0, silence: float = 0.02, cell_ms: int = 600_000) -> DataFrame:
    """Pieces of each task's dialogue audio, one row per piece; offsets are ms from the audio's start.

    The length is that of ``dlg_wav`` at ``wav_rate``; where the wave is null (or the rate is null or not positive), that
    of ``dlg_start`` to ``dlg_end``, and pauses come from ``segments`` of the episode in that time. Tasks with neither
    are left out, as are rows without ``task_id`` or ``dlg_key``; null values in a wave count as silence. Rows delivered
    twice yield the same pieces, of which one set remains. An empty wave is one empty piece.

    Waves are cut where they are read and never shuffled. For tasks without a wave and longer than the limit, turns are
    found by an equi-join on (episode, cell of time), so that a round-the-clock episode spreads over its cells; long turns
    have larger cells, so no turn has more than a few. A task's turns then stream by in order.
    """
    limit, overlap = round(limit_sec * 1000), round(overlap_sec * 1000)
    with_wave = F.col("dlg_wav").isNotNull() & F.coalesce(F.col("wav_rate") > 0, F.lit(False))
    known = tasks.where(F.col("task_id").isNotNull() & F.col("dlg_key").isNotNull())

    def emit(ids: list, pieces: list[list[tuple[int, int, bool]]], by_wave: bool) -> pa.RecordBatch:
        rows = [(*i, k, len(ps), a, b, ps[-1][1], h, by_wave) for i, ps in zip(ids, pieces, strict=True) for k, (a, b, h) in enumerate(ps)]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
        names = [x.split()[0] for x in PIECES.split(", ")]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    def by_wave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = list(zip(*(b.column(c).to_pylist() for c in ("task_id", "dlg_key", "episode_key")), strict=True))
            waves, rates = b.column("dlg_wav"), b.column("wav_rate").to_pylist()
            starts = waves.offsets.to_numpy()
            values = waves.values.to_numpy(zero_copy_only=False)
            pieces = []
            for k, rate in enumerate(rates):
                wave = values[starts[k] : starts[k + 1]]
                # prefix sums of equal units are their numbers: offsets count values, and limits are rounded to be kept
                most, shared = limit * rate // 1000, -(-overlap * rate // 1000)
                tiers = tiers_of(*silent_offsets(wave, silence), shared) if len(wave) > most else []
                pieces.append([(a * 1000 // rate, z * 1000 // rate, h) for a, z, h in cut_offsets(len(wave), tiers, most, shared)])
            yield emit(ids, pieces, True)

    def by_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by task and start of turn; the first of a task has no turn."""
        at: tuple | None = None
        cutter: TurnCutter | None = None
        for b in batches:
            ids: list[tuple] = []
            pieces: list[list[tuple[int, int, bool]]] = []
            for *task, first, last in zip(*(b.column(c).to_pylist() for c in ("task_id", "dlg_key", "episode_key", "__s", "__e", "a", "b")), strict=True):
                if tuple(task) != at:
                    if cutter is not None:
                        ids.append(at[:3])
                        pieces.append(cutter.end())
                    at, cutter = tuple(task), TurnCutter(task[4] - task[3], limit, overlap)
                if first is not None:
                    cutter.add(first, last)
            yield emit(ids, pieces, False)
        if cutter is not None:
            yield emit([at[:3]], [cutter.end()], False)

    waves = known.where(with_wave).select("task_id", "dlg_key", "episode_key", "wav_rate", "dlg_wav").mapInArrow(by_wave, PIECES)

    bounds = known.where(~with_wave & usable_bounds(F.col("dlg_start"), F.col("dlg_end")))
    bounds = bounds.select("task_id", "dlg_key", "episode_key", millis(F.col("dlg_start")).alias("__s"), millis(F.col("dlg_end")).alias("__e")).distinct()
    long = bounds.where(F.col("__e") - F.col("__s") > limit)
    width = lambda level: F.lit(cell_ms) * F.pow(F.lit(4.0), level)
    cells = lambda a, b, w: F.explode(F.sequence(F.floor(a / w), F.floor(b / w))).alias("__cell")
    turns = segments.where(usable_bounds(F.col("start_sec"), F.col("end_sec"))).select("episode_key", millis(F.col("start_sec")).alias("__a"), millis(F.col("end_sec")).alias("__b"))
    # the least level at which a turn is at most four cells long
    level = F.greatest(F.lit(0), F.least(F.lit(LEVELS - 1), F.ceil(F.log(4.0, F.greatest(F.lit(1), F.col("__b") - F.col("__a")) / F.lit(4.0 * cell_ms))).cast("int")))
    turns = turns.withColumn("__level", level)
    turns = turns.select("*", cells(F.col("__a"), F.col("__b"), width(F.col("__level"))))
    asked = long.select("*", F.explode(F.array(*map(F.lit, range(LEVELS)))).alias("__level"))
    met = asked.select("*", cells(F.col("__s"), F.col("__e"), width(F.col("__level")))).join(turns, ["episode_key", "__level", "__cell"])
    met = met.where((F.col("__a") < F.col("__e")) & (F.col("__b") > F.col("__s")) & (F.col("__cell") == F.floor(F.greatest("__a", "__s") / width(F.col("__level")))))
    task = ["task_id", "dlg_key", "episode_key", "__s", "__e"]
    none = F.lit(None).cast("bigint")
    rows = bounds.select(*task, none.alias("a"), none.alias("b")).unionByName(met.select(*task, (F.col("__a") - F.col("__s")).alias("a"), (F.col("__b") - F.col("__s")).alias("b")))
    quiet = rows.repartition(*task).sortWithinPartitions(*task, "a", "b").mapInArrow(by_turns, PIECES)
    return waves.unionByName(quiet).dropDuplicates(["task_id", "dlg_key", "piece_no"])


def _pieces(spark: SparkSession, d: str) -> DataFrame:
    return audio_pieces(read_table(spark, d, "separation_tasks"), read_table(spark, d, "segments"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Tasks that the operator cut into more than one piece."""
    return _pieces(spark, d).where((F.col("piece_no") == 0) & (F.col("n_pieces") > 1)).select("dlg_key")


def p1_pieces(spark: SparkSession, d: str) -> DataFrame:
    return _pieces(spark, d)


def p1_held(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the pieces of each task: its length, that they cover it from 0 on, that none is longer than 600 s and
    that consecutive ones share 2 s, to the length of one value of the wave."""
    by = W.partitionBy("task_id", "dlg_key").orderBy("piece_no")  # pieces of one task
    before, first, last = F.lag("to_ms").over(by), F.col("piece_no") == 0, F.col("piece_no") == F.col("n_pieces") - 1
    at = _pieces(spark, d).withColumn("__shared", F.coalesce(before - F.col("from_ms"), F.lit(2_000)))
    ends = F.when(first, F.col("from_ms") == 0).otherwise(True) & F.when(last, F.col("to_ms") == F.col("total_ms")).otherwise(True)
    return at.groupBy("task_id", "dlg_key", "total_ms").agg((F.every(ends) & (F.count("*") == F.max("n_pieces"))).alias("covered"), F.every(F.col("to_ms") - F.col("from_ms") <= 600_000).alias("within_limit"), F.every(F.col("__shared").between(2_000, 3_000)).alias("shared"))


SQL = {
    "p1_held": """SELECT DISTINCT task_id, dlg_key, CASE WHEN dlg_wav IS NOT NULL AND wav_rate > 0 THEN CAST(len(dlg_wav) AS BIGINT) * 1000 // wav_rate ELSE CAST(round(dlg_end * 1000) AS BIGINT) - CAST(round(dlg_start * 1000) AS BIGINT) END AS total_ms,
     true AS covered, true AS within_limit, true AS shared FROM separation_tasks WHERE task_id IS NOT NULL AND dlg_key IS NOT NULL AND (dlg_wav IS NOT NULL AND wav_rate > 0 OR dlg_end > dlg_start)""",
    "p1_found": """SELECT DISTINCT dlg_key FROM separation_tasks WHERE CASE WHEN dlg_wav IS NOT NULL THEN len(dlg_wav) > 600 * wav_rate
     ELSE dlg_end > dlg_start AND CAST(round(dlg_end * 1000) AS BIGINT) - CAST(round(dlg_start * 1000) AS BIGINT) > 600000 END"""
}
QUERIES = {"p1_found": p1_found, "p1_pieces": p1_pieces, "p1_held": p1_held}
