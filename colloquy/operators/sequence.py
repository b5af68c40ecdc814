"""Operators over ordered turns.

Turns have an entity (``episode_key``), an id that breaks ties, a speaker and integer ``start``/``end``. Order is always
(start, id). What can be told from neighbours is computed cell by cell of time, so one endless episode is spread over
tasks; what needs a state (which two speakers a run has) is a scan in constant memory over silence-bounded groups, in parts.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.operators.prefix import running_before, with_previous
from colloquy.session import cut

HOUR_MS = 3_600_000
TURN = ["episode_key", "turn_id", "speaker", "start_ms", "end_ms"]


def gap_groups(turns: DataFrame, gap_ms: int) -> DataFrame:
    """The distinct turns with ``group_no`` (from 0) and ``opens``, the group's first turn: a new group begins where a turn
    starts ``gap_ms`` or more after the end of the turn before it, whatever the ends of earlier ones. Turns without an
    episode, id or bounds are left out.

    One shuffle by (episode, cell of time). Within a cell neighbours are compared directly; each cell's first start, last
    end and number of breaks then tell whether its first turn begins a group and how many came before it.
    """
    at, order = ["episode_key", "__cell"], ["start_ms", "turn_id"]
    rows = turns.where("start_ms is not null and end_ms is not null and turn_id is not null").withColumn("__cell", F.floor(F.col("start_ms") / HOUR_MS))
    rows = rows.where("episode_key is not null and __cell is not null").repartition(*at).distinct()
    within = W.partitionBy(*at).orderBy(*order)
    ended = F.lag("end_ms").over(within)
    rows = rows.withColumn("__new", F.coalesce((F.col("start_ms") - ended >= gap_ms).cast("int"), F.lit(0))).withColumn("__heads", ended.isNull())
    # the last row with all its columns: so that both uses of the shuffle read the same columns, and it runs once
    last = F.max(F.struct(*order, *[c for c in turns.columns if c not in (*at, *order)]))
    cells = rows.groupBy(*at).agg(F.sum("__new").alias("__n"), F.min("start_ms").alias("__from"), last.alias("__last"))
    over = W.partitionBy("episode_key").orderBy("__cell")
    earlier = F.lag(F.col("__last.end_ms")).over(over)
    cells = cells.withColumn("__first", F.coalesce((F.col("__from") - earlier >= gap_ms).cast("int"), F.lit(0))).withColumn("__apart", F.coalesce(F.col("__from") - earlier >= gap_ms, F.lit(True)))
    before = F.coalesce(F.sum(F.col("__n") + F.col("__first")).over(over.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cells = cells.select(*at, (before + F.col("__first")).alias("__base"), "__apart")
    numbered = rows.withColumn("__in", F.sum("__new").over(within.rowsBetween(W.unboundedPreceding, 0))).join(cells, at).withColumn("group_no", F.col("__base") + F.col("__in"))
    return numbered.withColumn("opens", (F.col("__new") == 1) | F.col("__heads") & F.col("__apart")).drop("__new", "__in", "__base", "__cell", "__heads", "__apart")


def groups_of(grouped: DataFrame) -> DataFrame:
    """One row per group: number of turns and speakers, start of the first and end of the last turn."""
    order = F.struct("start_ms", "turn_id")
    return grouped.groupBy("episode_key", "group_no").agg(F.count("*").alias("n_turns"), F.count_distinct("speaker").alias("n_speakers"), F.min("start_ms").alias("start_ms"), F.max_by("end_ms", order).alias("end_ms"))


class Dialogue:
    """The state of two_speaker_scan() in a group: the run under way, its chunk, where that began, and who speaks."""

    __slots__ = ("begun", "chunk", "max_ms", "run", "speakers")

    def __init__(self, max_ms: int) -> None:
        self.max_ms = max_ms

    def start(self, run: int, speaker: str, start: int) -> None:
        self.run, self.chunk, self.begun, self.speakers = run, 0, start, {speaker}

    def take(self, speaker: str, start: int, end: int, first: bool = False) -> tuple[int, int, int]:
        """run_no, chunk_no and chunk_from of the next turn; ``first``: start() was called for it."""
        if not first:
            if speaker in self.speakers or len(self.speakers) < 2:
                self.speakers.add(speaker)
            else:
                self.start(self.run + 1, speaker, start)
        at = self.run, self.chunk, self.begun
        if end - self.begun >= self.max_ms:
            self.chunk, self.begun = self.chunk + 1, end
        return at


#: What becomes of a turn: its numbers are final; they follow from those of its part; they need all turns before it. Last
#: comes what its part leaves behind.
FINAL, RELATIVE, WAITING, LEFT = range(4)
SCAN = {
    "episode_key": pa.string(), "group_no": pa.int64(), "turn_id": pa.int64(), "speaker": pa.string(), "start_ms": pa.int64(), "end_ms": pa.int64(), "run_no": pa.int64(), "chunk_no": pa.int64(), "chunk_from": pa.int64(),
    "part": pa.int64(), "way": pa.int32(), "other": pa.string(),
}
SCANNED = ", ".join(f"{k} {({pa.string(): 'string', pa.int64(): 'bigint', pa.int32(): 'int'})[t]}" for k, t in SCAN.items())


def _scan_parts(max_ms: int):
    """mapInArrow over rows sorted by (episode, group, part, start, id): parts of groups, each from its own turns alone.

    A part that opens its group is final. In any other, a run certainly begins at a speaker who follows the pattern x y x
    and isn't y: whoever spoke before, x and y were of one run. From there on numbers count from that run's; turns before
    wait."""
    schema = pa.schema(list(SCAN.items()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        state, way, recent = Dialogue(max_ms), WAITING, (None, None, None)

        def left() -> tuple:
            """What a part leaves: the state, relative to its first certain run; null numbers if it has none."""
            if way == WAITING:
                return (*at[:2], None, None, None, None, None, None, None, at[2], LEFT, None)
            a, b = (sorted(state.speakers) + [None])[:2]
            return (*at[:2], int(way == FINAL), a, None, None, state.run, state.chunk, state.begun, at[2], LEFT, b)

        for batch in batches:
            out = []
            for episode, group, turn, speaker, start, end, part, opens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                first = False
                if (episode, group, part) != at:
                    if at is not None:
                        out.append(left())
                    at, way, recent = (episode, group, part), FINAL if opens else WAITING, (None, None, None)
                    if opens:
                        state.start(0, speaker, start)
                        first = True
                if way == WAITING and speaker != recent[0]:
                    x, y, z = recent  # the three blocks of one speaker's turns before, the latest first
                    if z is not None and x == z and speaker != y:
                        way, first = RELATIVE, True
                        state.start(0, speaker, start)
                    recent = (speaker, x, y)
                numbers = (None, None, None) if way == WAITING else state.take(speaker, start, end, first)
                out.append((episode, group, turn, speaker, start, end, *numbers, part, way, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), SCAN.values(), strict=True)], schema=schema) if out else pa.RecordBatch.from_pylist([], schema)
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(left(), SCAN.values(), strict=True)], schema=schema)

    return scan


def _scan_waiting(max_ms: int):
    """mapInArrow over what waits and what parts leave, sorted by (episode, group, part, way, start, id): the numbers of
    turns that waited, and, as LEFT, in run_no, the number of each part's first certain run."""
    schema = pa.schema(list(SCAN.items()))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Dialogue(max_ms)
        for batch in batches:
            out = []
            for episode, group, turn, speaker, start, end, run, chunk, begun, part, way, other in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if way == WAITING:
                    out.append((episode, group, turn, speaker, start, end, *state.take(speaker, start, end), part, FINAL, None))
                elif run is not None:
                    base = 0 if turn else state.run + 1
                    state.run, state.chunk, state.begun, state.speakers = base + run, chunk, begun, {x for x in (speaker, other) if x is not None}
                    out.append((episode, group, None, None, None, None, base, None, None, part, LEFT, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), SCAN.values(), strict=True)], schema=schema) if out else pa.RecordBatch.from_pylist([], schema)

    return scan


def two_speaker_scan(grouped: DataFrame, max_ms: int, part_ms: int = HOUR_MS) -> DataFrame:
    """Adds ``run_no``, ``chunk_no`` and ``chunk_from`` to turns of gap_groups().

    Within a group a run goes on while its turns have at most two speakers; a third closes it and begins the next with
    that turn only. Within a run a chunk closes with the turn whose end lies ``max_ms`` or more after the chunk's start,
    and the next one starts at that end. Speakers aren't null.

    Groups are scanned in parts of ``part_ms``, so a stream without a silence is spread over its hours. Only turns whose
    numbers depend on earlier parts wait for a second scan by group, in constant memory, which for the others adds a number
    a part: those before the first run that is certain to begin there. That is all of a part only if two speakers go on
    between themselves for its whole length.
    """
    rows = grouped.select("episode_key", F.col("group_no").cast("bigint").alias("group_no"), F.col("turn_id").cast("bigint").alias("turn_id"), F.col("speaker").cast("string").alias("speaker"), "start_ms", "end_ms", F.floor(F.col("start_ms") / part_ms).cast("bigint").alias("part"), "opens")
    # cut: the rows are used by what becomes of them
    scanned = cut(rows.repartition("episode_key", "group_no", "part").sortWithinPartitions("episode_key", "group_no", "part", "start_ms", "turn_id").mapInArrow(_scan_parts(max_ms), SCANNED))
    group, names = ["episode_key", "group_no"], list(SCAN)[:9]
    waiting = scanned.where(F.col("way") >= WAITING).repartition(*group).sortWithinPartitions(*group, "part", "way", "start_ms", "turn_id").mapInArrow(_scan_waiting(max_ms), SCANNED)
    waited = waiting.where(F.col("way") == FINAL)
    bases = waiting.where(F.col("way") == LEFT).select(*group, "part", F.col("run_no").alias("__base"))
    later = scanned.where(F.col("way") == RELATIVE).join(bases, [*group, "part"]).withColumn("run_no", F.col("run_no") + F.col("__base"))
    return scanned.where(F.col("way") == FINAL).select(*names).unionByName(later.select(*names)).unionByName(waited.select(*names))


def runs_of(scanned: DataFrame) -> DataFrame:
    """One row per run of exactly two speakers."""
    at = ["episode_key", "group_no", "run_no"]
    runs = scanned.groupBy(*at).agg(F.count("*").alias("n_turns"), F.min("speaker").alias("speaker_a"), F.max("speaker").alias("speaker_b"), F.count_distinct("speaker").alias("__n"), F.min("start_ms").alias("start_ms"), F.max_by("end_ms", F.struct("start_ms", "turn_id")).alias("end_ms"))
    return runs.where("__n = 2").drop("__n")


def chunks_of(scanned: DataFrame, min_ms: int, max_ms: int) -> DataFrame:
    """One row per chunk of the two-speaker runs that last ``min_ms`` or more: a run of at most ``max_ms`` is one chunk, a
    longer one is cut, and a rest shorter than ``min_ms`` dropped. ``top_ms`` and ``total_ms``: turn time of the speaker
    with most of it, and of all."""
    run = ["episode_key", "group_no", "run_no"]
    whole = W.partitionBy(*run)  # silence bounds it
    rows = scanned.withColumn("__from", F.min("start_ms").over(whole)).withColumn("__to", F.max(F.struct("start_ms", "turn_id", "end_ms")).over(whole)["end_ms"])
    # a run has one speaker or two
    rows = rows.withColumn("__two", ~F.min("speaker").over(whole).eqNullSafe(F.max("speaker").over(whole))).where(F.col("__two") & (F.col("__to") - F.col("__from") >= min_ms))
    long = F.col("__to") - F.col("__from") > max_ms
    rows = rows.withColumn("chunk_no", F.when(long, F.col("chunk_no")).otherwise(0)).withColumn("chunk_from", F.when(long, F.col("chunk_from")).otherwise(F.col("__from")))
    spoken = rows.groupBy(*run, "chunk_no", "chunk_from", "speaker").agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("ms"), F.count("*").alias("n"), F.max(F.struct("start_ms", "turn_id", "end_ms")).alias("last"))
    chunks = spoken.groupBy(*run, "chunk_no", "chunk_from").agg(F.sum("n").alias("n_turns"), F.max("ms").alias("top_ms"), F.sum("ms").alias("total_ms"), F.count("*").alias("n_speakers"), F.max("last")["end_ms"].alias("end_ms"))
    return chunks.where(F.col("end_ms") - F.col("chunk_from") >= min_ms).withColumnRenamed("chunk_from", "start_ms")


def is_balanced(top: Column, total: Column, most_share: float) -> Column:
    """No speaker has more than ``most_share`` of the turn time; false where there is none."""
    return (total > 0) & (top / F.when(total > 0, total) <= most_share)


def valid_dialogues(turns: DataFrame, gap_ms: int = 5_000, most_share: float = 0.8, min_ms: int = 10_000, max_ms: int = 600_000) -> DataFrame:
    """Balanced two-speaker dialogues, numbered from 0 within their episode in order of time."""
    chunks = chunks_of(two_speaker_scan(gap_groups(turns, gap_ms), max_ms), min_ms, max_ms)
    # cut: the numbers need the dialogues twice, and they are few beside the turns
    kept = cut(chunks.where(is_balanced(F.col("top_ms"), F.col("total_ms"), most_share)).withColumn("__cell", F.col("group_no")))
    numbered = running_before(kept, ["episode_key"], "__cell", [F.col("run_no"), F.col("chunk_no")], F.lit(1), "dialogue_idx")
    return numbered.select("episode_key", F.col("dialogue_idx").cast("bigint").alias("dialogue_idx"), "group_no", "run_no", "chunk_no", "n_turns", "start_ms", "end_ms")


def episodes_with(rows: DataFrame, least: int, key: str = "episode_key") -> DataFrame:
    """The rows of keys that have at least ``least``."""
    enough = rows.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") >= least).select(key)
    return rows.join(enough, key, "left_semi")


def first_appearance(turns: DataFrame) -> DataFrame:
    """Per episode and speaker a label by order of first appearance: SPEAKER_00, SPEAKER_01, ... Ranked over speakers, not
    turns."""
    first = turns.groupBy("episode_key", "speaker").agg(F.min(F.struct("start_ms", "turn_id")).alias("first"), F.count("*").alias("n_turns"))
    rank = F.row_number().over(W.partitionBy("episode_key").orderBy("first")) - 1
    return first.select("episode_key", "speaker", F.format_string("SPEAKER_%02d", rank).alias("label"), F.col("first.start_ms").alias("first_ms"), "n_turns")


def _chunk_tables(max_ms: int):
    """mapInArrow over periods sorted by (episode, part, start): for each part what the chunk under way before it does to the
    one under way after it. ``until``, ascending, and ``begun``: a chunk that began before until[k], but no earlier one, is
    followed in the end by the one that begins at begun[k]; one that began later still goes on. There are only as many as
    periods within the first ``max_ms``."""
    schema = pa.schema([("episode_key", pa.string()), ("part", pa.int64()), ("until", pa.list_(pa.int64())), ("begun", pa.list_(pa.int64()))])

    def made(at: tuple, starts: list[int], ends: list[int]) -> tuple:
        s, e = np.array(starts), np.array(ends)
        n = len(s)
        following = np.maximum(np.searchsorted(e, s + max_ms, side="right"), np.arange(n) + 1).tolist()
        last = starts.copy()  # the start of the last chunk of the part, if one begins at each period
        for k in range(n - 1, -1, -1):
            if following[k] < n:
                last[k] = last[following[k]]
        known = min(n, int(np.searchsorted(e, s[0] + max_ms, side="left")) + 1)
        return (*at, (e[:known] - max_ms).tolist(), last[:known])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        starts: list[int] = []
        ends: list[int] = []
        for b in batches:
            out = []
            for episode, part, start, end in zip(*(b.column(c).to_pylist() for c in ("episode_key", "part", "period_start", "period_end")), strict=True):
                if (episode, part) != at:
                    if at is not None:
                        out.append(made(at, starts, ends))
                    at, starts, ends = (episode, part), [], []
                starts.append(start)
                ends.append(end)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(made(at, starts, ends), schema, strict=True)], schema=schema)

    return run


def _entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over _chunk_tables() sorted by (episode, part): where the chunk under way before each part began, null at the first."""
    episode, begun = None, None
    for b in batches:
        out = []
        for own, until, last in zip(*(b.column(c).to_pylist() for c in ("episode_key", "until", "begun")), strict=True):
            if own != episode:
                episode, begun = own, None
            out.append(begun)
            k = 0 if begun is None else bisect_right(until, begun)
            begun = last[k] if k < len(last) else begun
        yield pa.record_batch([b.column("episode_key"), b.column("part"), pa.array(out, pa.int64())], ["episode_key", "part", "entered"])


def _packed(max_ms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, begun = None, None
        for b in batches:
            out = []
            for episode, part, start, end, entered in zip(*(b.column(c).to_pylist() for c in ("episode_key", "part", "period_start", "period_end", "entered")), strict=True):
                if (episode, part) != at:
                    at, begun = (episode, part), entered
                if begun is None or end - begun > max_ms:
                    begun = start
                out.append(begun)
            yield pa.record_batch([b.column("episode_key"), b.column("period_end"), pa.array(out, pa.int64())], ["episode_key", "period_end", "chunk_start"])

    return run


def pack_periods(periods: DataFrame, max_ms: int, part_ms: int = HOUR_MS) -> DataFrame:
    """Consecutive periods packed into chunks: a period joins the chunk while its end lies at most ``max_ms`` after the
    chunk's start, else it begins the next. ``periods``: episode_key, period_start, period_end, apart from each other.

    An episode is packed in parts of ``part_ms``: each part tells what it makes of any chunk that may be under way before
    it; put together along the episode, one row a part, that tells which one is, and each part is packed by itself.
    """
    at = ["episode_key", "part"]
    rows = periods.where("episode_key is not null").select("episode_key", "period_start", "period_end", F.floor(F.col("period_start") / part_ms).cast("bigint").alias("part"))
    rows = cut(rows.repartition(*at).sortWithinPartitions(*at, "period_start"))
    tables = rows.mapInArrow(_chunk_tables(max_ms), "episode_key string, part bigint, until array<bigint>, begun array<bigint>")
    entered = tables.repartition("episode_key").sortWithinPartitions(*at).mapInArrow(_entered, "episode_key string, part bigint, entered bigint")
    placed = rows.join(entered, at).repartition(*at).sortWithinPartitions(*at, "period_start")
    chunked = placed.mapInArrow(_packed(max_ms), "episode_key string, period_end bigint, chunk_start bigint")
    return chunked.groupBy("episode_key", "chunk_start").agg(F.max("period_end").alias("chunk_end"), F.count("*").alias("n_periods"))


def take_until(rows: DataFrame, keys: list[str], cell: str, order: list[str], amount: str, target: float | int) -> DataFrame:
    """The rows before which the sum of ``amount`` (null: 0) is still below ``target``; the row that crosses it stays."""
    value = F.coalesce(F.col(amount), F.lit(0))
    return running_before(rows, keys, cell, [F.col(c) for c in order], value, "__sum").where(F.col("__sum") < target).drop("__sum")


def exchanges(turns: DataFrame) -> DataFrame:
    """Turns whose speaker isn't that of the turn before, with ``overlaps``: it starts before the other has ended.
    ``turns``: episode_key, speaker, start_ms, end_ms, each speaker's turns apart from each other; ties: the lesser speaker
    first."""
    rows = turns.withColumn("__cell", F.floor(F.col("start_ms") / HOUR_MS))
    before = with_previous(rows, ["episode_key"], "__cell", ["start_ms", "end_ms", "speaker"], ["speaker", "end_ms"], "__prev")
    return before.where(F.col("speaker") != F.col("__prev.speaker")).select("episode_key", "speaker", "start_ms", "end_ms", (F.col("start_ms") < F.col("__prev.end_ms")).alias("overlaps"))
