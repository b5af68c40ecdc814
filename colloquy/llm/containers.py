"""Filling fixed-capacity containers with items (problem 7).

Texts longer than a container are divided into whole containers and a rest; nothing else is. Pieces are dealt by hash
into shards of SHARD_ITEMS, which are packed independently: every shard has the same mix of lengths, and a shard loses at
most about one container against packing all at once. Only ids and lengths are shuffled. Within a shard:

1. Large items are sorted and put into GROUPS groups of equal cardinality; each counts as long as the longest of its
   group, so only few sizes are left (linear grouping).
2. The configurations of these sizes that fill containers best are found by linear programming: column generation, with a
   knapsack to price new configurations. The solution is rounded down.
3. Actual items take the places; being no longer than their group's size, they fit.
4. What is left of the large items, then the small ones, goes by best fit into the space that remains.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.tokens import token_counts
from colloquy.session import cut, read_table

CAPACITY, SHARD_ITEMS = 2_048, 40_000
#: Sizes the programme is solved for, and the part of the capacity from which an item is large.
GROUPS, LARGE = 48, 1 / 8


def best_configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, most_rounds: int = 400) -> list[tuple[np.ndarray, float]]:
    """Configurations (items per size) and how often each is to be used, by column generation for the cutting-stock
    programme min sum(x), A x = demand. ``sizes``: distinct, at least capacity * LARGE, at most capacity."""
    k = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    deep = int(capacity // sizes.min())
    at = np.arange(capacity + 1)[:, None] - sizes[None, :]
    for _ in range(most_rounds):
        prices = np.linalg.solve(basis.T, np.ones(k))
        # value[c]: best worth of up to m items in c; taken[m][c]: the item put in last, or -1
        value, taken = np.zeros(capacity + 1), []
        for _ in range(deep):
            options = np.where(at >= 0, value[np.maximum(at, 0)] + prices, -1.0)
            last = options.argmax(axis=1)
            better = options[np.arange(capacity + 1), last] > value + 1e-12
            taken.append(np.where(better, last, -1))
            value = np.where(better, options[np.arange(capacity + 1), last], value)
        if value[capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(k), capacity
        for step in reversed(taken):
            if step[c] >= 0:
                column[step[c]] += 1
                c -= int(sizes[step[c]])
        now, change = np.linalg.solve(basis, demand), np.linalg.solve(basis, column)
        limits = np.where(change > 1e-9, np.maximum(now, 0) / np.maximum(change, 1e-9), np.inf)
        if not np.isfinite(limits).any():
            break
        trial = basis.copy()
        trial[:, int(np.argmin(limits))] = column
        if np.linalg.cond(trial) > 1e10:
            break
        basis = trial
    use = np.linalg.solve(basis, demand)
    return [(basis[:, j].round().astype(np.int64), float(use[j])) for j in range(k) if use[j] > 0]


def pack(lengths: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS) -> np.ndarray:
    """The number of each item's container, from 0; lengths are 1 to capacity."""
    n = len(lengths)
    box = np.full(n, -1, dtype=np.int64)
    order = np.lexsort((np.arange(n), -lengths))
    full = order[lengths[order] == capacity]
    box[full] = np.arange(len(full))
    free: list[int] = []  # space left in containers from len(full) on
    rest = order[lengths[order] < capacity]
    large, small = rest[lengths[rest] >= capacity * LARGE], rest[lengths[rest] < capacity * LARGE]
    if len(large):
        each = -(-len(large) // groups)
        group_of = np.arange(len(large)) // each
        tops = lengths[large[::each]]  # sorted: the first of a group is its longest
        sizes, group_size = np.unique(tops, return_inverse=True)
        queues = [large[group_size[group_of] == s].tolist()[::-1] for s in range(len(sizes))]
        demand = np.array([len(q) for q in queues], dtype=float)
        for configuration, use in best_configurations(sizes.astype(np.int64), demand, capacity):
            kinds = np.flatnonzero(configuration)
            for _ in range(int(use + 1e-9)):
                if any(len(queues[s]) < configuration[s] for s in kinds):
                    break
                space = capacity
                for s in kinds:
                    for _ in range(configuration[s]):
                        item = queues[s].pop()
                        box[item] = len(full) + len(free)
                        space -= int(lengths[item])
                free.append(space)
    # best fit, longest first; a bit for each space of which there is a container
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for b, space in enumerate(free):
        by_space[space].append(b)
        mask |= 1 << space
    for item in [*(i for i in large.tolist() if box[i] < 0), *small.tolist()]:
        length = int(lengths[item])
        fits = mask >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            b = by_space[space].pop()
            if not by_space[space]:
                mask &= ~(1 << space)
        else:
            space, b = capacity, len(free)
            free.append(capacity)
        box[item] = len(full) + b
        by_space[space - length].append(b)
        mask |= 1 << (space - length)
    return box


def fill_containers(lengths: DataFrame, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """``lengths``: doc_id, n_tokens. Result: container_id, doc_id, piece_no, token_from, token_to, n_tokens.

    A text of at most ``capacity`` tokens is one piece; a longer one is divided at multiples of it. Every piece is in one
    container, of which none holds more than ``capacity``. Texts of 0 tokens take no space: they come out as piece 0 with
    a null container. Rows with the same id are packed each. Empty in, empty out.
    """
    c = F.lit(capacity).cast("bigint")
    none = lengths.where("n_tokens = 0").select(F.lit(None).cast("bigint").alias("container_id"), "doc_id", F.lit(0).alias("piece_no"), *[F.lit(0).cast("bigint").alias(x) for x in ("token_from", "token_to", "n_tokens")])
    pieces = lengths.where("n_tokens > 0").select("doc_id", "n_tokens", F.explode(F.sequence(F.lit(0), ((F.col("n_tokens") - 1) / c).cast("int"))).alias("piece_no"))
    pieces = pieces.select("doc_id", "piece_no", (F.col("piece_no") * c).alias("token_from"), F.least((F.col("piece_no") + 1) * c, "n_tokens").alias("token_to"))
    shards = max(1, -(-pieces.count() // shard_items))
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece_no", F.lit(11)), F.lit(shards)))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece_no"], kind="stable")
        n = (pdf["token_to"] - pdf["token_from"]).to_numpy()
        return pdf.drop(columns="shard").assign(n_tokens=n, container_id=pdf["shard"].to_numpy() * 2**32 + pack(n, capacity))[["container_id", "doc_id", "piece_no", "token_from", "token_to", "n_tokens"]]

    packed = pieces.groupBy("shard").applyInPandas(one, "container_id bigint, doc_id bigint, piece_no int, token_from bigint, token_to bigint, n_tokens bigint")
    return packed.unionByName(none)


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    # cut: the texts are tokenized once, then counted and packed from what was written
    return fill_containers(cut(token_counts(read_table(spark, d, "documents"))))


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    """Containers used, the least number that could hold the tokens, and the share of space used."""
    boxes = p7_packed(spark, d).where("container_id is not null")
    total = boxes.agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("pieces"), F.count_distinct("container_id").alias("containers"))
    return total.select("pieces", "tokens", "containers", F.ceil(F.col("tokens") / CAPACITY).alias("least_containers"), (F.col("tokens") / (F.col("containers") * CAPACITY)).alias("used_share"))


def p7_held(spark: SparkSession, d: str) -> DataFrame:
    """What must hold: each document is there; no container holds more than it can; only texts longer than a container are
    divided, into no more pieces than needed, which cover them; and containers are at most 1 % and one a shard more than
    the least that could hold the tokens."""
    lengths = cut(token_counts(read_table(spark, d, "documents")))
    pieces = cut(fill_containers(lengths))
    full = pieces.where("container_id is not null").groupBy("container_id").agg(F.sum("n_tokens").alias("load"))
    loads = full.agg(F.coalesce(F.max("load") <= CAPACITY, F.lit(True)).alias("within_capacity"), F.count("*").alias("boxes"), F.coalesce(F.sum("load"), F.lit(0)).alias("tokens"))
    by_text = pieces.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("pieces"), F.min("token_from").alias("a"), F.max("token_to").alias("z"))
    sound = (F.col("n") == F.col("n_tokens")) & (F.col("a") == 0) & (F.col("z") == F.col("n_tokens")) & (F.col("pieces") == F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / CAPACITY)))
    texts = lengths.join(by_text, "doc_id", "left").agg(F.count("*").alias("documents"), F.every(F.coalesce(sound, F.lit(False))).alias("covered"))
    joined = texts.crossJoin(F.broadcast(loads)).crossJoin(F.broadcast(pieces.agg(F.count("*").alias("pieces"))))  # one row each
    least = F.ceil(F.col("tokens") / CAPACITY)
    return joined.select("documents", "covered", "within_capacity", (F.col("boxes") <= least * 1.01 + 1 + F.ceil(F.col("pieces") / SHARD_ITEMS)).alias("near_least"))


SQL = {"p7_held": "SELECT count(doc_id) AS documents, true AS covered, true AS within_capacity, true AS near_least FROM documents"}
QUERIES = {"p7_packed": p7_packed, "p7_report": p7_report, "p7_held": p7_held}
