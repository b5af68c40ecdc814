"""Mixing sources to target weights (problem 8).

Sainte-Lague apportionment: blocks of equal tokens go one after the other to the source with the highest quotient
share / (2 * blocks so far + 1), as long as the source has any left within its repeats. A source's blocks are divided
among its shards in the same way, weighted by their tokens, so that every shard has an integer quota. Within a shard,
documents stand in an order given by a seeded hash and are cut into blocks at the middle of a document; a shard whose
quota is more than its blocks is used in whole passes, and the blocks that remain come from the front of that order.
As documents are used whole, a source may end half a document off its share; one document a source, that whose length
comes nearest to the difference, is then added or taken out once.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.llm.tokens import token_counts
from colloquy.operators.prefix import running_before
from colloquy.session import cut, read_table

#: A block has 1 / BLOCKS of the mix, but at most MOST_BLOCK_TOKENS.
BLOCKS, MOST_BLOCK_TOKENS = 4_096, 2_048
#: A shard has about this many tokens; a source has at most MOST_SHARDS shards, so plans stay small. Larger shards are
#: ordered in cells of about SHARD_TOKENS each.
SHARD_TOKENS, MOST_SHARDS = 8_000_000, 1_000


def sainte_lague(weights: list[float], seats: int, caps: list[int]) -> list[int]:
    """Seats per weight by highest quotients weight / (2 * seats so far + 1), none above its cap; ties go to the first.
    Weights of 0 get none. Work doesn't grow with the seats: a bisection finds a quotient that all but a few seats reach,
    and only those few are dealt one by one."""
    exact = [Fraction(w) if w > 0 and c > 0 else Fraction(0) for w, c in zip(weights, caps, strict=True)]
    seats = min(seats, sum(c for w, c in zip(exact, caps, strict=True) if w))
    if seats <= 0:
        return [0] * len(weights)

    def dealt(level: Fraction) -> list[int]:
        """Seats whose quotient is at least ``level``."""
        return [min(c, int((w / level + 1) / 2)) for w, c in zip(exact, caps, strict=True)]

    low, high = min(w for w in exact if w) / (2 * seats + 1), 2 * max(exact)
    while sum(dealt(low)) < seats:  # caps may leave the seats to a small weight
        low /= 2
    while high - low > high / 2**60 and sum(dealt(high)) + len(exact) < seats:
        middle = Fraction(float((low + high) / 2))
        low, high = (middle, high) if sum(dealt(middle)) > seats else (low, middle)
    out = dealt(high)
    queue = [(-w / (2 * n + 1), k) for k, (w, n) in enumerate(zip(exact, out, strict=True)) if w and n < caps[k]]
    heapq.heapify(queue)
    for _ in range(seats - sum(out)):
        _, k = heapq.heappop(queue)
        out[k] += 1
        if out[k] < caps[k]:
            heapq.heappush(queue, (-exact[k] / (2 * out[k] + 1), k))
    return out


def largest_mix(tokens: list[int], shares: list[float], repeats: list[int]) -> int:
    """The most tokens a mix can have in which every source that has any keeps its share: beyond it, some source would
    run out of repeats and fall behind its target."""
    have = [k for k, n in enumerate(tokens) if n * repeats[k] > 0 and shares[k] > 0]
    total = sum(shares[k] for k in have)
    return int(min((tokens[k] * repeats[k] * total / shares[k] for k in have), default=0))


def mix(lengths: DataFrame, targets: DataFrame, total_tokens: int | None = None, block_tokens: int | None = None, seed: int = 5) -> DataFrame:
    """``lengths``: doc_id, source, n_tokens; ``targets``: source, target_share, max_repeats. Result: doc_id, source,
    n_tokens, repeats, one row for each document the mix uses.

    ``total_tokens`` (None: largest_mix()) is divided over the sources that have tokens in the proportion of their
    shares; where a source's repeats don't suffice, the others fill up by their quotients. Documents of no source, of one
    without a target, or of 0 tokens aren't used. Targets are few, and collected; a null share or repeats is 0; of a
    source that is listed twice the larger share counts. Empty documents give an empty mix.
    """
    plan = targets.where("source is not null").groupBy("source").agg(F.max(F.coalesce("target_share", F.lit(0.0))).alias("share"), F.max(F.coalesce("max_repeats", F.lit(0))).alias("repeats")).orderBy("source").collect()
    spark, names = lengths.sparkSession, [r["source"] for r in plan]
    docs = lengths.select("doc_id", "source", "n_tokens").where((F.col("n_tokens") > 0) & F.col("source").isin(names))
    sums = {r["source"]: r["n"] for r in docs.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    have = [sums.get(x, 0) for x in names]
    shares, repeats = [r["share"] for r in plan], [r["repeats"] for r in plan]
    total = largest_mix(have, shares, repeats) if total_tokens is None else total_tokens
    block_tokens = block_tokens or min(MOST_BLOCK_TOKENS, max(1, total // BLOCKS))
    blocks = sainte_lague([s if n else 0 for s, n in zip(shares, have, strict=True)], round(total / block_tokens), [-(-n * r // block_tokens) for n, r in zip(have, repeats, strict=True)])

    shards = {x: min(MOST_SHARDS, max(1, n // SHARD_TOKENS)) for x, n in zip(names, have, strict=True)}
    per_source = spark.createDataFrame([(x, shards[x]) for x in names], "source string, shards bigint")
    placed = docs.join(F.broadcast(per_source), "source").withColumn("__h", F.xxhash64("doc_id", F.lit(seed))).withColumn("shard", F.pmod(F.col("__h"), "shards"))
    placed = cut(placed.drop("shards"))
    rows = placed.groupBy("source", "shard").agg(F.sum("n_tokens").alias("n")).collect()  # at most MOST_SHARDS a source
    by_source: dict[str, list] = {x: [] for x in names}
    for r in sorted(rows, key=lambda r: (r["source"], r["shard"])):
        by_source[r["source"]].append(r)
    table = []
    for x, quota, most in zip(names, blocks, repeats, strict=True):
        own = by_source[x]
        each = sainte_lague([float(r["n"]) for r in own], quota, [-(-r["n"] * most // block_tokens) for r in own])
        for r, q in zip(own, each, strict=True):
            wanted = min(q * block_tokens, r["n"] * most)
            passes = wanted // r["n"]
            table.append((x, r["shard"], int(passes), round((wanted - passes * r["n"]) / block_tokens), int(most)))
    quotas = spark.createDataFrame(table, "source string, shard bigint, passes bigint, more_blocks bigint, most bigint")
    # the leading bits of the hash: cells of about SHARD_TOKENS, in the order of the hash
    bits = max(0, (max((r["n"] for r in rows), default=0) // SHARD_TOKENS).bit_length())
    cell = F.shiftright("__h", 64 - bits) if bits else F.lit(0).cast("bigint")
    ordered = running_before(placed.withColumn("__cell", cell), ["source", "shard"], "__cell", [F.col("__h"), F.col("doc_id")], F.col("n_tokens"), "__before")
    block = F.floor((F.col("__before") + F.col("n_tokens") / 2) / block_tokens)
    dealt = ordered.withColumn("__block", block).join(F.broadcast(quotas), ["source", "shard"])
    count = F.least(F.col("passes") + F.when(F.col("__block") < F.col("more_blocks"), 1).otherwise(0), "most")
    dealt = cut(dealt.select("doc_id", "source", "n_tokens", count.cast("bigint").alias("repeats"), "most"))
    return _settled(dealt, dict(zip(names, (b * block_tokens for b in blocks), strict=True))).where("repeats > 0")


def _settled(dealt: DataFrame, wanted: dict[str, int]) -> DataFrame:
    """Adds or takes out, once for each source, the document that brings its tokens nearest to those wanted."""
    spark = dealt.sparkSession
    got = {r["source"]: r["n"] for r in dealt.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("n")).collect()}
    off = spark.createDataFrame([(x, int(w - got[x])) for x, w in wanted.items() if x in got], "source string, off bigint")
    near = F.struct(F.abs(F.col("n_tokens") - F.abs("off")).alias("d"), F.col("doc_id"))
    can = F.when(F.col("off") > 0, F.col("repeats") < F.col("most")).otherwise(F.col("repeats") > 0)
    best = dealt.join(F.broadcast(off), "source").where(can).groupBy("source", "off").agg(F.min(near).alias("best")).where("best.d < abs(off)")
    # one row a source at most
    change = best.select("source", F.col("best.doc_id").alias("doc_id"), F.signum("off").cast("bigint").alias("change"))
    joined = dealt.join(F.broadcast(change), ["source", "doc_id"], "left")
    return joined.select("doc_id", "source", "n_tokens", (F.col("repeats") + F.coalesce("change", F.lit(0))).alias("repeats"))


def shares_of(mixed: DataFrame, targets: DataFrame, lengths: DataFrame | None = None) -> DataFrame:
    """Per target source: target_share, documents, tokens and actual_share of the mix; 0 where the mix has none of it.
    With ``lengths``, what the mix was made of, also available_tokens, used_tokens, each document once, and their
    quotient used_part, 0 where nothing is available."""
    used = mixed.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.max("repeats").alias("most_repeats"))
    joined = targets.select("source", "target_share", "max_repeats").join(used, "source", "left").fillna(0, ["documents", "tokens", "most_repeats"])
    all_tokens = F.sum("tokens").over(W.partitionBy(F.lit(0)))  # over the few targets
    joined = joined.withColumn("actual_share", F.when(all_tokens > 0, F.col("tokens") / all_tokens).otherwise(0.0))
    if lengths is None:
        return joined
    used_once = mixed.groupBy("source").agg(F.sum("n_tokens").alias("used_tokens"))
    there = lengths.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"))
    joined = joined.join(there, "source", "left").join(used_once, "source", "left").fillna(0, ["available_tokens", "used_tokens"])
    return joined.withColumn("used_part", F.when(F.col("available_tokens") > 0, F.col("used_tokens") / F.nullif("available_tokens", F.lit(0))).otherwise(0.0))


def _lengths(spark: SparkSession, d: str) -> DataFrame:
    return cut(token_counts(read_table(spark, d, "documents"), keep=("source",)))


def p8_mixed(spark: SparkSession, d: str) -> DataFrame:
    return mix(_lengths(spark, d), read_table(spark, d, "mix_targets"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    lengths, targets = _lengths(spark, d), read_table(spark, d, "mix_targets")
    return shares_of(mix(lengths, targets), targets, lengths)


def _all_tokens(lengths: DataFrame) -> int:
    return lengths.agg(F.sum("n_tokens")).first()[0] or 0


def p8_corpus(spark: SparkSession, d: str) -> DataFrame:
    """A mix as large as the corpus: where repeats don't suffice for a source's share, others fill up."""
    lengths, targets = _lengths(spark, d), read_table(spark, d, "mix_targets")
    return shares_of(mix(lengths, targets, total_tokens=_all_tokens(lengths)), targets, lengths)


def p8_held(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of the mix as large as it can be at its targets (``whole`` false) and of that of the corpus's size: no
    document too often; every source that has tokens within 2 % of all of its share, or within half of its shortest
    document, as documents are used whole; in the second mix also used up or above its share."""
    lengths, targets = _lengths(spark, d), read_table(spark, d, "mix_targets")
    own, whole = mix(lengths, targets), mix(lengths, targets, total_tokens=_all_tokens(lengths))
    has = F.col("available_tokens") * F.col("max_repeats") > 0
    there = F.sum(F.when(has, F.col("target_share")).otherwise(0.0)).over(W.partitionBy(F.lit(0)))  # over the few targets
    everything = F.sum("tokens").over(W.partitionBy(F.lit(0)))
    off = F.col("tokens") - everything * F.col("target_share") / F.nullif(there, F.lit(0.0))
    bearable = F.greatest(everything * 0.02, F.col("shortest") / 2)
    shortest = lengths.where("n_tokens > 0").groupBy("source").agg(F.min("n_tokens").alias("shortest"))
    shared = lambda mixed: shares_of(mixed, targets, lengths).join(shortest, "source", "left")
    often = F.col("most_repeats") <= F.col("max_repeats")
    small = shared(own).select("source", F.lit(False).alias("whole"), often.alias("within_repeats"), (~has | F.coalesce(F.abs(off) <= bearable, F.lit(False))).alias("share_held"))
    used_up = F.col("tokens") >= F.col("available_tokens") * F.col("max_repeats") * 0.98
    large = shared(whole).select("source", F.lit(True).alias("whole"), often.alias("within_repeats"), (~has | used_up | F.coalesce(off >= -bearable, F.lit(False))).alias("share_held"))
    return small.unionByName(large)


SQL = {"p8_held": "SELECT source, w AS whole, true AS within_repeats, true AS share_held FROM mix_targets, (SELECT false AS w UNION ALL SELECT true)"}
QUERIES = {"p8_mixed": p8_mixed, "p8_shares": p8_shares, "p8_corpus": p8_corpus, "p8_held": p8_held}
