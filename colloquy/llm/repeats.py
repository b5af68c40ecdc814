"""Which keys repeat, as a Bloom filter of fixed size: for operators that must count what repeats only once, and shuffle
nothing else."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the filter, and how many a key sets. A full filter only sends more rows by shuffle.
FILTER_BITS, PROBES = 1 << 25, 3


@dataclass
class Repeats:
    """What a pass over keys found: rows, distinct keys, and the filter of keys of two rows or more."""

    rows: int
    keys: int
    words: np.ndarray

    def may_repeat(self, hashes: np.ndarray) -> np.ndarray:
        """For each row, by its key's hash: true for every key of several rows and, by chance, for a few others."""
        out = np.ones(len(hashes), dtype=bool)
        for k in range(PROBES):
            at = (hashes.view(np.uint64) >> np.uint64(k * 20)) & np.uint64(64 * len(self.words) - 1)
            out &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def repeats(keys: DataFrame) -> Repeats:
    """``keys``: one row for each row, its hash in ``h`` and, in any other columns, the key. Keys are shuffled, aggregated
    before; what is collected is at most the filter."""
    per = keys.groupBy(*keys.columns).agg(F.count("*").alias("n"))
    at = [F.shiftrightunsigned("h", k * 20).bitwiseAND(F.lit(FILTER_BITS - 1)) for k in range(PROBES)]
    bits = [F.struct(F.shiftright(a, 6).alias("word"), F.expr("1L").alias("one"), a.bitwiseAND(F.lit(63)).cast("int").alias("bit"), F.lit(0).cast("bigint").alias("n")) for a in at]
    own = F.struct(F.lit(-1).cast("bigint").alias("word"), F.expr("0L").alias("one"), F.lit(0).alias("bit"), F.col("n").alias("n"))
    each = per.select(F.inline(F.when(F.col("n") > 1, F.array(own, *bits)).otherwise(F.array(own))))
    sums = each.groupBy("word").agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("bits"), F.count("*").alias("keys"), F.sum("n").alias("n")).toArrow()
    word, set_, n_keys, n = (sums.column(c).to_numpy() for c in ("word", "bits", "keys", "n"))
    words, all_ = np.zeros(FILTER_BITS // 64, dtype=np.uint64), word == -1
    words[word[~all_]] = set_[~all_].view(np.uint64)
    return Repeats(int(n[all_].sum()), int(n_keys[all_].sum()), words)
