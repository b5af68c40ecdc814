"""Aggregates over waves, embeddings and scorer output."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def active_stretches(wave: np.ndarray, rate: int, frame_sec: float = 0.02, least_sec: float = 0.12, bridge_sec: float = 0.2) -> list[tuple[int, int]]:
    """(first, end) frame numbers of the stretches in which a track is active.

    A frame is active if its root mean square is above the largest of 1e-4, half the 0.75 quantile and a twentieth of the
    maximum. Stretches shorter than ``least_sec`` are dropped, then gaps of at most ``bridge_sec`` bridged. A silent or
    empty track has none.
    """
    hop = max(1, int(rate * frame_sec))
    n = len(wave) // hop
    if n == 0:
        return []
    rms = np.sqrt((wave[: n * hop].astype(np.float64).reshape(n, hop) ** 2).mean(axis=1) + 1e-12)
    if rms.max() <= 1e-6:
        return []
    active = rms > max(1e-4, float(np.quantile(rms, 0.75)) * 0.5, float(rms.max()) * 0.05)
    edges = np.flatnonzero(np.diff(np.r_[0, active.astype(np.int8), 0]))
    out: list[tuple[int, int]] = []
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        if (b - a) * hop / rate < least_sec:
            continue
        if out and a * hop / rate - out[-1][1] * hop / rate <= bridge_sec:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def activity(waves: DataFrame, key: str, wave: str, rate: str) -> DataFrame:
    """Rows ``key``, ``n``, ``frames``: the number of active stretches and of frames in them. Waves stay where they are
    read. Null waves and rates that aren't positive are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column, rates = b.column("__wave"), b.column("__rate").to_pylist()
            at, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            found = [active_stretches(np.nan_to_num(values[at[k] : at[k + 1]]), r) for k, r in enumerate(rates)]
            yield pa.record_batch([b.column("__key"), pa.array([len(x) for x in found], pa.int64()), pa.array([sum(z - a for a, z in x) for x in found], pa.int64())], ["key", "n", "frames"])

    rows = waves.where(F.col(wave).isNotNull() & (F.col(rate) > 0) & F.col(key).isNotNull()).select(F.col(key).cast("string").alias("__key"), F.col(wave).alias("__wave"), F.col(rate).alias("__rate"))
    return rows.mapInArrow(run, "key string, n bigint, frames bigint").withColumnRenamed("key", key)


def unit_sums(vectors: DataFrame, group: str, vector: str) -> DataFrame:
    """Per group: the number of vectors and the squared length of the sum of their unit vectors. Vectors that are null,
    empty or of length 0 are left out. Two numbers a dimension are shuffled, never pairs."""
    norm = F.sqrt(F.aggregate(F.transform(vector, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda a, x: a + x))
    units = vectors.where(F.size(vector) > 0).withColumn("__norm", norm).where("__norm > 0").select(group, F.posexplode(F.transform(vector, lambda x: x.cast("double") / F.col("__norm"))).alias("at", "x"))
    sums = units.groupBy(group, "at").agg(F.sum("x").alias("s"), F.count("*").alias("n"))
    return sums.groupBy(group).agg(F.max("n").alias("n"), F.sum(F.col("s") * F.col("s")).alias("square"))


def mean_pair_cosine(vectors: DataFrame, group: str, vector: str) -> DataFrame:
    """The mean cosine of all pairs of a group's vectors: the squared length of the sum of unit vectors holds each pair
    twice and each vector once. Null for groups of one."""
    s = unit_sums(vectors, group, vector)
    pairs = F.col("n") * (F.col("n") - 1)
    return s.select(group, "n", ((F.col("square") - F.col("n")) / F.nullif(pairs, F.lit(0))).alias("mean_cosine"))


def cosine(a: str, b: str) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def linked_labels(vectors: Iterable, least: float = 0.7) -> list[str]:
    """A label for each local speaker in turn, as in link_speakers()."""
    sums: list[np.ndarray] = []
    sizes: list[int] = []
    known: list[str] = []
    labels: list[str] = []
    named = 0  # labels given, those of unknown speakers among them
    for vector in vectors:
        if vector is None or len(vector) == 0:
            labels.append(f"SPEAKER_UNK_{named:02d}")
            named += 1
            continue
        v = np.asarray(vector, dtype=float)
        best = -1
        if known:
            centroids = np.stack(sums) / np.array(sizes)[:, None]
            similar = centroids @ v / (np.linalg.norm(centroids, axis=1) * np.linalg.norm(v) + 1e-8)
            best = int(np.argmax(similar)) if similar.max() > least else -1
        if best < 0:
            known.append(f"SPEAKER_{named:02d}")
            named += 1
            sums.append(v)
            sizes.append(1)
        else:
            sums[best] = sums[best] + v
            sizes[best] += 1
        labels.append(known[best])
    return labels


def link_speakers(embeddings: DataFrame, least: float = 0.7) -> DataFrame:
    """``embeddings``: episode, chunk, speaker, embedding (null: none could be made). Adds ``label``.

    In the order (chunk, speaker) each local speaker joins the global one whose centroid, the mean of its members, is most
    similar, if by more than ``least``; else it is a new one, SPEAKER_00, SPEAKER_01, ...; without an embedding always a
    new SPEAKER_UNK_nn of the same count. The order makes the outcome definite. An episode's speakers are few; its turns
    aren't needed here.
    """

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["chunk", "speaker"], kind="stable")
        return pdf.assign(label=linked_labels(pdf["embedding"], least))[["episode", "chunk", "speaker", "label"]]

    return embeddings.select("episode", "chunk", "speaker", "embedding").groupBy("episode").applyInPandas(one, "episode bigint, chunk bigint, speaker string, label string")
