"""Model stages with fixed schemas: diarization, separation, scoring, embedding.

A backend is a factory, called once per Python worker, that gives a function of a wave and its rate. Stages run it over
Arrow batches; whatever it raises becomes a row with ``error``, never a failed job. Backends are registered by name; those
named ``energy_*`` need no model and are deterministic.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.functions.waves import resample, stitch, track_consistency, windowed_mean
from colloquy.operators.metrics import active_stretches, linked_labels

TURNS = pa.list_(pa.struct([("speaker", pa.string()), ("start", pa.float64()), ("end", pa.float64())]))
#: What each kind of backend returns, as Arrow types of the stage's columns.
KINDS: dict[str, dict[str, pa.DataType]] = {
    "diarize": {"turns": TURNS},
    "separate": {"left": pa.list_(pa.float32()), "right": pa.list_(pa.float32())},
    "score": {"metrics": pa.map_(pa.string(), pa.float64())},
    "embed": {"embedding": pa.list_(pa.float32())},
}
DDL = {"diarize": "turns array<struct<speaker string, start double, end double>>", "separate": "left array<float>, right array<float>", "score": "metrics map<string, double>", "embed": "embedding array<float>"}


@dataclass(frozen=True)
class Backend:
    """``models``: how the names of the models begin that it runs."""

    kind: str
    load: Callable[[], Callable[[np.ndarray, int], tuple]]
    requires: tuple[str, ...] = ()
    models: tuple[str, ...] = ()


REGISTRY: dict[str, Backend] = {}
#: Short names of backends.
ALIASES = {"energy": "energy_diarize"}


def register(name: str, kind: str, load: Callable, requires: tuple[str, ...] = (), models: tuple[str, ...] = ()) -> None:
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}")
    REGISTRY[name] = Backend(kind, load, requires, models)


def backend(name: str) -> Backend:
    """By its name, a short name, or the name of a model: the backend with the longest beginning of it; case doesn't matter."""
    plain = name.strip().lower()
    found = REGISTRY.get(name) or REGISTRY.get(ALIASES.get(plain, plain))
    if found is None:
        fitting = [(len(m), b) for b in REGISTRY.values() for m in b.models if plain.startswith(m.lower())]
        found = max(fitting, key=lambda x: x[0])[1] if fitting else None
    if found is None:
        raise ValueError(f"unknown backend {name!r}; there are {', '.join(sorted(REGISTRY))}")
    return found


def run_stage(rows: DataFrame, name: str, key: str, wave: str, rate: str) -> DataFrame:
    """``key``, the backend's columns, ``error``: one row for each row, null columns where there is an error."""
    chosen = backend(name)
    kinds = KINDS[chosen.kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for b in batches:
            out, errors = [], []
            for samples, hz in zip(b.column("__wave"), b.column("__rate").to_pylist(), strict=True):
                try:
                    model = model or chosen.load()
                    if not samples.is_valid or not hz or hz <= 0:
                        raise ValueError("no wave")
                    out.append(model(np.nan_to_num(samples.values.to_numpy(zero_copy_only=False).astype(np.float32)), hz))  # a null sample is silence
                    errors.append(None)
                except Exception as e:  # noqa: BLE001
                    out.append((None,) * len(kinds))
                    errors.append(f"{type(e).__name__}: {e}")
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds.values(), strict=True)] if out else [pa.array([], t) for t in kinds.values()]
            yield pa.RecordBatch.from_arrays([b.column("__key"), *columns, pa.array(errors, pa.string())], ["key", *kinds, "error"])

    picked = rows.select(F.col(key).cast("string").alias("__key"), F.col(wave).cast("array<float>").alias("__wave"), F.col(rate).cast("int").alias("__rate"))
    return picked.mapInArrow(run, f"key string, {DDL[chosen.kind]}, error string").withColumnRenamed("key", key)


def _energy_diarize():
    def run(wave: np.ndarray, rate: int) -> tuple:
        hop = max(1, int(rate * 0.02))
        loud = float(np.abs(wave).mean()) if len(wave) else 0.0
        turns = [{"speaker": f"SPEAKER_{int(np.abs(wave[a * hop : z * hop]).mean() > loud):02d}", "start": a * hop / rate, "end": z * hop / rate} for a, z in active_stretches(wave, rate)]
        return (turns,)

    return run


def packed(periods: list[tuple[float, float]], most: float) -> list[tuple[float, float]]:
    """Consecutive periods as chunks: a period joins while its end lies at most ``most`` after the chunk's start."""
    out: list[tuple[float, float]] = []
    for a, z in periods:
        if out and z - out[-1][0] <= most:
            out[-1] = (out[-1][0], z)
        else:
            out.append((a, z))
    return out


def long_diarization(voice: Callable, diarize: Callable, embed: Callable, max_chunk: float = 60.0, least: float = 0.7, least_samples: int = 160) -> Callable:
    """A factory for waves of any length, of factories for short ones. ``voice`` gives the periods with speech in seconds;
    they are packed into chunks, which are diarized each; local speakers are linked by the mean embedding of their turns of
    more than ``least_samples``. Where ``voice`` fails all is one period; a chunk that fails is skipped; no speech, no turns.
    """

    def load():
        hear, turns_of, vector_of = voice(), diarize(), embed()

        def run(wave: np.ndarray, rate: int) -> tuple:
            try:
                periods = hear(wave, rate)
            except Exception:  # noqa: BLE001
                periods = [(0.0, len(wave) / rate)]
            found: list[tuple[float, dict]] = []
            locals_: dict[tuple[int, str], list[np.ndarray]] = {}
            for k, (a, z) in enumerate(packed(periods, max_chunk)):
                chunk = wave[int(a * rate) : int(z * rate)]
                try:
                    own = turns_of(chunk, rate)[0]
                    vectors: dict[str, list[np.ndarray]] = {t["speaker"]: [] for t in own}
                    for t in own:
                        part = chunk[int(t["start"] * rate) : int(t["end"] * rate)]
                        if len(part) > least_samples:
                            vectors[t["speaker"]].append(np.asarray(vector_of(part, rate)[0], dtype=float))
                except Exception:  # noqa: BLE001, S112
                    continue
                locals_ |= {(k, who): v for who, v in vectors.items()}
                found += [(k, {"speaker": t["speaker"], "start": a + t["start"], "end": a + t["end"]}) for t in own]
            order = sorted(locals_)
            labels = dict(zip(order, linked_labels((np.mean(locals_[x], axis=0) if locals_[x] else None for x in order), least), strict=True))
            turns = [t | {"speaker": labels[k, t["speaker"]]} for k, t in found]
            return (sorted(turns, key=lambda t: (t["start"], t["end"])),)

        return run

    return load


def windowed_score(score: Callable, seconds: float = 9.0, least_seconds: float = 1.0) -> Callable:
    """A factory whose metrics are means over windows, of a factory that scores one window; without any window it raises."""

    def load():
        one = score()

        def run(wave: np.ndarray, rate: int) -> tuple:
            found = windowed_mean(wave, rate, lambda w, hz: dict(one(w, hz)[0]), seconds, least_seconds)
            if found is None:
                raise ValueError("too short to score")
            return (list(found.items()),)

        return run

    return load


def referenced_score(score: Callable, reference: np.ndarray, rate: int) -> Callable:
    """A factory of scores that compare each track with the same reference recording, brought to the track's rate and its
    length, repeated where that is longer. ``score`` makes a function of track, reference and rate. The reference goes to
    the workers once, with the factory."""
    known = np.asarray(reference, dtype=np.float32)
    if not len(known):
        raise ValueError("empty reference")

    def load():
        one = score()

        def run(wave: np.ndarray, hz: int) -> tuple:
            if not len(wave):
                raise ValueError("empty wave")
            return (list(one(wave, np.resize(resample(known, rate, hz), len(wave)), hz).items()),)

        return run

    return load


def consistency_score(embed: Callable, seconds: float = 2.0, least_seconds: float = 1.0) -> Callable:
    """A factory of the score ``consistency`` of a track, of a factory of embeddings."""

    def load():
        one = embed()

        def run(wave: np.ndarray, rate: int) -> tuple:
            value = track_consistency(wave, rate, lambda w, hz: one(w, hz)[0], seconds, least_seconds)
            if value is None:
                raise ValueError("too short to score")
            return ([("consistency", value)],)

        return run

    return load


def _energy_voice():
    def run(wave: np.ndarray, rate: int) -> list[tuple[float, float]]:
        hop = max(1, int(rate * 0.02))
        return [(a * hop / rate, z * hop / rate) for a, z in active_stretches(wave, rate)]

    return run


def _energy_separate():
    def run(wave: np.ndarray, rate: int) -> tuple:
        size = max(2, 60 * rate)
        overlap = max(1, size // 6)
        hop, half = size - overlap, np.median(np.abs(wave)) if len(wave) else 0.0
        chunks = [np.vstack([np.where(np.abs(c) > half, c, 0), np.where(np.abs(c) <= half, c, 0)]) for k in range(0, max(1, len(wave)), hop) if len(c := wave[k : k + size])]
        both = stitch(chunks, size, overlap, len(wave))
        return both[0], both[1]

    return run


def _energy_score():
    def run(wave: np.ndarray, rate: int) -> tuple:
        if not len(wave):
            raise ValueError("empty wave")
        return ([("rms", float(np.sqrt((wave.astype(float) ** 2).mean()))), ("peak", float(np.abs(wave).max())), ("active", float(sum(z - a for a, z in active_stretches(wave, rate))))],)

    return run


def _energy_embed():
    def run(wave: np.ndarray, rate: int) -> tuple:
        return (np.histogram(np.abs(wave), bins=16, range=(0, 1))[0].astype(np.float32).tolist(),)

    return run


for _name, _kind, _load in (("energy_diarize", "diarize", _energy_diarize), ("energy_separate", "separate", _energy_separate), ("energy_score", "score", _energy_score), ("energy_embed", "embed", _energy_embed)):
    register(_name, _kind, _load)
register("energy_long", "diarize", long_diarization(_energy_voice, _energy_diarize, _energy_embed))
register("energy_windows", "score", windowed_score(_energy_score))
register("energy_consistency", "score", consistency_score(_energy_embed))
