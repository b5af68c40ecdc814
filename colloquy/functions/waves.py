"""Waves as float arrays: decoding, slicing, mixing and stitching. NumPy only; used inside Arrow stages."""

from __future__ import annotations

import io
import wave as wave_file

import numpy as np


def decode_wav(content: bytes) -> tuple[np.ndarray, int]:
    """(channels x samples as float32, rate) of 16- or 32-bit PCM. Raises ValueError for anything else or nothing."""
    try:
        with wave_file.open(io.BytesIO(content)) as w:
            width, channels, rate, data = w.getsampwidth(), w.getnchannels(), w.getframerate(), w.readframes(w.getnframes())
    except (wave_file.Error, EOFError) as e:
        raise ValueError(f"not a PCM wave file: {e}") from e
    if width not in (2, 4):
        raise ValueError(f"{8 * width}-bit samples aren't supported")
    if not data:
        raise ValueError("no samples")
    scale = 32_768 if width == 2 else 2_147_483_648
    return (np.frombuffer(data, dtype="<i2" if width == 2 else "<i4").reshape(-1, channels).T / scale).astype(np.float32), rate


def encode_wav(channels: np.ndarray, rate: int) -> bytes:
    """16-bit PCM of (channels x samples), or one channel, from -1 to 1; what lies beyond is cut off."""
    both = np.atleast_2d(channels)
    out = io.BytesIO()
    with wave_file.open(out, "wb") as w:
        w.setnchannels(len(both))
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.clip(np.round(np.nan_to_num(both.T) * 32_768), -32_768, 32_767).astype("<i2").tobytes())
    return out.getvalue()


def windows(samples: int, rate: int, seconds: float, least_seconds: float) -> list[tuple[int, int]]:
    """Consecutive windows of ``seconds``, (start, end) in samples; one that is shorter, as the last may be, counts only if
    it has ``least_seconds``."""
    size, least = max(1, int(seconds * rate)), int(least_seconds * rate)
    return [(a, min(a + size, samples)) for a in range(0, samples, size) if min(a + size, samples) - a >= min(size, least)]


def windowed_mean(channel: np.ndarray, rate: int, score, seconds: float = 9.0, least_seconds: float = 1.0) -> dict[str, float] | None:
    """The mean of each metric that ``score`` gives of the windows; None where there is no window. A metric that some
    windows lack, or that isn't finite there, is the mean of the others."""
    found: dict[str, list[float]] = {}
    for a, z in windows(len(channel), rate, seconds, least_seconds):
        for k, v in score(channel[a:z], rate).items():
            if v is not None and np.isfinite(v):
                found.setdefault(k, []).append(float(v))
    return {k: float(np.mean(v)) for k, v in found.items()} or None


def track_consistency(channel: np.ndarray, rate: int, embed, seconds: float = 2.0, least_seconds: float = 1.0) -> float | None:
    """The mean cosine between the embeddings of all pairs of windows, from the length of their summed unit vectors. With
    fewer than two windows it is 1 if the track has ``least_seconds``, else None."""
    parts = [np.asarray(embed(channel[a:z], rate), dtype=float) for a, z in windows(len(channel), rate, seconds, least_seconds)]
    if len(parts) < 2:
        return 1.0 if len(channel) >= least_seconds * rate else None
    units = np.stack([p / (np.linalg.norm(p) + 1e-12) for p in parts])
    n = len(units)
    return float((np.linalg.norm(units.sum(axis=0)) ** 2 - (units**2).sum()) / (n * (n - 1)))


def mono(channels: np.ndarray) -> np.ndarray:
    return channels.mean(axis=0, keepdims=True)


def stereo(channels: np.ndarray) -> np.ndarray:
    """One channel is doubled, more than two are cut."""
    return np.vstack([channels, channels]) if len(channels) == 1 else channels[:2]


def resample(channel: np.ndarray, rate: int, to: int) -> np.ndarray:
    if rate == to or not len(channel):
        return channel
    n = max(1, round(len(channel) * to / rate))
    return np.interp(np.arange(n) * rate / to, np.arange(len(channel)), channel).astype(np.float32)


def pair(a: np.ndarray, rate_a: int, b: np.ndarray, rate_b: int) -> np.ndarray:
    """Two tracks as channels at a's rate, cut to the shorter. Raises ValueError if either is empty."""
    b = resample(b, rate_b, rate_a)
    n = min(len(a), len(b))
    if not n:
        raise ValueError("empty track")
    return np.vstack([a[:n], b[:n]])


def stitch(chunks: list[np.ndarray], chunk: int, overlap: int, total: int) -> np.ndarray:
    """Two-channel chunks, each ``chunk`` long and ``overlap`` into the next, as one of ``total`` samples.

    Each chunk is scaled to a peak of 0.9; where its channels, over the overlap, match those before better swapped, they
    are swapped; overlaps are cross-faded linearly.
    """
    hop, out = chunk - overlap, np.zeros((2, max(total, 0)), dtype=np.float32)
    for k, c in enumerate(chunks):
        size = min(chunk, total - k * hop)
        if size <= 0:
            break
        c = np.pad(c[:, :size], ((0, 0), (0, max(0, size - c.shape[1]))))
        peak = np.abs(c).max(initial=0.0)
        c = c * (0.9 / peak) if peak > 0 else c
        at, shared = k * hop, min(overlap, size) if k else 0
        if shared:
            old, new = out[:, at : at + shared], c[:, :shared]
            old, new = old - old.mean(axis=1, keepdims=True), new - new.mean(axis=1, keepdims=True)
            if (old * new[::-1]).sum() > (old * new).sum():
                c = c[::-1]
            fade = np.linspace(0, 1, shared, dtype=np.float32)
            out[:, at : at + shared] = out[:, at : at + shared] * (1 - fade) + c[:, :shared] * fade
        out[:, at + shared : at + size] = c[:, shared:]
    return out
