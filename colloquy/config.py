"""Settings of a run: a JSON file, then dotted overrides, then flags; unknown names are errors."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields, replace
from typing import Any


@dataclass(frozen=True)
class Config:
    data: str = "."
    output: str = "out"
    languages: list[str] = field(default_factory=lambda: ["vi", "ja", "en"])
    episode_limit: int | None = None
    target_hours: float | None = None
    max_minutes: float = 180.0
    min_sample_rate: int = 16_000
    min_bit_rate: int = 32_000
    gap_seconds: float = 5.0
    max_speaker_share: float = 0.8
    min_dialogue_seconds: float = 10.0
    max_dialogue_seconds: float = 600.0
    min_dialogues: int = 4
    diarization: str = "energy_diarize"
    separation: str = "energy_separate"
    scorer: str = "energy_score"
    shard_bytes: int = 3 * 1024**3
    writers: int = 8
    nodes: int = 1
    node: int = 0
    spark: dict[str, str] = field(default_factory=dict)


#: Other names under which settings are known.
NAMES = {
    "source.languages": "languages", "source.target_hours": "target_hours", "source.episode_limit_per_feed": "episode_limit", "audio.output_dir": "output", "audio.min_original_sample_rate": "min_sample_rate", "audio.min_original_bitrate": "min_bit_rate",
    "runtime.node_index": "node", "runtime.num_nodes": "nodes", "diarization.backend": "diarization", "diarization.dialogue_gap_seconds": "gap_seconds", "diarization.dialogue_min_duration_seconds": "min_dialogue_seconds",
    "diarization.dialogue_max_duration_seconds": "max_dialogue_seconds", "diarization.dialogue_max_single_speaker_ratio": "max_speaker_share", "separation.backend": "separation",
}
OTHERS = NAMES | {k.rpartition(".")[2]: v for k, v in NAMES.items() if k.rpartition(".")[2] != "backend"}


def coerced(name: str, value: Any) -> Any:
    """The value as the setting's kind: numbers and lists may come as text. Raises ValueError where it can't be."""
    usual = getattr(Config(), name)
    if name in ("episode_limit", "target_hours"):
        return None if value is None else (int if name == "episode_limit" else float)(value)
    if isinstance(usual, list):
        return [str(x).strip() for x in (value.split(",") if isinstance(value, str) else value or [])]
    if value is None or isinstance(value, bool):
        raise ValueError(f"{name} can't be {value!r}")
    return type(usual)(value) if isinstance(usual, (int, float, str)) else value


def _flat(tree: dict[str, Any], prefix: str = "") -> dict[str, Any]:
    """Nested objects as dotted names; settings of Spark stay together."""
    out: dict[str, Any] = {}
    for k, v in tree.items():
        if isinstance(v, dict) and prefix + k != "spark":
            out |= _flat(v, f"{prefix}{k}.")
        else:
            out[prefix + k] = v
    return out


def value_of(text: str) -> Any:
    """An override's value: JSON if it is any, else the text itself; '' is None."""
    if text == "":
        return None
    try:
        return json.loads(text)
    except ValueError:
        return text


def apply(config: Config, values: dict[str, Any]) -> Config:
    """Names may be dotted; what counts is the last part, or, for ``spark.``, the rest."""
    known, changes, spark = {f.name for f in fields(config)}, {}, dict(config.spark)
    for name, value in _flat(values).items():
        if name == "spark":
            spark |= value or {}
        elif name.startswith("spark."):
            spark[name] = str(value)
        elif (own := OTHERS.get(name) or name.rpartition(".")[2]) in known:
            changes[own] = coerced(own, value)
        else:
            raise ValueError(f"unknown setting {name!r}")
    return replace(config, **changes, spark=spark)


def load(path: str | None, overrides: list[str] = ()) -> Config:
    """``overrides``: name=value."""
    config = Config()
    if path:
        with open(path, encoding="utf-8") as f:
            config = apply(config, json.load(f))
    pairs = dict(x.partition("=")[::2] for x in overrides)
    return apply(config, {k: value_of(v) for k, v in pairs.items()})


def resolved(config: Config) -> str:
    return json.dumps(asdict(config), indent=2, ensure_ascii=False)
