"""Settings with their ranges, from a TOML file and the environment."""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass, field, fields


def _in(low: float, high: float) -> dict:
    return {"low": low, "high": high}


class Checked:
    def __post_init__(self) -> None:
        for f in fields(self):
            m, v = f.metadata, getattr(self, f.name)
            if "low" in m and not m["low"] <= v <= m["high"]:
                raise ValueError(f"{type(self).__name__}.{f.name} is {v}; it must be from {m['low']} to {m['high']}")
            if "one_of" in m and v not in m["one_of"]:
                raise ValueError(f"{type(self).__name__}.{f.name} is {v!r}; it must be one of {m['one_of']}")


@dataclass(frozen=True)
class Slicer(Checked):
    max_tokens: int = field(default=5000, metadata=_in(1, 1_000_000))
    soft_boundary: bool = True
    soft_boundary_max_shift: int = field(default=500, metadata=_in(0, 1_000_000))
    strict_compat: bool = False


@dataclass(frozen=True)
class Dedup(Checked):
    sim_threshold: float = field(default=0.85, metadata=_in(0, 1))
    len_ratio_min: float = field(default=0.8, metadata=_in(0, 1))
    k_neighbors: int = field(default=5, metadata=_in(1, 1000))


@dataclass(frozen=True)
class Refiner(Checked):
    run: bool = True
    sim_threshold: float = field(default=0.7, metadata=_in(0, 1))
    max_pairs_per_node: int = field(default=5, metadata=_in(1, 1000))
    metric: str = field(default="IP", metadata={"one_of": ("IP",)})


@dataclass(frozen=True)
class Metrics(Checked):
    pagerank_damping: float = field(default=0.85, metadata=_in(0, 1))
    pagerank_max_iter: int = field(default=100, metadata=_in(1, 10_000))
    louvain_resolution: float = field(default=1.0, metadata=_in(0.01, 100))
    bridge_weight_betweenness: float = field(default=0.7, metadata=_in(0, 1))
    default_difficulty: int = field(default=3, metadata=_in(1, 5))
    max_nodes: int = field(default=1000, metadata=_in(1, 1_000_000))


@dataclass(frozen=True)
class Anomalies(Checked):
    outlier_method: str = field(default="iqr", metadata={"one_of": ("iqr", "zscore")})
    iqr_factor: float = field(default=1.5, metadata=_in(0, 100))
    sum_tolerance: float = field(default=0.01, metadata=_in(0, 1))
    strict: bool = False


@dataclass(frozen=True)
class Config:
    slicer: Slicer = Slicer()
    dedup: Dedup = Dedup()
    refiner: Refiner = Refiner()
    metrics: Metrics = Metrics()
    anomalies: Anomalies = Anomalies()
    api_key: str | None = None


def load(path: str | None = None, key_variable: str = "CARTOLEX_API_KEY") -> Config:
    """Settings from a file (sections and keys as above; others are an error), and the key from the environment."""
    raw = {}
    if path:
        with open(path, "rb") as f:
            raw = tomllib.load(f)
    kinds = {"slicer": Slicer, "dedup": Dedup, "refiner": Refiner, "metrics": Metrics, "anomalies": Anomalies}
    if extra := raw.keys() - kinds.keys():
        raise ValueError(f"unknown sections {sorted(extra)}")
    parts = {}
    for name, kind in kinds.items():
        own = raw.get(name, {})
        if extra := own.keys() - {f.name for f in fields(kind)}:
            raise ValueError(f"unknown keys {sorted(extra)} in {name}")
        parts[name] = kind(**own)
    return Config(**parts, api_key=os.environ.get(key_variable))
