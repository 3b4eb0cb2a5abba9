"""Settings with ranges, read from the environment on the driver."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields

from scrivano.errors import ConfigError

LIMITS = {"chunk_size": (100, 20_000), "chunk_overlap": (0, 5_000), "top_k": (1, 100), "delay_s": (0.0, 60.0), "retries": (0, 20), "cooldown_s": (0, 3_600), "most_unknown": (0.0, 100.0), "ttl_s": (0, 31_536_000)}


def listed_setting(text: str | None) -> list[str]:
    """JSON list or comma-separated values, trimmed, without blanks."""
    s = (text or "").strip()
    if s.startswith("["):
        try:
            return [str(x).strip() for x in json.loads(s) if str(x).strip()]
        except ValueError:
            pass
    return [x.strip() for x in s.strip("[]").split(",") if x.strip()]


@dataclass(frozen=True)
class Settings:
    chunk_size: int = 3000
    chunk_overlap: int = 300
    top_k: int = 6
    delay_s: float = 1.0
    retries: int = 5
    cooldown_s: int = 60
    most_unknown: float = 35.0
    ttl_s: int = 3600
    models: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        for name, (low, high) in LIMITS.items():
            if not low <= getattr(self, name) <= high:
                raise ConfigError(f"{name} must be from {low} to {high}", value=getattr(self, name))
        if self.chunk_overlap >= self.chunk_size:
            raise ConfigError("chunk_overlap must be smaller than chunk_size", value=self.chunk_overlap)

    @classmethod
    def from_environment(cls, prefix: str = "SCRIVANO_", env: dict[str, str] | None = None) -> Settings:
        env = os.environ if env is None else env
        out = {}
        for f in fields(cls):
            raw = env.get(prefix + f.name.upper())
            if raw is not None:
                try:
                    out[f.name] = listed_setting(raw) if f.name == "models" else (float if "float" in str(f.type) else int)(raw)
                except ValueError as e:
                    raise ConfigError(f"{f.name} is no number", value=raw) from e
        return cls(**out)
