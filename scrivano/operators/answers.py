"""Answers by given models, with failover, or from the passages alone."""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from scrivano.errors import AllModelsFailed, QuotaError

QUOTA = re.compile(r"(?i)\b429\b|quota|rate.?limit|resource.?exhausted")


@dataclass
class Failover:
    """Asks the first model that is not cooling down; a quota error sends a model to rest for `cooldown_s` seconds."""

    models: dict[str, Callable[[str], str]]
    cooldown_s: float = 60
    clock: Callable[[], float] = time.monotonic
    resting: dict[str, float] = field(default_factory=dict)

    def ask(self, prompt: str) -> tuple[str, str]:
        problems = {}
        for name, model in self.models.items():
            if self.resting.get(name, 0) > self.clock():
                problems[name] = "resting"
                continue
            try:
                return name, model(prompt)
            except Exception as e:
                problems[name] = str(e)
                if isinstance(e, QuotaError) or QUOTA.search(str(e)):
                    self.resting[name] = self.clock() + self.cooldown_s
        raise AllModelsFailed("no model answered", problems=problems)


def local_answer(question: str, passages: list[tuple[str, str]], most: int = 320) -> str:
    """Answer without a model: the passages found, with their sources."""
    if not passages:
        return f"Nessun documento pertinente per: {question}"
    return "\n".join([f"Risultati per: {question}", *(f"- {name}: {' '.join(text.split())[:most]}..." for name, text in passages)])


def mode(models: list[str], vectors: bool) -> str:
    return "local" if not models else "vector" if vectors else "lexical"
