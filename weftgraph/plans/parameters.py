"""What a graph build is asked for."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from ..functions import months

# The two presets.
PRESETS = {
    "preview": {"top_repos": 5_000, "min_shared": 2, "max_actor_degree": 30, "max_edges_per_node": 30, "labels": 150, "max_rows": 200_000},
    "final": {"top_repos": 20_000, "min_shared": 2, "max_actor_degree": 30, "max_edges_per_node": 20, "labels": 300, "max_rows": 500_000},
}
DUPLICATE_LIMIT = 0.01


@dataclass(frozen=True)
class Parameters:
    platform: str
    start: int
    end: int
    top_repos: int
    min_shared: int
    max_actor_degree: int
    max_edges_per_node: int
    labels: int
    max_rows: int

    def __post_init__(self):
        if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_-]*", self.platform):
            raise ValueError(f"unsafe platform name: {self.platform!r}")
        if not (months.valid(self.start) and months.valid(self.end)) or self.start > self.end:
            raise ValueError("the window is no range of months")
        if min(self.top_repos, self.min_shared, self.max_edges_per_node, self.labels, self.max_rows) < 1:
            raise ValueError("limits must be positive")
        if self.max_actor_degree < 2:
            raise ValueError("an actor of less than two repositories joins none")


def preset(name: str, platform: str, end: int, count: int = 12, **changes: int) -> Parameters:
    """A preset over the ``count`` months up to ``end``; an explicit 0 is an error, not a default."""
    return Parameters(platform, months.shift(end, 1 - count), end, **{**PRESETS[name], **{k: v for k, v in changes.items() if v is not None}})


def resolution(x: float) -> float:
    if not math.isfinite(x) or x <= 0:
        raise ValueError("the resolution must be finite and positive")
    return x
