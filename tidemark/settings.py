"""Frozen settings of a run."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, replace

#: What a run writes to: a root folder or URI of datasets, an event bus, a table of dashboard entries.
TARGETS = ("dataset_root", "alert_bus", "projection_table")


@dataclass(frozen=True)
class Settings:
    """Analytical parameters and the targets of a live and of a replay run; a target that is None is not written."""

    realtime_window_seconds: int = 5
    offline_threshold_seconds: int = 300
    outage_threshold_ratio: float = 0.5
    late_event_tolerance_seconds: int = 60
    data_retention_days: int = 730
    service_name: str = "tidemark"
    environment: str = "dev"
    dataset_root: str | None = None
    replay_dataset_root: str | None = None
    alert_bus: str | None = None
    replay_alert_bus: str | None = None
    projection_table: str | None = None
    replay_projection_table: str | None = None

    def __post_init__(self) -> None:
        rules = {
            "a positive number of seconds or days": [self.realtime_window_seconds > 0, self.offline_threshold_seconds > 0, self.data_retention_days > 0],
            "a share above 0 and up to 1": [0.0 < self.outage_threshold_ratio <= 1.0],
            "no negative tolerance": [self.late_event_tolerance_seconds >= 0],
            "a service and an environment": [bool(self.service_name), bool(self.environment)],
            "targets without white space at their ends, or None": [v is None or (v != "" and v == v.strip()) for v in self._targets()],
        }
        broken = [rule for rule, checks in rules.items() if not all(checks)]
        if broken:
            raise ValueError(f"settings need {'; '.join(broken)}: {self}")

    def _targets(self) -> list[str | None]:
        return [getattr(self, f"{kind}{t}") for t in TARGETS for kind in ("", "replay_")]

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, prefix: str = "TIDEMARK_") -> Settings:
        """Settings from variables named prefix + FIELD; an empty string counts as unset."""
        env = os.environ if env is None else env
        found = {}
        for name, kind in cls.__annotations__.items():
            raw = env.get(prefix + name.upper())
            if not raw:
                continue
            try:
                found[name] = int(raw) if kind == "int" else float(raw) if kind == "float" else raw
            except ValueError as e:
                raise ValueError(f"{prefix}{name.upper()} must be a {kind}, got {raw!r}") from e
        return cls(**found)

    def for_replay(self, environment: str = "replay") -> Settings:
        """The same analysis with the replay targets; one that is not set is written nowhere."""
        return replace(self, environment=environment, **{t: getattr(self, f"replay_{t}") for t in TARGETS})
