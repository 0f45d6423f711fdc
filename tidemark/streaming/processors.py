"""Streaming forms of the per-key operators: the same rows as the batch forms, from state kept by key.

A micro-batch has no order, so each key's rows are sorted by arrival first; arrivals must come in order across
batches. State is one row of JSON for a key: its high mark and its windows that are not sealed.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.detectors import Silence
from tidemark.operators.watermark import DROPPED, ON_TIME, TOLERATED

EMISSION = "partition_key string, aggregation_name string, window_start timestamp, window_end timestamp, value double, event_count long, is_repair boolean, last_contributing_trace_id string, arrival_seq long"


@dataclass(frozen=True)
class Fold:
    """An aggregation as a fold whose state is JSON."""

    name: str
    initial: Callable[[], object]
    combine: Callable[[object, object], object]
    finalise: Callable[[object], float]


COUNT = Fold("count", lambda: 0, lambda s, _: s + 1, float)
SUM = Fold("sum", lambda: 0.0, lambda s, x: s + float(x), float)
MEAN = Fold("mean", lambda: [0.0, 0], lambda s, x: [s[0] + float(x), s[1] + 1], lambda s: s[0] / s[1] if s[1] else 0.0)
DISTINCT = Fold("distinct", list, lambda s, x: s if x in s else [*s, x], lambda s: float(len(s)))


class KeyWindows:
    """A key's watermark and windows, event by event; times in microseconds."""

    def __init__(self, fold: Fold, size: int, slide: int, lateness: int, state: dict | None = None) -> None:
        self.fold, self.size, self.slide, self.late = fold, size * 1_000_000, slide * 1_000_000, lateness * 1_000_000
        state = state or {"high": None, "windows": {}}
        self.high: int | None = state["high"]
        #: start -> [state, count, has emitted, last trace]
        self.windows: dict[int, list] = {int(k): v for k, v in state["windows"].items()}

    def state(self) -> dict:
        return {"high": self.high, "windows": {str(k): v for k, v in self.windows.items()}}

    def observe(self, ts: int) -> tuple[str, int]:
        """(class, watermark after it)."""
        before = None if self.high is None else self.high - self.late
        self.high = ts if self.high is None else max(self.high, ts)
        if before is None or ts >= before:
            kind = ON_TIME
        else:
            kind = TOLERATED if self.late and before - ts <= self.late else DROPPED
        return kind, self.high - self.late

    def event(self, ts: int, contribution: object, trace: str | None) -> Iterator[tuple]:
        """(start, end, value, count, is repair, trace) of what an event emits, in order."""
        kind, mark = self.observe(ts)
        out = []
        if kind != DROPPED:
            start = ts // self.slide * self.slide
            while start + self.size > ts:
                own = self.windows.setdefault(start, [self.fold.initial(), 0, False, None])
                own[0], own[1], own[3] = self.fold.combine(own[0], contribution), own[1] + 1, trace
                if own[2]:
                    out.append((start, True))
                start -= self.slide
        for start in sorted(self.windows):
            own = self.windows[start]
            if not own[2] and mark >= start + self.size:
                own[2] = True
                out.append((start, False))
        for start, repair in sorted(out):
            own = self.windows[start]
            yield start, start + self.size, self.fold.finalise(own[0]), own[1], repair, own[3]
        for start in [s for s in self.windows if mark > s + self.size + self.late]:
            del self.windows[start]


def window_changelog(events: DataFrame, fold: Fold, size: int, slide: int, lateness: int, contribution: str | None = None) -> DataFrame:
    """The changelog of a streaming DataFrame with partition_key, arrival_seq, event_timestamp and trace_id."""
    columns = [c.split()[0] for c in EMISSION.split(", ")]

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        own = KeyWindows(fold, size, slide, lateness, json.loads(state.get[0]) if state.exists else None)
        rows = []
        for r in pd.concat(list(batches)).sort_values("arrival_seq").itertuples():
            us = int(pd.Timestamp(r.event_timestamp).as_unit("ns").value) // 1000
            for a, b, value, n, repair, trace in own.event(us, getattr(r, contribution) if contribution else None, r.trace_id):
                rows.append((key[0], fold.name, pd.Timestamp(a, unit="us"), pd.Timestamp(b, unit="us"), value, n, repair, trace, r.arrival_seq))
        state.update((json.dumps(own.state()),))
        yield pd.DataFrame(rows, columns=columns)

    return events.groupBy("partition_key").applyInPandasWithState(run, EMISSION, "state string", "append", GroupStateTimeout.NoTimeout)


OFFLINE = "shard string, kind string, device_id string, store_id string, source_event_id string, at timestamp, silent_us long, arrival_seq long"


def offline_stream(events: DataFrame, threshold: int) -> DataFrame:
    """Offline and online moves of a streaming DataFrame with shard, arrival_seq, event_timestamp, event_id, device_id and the
    device's store_id, null if it has none."""
    columns = [c.split()[0] for c in OFFLINE.split(", ")]

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        own = Silence(threshold)
        if state.exists:
            held = json.loads(state.get[0])
            own.last, own.offline, own.store, own.first = held["last"], set(held["offline"]), held["store"], held["first"]
        rows = []
        for r in pd.concat(list(batches)).sort_values("arrival_seq").itertuples():
            if r.device_id is None:
                continue
            if r.store_id is not None:
                own.register(r.device_id, r.store_id)
            us = int(pd.Timestamp(r.event_timestamp).as_unit("ns").value) // 1000
            for kind, device, silent in own.see(int(r.arrival_seq), us, r.device_id):
                rows.append((key[0], kind, device, own.store[device], r.event_id, pd.Timestamp(us, unit="us"), silent, r.arrival_seq))
        state.update((json.dumps({"last": own.last, "offline": sorted(own.offline), "store": own.store, "first": own.first}),))
        yield pd.DataFrame(rows, columns=columns).astype({"silent_us": "Int64"})

    return events.groupBy("shard").applyInPandasWithState(run, OFFLINE, "state string", "append", GroupStateTimeout.NoTimeout)
