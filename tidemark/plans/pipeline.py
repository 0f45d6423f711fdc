"""A pipeline: what is registered on it becomes a family of DataFrames over one event table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import alerts as alerting
from tidemark.operators import watermark, windows
from tidemark.operators.routing import Router
from tidemark.settings import Settings
from tidemark.sources import datasets


@dataclass
class Result:
    """What a batch of events gives; every row carries the arrival_seq of the event that caused it."""

    classified: DataFrame
    failures: DataFrame
    changelogs: dict[str, DataFrame] = field(default_factory=dict)
    emissions: dict[str, DataFrame] = field(default_factory=dict)
    features: DataFrame | None = None
    detections: DataFrame | None = None
    alerts: DataFrame | None = None
    summary: DataFrame | None = None
    dispatched: DataFrame | None = None
    observer_errors: dict[str, str] = field(default_factory=dict)

    def nested(self) -> DataFrame:
        """One row for each event with lists of what it caused, as a record of its processing."""
        out = self.classified.select("arrival_seq", "event_id", "partition_key", "classification").unionByName(
            self.failures.select("arrival_seq", "event_id"), allowMissingColumns=True
        )
        lists = {"detections": self.detections, "alerts": self.alerts, "features": self.features}
        for name, rows in lists.items():
            if rows is not None:
                own = rows.groupBy("arrival_seq").agg(F.array_sort(F.collect_list(F.struct(*[c for c in rows.columns if c != "arrival_seq"]))).alias(name))
                out = out.join(own, "arrival_seq", "left")
        return out


class Pipeline:
    """Register window aggregations, detectors and an alert router; run() declares all results lazily."""

    def __init__(self, settings: Settings, key: Column, router: Router | None = None, strict: bool = False, *, span: int | None = None, stretch: int | None = None) -> None:
        """span and stretch spread hot keys over tasks, in watermarks and in windows (see there); results are the same."""
        self.settings, self.key, self.strict, self.router = settings, key, strict, router
        self.span, self.stretch = span, stretch
        self._windows: dict[str, tuple[windows.Geometry, list[windows.Aggregation]]] = {}
        self._event: dict[str, Callable[[DataFrame], DataFrame]] = {}
        self._emission: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {}
        self._acks: DataFrame | None = None

    def register_windows(self, name: str, geometry: windows.Geometry, aggregations: list[windows.Aggregation], lateness: float | None = None) -> Pipeline:
        if name in self._windows:
            raise ValueError(f"windows {name} are registered already")
        if lateness is not None and lateness != self.settings.late_event_tolerance_seconds:
            raise ValueError("windows and watermarks share one lateness")
        self._windows[name] = (geometry, aggregations)
        return self

    def register_event_detector(self, name: str, detector: Callable[[DataFrame], DataFrame]) -> Pipeline:
        if name in self._event or name in self._emission:
            raise ValueError(f"detector {name} is registered already")
        self._event[name] = detector
        return self

    def register_emission_detector(self, name: str, aggregation: str, detector: Callable[[DataFrame], DataFrame]) -> Pipeline:
        if name in self._event or name in self._emission:
            raise ValueError(f"detector {name} is registered already")
        self._emission[name] = (aggregation, detector)
        return self

    def register_alerts(self, acks: DataFrame) -> Pipeline:
        if self._acks is not None:
            raise ValueError("an alert router is registered already")
        self._acks = acks
        return self

    def run(self, events: DataFrame) -> Result:
        late = self.settings.late_event_tolerance_seconds
        keyed, failures = watermark.extract_key(events, self.key)
        classified = watermark.with_watermark(keyed, late, span=self.span)
        out = Result(classified, failures, summary=watermark.batch_summary(classified, failures))
        vectors, found = [], []
        for name, (geometry, aggregations) in self._windows.items():
            wide = windows.changelog(classified, geometry, aggregations, late, stretch=self.stretch)
            out.changelogs[name] = wide
            for k, a in enumerate(aggregations):
                out.emissions[a.name] = windows.emissions(wide, a.name, ordinal=k)
            vectors.append(windows.feature_vectors(wide, [a.name for a in aggregations]))
        for rows in vectors:
            out.features = rows if out.features is None else out.features.unionByName(rows)

        def observed(name: str, make: Callable[[], DataFrame]) -> None:
            try:
                found.append(make())
            except Exception as e:
                if self.strict:
                    raise
                out.observer_errors[name] = repr(e)

        if self.router is not None:
            out.dispatched, _, errors = self.router.dispatch(classified, strict=self.strict)
            out.observer_errors |= {"/".join(map(str, k)): e for k, e in errors.items()}
        for name, detector in self._event.items():
            observed(name, lambda d=detector: d(classified))
        for name, (aggregation, detector) in self._emission.items():
            if aggregation in out.emissions:
                observed(name, lambda d=detector, a=aggregation: d(out.emissions[a]))
        for rows in found:
            out.detections = rows if out.detections is None else out.detections.unionByName(rows)
        if self._acks is not None and out.detections is not None:
            out.alerts = alerting.route(out.detections, self._acks)
        return out

    def write(self, result: Result, root: str | None, mode: str = "append") -> None:
        """All record types below root; nothing without one."""
        datasets.write_emissions(result.emissions, root, mode=mode)
        if result.detections is not None:
            datasets.write_detections(result.detections, root, mode=mode)
        if result.features is not None:
            datasets.write_features(result.features, root, mode=mode)
