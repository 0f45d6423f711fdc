"""Dispatch of events to handlers by type and version."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.versions import parse, resolve


class Router:
    """Handlers, DataFrame transformations, by (event type, version); an event goes to the greatest version of its
    major that is not above its own."""

    def __init__(self) -> None:
        self._handlers: dict[tuple[str, str], list[Callable[[DataFrame], DataFrame]]] = {}

    def register(self, event_type: str, version: str, handler: Callable[[DataFrame], DataFrame]) -> None:
        if not event_type or not version:
            raise ValueError("an event type and a version are needed")
        if not callable(handler):
            raise TypeError("a handler is callable")
        self._handlers.setdefault((event_type, version), []).append(handler)

    def registered_keys(self) -> list[tuple[str, str]]:
        return sorted(self._handlers)

    def _table(self, events: DataFrame) -> DataFrame:
        rows = [(t, v, len(h)) for (t, v), h in self._handlers.items()]
        return events.sparkSession.createDataFrame(rows, "event_type string, version string, handlers int")

    def resolve(self, events: DataFrame) -> DataFrame:
        """events(event_type, schema_version) with matched_version, fell_back and handlers."""
        table = self._table(events)
        asked = resolve(events.withColumn("version", F.col("schema_version")), table, lowest=False, out="matched_version").drop("version")
        counts = table.select("event_type", F.col("version").alias("matched_version"), "handlers")
        joined = asked.join(counts, ["event_type", "matched_version"], "left")
        return joined.withColumn("handlers", F.coalesce("handlers", F.lit(0))).withColumn("fell_back", F.coalesce(F.col("matched_version") != F.col("schema_version"), F.lit(False)))

    def dispatch(self, events: DataFrame, strict: bool = False) -> tuple[DataFrame, dict[tuple[str, str, int], DataFrame], dict[tuple[str, str, int], str]]:
        """(events with matched_key, handlers_invoked, handler_failures and fell_back; the handlers' outputs; their errors).

        Handlers see the events of their key. One that raises while its plan is built counts as failed for each of them.
        """
        found = self.resolve(events)
        outputs, errors = {}, {}
        for (kind, version), handlers in self._handlers.items():
            own = found.where((F.col("event_type") == kind) & (F.col("matched_version") == version))
            for k, handler in enumerate(handlers):
                try:
                    outputs[kind, version, k] = handler(own)
                except Exception as e:
                    if strict:
                        raise
                    errors[kind, version, k] = repr(e)
        failed = F.lit(0)
        for kind, version in {e[:2] for e in errors}:
            n = sum(e[:2] == (kind, version) for e in errors)
            failed = F.when((F.col("event_type") == kind) & (F.col("matched_version") == version), n).otherwise(failed)
        told = found.withColumn("handler_failures", failed).withColumn("handlers_invoked", F.col("handlers") - F.col("handler_failures"))
        key = F.when(F.col("matched_version").isNotNull(), F.concat_ws("/", "event_type", "matched_version"))
        return told.withColumn("matched_key", key).drop("handlers"), outputs, errors


class Catalog:
    """Registered schemas. A producer's request goes to the least version of its major that is not below it."""

    def __init__(self, entries: dict[tuple[str, str], object] | None = None) -> None:
        self._entries: dict[tuple[str, str], object] = {}
        for (kind, version), schema in (entries or {}).items():
            self.register(kind, version, schema)

    def register(self, event_type: str, version: str, schema: object) -> None:
        if self._entries.setdefault((event_type, version), schema) is not schema:
            raise ValueError(f"{event_type} {version} is registered already")

    def is_registered(self, event_type: str, version: str) -> bool:
        return (event_type, version) in self._entries

    def list_versions(self, event_type: str) -> list[str]:
        return sorted(v for t, v in self._entries if t == event_type)

    def list_registered(self) -> dict[tuple[str, str], object]:
        return dict(self._entries)

    def frame(self, spark) -> DataFrame:
        table = spark.createDataFrame(sorted(self._entries), "event_type string, version string")
        return table.withColumn("parsed", parse(F.col("version")))

    def resolve(self, requests: DataFrame) -> DataFrame:
        return resolve(requests, self.frame(requests.sparkSession), lowest=True)
