"""Sinks of alerts and dashboard entries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.alerts import BUS_BATCH, bus_entries
from tidemark.operators.views import time_to_live


class MemoryAlerts:
    """Alerts in the order they were published; an empty publish is a call too."""

    def __init__(self) -> None:
        self.calls: list[list[Row]] = []

    def publish(self, alerts: DataFrame) -> None:
        self.calls.append(alerts.orderBy("arrival_seq", "ordinal", "alert_id").collect())

    @property
    def alerts(self) -> list[Row]:
        return [a for call in self.calls for a in call]


class BusAlerts:
    """Alerts sent in batches of at most BUS_BATCH by put(entries), on the executors; nothing without a bus."""

    def __init__(self, bus: str | None, put: Callable[[list[dict]], None]) -> None:
        self.bus, self.put = bus, put

    def publish(self, alerts: DataFrame) -> None:
        if self.bus is None:
            return
        put = self.put

        def send(rows: Iterator[Row]) -> None:
            held: list[dict] = []
            for r in rows:
                held.append({"EventBusName": r.bus, "Source": r.source, "DetailType": r.detail_type, "Detail": r.detail})
                if len(held) == BUS_BATCH:
                    put(held)
                    held = []
            if held:
                put(held)

        bus_entries(alerts, self.bus).sortWithinPartitions("store_id", "batch", "place").foreachPartition(send)


ENTRY = "view string, key string, value string, ttl long"


def latest(entries: DataFrame, order: str | None = None) -> DataFrame:
    """One entry (view, key, value, ttl) a key: the last by `order`, or the greatest value where there is no order."""
    rank = F.struct(*([F.col(order)] if order else []), F.col("value"))
    last = entries.groupBy("view", "key").agg(F.max_by("value", rank).alias("value"))
    return last.select("view", "key", "value", time_to_live(F.col("view"), F.col("key")).alias("ttl"))


class MemoryStore:
    """Dashboard entries in the driver's memory, for tests and small fleets."""

    def __init__(self) -> None:
        self._values: dict[tuple[str, str], str] = {}

    def get(self, view: str, key: str) -> str | None:
        return self._values.get((view, key))

    def put(self, view: str, key: str, value: str) -> None:
        self._values[view, key] = value

    def delete(self, view: str, key: str) -> None:
        self._values.pop((view, key), None)

    def keys(self, view: str) -> list[str]:
        return sorted(k for v, k in self._values if v == view)

    def upsert(self, entries: DataFrame, order: str | None = None) -> None:
        """Writes entries; one whose value is null deletes its key."""
        for r in latest(entries, order).toLocalIterator():
            if r.value is None:
                self.delete(r.view, r.key)
            else:
                self.put(r.view, r.key, r.value)


class TableStore:
    """Dashboard entries (view, key, value, ttl) as a Parquet table: the last write of a key stays. None is no store.

    Every write makes a new version in a numbered folder; the greatest one that was completed is the table, also for
    a store that is opened on an existing path. The version before it stays for readers, older ones go. One
    writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str | None) -> None:
        self.spark, self.path = spark, path

    def _files(self, path: str) -> tuple:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def versions(self) -> list[int]:
        """Completed versions, in rising order: those whose folder has Spark's mark of success, which is written last."""
        fs, root = self._files(self.path)
        if not fs.exists(root):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(root)]
        return sorted(int(n) for n in names if n.isdigit() and fs.exists(self._files(f"{self.path}/{n}/_SUCCESS")[1]))

    def read(self) -> DataFrame:
        found = self.versions() if self.path is not None else []
        if not found:
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(f"{self.path}/{found[-1]}")

    def upsert(self, entries: DataFrame, order: str | None = None) -> None:
        """Writes entries; one whose value is null deletes its key. Of several entries of a key the last by order counts."""
        if self.path is None:
            return
        found = self.versions()
        new = latest(entries, order)
        kept = self.read().join(new.select("view", "key"), ["view", "key"], "left_anti")
        turn = found[-1] + 1 if found else 1
        kept.unionByName(new.where("value is not null")).write.mode("overwrite").parquet(f"{self.path}/{turn}")
        for old in found[:-1]:
            fs, place = self._files(f"{self.path}/{old}")
            fs.delete(place, True)

    def get(self, view: str, key: str) -> str | None:
        row = self.read().where((F.col("view") == view) & (F.col("key") == key)).first()
        return row and row.value

    def keys(self, view: str) -> list[str]:
        return [r.key for r in self.read().where(F.col("view") == view).select("key").orderBy("key").collect()]

    def put(self, view: str, key: str, value: str) -> None:
        self.upsert(self.spark.createDataFrame([(view, key, value)], "view string, key string, value string"))

    def delete(self, view: str, key: str) -> None:
        self.upsert(self.spark.createDataFrame([(view, key, None)], "view string, key string, value string"))
