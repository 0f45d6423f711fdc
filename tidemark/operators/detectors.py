"""Detectors: rows where a condition changes, never where it lasts."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.identity import derive, iso, plain
from tidemark.functions.jsonx import canonical
from tidemark.operators.registries import store_for
from tidemark.operators.watermark import seconds

#: The types of detections and their severities.
OFFLINE, ONLINE = "device.offline", "device.online"
OUTAGE, RECOVERED = "store.outage", "store.recovered"
ANOMALY = "signal.anomaly"
SEVERITY = {OFFLINE: "WARNING", ONLINE: "INFO", OUTAGE: "CRITICAL", RECOVERED: "INFO", ANOMALY: "WARNING"}

COLUMNS = ["event_id", "detection_id", "detection_type", "severity", "detected_at", "event_timestamp", "store_id", "device_id", "source_event_id", "threshold_breached", "details", "trace_id", "arrival_seq", "ordinal"]


def _shaped(rows: DataFrame, kind: Column, detection_id: Column, source_event: Column, at: Column, store: Column, device: Column, text: Column, details: Column, trace: Column, ordinal: Column) -> DataFrame:
    level = F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv])
    named = rows.select(
        detection_id.alias("detection_id"), kind.alias("detection_type"), level[kind].alias("severity"), at.alias("detected_at"), at.alias("event_timestamp"),
        store.alias("store_id"), device.alias("device_id"), source_event.alias("source_event_id"), text.alias("threshold_breached"), details.alias("details"),
        trace.alias("trace_id"), F.col("arrival_seq"), ordinal.cast("int").alias("ordinal"),
    )
    return named.withColumn("event_id", derive("event.detection", F.col("detection_id"))).select(COLUMNS)


def _order(key: str) -> object:
    return Window.partitionBy(key).orderBy("arrival_seq", "window_start", "is_repair")


def pyfloat(x: Column) -> Column:
    """A double as text in the shortest form, as in 12.0 or 0.25."""
    return x.cast("double").cast("string")


def anomalies(emissions: DataFrame, signal: str, threshold: float, comparison: str = "above", *, aggregation: str = "signal_value", key: str = "partition_key", whole: bool = False) -> DataFrame:
    """A detection where a key's value passes the threshold and did not before; repairs count like closures.

    emissions with another aggregation_name are not seen. whole: values and threshold are integers in texts.
    """
    if comparison not in ("above", "below"):
        raise ValueError("comparison is above or below")
    seen = emissions.where(F.col("aggregation_name") == aggregation)
    beyond = F.col("value") > threshold if comparison == "above" else F.col("value") < threshold
    moved = seen.withColumn("__on", beyond).withColumn("__was", F.lag("__on", 1, False).over(_order(key))).where("__on and not __was")
    value = F.col("value").cast("long" if whole else "double")
    shown = value.cast("string")
    limit = F.lit(int(threshold) if whole else float(threshold))
    coords = [F.col(key), F.lit(signal), plain(F.col("window_start")), plain(F.col("window_end"))]
    details = canonical({"signal_name": F.lit(signal), "value": value, "threshold": limit, "comparison": F.lit(comparison), "window_start": iso(F.col("window_start")), "window_end": iso(F.col("window_end"))})
    text = F.concat(F.lit(f"{signal} "), shown, F.lit(f" {comparison} threshold "), limit.cast("string"))
    return _shaped(moved, F.lit(ANOMALY), derive("detection.signal_anomaly", *coords), derive("source.signal_anomaly", *coords), F.col("window_end"), F.col(key), F.lit(None).cast("string"), text, details, F.col("last_contributing_trace_id"), F.lit(0))


def outages(emissions: DataFrame, threshold: float, *, aggregation: str = "distinct_devices", key: str = "partition_key") -> DataFrame:
    """store.outage where the share of a store's devices that did not report passes the threshold, store.recovered where
    it falls back. emissions carry registered_count (see registries.device_count); stores without devices are not judged
    and keep their state."""
    if not 0.0 < threshold < 1.0:
        raise ValueError("the threshold is between 0 and 1")
    seen = emissions.where((F.col("aggregation_name") == aggregation) & (F.col("registered_count") > 0))
    offline = F.greatest(F.lit(0).cast("long"), F.col("registered_count") - F.col("value").cast("long"))
    rated = seen.withColumn("__off", offline).withColumn("__ratio", F.col("__off") / F.col("registered_count"))
    rated = rated.withColumn("__on", F.col("__ratio") > threshold).withColumn("__was", F.lag("__on", 1, False).over(_order(key))).where("__on != __was")
    coords = [F.col(key), plain(F.col("window_start")), plain(F.col("window_end"))]
    pick = lambda a, b: F.when(F.col("__on"), a).otherwise(b)
    percent = F.bround(F.col("__ratio") * 100).cast("long").cast("string")
    limit = str(round(threshold * 100))
    n, k = F.col("registered_count").cast("string"), F.col("__off").cast("string")
    text = pick(
        F.concat(k, F.lit(" of "), n, F.lit(" devices not reporting ("), percent, F.lit(f"% offline, threshold {limit}%)")),
        F.concat((F.col("registered_count") - F.col("__off")).cast("string"), F.lit(" of "), n, F.lit(" devices reporting ("), percent, F.lit(f"% offline, below threshold {limit}%)")),
    )
    fields = {"offline_count": F.col("__off"), "registered_count": F.col("registered_count"), "offline_ratio": F.col("__ratio"), "threshold_ratio": F.lit(float(threshold)), "window_start": iso(F.col("window_start")), "window_end": iso(F.col("window_end"))}
    details = pick(canonical(fields), canonical({**fields, "recovered": F.lit(True)}))
    ids = lambda role: pick(derive(f"{role}.store_outage", *coords), derive(f"{role}.store_recovered", *coords))
    return _shaped(rated, pick(F.lit(OUTAGE), F.lit(RECOVERED)), ids("detection"), ids("source"), F.col("window_end"), F.col(key), F.lit(None).cast("string"), text, details, F.col("last_contributing_trace_id"), F.lit(0))


def _offline_rows(moves: DataFrame, threshold: int) -> DataFrame:
    """Detections from moves(kind, device_id, store_id, source_event_id, at, silent_us, trace_id, arrival_seq, first_seen)."""
    off = F.col("kind") == OFFLINE
    silent = F.floor(F.col("silent_us") / 1_000_000).cast("long")
    text = F.when(off, F.concat(F.lit("no events for "), silent.cast("string"), F.lit(f"s (threshold {threshold}s)"))).otherwise("device reporting again after silence")
    details = F.when(off, canonical({"silent_seconds": silent, "threshold_seconds": F.lit(threshold)})).otherwise(canonical({"recovered": F.lit(True)}))
    coords = [F.col("store_id"), F.col("device_id"), F.col("source_event_id")]
    ids = F.when(off, derive("detection.device_offline", *coords)).otherwise(derive("detection.device_online", *coords))
    rank = F.row_number().over(Window.partitionBy("shard", "arrival_seq").orderBy(off.asc(), "first_seen")) - 1
    ranked = moves.where("store_id is not null and store_id != ''").withColumn("__rank", rank)
    return _shaped(ranked, F.col("kind"), ids, F.col("source_event_id"), F.col("at"), F.col("store_id"), F.col("device_id"), text, details, F.col("trace_id"), F.col("__rank"))


def offline_in_order(events: DataFrame, threshold: int, *, shard: str = "shard") -> DataFrame:
    """device.offline and device.online of events whose arrival order is their time order within a shard.

    events: shard, arrival_seq, event_id, event_timestamp, device_id, store_id (of the device, known from its first event on),
    trace_id. A device last seen at l goes offline at the first event of the shard, before its own next one, whose time
    is beyond l + threshold. A null device has no effect. Gaps take a window by device, discovery one by shard: a
    shard is one order, so use as many shards as the deployment has.
    """
    own = events.where("device_id is not null").select(F.col(shard).alias("shard"), "arrival_seq", "event_id", F.col("event_timestamp").alias("at"), "device_id", "store_id", "trace_id")
    by_device = Window.partitionBy("shard", "device_id").orderBy("arrival_seq")
    gaps = own.withColumn("next_seq", F.lead("arrival_seq").over(by_device)).withColumn("first_seen", F.first("arrival_seq").over(by_device))
    tick = F.struct("arrival_seq", "event_id", "at", "trace_id")
    ticks = own.select("shard", F.col("at").alias("t"), F.lit(True).alias("tick"), tick.alias("n"))
    probes = gaps.select("shard", (F.col("at") + seconds(threshold)).alias("t"), F.lit(False).alias("tick"), F.struct("*").alias("g"))
    # beyond, not at: probes stand before ticks of their time when the times fall
    order = Window.partitionBy("shard").orderBy(F.desc("t"), F.asc("tick")).rowsBetween(Window.unboundedPreceding, 0)
    found = ticks.unionByName(probes, allowMissingColumns=True).withColumn("first", F.min("n").over(order)).where("not tick")
    silent = found.select("g.*", "first").where(F.col("first.arrival_seq").isNotNull() & (F.col("next_seq").isNull() | (F.col("first.arrival_seq") < F.col("next_seq"))))
    offline = silent.select("shard", F.lit(OFFLINE).alias("kind"), "device_id", "store_id", F.col("first.event_id").alias("source_event_id"), F.col("first.at").alias("at"), (F.unix_micros("first.at") - F.unix_micros("at")).alias("silent_us"), F.col("first.trace_id").alias("trace_id"), F.col("first.arrival_seq").alias("arrival_seq"), "first_seen")
    # the event that ends a silence brings the device back
    back = silent.where("next_seq is not null").select("shard", F.col("next_seq").alias("arrival_seq"), "device_id", "first_seen")
    online = back.join(own, ["shard", "arrival_seq", "device_id"]).select("shard", F.lit(ONLINE).alias("kind"), "device_id", "store_id", F.col("event_id").alias("source_event_id"), "at", F.lit(None).cast("long").alias("silent_us"), "trace_id", "arrival_seq", "first_seen")
    return _offline_rows(offline.unionByName(online), threshold)


_MOVES = "shard string, kind string, device_id string, store_id string, source_event_id string, at timestamp, silent_us long, trace_id string, arrival_seq long, first_seen long"


class Silence:
    """The state of a shard: when each device was last seen, and whether it is offline.

    Times last seen wait in a heap, so that an event looks at those only that its time has passed. An entry that a
    later event of its device made void is dropped when it comes up; one whose device is not registered yet is set
    aside until it is.
    """

    def __init__(self, threshold: int):
        self.limit = threshold * 1_000_000
        self.last: dict[str, int] = {}
        self.offline: set[str] = set()
        self.first: dict[str, int] = {}
        self.store: dict[str, str] = {}
        self.due: list[tuple[int, str]] = []
        self.aside: set[str] = set()

    def register(self, device: str, store: str) -> None:
        self.store[device] = store
        if store and device in self.aside:
            self.aside.discard(device)
            heappush(self.due, (self.last[device], device))

    def see(self, seq: int, micros: int, device: str) -> Iterator[tuple[str, str, int | None]]:
        """(kind, device, silence) of what an event shows: first that its device is back, then who is silent."""
        self.last[device] = micros
        self.first.setdefault(device, seq)
        self.aside.discard(device)
        heappush(self.due, (micros, device))
        if device in self.offline:
            self.offline.discard(device)
            if self.store.get(device):
                yield ONLINE, device, None
        silent = []
        while self.due and micros - self.due[0][0] > self.limit:
            then, other = heappop(self.due)
            if self.last[other] != then or other in self.offline:
                continue
            if not self.store.get(other):
                self.aside.add(other)
                continue
            self.offline.add(other)
            silent.append((self.first[other], other, micros - then))
        for _, other, length in sorted(silent):
            yield OFFLINE, other, length


def offline_general(events: DataFrame, registrations: DataFrame, threshold: int, *, shard: str = "shard") -> DataFrame:
    """The same for events that arrive out of time order, and devices that register late: a shard's events are followed
    one by one, in sorted partitions and a batch at a time. registrations: shard, arrival_seq, device_id, store_id; one
    is known to the event of its arrival. A shard's state has an entry a device."""
    rows = events.where("device_id is not null").select(F.col(shard).alias("shard"), "arrival_seq", F.lit(1).alias("k"), F.unix_micros("event_timestamp").alias("us"), "event_id", "device_id", F.lit(None).cast("string").alias("store_id"), "trace_id")
    facts = registrations.select(F.col(shard).alias("shard"), "arrival_seq", F.lit(0).alias("k"), F.lit(None).cast("long").alias("us"), F.lit(None).cast("string").alias("event_id"), "device_id", "store_id", F.lit(None).cast("string").alias("trace_id"))
    schema = pa.schema([("shard", pa.string()), ("kind", pa.string()), ("device_id", pa.string()), ("store_id", pa.string()), ("source_event_id", pa.string()), ("at", pa.timestamp("us", "UTC")), ("silent_us", pa.int64()), ("trace_id", pa.string()), ("arrival_seq", pa.int64()), ("first_seen", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, Silence(threshold)
        for batch in batches:
            out = []
            for own, seq, k, us, event, device, store, trace in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if own != name:
                    name, state = own, Silence(threshold)
                if k == 0:
                    state.register(device, store)
                    continue
                for kind, other, silent in state.see(seq, us, device):
                    out.append((own, kind, other, state.store[other], event, us, silent, trace, seq, state.first[other]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)

    dealt = rows.unionByName(facts).repartition("shard").sortWithinPartitions("shard", "arrival_seq", "k")
    return _offline_rows(dealt.mapInArrow(run, _MOVES), threshold)


def with_store(events: DataFrame, registrations: DataFrame) -> DataFrame:
    """events with the store of their device as of their arrival."""
    return store_for(events, registrations)
