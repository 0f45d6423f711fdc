"""Dashboard views as folds over detections, and the reads on them. All are idempotent: a detection that comes twice counts once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.identity import iso
from tidemark.operators.detectors import ANOMALY, OFFLINE, ONLINE, OUTAGE, RECOVERED
from tidemark.operators.watermark import seconds

#: Seconds of a bucket of anomalies, and of its life beyond its start.
BUCKET, RETENTION = 60, 86_400


def _last(detections: DataFrame, keys: list[str], kinds: list[str]) -> DataFrame:
    own = detections.where(F.col("detection_type").isin(kinds))
    return own.groupBy(*keys).agg(F.max_by(F.struct("detection_type", "detected_at"), F.struct("arrival_seq", "ordinal")).alias("l")).select(*keys, "l.*")


def offline_devices(detections: DataFrame) -> DataFrame:
    """(store_id, device_ids, offline_count): devices whose last change was to offline; stores without any have no row."""
    off = _last(detections.where("device_id is not null"), ["store_id", "device_id"], [OFFLINE, ONLINE]).where(F.col("detection_type") == OFFLINE)
    return off.groupBy("store_id").agg(F.array_sort(F.collect_set("device_id")).alias("device_ids")).withColumn("offline_count", F.size("device_ids"))


def active_outages(detections: DataFrame) -> DataFrame:
    """(store_id, since): stores whose last change was an outage."""
    return _last(detections, ["store_id"], [OUTAGE, RECOVERED]).where(F.col("detection_type") == OUTAGE).select("store_id", iso(F.col("detected_at")).alias("since"))


def active_outage_count(outages: DataFrame) -> DataFrame:
    """One row: the number of stores in outage."""
    return outages.agg(F.count("*").alias("active_outages"))


def stores_in_outage(outages: DataFrame) -> DataFrame:
    """The stores in outage, in order."""
    return outages.select("store_id").orderBy("store_id")


def is_in_outage(stores: DataFrame, outages: DataFrame) -> DataFrame:
    """stores (store_id) with in_outage."""
    marks = outages.select("store_id", F.lit(True).alias("in_outage"))
    return stores.join(marks, "store_id", "left").withColumn("in_outage", F.coalesce("in_outage", F.lit(False)))


def anomaly_buckets(detections: DataFrame) -> DataFrame:
    """(signal_name, bucket, detection_ids): anomalies of the whole fleet by signal and minute; without a signal they are ignored."""
    own = detections.where(F.col("detection_type") == ANOMALY).withColumn("signal_name", F.get_json_object("details", "$.signal_name"))
    own = own.where("signal_name is not null and signal_name != ''")
    return own.groupBy("signal_name", F.window("detected_at", f"{BUCKET} seconds").start.alias("bucket")).agg(F.array_sort(F.collect_set("detection_id")).alias("detection_ids"))


def count_in_window(buckets: DataFrame, as_of: Column, window_seconds: int = 300, signals: DataFrame | None = None) -> DataFrame:
    """(signal_name, anomalies, rate_per_minute) in the buckets from that of as_of - window on and before as_of.

    signals (signal_name), if given, are those asked for: each has a row, also with no anomalies. Without, only signals
    with anomalies in the window have one.
    """
    low = F.timestamp_seconds(F.floor(F.unix_micros(as_of - seconds(window_seconds)) / (BUCKET * 1_000_000)) * BUCKET)
    seen = buckets.where((F.col("bucket") >= low) & (F.col("bucket") < as_of))
    counts = seen.groupBy("signal_name").agg(F.sum(F.size("detection_ids")).alias("anomalies"))
    if signals is not None:
        asked = signals.select("signal_name").distinct()
        counts = asked.join(counts, "signal_name", "left").withColumn("anomalies", F.coalesce("anomalies", F.lit(0).cast("long")))
    return counts.withColumn("rate_per_minute", F.col("anomalies") / (window_seconds / 60.0))


def as_entries(detections: DataFrame) -> DataFrame:
    """(view, key, value): the three views as one table of strings."""
    return (
        offline_devices(detections).select(F.lit("offline_count").alias("view"), F.col("store_id").alias("key"), F.to_json("device_ids").alias("value"))
        .unionByName(active_outages(detections).select(F.lit("active_outage").alias("view"), F.col("store_id").alias("key"), F.col("since").alias("value")))
        .unionByName(anomaly_buckets(detections).select(F.lit("anomaly_rate").alias("view"), F.concat_ws("|", F.col("signal_name"), iso(F.col("bucket"))).alias("key"), F.to_json("detection_ids").alias("value")))
    )


def time_to_live(view: Column, key: Column, retention: int = RETENTION) -> Column:
    """Seconds since the epoch at which an entry expires; null for views that do not expire and keys without a time."""
    at = F.try_to_timestamp(F.substring_index(key, "|", -1))
    return F.when(view == "anomaly_rate", F.unix_timestamp(at) + retention)


def route_detections(detections: DataFrame, projections: dict[str, Callable[[DataFrame], DataFrame]], strict: bool = False) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """(views, failures): every projection is offered all detections; one that raises is reported, or raised if strict."""
    views, failures = {}, {}
    for name, fold in projections.items():
        try:
            views[name] = fold(detections)
        except Exception as e:
            if strict:
                raise
            failures[name] = repr(e)
    return views, failures
