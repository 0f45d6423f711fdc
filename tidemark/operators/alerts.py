"""Alerts: one for each detection, marked with whether it was acknowledged when it was routed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.identity import derive, iso
from tidemark.functions.jsonx import canonical
from tidemark.operators.registries import acknowledgements

#: Entries that the event bus takes in one call.
BUS_BATCH = 10


def route(detections: DataFrame, acks: DataFrame) -> DataFrame:
    """Alerts of detections, annotated and never suppressed. acks: alert_id, arrival_seq; one counts from its arrival on."""
    named = detections.withColumn("alert_id", derive("alert", F.col("detection_id")))
    known = named.join(acknowledgements(acks), "alert_id", "left")
    told = known.withColumn("acknowledged", F.coalesce(F.col("ack_seq") <= F.col("arrival_seq"), F.lit(False)))
    return told.select(
        derive("event.alert", F.col("alert_id")).alias("event_id"), "alert_id", "detection_id", "detection_type", "severity",
        F.col("event_timestamp").alias("routed_at"), "store_id", "device_id", F.col("threshold_breached").alias("summary"),
        canonical({"acknowledged": F.col("acknowledged"), "detected_at": iso(F.col("detected_at"))}).alias("details"),
        "acknowledged", "trace_id", "arrival_seq", "ordinal",
    )


def bus_entries(alerts: DataFrame, bus: str | None, source: str = "tidemark") -> DataFrame:
    """(batch, place, bus, source, detail_type, detail): entries for an event bus in batches of BUS_BATCH; none without a bus.

    Batches are cut within the alerts of one store, in order, so that no order of all alerts is needed.
    """
    detail = F.to_json(F.struct(*[c for c in alerts.columns if c not in ("arrival_seq", "ordinal", "acknowledged")]), {"ignoreNullFields": "false"})
    row = F.row_number().over(Window.partitionBy("store_id").orderBy("arrival_seq", "ordinal", "alert_id")) - 1
    entries = alerts.withColumn("__n", row).select(
        "store_id", F.floor(F.col("__n") / BUS_BATCH).alias("batch"), (F.col("__n") % BUS_BATCH).alias("place"),
        F.lit(bus).alias("bus"), F.lit(source).alias("source"), F.concat_ws(":", "severity", "detection_type").alias("detail_type"), detail.alias("detail"),
    )
    return entries if bus else entries.limit(0)
