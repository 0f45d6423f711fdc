"""Event sources: archives, packets, raw JSON, and the driver's generic events."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def archive(spark: SparkSession, path: str, start: Column | None = None, end: Column | None = None, *, ts: str = "event_timestamp") -> DataFrame:
    """Events of [start, end) of a Parquet archive; the bounds reach the scan."""
    rows = spark.read.option("mergeSchema", True).parquet(path)
    if start is not None:
        rows = rows.where(F.col(ts) >= start)
    return rows if end is None else rows.where(F.col(ts) < end)


def archive_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The same archive as a stream of its files."""
    return spark.readStream.schema(schema).parquet(path)


def raw_json(spark: SparkSession, path: str) -> DataFrame:
    """(raw) lines of JSON events, to be validated."""
    return spark.read.text(path).withColumnRenamed("value", "raw")


def packets(spark: SparkSession, path: str) -> DataFrame:
    """Captured packets, with their arrival order."""
    return spark.read.schema("arrival_seq long, src_ip string, src_port int, dst_ip string, dst_port int, sequence_number long, payload binary, timestamp timestamp, fin boolean").parquet(path)


def config(path: str) -> dict:
    """A replay's JSON configuration."""
    with open(path) as f:
        return json.load(f)


def jittered(spark: SparkSession, sf_dir: str, stores: int = 10) -> DataFrame:
    """The driver's events as telemetry that arrives up to three hours late: arrival order is the second in which an
    event arrives, then its id. Keys are event types, stores are user ids modulo stores, devices are users."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    arrival = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000 + (F.col("event_id") * 7919) % 10800
    return e.select(
        (F.floor(arrival) * 100_000_000 + F.col("event_id")).alias("arrival_seq"),
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_type").alias("partition_key"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.concat(F.lit("store-"), (F.col("user_id") % stores).cast("string")).alias("store_id"),
        F.col("user_id").cast("string").alias("device_id"),
        F.col("value"),
        F.col("event_id").cast("string").alias("trace_id"),
    )
