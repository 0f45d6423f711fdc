"""Registries as folds over arrival order: which store a device is in, how many devices a store has, what is acknowledged."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def device_history(registrations: DataFrame, *, seq: str = "arrival_seq") -> DataFrame:
    """(device_id, store_id, valid_from, valid_to): the stretches of arrivals in which a device is in a store;
    valid_to is null while it is. Registrations that do not move a device change nothing."""
    order = Window.partitionBy("device_id").orderBy(seq)
    moved = registrations.select("device_id", "store_id", F.col(seq).alias("valid_from"), F.lag("store_id").over(order).alias("__was"))
    moved = moved.where(F.col("__was").isNull() | (F.col("__was") != F.col("store_id")))
    return moved.select("device_id", "store_id", "valid_from", F.lead("valid_from").over(Window.partitionBy("device_id").orderBy("valid_from")).alias("valid_to"))


def current(registrations: DataFrame, *, seq: str = "arrival_seq") -> DataFrame:
    """(device_id, store_id): the last registration of each device."""
    return registrations.groupBy("device_id").agg(F.max_by("store_id", seq).alias("store_id"))


def store_for(rows: DataFrame, registrations: DataFrame, *, seq: str = "arrival_seq", out: str = "store_id") -> DataFrame:
    """rows(device_id, arrival) with the store of the device as of each arrival, null if unknown. Both sides are dealt by
    the device and sorted by arrival once; a registration is known to rows of its own arrival."""
    left = rows.select("device_id", F.col(seq).alias("__at"), F.lit(1).alias("__k"), F.lit(None).cast("string").alias("__s"), F.struct("*").alias("__row"))
    right = registrations.select("device_id", F.col(seq).alias("__at"), F.lit(0).alias("__k"), F.col("store_id").alias("__s"))
    order = Window.partitionBy("device_id").orderBy("__at", "__k").rowsBetween(Window.unboundedPreceding, 0)
    known = left.unionByName(right, allowMissingColumns=True).withColumn("__known", F.last("__s", ignorenulls=True).over(order))
    return known.where("__k = 1").select("__row.*", F.col("__known").alias(out))


def count_changes(registrations: DataFrame, *, seq: str = "arrival_seq") -> DataFrame:
    """(store_id, arrival, change): +1 where a device enters a store, -1 where it leaves one."""
    order = Window.partitionBy("device_id").orderBy(seq)
    rows = registrations.select("store_id", F.col(seq).alias("__at"), F.lag("store_id").over(order).alias("__was"))
    rows = rows.where(F.col("__was").isNull() | (F.col("__was") != F.col("store_id")))
    came = rows.select("store_id", "__at", F.lit(1).alias("change"))
    left = rows.where("__was is not null").select(F.col("__was").alias("store_id"), "__at", F.lit(-1).alias("change"))
    return came.unionByName(left).withColumnRenamed("__at", seq)


def device_count(rows: DataFrame, registrations: DataFrame, *, store: str = "partition_key", seq: str = "arrival_seq", out: str = "registered_count") -> DataFrame:
    """rows with the number of devices in their store as of each arrival; 0 if unknown."""
    left = rows.select(F.col(store).alias("__s"), F.col(seq).alias("__at"), F.lit(1).alias("__k"), F.lit(0).alias("__c"), F.struct("*").alias("__row"))
    right = count_changes(registrations, seq=seq).select(F.col("store_id").alias("__s"), F.col(seq).alias("__at"), F.lit(0).alias("__k"), F.col("change").alias("__c"))
    order = Window.partitionBy("__s").orderBy("__at", "__k").rowsBetween(Window.unboundedPreceding, 0)
    known = left.unionByName(right, allowMissingColumns=True).withColumn("__n", F.sum("__c").over(order))
    return known.where("__k = 1").select("__row.*", F.col("__n").cast("long").alias(out))


def store_sizes(registrations: DataFrame, *, seq: str = "arrival_seq") -> DataFrame:
    """(store_id, devices) after all registrations; stores without a device have no row."""
    return current(registrations, seq=seq).groupBy("store_id").agg(F.count("*").alias("devices"))


def acknowledgements(acks: DataFrame, *, seq: str = "arrival_seq") -> DataFrame:
    """(alert_id, ack_seq): the first acknowledgement of each alert."""
    return acks.groupBy("alert_id").agg(F.min(seq).alias("ack_seq"))
