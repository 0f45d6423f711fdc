"""Per-key watermarks and lateness classes, a function of event times and arrival order only.

With H the greatest event time of a key so far, the watermark after an event is H - L. An event is classed
against the watermark before it: on time at or above it, tolerated up to L below it, else dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ON_TIME, TOLERATED, DROPPED = "on_time", "late_tolerated", "late_dropped"


def seconds(n: float) -> Column:
    """An interval of n seconds."""
    return F.make_dt_interval(secs=F.lit(float(n)))


def with_watermark(events: DataFrame, lateness: float, *, key: str = "partition_key", ts: str = "event_timestamp", seq: str = "arrival_seq", span: int | None = None) -> DataFrame:
    """events with high_event_timestamp, watermark and classification.

    span, if given, splits every key into stretches of that many arrival numbers: a stretch starts from the
    greatest time of the stretches before it, so one key's events are spread over many tasks. The result is
    the same. Null or empty keys are an error of the caller (see extract_key).
    """
    if lateness < 0:
        raise ValueError("lateness must not be negative")
    if span:
        events = events.withColumn("__stretch", F.floor(F.col(seq) / span))
        tops = events.groupBy(key, "__stretch").agg(F.max(ts).alias("__top"))
        before = Window.partitionBy(key).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
        tops = tops.select(key, "__stretch", F.max("__top").over(before).alias("__base"))
        events = events.join(tops, [key, "__stretch"])
        order = Window.partitionBy(key, "__stretch").orderBy(seq)
        before_it = F.greatest("__base", F.max(ts).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    else:
        order = Window.partitionBy(key).orderBy(seq)
        before_it = F.max(ts).over(order.rowsBetween(Window.unboundedPreceding, -1))
    late = seconds(lateness)
    classed = events.withColumn("__before", before_it - late)
    gone = F.when(F.col("__before") - F.col(ts) <= late, TOLERATED).otherwise(DROPPED) if lateness else F.lit(DROPPED)
    kind = F.when(F.col("__before").isNull() | (F.col(ts) >= F.col("__before")), ON_TIME).otherwise(gone)
    high = F.greatest(F.col("__before") + late, F.col(ts))
    out = classed.withColumn("high_event_timestamp", high).withColumn("classification", kind).withColumn("watermark", F.col("high_event_timestamp") - late)
    return out.drop("__before", "__stretch", "__base")


def watermark_for(events: DataFrame, lateness: float, *, key: str = "partition_key", ts: str = "event_timestamp") -> DataFrame:
    """(key, watermark) after all events; a key without events has no row."""
    return events.groupBy(key).agg((F.max(ts) - seconds(lateness)).alias("watermark"))


def global_watermark(events: DataFrame, lateness: float, *, key: str = "partition_key", ts: str = "event_timestamp") -> DataFrame:
    """One row: the least watermark of any key; null without events."""
    return watermark_for(events, lateness, key=key, ts=ts).agg(F.min("watermark").alias("watermark"))


def by_source(source: str = "source") -> Column:
    """The key of an event by its source."""
    return F.col(source)


def by_payload_field(field: str) -> Column:
    """The key of an event by a field of its payload, as text."""
    return F.col(f"payload.{field}").cast("string")


def extract_key(events: DataFrame, key: Column, pattern: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(events with partition_key, events without): a null or empty key, or one that does not match the
    pattern, is an extraction failure and reaches no other operator."""
    keyed = events.withColumn("partition_key", key)
    good = F.col("partition_key").isNotNull() & (F.col("partition_key") != "")
    if pattern:
        good = good & F.col("partition_key").rlike(pattern)
    return keyed.where(good), keyed.where(~good | F.col("partition_key").isNull()).drop("partition_key").withColumn("extraction_failed", F.lit(True))


def checked_key(key: Column, pattern: str | None = None) -> Column:
    """The key, or an error that ends the query: for callers to whom an empty or malformed key is a broken contract."""
    good = key.isNotNull() & (key != "")
    if pattern:
        good = good & key.rlike(pattern)
    return F.when(F.coalesce(good, F.lit(False)), key).otherwise(F.raise_error(F.concat(F.lit("no partition key: "), F.coalesce(key, F.lit("null")))))


def batch_summary(classified: DataFrame, failures: DataFrame) -> DataFrame:
    """One row of counts of a batch."""
    kinds = [F.count_if(F.col("classification") == k).alias(k) for k in (ON_TIME, TOLERATED, DROPPED)]
    both = classified.select(F.col("classification")).unionByName(failures.select(F.lit(None).cast("string").alias("classification")))
    return both.agg(F.count("*").alias("events"), *kinds, F.count_if(F.col("classification").isNull()).alias("extraction_failures"))
