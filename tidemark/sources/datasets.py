"""Hourly, Hive-partitioned Parquet datasets of detections, emissions and features."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.settings import Settings

#: The partition columns of a dataset, in the order of its folders.
PARTITION = ["store_id", "year", "month", "day", "hour"]


@contextmanager
def conf(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session while the block runs."""
    was = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if was is None else spark.conf.set(name, was)


def hour(ts: Column) -> Column:
    """A time truncated to its hour."""
    return F.date_trunc("hour", ts)


def partitioned(rows: DataFrame, store: str, ts: str) -> DataFrame:
    """rows with padded partition columns; emissions go by window_start, detections by event_timestamp, features by window_start."""
    at = F.col(ts)
    own = rows.withColumnRenamed(store, "store_id") if store != "store_id" else rows
    return own.withColumns({"year": F.date_format(at, "yyyy"), "month": F.date_format(at, "MM"), "day": F.date_format(at, "dd"), "hour": F.date_format(at, "HH")})


def object_key(kind: str, store: Column, ts: Column, sequence: Column) -> Column:
    """The path of a partition's file: kind/store_id=/year=/month=/day=/hour=/<8 digits>.parquet."""
    return F.concat(F.lit(f"{kind}/store_id="), store, F.date_format(ts, "'/year='yyyy'/month='MM'/day='dd'/hour='HH'/'"), F.lpad(sequence.cast("string"), 8, "0"), F.lit(".parquet"))


def write(rows: DataFrame, root: str | None, kind: str, *, store: str, ts: str, order: list[str], mode: str = "append") -> None:
    """Writes one record type below root/kind: one task and file for a partition, rows in total order, snappy, no
    dictionary, microseconds. Without a root nothing is written."""
    if root is None:
        return
    own = partitioned(rows, store, ts)
    dealt = own.repartition(*PARTITION).sortWithinPartitions(*PARTITION, *order)
    with conf(rows.sparkSession, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS"):
        dealt.write.mode(mode).option("compression", "snappy").option("parquet.enable.dictionary", "false").partitionBy(*PARTITION).parquet(f"{root}/{kind}")


def write_emissions(emissions: dict[str, DataFrame], root: str | None, *, mode: str = "append") -> None:
    """Every aggregation's emissions below emissions/<name>, each with its own type of value."""
    for name, rows in emissions.items():
        write(rows, root, f"emissions/{name}", store="partition_key", ts="window_start", order=["window_start", "arrival_seq", "is_repair"], mode=mode)


def write_detections(rows: DataFrame, root: str | None, *, mode: str = "append") -> None:
    write(rows, root, "detections", store="store_id", ts="event_timestamp", order=["event_timestamp", "detection_type", "detection_id", "arrival_seq"], mode=mode)


def write_features(rows: DataFrame, root: str | None, *, mode: str = "append") -> None:
    write(rows, root, "features", store="partition_key", ts="window_start", order=["window_start", "arrival_seq"], mode=mode)


def read(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """A dataset with the union of its files' columns, null where a file is older than a column; its partition
    columns are text, as in the folders' names."""
    with conf(spark, "spark.sql.sources.partitionColumnTypeInference.enabled", "false"):
        return spark.read.option("mergeSchema", True).option("basePath", f"{root}/{kind}").parquet(f"{root}/{kind}")


def union_versions(tables: list[DataFrame]) -> DataFrame:
    """Tables of several schema versions as one."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


#: The record types of a flush, each with its columns of store and time and what orders its rows.
RECORDS = {
    "emissions": ("partition_key", "window_start", ["arrival_seq", "window_start", "is_repair"]),
    "detections": ("store_id", "event_timestamp", ["arrival_seq", "ordinal", "detection_id"]),
    "features": ("partition_key", "window_start", ["arrival_seq", "window_start"]),
}


def flush_plan(records: dict[str, DataFrame]) -> DataFrame:
    """Every record of a run in the flush that takes it: (kind, store_id, hour, sequence, record, arrival_seq).

    records: rows of each type in RECORDS, each with the arrival_seq of the event that caused it. Detections and
    features wait in their partition (store and hour) for an emission of it; the event that brings one flushes
    all that has come by then, as the partition's next sequence number. What waits for no emission has a null
    sequence. So the flush of a record is the first emission's event of its partition at or after its own.
    """
    rows = None
    for kind, (store, ts, order) in RECORDS.items():
        if kind not in records:
            continue
        df = records[kind]
        own = df.select(
            F.lit(kind).alias("kind"), F.col(store).alias("store_id"), hour(F.col(ts)).alias("hour"), F.col("arrival_seq").alias("arrival_seq"),
            F.to_json(F.struct(*[F.col(c) for c in [*order, *[c for c in df.columns if c not in order]]]), {"ignoreNullFields": "false"}).alias("record"),
        )
        rows = own if rows is None else rows.unionByName(own)
    if rows is None:
        raise ValueError("no records")
    marks = rows.where("kind = 'emissions'").select("store_id", "hour", F.col("arrival_seq").alias("flushed_by")).distinct()
    marks = marks.withColumn("sequence", F.row_number().over(Window.partitionBy("store_id", "hour").orderBy("flushed_by")).cast("long") - 1)
    # the next mark at or after a record: marks come after records of their own event
    both = rows.withColumn("__at", F.struct(F.col("arrival_seq").alias("a"), F.lit(0).alias("k"))).unionByName(
        marks.select("store_id", "hour", F.struct(F.col("flushed_by").alias("a"), F.lit(1).alias("k")).alias("__at"), F.struct("flushed_by", "sequence").alias("__mark")), allowMissingColumns=True
    )
    ahead = Window.partitionBy("store_id", "hour").orderBy("__at").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    taken = both.withColumn("__next", F.min("__mark").over(ahead)).where("kind is not null")
    return taken.select("kind", "store_id", "hour", "arrival_seq", F.col("__next.flushed_by").alias("flushed_by"), F.col("__next.sequence").alias("sequence"), "record")


class MemoryDatasets:
    """Flushes in the driver's memory, in the order they happen: the event's, then that in which its emissions first name partitions."""

    def __init__(self) -> None:
        self.flushes: list[Row] = []
        self.waiting: list[Row] = []

    def write(self, records: dict[str, DataFrame]) -> None:
        plan = flush_plan(records)
        kinds = [F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("record")))).alias(k) for k in RECORDS]
        first = F.min(F.when(F.col("kind") == "emissions", F.struct("arrival_seq", "record"))).alias("first")
        done = plan.where("sequence is not null").groupBy("flushed_by", "store_id", "hour", "sequence").agg(*kinds, first)
        self.flushes += done.orderBy("flushed_by", "first", "store_id", "hour").drop("first").collect()
        self.waiting += plan.where("sequence is null").orderBy("store_id", "hour", "arrival_seq").collect()

    def buffered_partitions(self) -> set[tuple]:
        return {(r.store_id, r.hour) for r in self.waiting}


class BufferedDatasets:
    """The same over batches, for foreachBatch: what waits is a table below root/_waiting, read with the next batch.

    Every batch writes the records that its emissions flush below root/<kind>, in the partition's folder with the
    columns batch and sequence, and all that still waits. The batch number makes it safe to repeat: files of a batch
    are replaced, and its input is what waited after the batch before it. Nothing without a root.
    """

    def __init__(self, spark: SparkSession, root: str | None) -> None:
        self.spark, self.root = spark, root

    def _waiting(self, batch: int) -> str:
        return f"{self.root}/_waiting/{batch}"

    def write(self, records: dict[str, DataFrame], batch: int) -> None:
        if self.root is None:
            return
        plan = flush_plan(records).select("kind", "store_id", "hour", "arrival_seq", "record")
        if batch > 0:
            plan = plan.unionByName(self.spark.read.schema(plan.schema).parquet(self._waiting(batch - 1)))
        marks = records["emissions"].select(F.col("partition_key").alias("store_id"), hour(F.col("window_start")).alias("hour")).distinct() if "emissions" in records else None
        taken = plan if marks is None else plan.join(marks, ["store_id", "hour"], "left_semi")
        left = plan if marks is None else plan.join(marks, ["store_id", "hour"], "left_anti")
        left.write.mode("overwrite").parquet(self._waiting(batch))
        if batch > 1:  # a batch that is repeated reads the one before it, and no older one
            place = self.spark._jvm.org.apache.hadoop.fs.Path(self._waiting(batch - 2))
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
        if marks is not None:
            place = F.row_number().over(Window.partitionBy("kind", "store_id", "hour").orderBy("arrival_seq", "record")) - 1
            done = taken.withColumn("place", place).withColumn("batch", F.lit(batch))
            done = done.withColumns({"year": F.date_format("hour", "yyyy"), "month": F.date_format("hour", "MM"), "day": F.date_format("hour", "dd")}).withColumn("hour", F.date_format("hour", "HH"))
            with conf(self.spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
                done.write.mode("overwrite").partitionBy("kind", "batch", *PARTITION).parquet(f"{self.root}/records")

    def read(self) -> DataFrame:
        """All flushed records: kind, batch, the partition's columns, place, arrival_seq and record."""
        with conf(self.spark, "spark.sql.sources.partitionColumnTypeInference.enabled", "false"):
            return self.spark.read.parquet(f"{self.root}/records").withColumn("batch", F.col("batch").cast("long"))


def from_settings(spark: SparkSession, settings: Settings) -> BufferedDatasets:
    """The writer that settings name; one that writes nothing if they name none."""
    return BufferedDatasets(spark, settings.dataset_root)


def flushed(emissions: DataFrame, rows: DataFrame, store: str, ts: str) -> DataFrame:
    """The rows of a batch whose partition has an emission in the batch: what a buffering writer would flush."""
    marks = emissions.select(F.col("partition_key").alias("__s"), hour(F.col("window_start")).alias("__h")).distinct()
    return rows.join(marks, (F.col(store) == F.col("__s")) & (hour(F.col(ts)) == F.col("__h")), "left_semi")


def value_type(rows: DataFrame, column: str = "value") -> str:
    """The stored type of a value: booleans, whole numbers and numbers as they are, all else as JSON text."""
    kind = rows.schema[column].dataType.simpleString()
    if kind == "boolean":
        return "boolean"
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return "bigint"
    return "double" if kind in ("float", "double") or kind.startswith("decimal") else "string"


def typed(rows: DataFrame, column: str = "value") -> DataFrame:
    """rows with the value in its stored type."""
    kind = value_type(rows, column)
    simple = rows.schema[column].dataType.simpleString()
    return rows.withColumn(column, F.to_json(column) if kind == "string" and simple != "string" else F.col(column).cast(kind))


def foreach_batch(write_batch: Callable[[DataFrame], None]) -> Callable[[DataFrame, int], None]:
    """A batch writer as a streaming sink."""
    return lambda df, _: write_batch(df)
