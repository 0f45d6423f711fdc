"""Helpers that several operators share: tables that cut lineage, digests, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only in local mode without a setting."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is executed inside hands Python at most so many rows at once, for rows that are large themselves."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, was)


_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are removed at the end, but for those that are to outlive it."""
    made: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), made))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        for path in made:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, *, outlives: bool = False) -> DataFrame:
    """Writes df to the shared folder and reads it back: lost executors then cost no recomputation.

    The table goes with the innermost scratch() around the call, or, if it outlives that, with the next one.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{uuid.uuid4().hex}"
    scopes = _SCOPES.get()[: -1 if outlives else None]
    if scopes:
        scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a long, b long): (id, component), component the least id reachable.

    Each round sends every node to the least of its neighbourhood, follows these pointers twice more and
    contracts the edges; the rounds needed grow with the logarithm of the longest chain. Minima are
    combined before the shuffle, and joins read written tables, so that AQE can split a hub's rows.
    """
    spark = edges.sparkSession
    with scratch(spark):
        left = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
        labels = None
        while not left.isEmpty():
            both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
            near = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("to")))
            one, two = (near.select(F.col("id").alias(f"i{k}"), F.col("to").alias(f"t{k}")) for k in (1, 2))
            up = written(near.join(one, F.col("to") == F.col("i1")).join(two, F.col("t1") == F.col("i2")).select("id", F.least("to", "t1", "t2").alias("to")))
            if labels is None:
                labels = up
            else:
                step = up.select(F.col("id").alias("to"), F.col("to").alias("next"))
                labels = written(labels.join(step, "to", "left").select("id", F.coalesce("next", "to").alias("to")))
            left = written(
                left.join(up.select(F.col("id").alias("a"), F.col("to").alias("ta")), "a")
                .join(up.select(F.col("id").alias("b"), F.col("to").alias("tb")), "b")
                .where("ta != tb")
                .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
                .distinct()
            )
        if labels is None:
            return spark.createDataFrame([], "id long, component long")
        return written(labels.select("id", F.col("to").alias("component")), outlives=True)


def merged(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Components (id, component) after more edges: only the components they join are worked on."""
    if labels is None:
        return components(edges)
    with scratch(edges.sparkSession):
        own = lambda c: F.coalesce(F.col(f"{c}c"), F.col(c)).alias(c)
        side = lambda c: labels.select(F.col("id").alias(c), F.col("component").alias(f"{c}c"))
        found = components(edges.join(side("a"), "a", "left").join(side("b"), "b", "left").select(own("a"), own("b")))
        step = found.select(F.col("id").alias("component"), F.col("component").alias("to"))
        old = labels.join(step, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
        return written(old.unionByName(found.join(labels.select("id"), "id", "left_anti")), outlives=True)
