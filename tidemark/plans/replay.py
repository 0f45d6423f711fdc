"""Replay: the same pipeline over an archive, with isolated targets.

python -m tidemark.plans.replay config.json, with {"archive": path, "start": time, "end": time, "output": path or null}.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import detectors
from tidemark.plans.pipeline import Pipeline, Result
from tidemark.settings import Settings
from tidemark.sources import events as sources


def fleet_pipeline(settings: Settings, registrations: DataFrame, shard: str | None = "store_id") -> Pipeline:
    """The default composition: keyed by store, offline devices found by following every event of a shard.

    A shard is a store, so that a fleet is spread over tasks and a store's silence shows at its own next event.
    Another column makes other shards; None makes the whole fleet one, which one task then follows.
    """
    threshold = settings.offline_threshold_seconds
    named = lambda df: df.withColumn("shard", F.lit("0") if shard is None else F.col(shard).cast("string"))
    return Pipeline(settings, F.col("store_id")).register_event_detector("offline", lambda e: detectors.offline_general(named(e), named(registrations), threshold))


def summary(result: Result) -> DataFrame:
    """One row of a run's counters: events by class, emissions, detections, alerts, features, handlers that ran or failed."""
    rows = [*result.emissions.values()]
    none = result.classified.sparkSession.createDataFrame([], "x int").agg(F.count("*").alias("n"))
    counted = {
        "emissions": [r.agg(F.count("*").alias("n")) for r in rows],
        **{k: [r.agg(F.count("*").alias("n"))] if r is not None else [] for k, r in (("detections", result.detections), ("alerts", result.alerts), ("features", result.features))},
        "handlers_invoked": [result.dispatched.agg(F.coalesce(F.sum("handlers_invoked"), F.lit(0)).alias("n"))] if result.dispatched is not None else [],
        "handler_failures": [result.dispatched.agg(F.coalesce(F.sum("handler_failures"), F.lit(0)).alias("n"))] if result.dispatched is not None else [],
    }
    counts = None
    for name, parts in counted.items():
        for part in parts or [none]:
            one = part.select(F.lit(name).alias("name"), F.col("n").cast("long").alias("n"))
            counts = one if counts is None else counts.unionByName(one)
    of_events = result.summary.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("long").alias("n")) for c in result.summary.columns])).alias("s")).select("s.*")
    names = [*result.summary.columns, *counted]
    return counts.unionByName(of_events).agg(*[F.sum(F.when(F.col("name") == k, F.col("n"))).alias(k) for k in names])


def run_replay(settings: Settings, events: DataFrame, build: Callable[[Settings], Pipeline]) -> tuple[Result, dict]:
    """(result, summary) of a pipeline built with the replay settings."""
    own = settings.for_replay()
    pipeline = build(own)
    result = pipeline.run(events)
    pipeline.write(result, own.dataset_root)
    return result, {"environment": own.environment, **summary(result).first().asDict()}


def window(start: Column, end: Column) -> Column:
    """Whether an event is in [start, end)."""
    return (F.col("event_timestamp") >= start) & (F.col("event_timestamp") < end)


def main(argv: list[str]) -> int:
    """Exit code 2 for wrong usage."""
    if len(argv) != 1:
        print("usage: python -m tidemark.plans.replay CONFIG.json", file=sys.stderr)
        return 2
    try:
        config = sources.config(argv[0])
        archive, start, end = config["archive"], config["start"], config["end"]
    except (OSError, ValueError, KeyError) as e:
        print(f"{argv[0]}: {e!r}", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("tidemark-replay").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    rows = sources.archive(spark, archive, F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
    facts = rows.where(F.col("event_type").isin("device.registration", "sip.registration")) if "event_type" in rows.columns else rows.where("false")
    own = Settings.from_env()
    pipeline = fleet_pipeline(own.for_replay(), facts.select("arrival_seq", "device_id", "store_id"))
    result = pipeline.run(rows)
    pipeline.write(result, config.get("output"))
    print(summary(result).first().asDict())
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
