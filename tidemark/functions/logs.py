"""Expressions over log records, trace headers and queue messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The keys of an event that may be logged, and the headers that carry a trace.
SAFE_KEYS = ["source", "detail-type", "id", "time", "region", "account"]
TRACE_HEADERS = {
    "trace_id": "x-trace-id",
    "span_id": "x-trace-span-id",
    "parent_span_id": "x-trace-parent-id",
    "correlation_id": "x-trace-correlation-id",
    "pipeline_stage": "x-trace-pipeline-stage",
}
LEVELS = {10: "DEBUG", 20: "INFO", 30: "WARNING", 40: "ERROR", 50: "CRITICAL"}


def narrow_level(number: Column) -> Column:
    """The highest standard level at or below a number; DEBUG below all."""
    out = F.lit(LEVELS[10])
    for least in sorted(LEVELS)[1:]:
        out = F.when(number >= least, LEVELS[least]).otherwise(out)
    return out


def safe_metadata(event: Column) -> Column:
    """The entries of a map whose keys may be logged."""
    return F.map_filter(event, lambda k, _: k.isin(SAFE_KEYS))


def retry_count(message: Column) -> Column:
    """attributes.ApproximateReceiveCount of a JSON message as an integer, else 0."""
    raw = F.trim(F.get_json_object(message, "$.attributes.ApproximateReceiveCount"))
    return F.coalesce(F.when(raw.rlike(r"^[+-]?[0-9]+$"), raw.try_cast("int")), F.lit(0))


def extract_trace(headers: Column, new_span: Column) -> Column:
    """The context of a request: its trace goes on in a new span under the sender's; null without a trace id."""
    of = lambda k: F.element_at(headers, TRACE_HEADERS[k])
    return F.when(
        F.coalesce(of("trace_id"), F.lit("")) != "",
        F.struct(of("trace_id").alias("trace_id"), new_span.alias("span_id"), of("span_id").alias("parent_span_id"), of("correlation_id").alias("correlation_id"), of("pipeline_stage").alias("pipeline_stage")),
    )


def inject_trace(headers: Column, context: Column) -> Column:
    """headers with the context's non-empty parts added or replaced."""
    parts = F.map_from_entries(F.array(*[F.struct(F.lit(h).alias("k"), context[k].alias("v")) for k, h in TRACE_HEADERS.items()]))
    parts = F.map_filter(parts, lambda _, v: v.isNotNull() & (v != ""))
    kept = F.map_filter(headers, lambda k, _: ~F.map_contains_key(parts, k))
    return F.when(context.isNull(), headers).otherwise(F.map_concat(kept, parts))


def child_span(context: Column, span_id: Column) -> Column:
    """A span below the current one, in the same trace."""
    return F.struct(
        context["trace_id"].alias("trace_id"), span_id.alias("span_id"), context["span_id"].alias("parent_span_id"),
        context["correlation_id"].alias("correlation_id"), context["pipeline_stage"].alias("pipeline_stage"),
    )


def latency(started: Column, ended: Column, error: Column) -> Column:
    """Milliseconds to three places, a status, and the error's type."""
    ms = F.round((F.unix_micros(ended) - F.unix_micros(started)) / 1000.0, 3)
    return F.struct(ms.alias("latency_ms"), F.when(error.isNull(), "success").otherwise("error").alias("status"), error.alias("exception_type"))


def log_line(level: Column, fields: dict[str, Column]) -> Column:
    """A record as one line of compact JSON, null fields left out."""
    return F.to_json(F.struct(level.alias("level"), *[v.alias(k) for k, v in fields.items()]))
