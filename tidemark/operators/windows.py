"""Windows that close once and are then repaired, as set algebra.

For a key and a window ending at E, let C be the contributions that were not dropped, f the first arrival of them
and j the first arrival of the key whose time reaches E + L (only then does the watermark reach E). The window closes at
c = max(f, j) with the value over C up to c; every later contribution gives a repair with the value up to it.
A window whose end the watermark never reaches gives nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.watermark import DROPPED, TOLERATED, seconds


@dataclass(frozen=True)
class Geometry:
    """Window length and distance in seconds; tumbling if they are equal."""

    size: int
    slide: int | None = None

    def __post_init__(self) -> None:
        step = self.slide if self.slide is not None else self.size
        if self.size <= 0 or step <= 0 or step > self.size or self.size % step:
            raise ValueError("a slide must be positive and divide the size")

    def column(self, ts: str) -> Column:
        return F.window(ts, f"{self.size} seconds", f"{self.slide or self.size} seconds")


@dataclass(frozen=True)
class Aggregation:
    """A name and a value over a window of rows: over(frame) for running values, plain() for final ones.

    mark, if given, makes a helper column from a key and window's partition columns and the order of arrival; over
    reads it as __mark_<name>. A fold has no running form: items are listed once a window, and value makes its
    value of the items up to a closure or repair.
    """

    name: str
    plain: Callable[[], Column]
    over: Callable[[object], Column] | None
    integral: bool = False
    mark: Callable[[list[str], str], Column] | None = None
    items: Column | None = None
    value: Callable[[Column], Column] | None = None


def _windowed(name: str, make: Callable[[], Column], integral: bool = False) -> Aggregation:
    return Aggregation(name, make, lambda w: make().over(w), integral)


def count(name: str = "count") -> Aggregation:
    return _windowed(name, lambda: F.count(F.lit(1)), True)


def total(column: str, name: str = "sum") -> Aggregation:
    return _windowed(name, lambda: F.sum(F.col(column).cast("double")))


def distinct(column: str, name: str = "distinct") -> Aggregation:
    """An exact distinct count; its running form counts the first arrivals of values, and keeps no set."""

    def first(keys: list[str], seq: str) -> Column:
        place = F.row_number().over(Window.partitionBy(*keys, column).orderBy(seq))
        return ((place == 1) & F.col(column).isNotNull()).cast("long")

    return Aggregation(name, lambda: F.count_distinct(F.col(column)), lambda w: F.sum(F.col(f"__mark_{name}")).over(w), True, mark=first)


def mean(column: str, name: str = "mean") -> Aggregation:
    """The mean, 0.0 of no values."""
    make = lambda: F.avg(F.col(column).cast("double"))
    return Aggregation(name, lambda: F.coalesce(make(), F.lit(0.0)), lambda w: F.coalesce(make().over(w), F.lit(0.0)))


def fold(name: str, column: str, initial: Column, combine: Callable[[Column, Column], Column], finalise: Callable[[Column], Column], order: str = "arrival_seq") -> Aggregation:
    """Any fold over contributions in arrival order, as expressions. A window's contributions are listed once, and
    folded once for its closure and for each repair."""
    items = F.struct(F.col(order).alias("o"), F.col(column).alias("x"))
    run = lambda xs: F.aggregate(F.transform(F.array_sort(xs), lambda s: s["x"]), initial, combine, finalise)
    return Aggregation(name, lambda: run(F.collect_list(items)), None, items=items, value=run)


def changelog(
    events: DataFrame,
    geometry: Geometry,
    aggregations: list[Aggregation],
    lateness: float,
    *,
    key: str = "partition_key",
    ts: str = "event_timestamp",
    seq: str = "arrival_seq",
    trace: str | None = "trace_id",
    given: bool = False,
    stretch: int | None = None,
) -> DataFrame:
    """(key, window_start, window_end, one column for each aggregation, event_count, is_repair,
    last_contributing_trace_id, arrival_seq): a row for each closure and repair, arrival_seq the arrival that caused it.

    events carry classification. With given, they also carry watermarks of the caller's own, and only tolerated
    contributions repair. Everything is dealt by the key once: the closing arrival, the running values and the
    choice of rows share that exchange.

    stretch, if given, is for keys that hold a large part of the events: the closing arrival is then found within
    stretches of that many seconds, each starting from the least arrival of the stretches after it, and values run by
    key and window, so that one key is spread over many tasks. The result is the same.
    """
    names = [a.name for a in aggregations]
    if len(set(names)) < len(names):
        raise ValueError("two aggregations have one name")
    reach = F.col("watermark") if given else F.col(ts)
    ticks = events.select(F.col(key).alias("__key"), reach.alias("__t"), F.col(seq).alias("__tick"), F.lit(False).alias("__probe"), F.lit(None).cast("struct<a:int>").alias("__none"))
    inside = events.where(F.col("classification") != DROPPED).withColumn("__w", geometry.column(ts))
    rows = inside.select(F.col(key).alias("__key"), (F.col("__w.end") + seconds(0 if given else lateness)).alias("__t"), F.lit(True).alias("__probe"), F.struct("*").alias("__row"))
    both = rows.unionByName(ticks.drop("__none"), allowMissingColumns=True)
    # ticks at or after a probe's time come first
    order = [F.desc("__t"), F.asc("__probe")]
    if stretch:
        both = both.withColumn("__b", F.floor(F.unix_micros("__t") / (stretch * 1_000_000)))
        beyond = Window.partitionBy("__key").orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, -1)
        least = both.groupBy("__key", "__b").agg(F.min("__tick").alias("__m")).select("__key", "__b", F.min("__m").over(beyond).alias("__after"))
        later = Window.partitionBy("__key", "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        both = both.join(least, ["__key", "__b"]).repartition("__key", "__b")
        probed = both.withColumn("__j", F.least("__after", F.min("__tick").over(later))).where("__probe and __j is not null").repartition("__key", "__row.__w.start")
    else:
        later = Window.partitionBy("__key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        probed = both.withColumn("__j", F.min("__tick").over(later)).where("__probe and __j is not null")
    flat = probed.select("__key", "__j", F.col("__row.__w.start").alias("window_start"), F.col("__row.__w.end").alias("window_end"), "__row.*").drop("__w")
    marks = {f"__mark_{a.name}": a.mark(["__key", "window_start"], seq) for a in aggregations if a.mark}
    flat = flat.withColumns(marks) if marks else flat
    cell = Window.partitionBy("__key", "window_start").orderBy(seq)
    upto = cell.rowsBetween(Window.unboundedPreceding, 0)
    running = flat.select(
        F.col("__key").alias(key), "window_start", "window_end", "__j", F.col(seq).alias("__seq"), "classification",
        *[a.over(upto).alias(a.name) for a in aggregations if a.over],
        F.count(F.lit(1)).over(upto).alias("event_count"),
        (F.col(trace) if trace else F.lit(None).cast("string")).alias("last_contributing_trace_id"),
        F.greatest(F.col("__j"), F.min(seq).over(upto)).alias("__close"),
        F.lead(seq).over(cell).alias("__next"),
    )
    closes = (F.col("__seq") <= F.col("__close")) & (F.col("__next").isNull() | (F.col("__next") > F.col("__close")))
    repairs = F.col("__seq") > F.col("__close")
    if given:
        repairs = repairs & (F.col("classification") == TOLERATED)
    kept = running.where(closes | repairs)
    folds = [a for a in aggregations if a.items is not None]
    if folds:
        lists = flat.groupBy(F.col("__key").alias(key), "window_start").agg(*[F.collect_list(F.struct(F.col(seq).alias("s"), a.items.alias("i"))).alias(f"__list_{a.name}") for a in folds])
        kept = kept.join(lists, [key, "window_start"])
        upto_it = lambda a: F.transform(F.filter(f"__list_{a.name}", lambda x: x["s"] <= F.col("__seq")), lambda x: x["i"])
        kept = kept.withColumns({a.name: a.value(upto_it(a)) for a in folds})
    return (
        kept.withColumn("is_repair", F.col("__seq") > F.col("__close"))
        .withColumn("arrival_seq", F.greatest("__seq", "__close"))
        .select(key, "window_start", "window_end", *names, "event_count", "is_repair", "last_contributing_trace_id", "arrival_seq")
    )


def emissions(wide: DataFrame, name: str, *, key: str = "partition_key", ordinal: int = 0) -> DataFrame:
    """One aggregation's rows of a changelog, its value typed as it is; order by (arrival_seq, agg_ordinal, window_start, is_repair)."""
    return wide.select(key, F.lit(name).alias("aggregation_name"), "window_start", "window_end", F.col(name).alias("value"), "event_count", "is_repair", "last_contributing_trace_id", "arrival_seq", F.lit(ordinal).alias("agg_ordinal"))


def open_windows(events: DataFrame, geometry: Geometry, lateness: float, *, key: str = "partition_key", ts: str = "event_timestamp") -> DataFrame:
    """(key, open_windows): windows with contributions that are not sealed, a window being sealed once the watermark is
    beyond its end by more than the lateness."""
    mark = events.groupBy(key).agg(F.max("watermark").alias("__wm"))
    cells = events.where(F.col("classification") != DROPPED).select(key, geometry.column(ts).alias("__w")).distinct()
    return cells.join(mark, key).where(F.col("__wm") <= F.col("__w.end") + seconds(lateness)).groupBy(key).agg(F.count("*").alias("open_windows"))


def feature_vectors(wide: DataFrame, names: list[str], *, key: str = "partition_key", version: str = "v1") -> DataFrame:
    """A feature vector of each changelog row: values by aggregation name, and an id of the window, so that a repair
    replaces what it repairs downstream."""
    from tidemark.functions.identity import derive, plain
    from tidemark.functions.jsonx import canonical

    return wide.select(
        "arrival_seq",
        derive("event.feature", F.col(key), plain(F.col("window_start")), plain(F.col("window_end")), F.lit(version)).alias("event_id"),
        F.col(key).alias("partition_key"), "window_start", "window_end",
        canonical({n: F.col(n) for n in names}).alias("feature_values"),
        F.lit(version).alias("feature_version"),
        F.col("window_end").alias("event_timestamp"),
        F.col("last_contributing_trace_id").alias("trace_id"),
    )


def bundle(rows: DataFrame, *, key: str = "partition_key", version: str = "v1") -> DataFrame:
    """Feature vectors from long emissions of any aggregations and geometries: those of one arrival, key and window start
    are one vector. The first emission gives the window's end, the last of a name its value, the first trace its trace."""
    from tidemark.functions.identity import derive, plain
    from tidemark.functions.jsonx import canonical_map

    order = F.struct("agg_ordinal", "is_repair")
    item = F.struct(order.alias("o"), F.col("aggregation_name").alias("k"), F.col("value").cast("double").alias("v"))
    grouped = rows.groupBy("arrival_seq", key, "window_start").agg(
        F.min_by("window_end", order).alias("window_end"),
        F.array_sort(F.collect_list(item)).alias("__items"),
        F.min_by("last_contributing_trace_id", F.when(F.col("last_contributing_trace_id").isNotNull(), order)).alias("trace_id"),
    )
    # the last of a name wins: keep an item if no later one has its name
    last = F.filter("__items", lambda x, i: ~F.exists(F.slice("__items", i + 2, F.size("__items")), lambda y: y["k"] == x["k"]))
    values = F.map_from_entries(F.transform(last, lambda x: F.struct(x["k"].alias("key"), x["v"].alias("value"))))
    return grouped.select(
        "arrival_seq",
        derive("event.feature", F.col(key), plain(F.col("window_start")), plain(F.col("window_end")), F.lit(version)).alias("event_id"),
        F.col(key).alias("partition_key"), "window_start", "window_end", canonical_map(values).alias("feature_values"),
        F.lit(version).alias("feature_version"), F.col("window_end").alias("event_timestamp"), "trace_id",
    )
