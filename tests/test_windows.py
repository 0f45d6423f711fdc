"""Watermarks and windows: stated cases, a sequential simulation, and streams against batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import watermark, windows
from tidemark.streaming import processors

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def at(s):
    return EPOCH + dt.timedelta(seconds=s)


def events(spark, rows):
    """rows: (key, arrival, second, value)."""
    data = [(k, i, at(t), float(v) if v is not None else None, f"t{i}", f"e{i}") for k, i, t, v in rows]
    return spark.createDataFrame(data, "partition_key string, arrival_seq long, event_timestamp timestamp, value double, trace_id string, event_id string")


def simulate(rows, size, slide, late):
    """Windows followed one event at a time, from the semantics."""
    high, open_, out = {}, {}, []
    for k, i, t, v in sorted(rows, key=lambda r: r[1]):
        before = high[k] - late if k in high else None
        if before is None or t >= before:
            kind = "on_time"
        elif late and before - t <= late:
            kind = "late_tolerated"
        else:
            kind = "late_dropped"
        high[k] = max(high.get(k, t), t)
        mark = high[k] - late
        if kind != "late_dropped":
            start = t // slide * slide
            while start + size > t:
                w = open_.setdefault((k, start), {"values": [], "closed": False})
                w["values"].append(v)
                if w["closed"]:
                    out.append((k, start, sum(w["values"]), len(w["values"]), True, i))
                start -= slide
        for (key, start), w in open_.items():
            if key == k and not w["closed"] and mark >= start + size:
                w["closed"] = True
                out.append((k, start, sum(w["values"]), len(w["values"]), False, i))
    return sorted(out)


def changed(df):
    rows = df.select("partition_key", F.unix_timestamp("window_start").alias("s"), "sum", "event_count", "is_repair", "arrival_seq").collect()
    return sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("size,slide,late", [(10, 5, 5), (5, 5, 3), (4, 2, 0), (6, 6, 9)])
def test_changelog_is_the_simulation(spark, size, slide, late):
    rng = random.Random(size * 100 + late)
    rows = [(f"k{rng.randrange(6)}", i, max(0, i // 6 + rng.randint(-12, 6)), rng.randint(0, 9)) for i in range(500)]
    classed = watermark.with_watermark(events(spark, rows), late)
    wide = windows.changelog(classed, windows.Geometry(size, slide), [windows.total("value")], late)
    assert changed(wide) == simulate(rows, size, slide, late)
    spread = windows.changelog(classed, windows.Geometry(size, slide), [windows.total("value")], late, stretch=7)
    assert changed(spread) == simulate(rows, size, slide, late)


def test_classes_at_their_boundaries(spark):
    rows = [("a", 0, 100, 1), ("a", 1, 90, 1), ("a", 2, 89, 1), ("a", 3, 80, 1), ("a", 4, 79, 1), ("b", 5, 1, 1)]
    found = watermark.with_watermark(events(spark, rows), 10).orderBy("arrival_seq").collect()
    assert [r.classification for r in found] == ["on_time", "on_time", "late_tolerated", "late_tolerated", "late_dropped", "on_time"]
    strict = watermark.with_watermark(events(spark, rows), 0).orderBy("arrival_seq").collect()
    assert [r.classification for r in strict][1:5] == ["late_dropped"] * 4
    with pytest.raises(ValueError):
        watermark.with_watermark(events(spark, rows), -1)


def test_stretches_give_the_same(spark):
    rng = random.Random(3)
    rows = [("a", i, i + rng.randint(-9, 9), 1) for i in range(300)]
    plain = watermark.with_watermark(events(spark, rows), 4).select("arrival_seq", "classification", "watermark").collect()
    split = watermark.with_watermark(events(spark, rows), 4, span=17).select("arrival_seq", "classification", "watermark").collect()
    assert sorted(plain) == sorted(split)


def test_marks_of_keys(spark):
    e = events(spark, [("a", 0, 100, 1), ("b", 1, 50, 1), ("a", 2, 90, 1)])
    assert {r.partition_key: r.watermark.timestamp() for r in watermark.watermark_for(e, 10).collect()} == {"a": 90, "b": 40}
    assert watermark.global_watermark(e, 10).first().watermark.timestamp() == 40
    assert watermark.global_watermark(e.where("false"), 10).first().watermark is None


def given(spark, rows):
    data = [("store-1", i, at(t), c, at(w), float(v), f"t{i}") for i, (t, c, w, v) in enumerate(rows)]
    return spark.createDataFrame(data, "partition_key string, arrival_seq long, event_timestamp timestamp, classification string, watermark timestamp, value double, trace_id string")


@pytest.mark.parametrize(
    "rows,expected",
    [
        ([(102, "on_time", 103, 1)], []),
        ([(102, "on_time", 103, 1), (106, "on_time", 110, 1)], [(100, 1.0, 1, False), (105, 1.0, 1, False)]),
        ([(102, "on_time", 102, 1), (110, "on_time", 110, 1), (103, "late_tolerated", 110, 1)], [(100, 1.0, 1, False), (100, 2.0, 2, True)]),
        ([(102, "on_time", 102, 1), (110, "on_time", 110, 1), (103, "late_dropped", 170, 1)], [(100, 1.0, 1, False), (110, 1.0, 1, False)]),
        ([(102, "on_time", 102, 1.5), (102, "on_time", 102, 2), (102, "on_time", 102, 0.5), (110, "on_time", 110, 0)], [(100, 4.0, 3, False)]),
    ],
)
def test_given_watermarks(spark, rows, expected):
    wide = windows.changelog(given(spark, rows), windows.Geometry(5), [windows.total("value")], 0, given=True)
    found = wide.orderBy("arrival_seq", "window_start", "is_repair").select(F.unix_timestamp("window_start"), "sum", "event_count", "is_repair").collect()
    assert [tuple(r) for r in found] == expected


def test_geometry_and_names():
    for bad in ((0, 1), (5, 2), (5, 6), (5, 0)):
        with pytest.raises(ValueError):
            windows.Geometry(*bad)


def test_bundle(spark):
    rows = [("k", "a", at(0), at(5), 1.0, "t1", 7, 0, False), ("k", "b", at(0), at(9), 2.0, None, 7, 1, False), ("k", "a", at(0), at(5), 3.0, "t2", 7, 2, True)]
    df = spark.createDataFrame(rows, "partition_key string, aggregation_name string, window_start timestamp, window_end timestamp, value double, last_contributing_trace_id string, arrival_seq long, agg_ordinal int, is_repair boolean")
    out = windows.bundle(df).first()
    assert (out.feature_values, out.window_end.timestamp(), out.trace_id) == ('{"a":3.0,"b":2.0}', 5, "t1")


def test_extraction_and_summary(spark):
    e = events(spark, [("a", 0, 100, 1), ("", 1, 101, 1), ("a", 2, 102, 1), (None, 3, 1, 1)])
    good, bad = watermark.extract_key(e, F.col("partition_key"))
    s = watermark.batch_summary(watermark.with_watermark(good, 60), bad).first()
    assert tuple(s) == (4, 2, 0, 0, 2)


@pytest.mark.parametrize("size,slide,late", [(10, 5, 5), (5, 5, 3)])
def test_stream_is_batch(spark, tmp_path, size, slide, late):
    rng = random.Random(size)
    rows = [(f"k{rng.randrange(3)}", i, max(0, i // 3 + rng.randint(-9, 5)), 1) for i in range(120)]
    e = events(spark, rows)
    src = tmp_path / "in"
    for k in range(3):
        e.where(f"arrival_seq >= {40 * k} and arrival_seq < {40 * k + 40}").coalesce(1).write.mode("append").parquet(str(src))
        batch = spark.readStream.schema(e.schema).parquet(str(src))
        out = processors.window_changelog(batch, processors.SUM, size, slide, late, "value")
        q = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
    found = spark.read.parquet(str(tmp_path / "out")).withColumnRenamed("value", "sum")
    assert changed(found) == simulate(rows, size, slide, late)


def test_key_windows_keep_their_state():
    rng = random.Random(9)
    rows = [("k", i, max(0, i + rng.randint(-9, 5)), 2) for i in range(200)]
    own, out = processors.KeyWindows(processors.SUM, 6, 3, 4), []
    for _, i, t, v in rows:
        own = processors.KeyWindows(processors.SUM, 6, 3, 4, own.state())
        out += [("k", a // 1_000_000, value, n, repair, i) for a, _, value, n, repair, _ in own.event(t * 1_000_000, v, None)]
    assert sorted(out) == simulate(rows, 6, 3, 4)
    assert len(own.windows) <= 13


def test_offline_stream(spark, tmp_path):
    rows = [(0, "A"), (350, "B"), (400, "A"), (750, "B")]
    data = [("0", i, f"e{i}", at(t), d, f"store-{d}") for i, (t, d) in enumerate(rows)]
    e = spark.createDataFrame(data, "shard string, arrival_seq long, event_id string, event_timestamp timestamp, device_id string, store_id string")
    for k in range(2):
        e.where(f"arrival_seq div 2 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        out = processors.offline_stream(spark.readStream.schema(e.schema).parquet(str(tmp_path / "in")), 300)
        q = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("arrival_seq", "device_id").collect()
    assert [(r.kind, r.device_id, r.arrival_seq) for r in got] == [("device.offline", "A", 1), ("device.online", "A", 2), ("device.offline", "A", 3), ("device.online", "B", 3)][: len(got)]
