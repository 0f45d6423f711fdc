"""Stores, dataset writers, the offline detector's deadlines, framing, and raw events: against plain versions."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import identity, sip
from tidemark.operators import detectors, routing, validation, views, watermark, windows, wire
from tidemark.plans import replay
from tidemark.settings import Settings
from tidemark.sources import datasets, stores

BASE = dt.datetime(2026, 4, 30, 12, tzinfo=dt.timezone.utc)


def sec(n):
    return BASE + dt.timedelta(seconds=n)


# ---- stores


@pytest.fixture(params=["memory", "table"])
def store(request, spark, tmp_path):
    return stores.MemoryStore() if request.param == "memory" else stores.TableStore(spark, str(tmp_path / "views"))


def test_a_store_keeps_the_last_write(spark, store):
    assert store.get("v", "a") is None and store.keys("v") == []
    store.put("v", "b", "1")
    store.put("v", "a", "1")
    store.put("w", "z", "1")
    store.put("v", "a", "2")
    assert (store.get("v", "a"), store.keys("v"), store.keys("w")) == ("2", ["a", "b"], ["z"])
    store.delete("v", "b")
    store.delete("v", "none")
    assert store.keys("v") == ["a"]
    rows = [("v", "a", "5", 1), ("v", "a", "4", 2), ("v", "c", "9", 2), ("v", "c", None, 3), ("v", "d", None, 1), ("v", "d", "7", 2)]
    store.upsert(spark.createDataFrame(rows, "view string, key string, value string, at long"), order="at")
    assert (store.get("v", "a"), store.get("v", "c"), store.keys("v")) == ("4", None, ["a", "d"])


def test_a_table_survives_reopening_and_broken_writes(spark, tmp_path):
    path = str(tmp_path / "views")
    for k in range(4):
        stores.TableStore(spark, path).put("v", f"s{k}", str(k))
    s = stores.TableStore(spark, path)
    assert s.keys("v") == ["s0", "s1", "s2", "s3"] and len(s.versions()) == 2
    (tmp_path / "views" / "99").mkdir()  # a write that was never completed
    again = stores.TableStore(spark, path)
    assert again.keys("v") == ["s0", "s1", "s2", "s3"]
    again.delete("v", "s0")
    assert stores.TableStore(spark, path).keys("v") == ["s1", "s2", "s3"]


# ---- dataset writers


class PlainBuffer:
    """A partition's records wait for an emission of it; the event that brings one flushes them all."""

    def __init__(self):
        self.waiting, self.done, self.count = {}, [], {}

    def event(self, seq, records):
        flagged = []
        for kind in ("detections", "features", "emissions"):
            for k, key, name in records:
                if k == kind:
                    self.waiting.setdefault(key, []).append((kind, name))
                    if kind == "emissions" and key not in flagged:
                        flagged.append(key)
        for key in flagged:
            n = self.count[key] = self.count.get(key, -1) + 1
            self.done += [(kind, *key, name, seq, n) for kind, name in self.waiting.pop(key)]


def record_tables(spark, rows):
    """rows: (kind, (store, hour), name, seq)."""
    emissions = [(s, sec(3600 * h), n, q, False) for k, (s, h), n, q in rows if k == "emissions"]
    found = [(s, sec(3600 * h + 5), q, 0, n) for k, (s, h), n, q in rows if k == "detections"]
    features = [(s, sec(3600 * h), q, n) for k, (s, h), n, q in rows if k == "features"]
    return {
        "emissions": spark.createDataFrame(emissions, "partition_key string, window_start timestamp, name string, arrival_seq long, is_repair boolean"),
        "detections": spark.createDataFrame(found, "store_id string, event_timestamp timestamp, arrival_seq long, ordinal int, detection_id string"),
        "features": spark.createDataFrame(features, "partition_key string, window_start timestamp, arrival_seq long, name string"),
    }


def some_records(rng, n):
    kinds = ["detections", "features", "emissions"]
    return [(rng.choice(kinds), (f"store-{rng.randrange(3)}", rng.randrange(2)), f"r{k}", k // 3) for k in range(n)]


def test_flushes_are_those_of_a_plain_buffer(spark):
    rng = random.Random(1)
    rows = some_records(rng, 80)
    plain = PlainBuffer()
    for seq in range(30):
        plain.event(seq, [r[:3] for r in rows if r[3] == seq])
    plan = datasets.flush_plan(record_tables(spark, rows)).collect()
    name = lambda r: json.loads(r.record).get("name") or json.loads(r.record)["detection_id"]
    hour = lambda t: round((t.replace(tzinfo=dt.timezone.utc) - BASE).total_seconds()) // 3600
    got = [(r.kind, r.store_id, hour(r.hour), name(r), r.flushed_by, r.sequence) for r in plan if r.sequence is not None]
    assert sorted(got) == sorted(plain.done)
    assert sorted(name(r) for r in plan if r.sequence is None) == sorted(n for v in plain.waiting.values() for _, n in v)
    memory = datasets.MemoryDatasets()
    memory.write(record_tables(spark, rows))
    assert [(f.flushed_by, f.sequence) for f in memory.flushes] == sorted({(f.flushed_by, f.sequence) for f in memory.flushes}) or len(memory.flushes) == len({(d[1], d[2], d[5]) for d in plain.done})
    assert [f.flushed_by for f in memory.flushes] == sorted(f.flushed_by for f in memory.flushes)
    assert sum(len(f.emissions) + len(f.detections) + len(f.features) for f in memory.flushes) == len(plain.done)
    assert {k for k, _ in memory.buffered_partitions()} == {k for k, _ in plain.waiting}


def test_what_waits_is_carried_over_batches(spark, tmp_path):
    rng = random.Random(2)
    rows = some_records(rng, 60)
    writer = datasets.BufferedDatasets(spark, str(tmp_path / "out"))
    waiting, done = {}, []
    for batch in range(4):
        own = [r for r in rows if r[3] // 5 == batch]
        for kind, key, name, _ in own:
            waiting.setdefault(key, []).append(name)
        for key in {key for kind, key, _, _ in own if kind == "emissions"}:
            done += [(batch, name) for name in waiting.pop(key)]
        writer.write(record_tables(spark, own), batch)
        if batch == 2:  # a batch that is repeated changes nothing
            writer.write(record_tables(spark, own), batch)
    got = [(r.batch, json.loads(r.record).get("name") or json.loads(r.record)["detection_id"]) for r in writer.read().collect()]
    assert sorted(got) == sorted(done) and done
    datasets.BufferedDatasets(spark, None).write(record_tables(spark, rows), 0)


# ---- the offline detector


def plain_silence(rows, facts, threshold):
    """rows: (seq, seconds, device); facts: (seq, device, store). Every event looks at every device."""
    last, offline, first, known, out = {}, set(), {}, {}, []
    for seq, at, device in rows:
        for q, d, s in facts:
            if q <= seq:
                known[d] = s
        last[device] = at
        first.setdefault(device, seq)
        if device in offline:
            offline.discard(device)
            if device in known:
                out.append((seq, "device.online", device))
        for d in sorted(last, key=first.get):
            if d not in offline and at - last[d] > threshold and d in known:
                offline.add(d)
                out.append((seq, "device.offline", d))
    return out


def test_late_events_and_late_registrations(spark):
    rng = random.Random(3)
    rows, t = [], 0
    for k in range(400):
        t += rng.choice([0, 2, 9, 30])
        rows.append((k, max(0, t - rng.choice([0, 0, 5, 80])), rng.choice("ABCDEFG")))
    facts = [(0, "A", "s1"), (0, "B", "s1"), (90, "C", "s2"), (200, "D", "s2"), (201, "E", "s2"), (390, "F", "s2")]
    e = spark.createDataFrame([("x", q, f"e{q}", sec(at), d, f"t{q}") for q, at, d in rows], "shard string, arrival_seq long, event_id string, event_timestamp timestamp, device_id string, trace_id string")
    f = spark.createDataFrame([("x", *x) for x in facts], "shard string, arrival_seq long, device_id string, store_id string")
    got = detectors.offline_general(e, f, 60).orderBy("arrival_seq", "ordinal").select("arrival_seq", "detection_type", "device_id").collect()
    want = plain_silence(rows, facts, 60)
    assert [tuple(r) for r in got] == want and len(want) > 30


def test_fleet_pipeline(spark):
    rows = [(0, 0, "A", "s1"), (1, 10, "B", "s2"), (2, 400, "B", "s2"), (3, 410, "C", "s1")]
    e = spark.createDataFrame([(f"e{q}", q, sec(at), d, s, f"t{q}") for q, at, d, s in rows], "event_id string, arrival_seq long, event_timestamp timestamp, device_id string, store_id string, trace_id string")
    facts = e.select("arrival_seq", "device_id", "store_id")
    for shard, at in (("store_id", 3), (None, 2)):
        found = replay.fleet_pipeline(Settings(), facts, shard).run(e)
        assert [(r.detection_type, r.device_id, r.arrival_seq) for r in found.detections.where("device_id = 'A'").collect()] == [("device.offline", "A", at)]
        told = replay.summary(found).first()
        assert (told.events, told.detections, told.emissions, told.alerts) == (4, found.detections.count(), 0, 0)


# ---- windows


def test_folds_and_distinct_counts(spark):
    rng = random.Random(4)
    rows, t = [], 0
    for k in range(150):
        t += rng.choice([0, 1, 4])
        rows.append((rng.choice("pq"), k, sec(max(0, t - rng.choice([0, 0, 3, 12]))), rng.choice(["a", "b", "c", None]), f"t{k}"))
    e = spark.createDataFrame(rows, "partition_key string, arrival_seq long, event_timestamp timestamp, device_id string, trace_id string")
    joined = windows.fold("all", "device_id", F.lit(""), lambda a, x: F.concat(a, F.coalesce(x, F.lit("-"))), lambda a: a)
    got = windows.changelog(watermark.with_watermark(e, 5), windows.Geometry(10), [windows.distinct("device_id", "d"), joined], 5).collect()
    classed = {r.arrival_seq: r.classification for r in watermark.with_watermark(e, 5).collect()}
    assert len(got) > 10
    for r in got:
        start = r.window_start.replace(tzinfo=dt.timezone.utc)
        inside = [x for x in rows if x[0] == r.partition_key and start <= x[2] < start + dt.timedelta(seconds=10) and classed[x[1]] != "late_dropped"]
        seen = [x[3] for x in inside][: r.event_count]
        assert (r.d, r["all"]) == (len({x for x in seen if x}), "".join(x or "-" for x in seen))


# ---- packets and messages


def test_framing_of_any_split():
    rng = random.Random(5)
    for _ in range(200):
        parts = [bytes(rng.choice(b"ab\r\n") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 4))]
        raw = wire.END.join(parts) + rng.choice([b"", wire.END])
        cuts = sorted(rng.randrange(len(raw) + 1) for _ in range(rng.randint(0, 8)))
        chunks = [c for c in (raw[a:b] for a, b in zip([0, *cuts], [*cuts, len(raw)])) if c]
        flow, out, at = wire.Flow(), [], []
        for k, c in enumerate(chunks):
            at += [k] * len(c)
            out += list(flow.frame(k, c))
        want, start = [], 0
        while (end := raw.find(wire.END, start)) >= 0:
            want.append((at[start], raw[start : end + 4]))
            start = end + 4
        assert out == want and bytes(flow.buffer) == raw[start:]


def test_bytes_that_are_no_text(spark):
    raw = b"register sip:x SIP/2.0\r\nFrom: <sip:h\xff\xfe1@s>\r\nVia: SIP/2.0/TCP 10.0.0.1:5060\r\n a : 1\r\nA: 2\r\n\r\n"
    (r,) = sip.parse(spark.createDataFrame([(bytearray(raw),)], "message binary")).collect()
    assert (r.method, r.device_label, r.headers["a"], r.source_ip) == ("REGISTER", "h1", "2", "10.0.0.1")


def test_raw_events_go_through_resolution_and_validation(spark):
    payload = {"session_id": "11111111-1111-4111-8111-111111111111", "actor_id": "11111111-1111-4111-8111-111111111111", "started_at": "2026-01-01T00:00:00Z"}
    make = lambda version, p, **more: json.dumps({"metadata": {"event_type": "session.start", "schema_version": version, "source": "edge"}, "event_timestamp": "2026-01-01T00:00:00Z", "trace": None, "payload": p, **more})
    rows = [make("v1", payload), make("v1", payload | {"x": {"y": 1}, "platform": "tv"}), make("v1.0", payload), make("v9", payload), "no json", "[1]", None, make("v1", None)]
    catalog = routing.Catalog({(c.event_type, c.version): c for c in validation.CONTRACTS})
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, raw string")
    got = {r.k: (r.resolved, r.problems) for r in validation.resolved(df, catalog).collect()}
    missing = ["event_timestamp:missing", "payload:missing", "trace:missing", "metadata:missing", "metadata:unregistered"]
    assert got[0] == ("v1", []) and got[1] == ("v1", ["platform:choice", "x:unknown"])
    assert got[2] == ("v1", ["metadata:identity"]) and got[3] == (None, ["metadata:unregistered"])
    assert all(got[k] == (None, missing) for k in (4, 5, 6))
    assert got[7] == ("v1", ["actor_id:missing", "session_id:missing", "started_at:missing"])


# ---- contracts


def test_keys_that_break_a_contract_raise(spark):
    assert spark.createDataFrame([("store-1",)], "k string").select(watermark.checked_key(F.col("k"), validation.NAME)).first()[0] == "store-1"
    for bad in ("", "Store 1", None):
        with pytest.raises(Exception, match="no partition key"):
            spark.createDataFrame([(bad,)], "k string").select(watermark.checked_key(F.col("k"), validation.NAME)).collect()


def test_times_without_an_offset_are_utc(spark):
    was = spark.conf.get("spark.sql.session.timeZone")
    texts = ["2026-04-30T12:00:00", "2026-04-30 12:00:00", "2026-04-30T12:00:00Z", "2026-04-30T14:00:00+02:00", "2026-04-30T12:00:00.000+00:00", "x", None]
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", F.unix_micros(identity.ensure_utc(F.col("t"))).alias("us")).orderBy("k").collect()
            assert [r.us for r in got] == [int(BASE.timestamp()) * 1_000_000] * 5 + [None] * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", was)


def test_outage_reads(spark):
    down = spark.createDataFrame([("s2", "x"), ("s1", "x")], "store_id string, since string")
    assert views.active_outage_count(down).first().active_outages == 2 and views.active_outage_count(down.where("false")).first().active_outages == 0
    assert [r.store_id for r in views.stores_in_outage(down).collect()] == ["s1", "s2"]
    asked = spark.createDataFrame([("s1",), ("s3",)], "store_id string")
    assert {tuple(r) for r in views.is_in_outage(asked, down).collect()} == {("s1", True), ("s3", False)}


def test_event_ids_are_kept_or_replaced(spark):
    df = spark.createDataFrame([("a", 1)], "event_id string, k int")
    new = F.concat(F.lit("n"), F.col("k").cast("string"))
    told = [wire.with_event_ids(df, *x).first().event_id for x in ((new, True), (None, False), (new, False))]
    assert told == ["a", "a", "n1"]
