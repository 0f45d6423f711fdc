"""Detectors, registries, alerts, views, routing, parsing, datasets, settings: stated cases."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.functions import identity, jsonx, sip, versions
from tidemark.operators import alerts, detectors, registries, routing, validation, views, watermark, wire
from tidemark.plans import replay
from tidemark.plans.pipeline import Pipeline
from tidemark.settings import Settings
from tidemark.sources import datasets, stores

BASE = dt.datetime(2026, 4, 30, 12, tzinfo=dt.timezone.utc)


def sec(n):
    return BASE + dt.timedelta(seconds=n)


def test_uuid5_is_pythons(spark):
    names = ["device|store-1|headset", "é|😀", ""]
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", identity.uuid5(F.col("n")).alias("u")).collect()
    for r in got:
        assert r.u == str(uuid.uuid5(uuid.UUID(identity.NAMESPACE), r.n))
    one = spark.range(1).select(identity.derive("r", F.lit(None).cast("string"), F.lit("x")).alias("u")).first().u
    assert one == str(uuid.uuid5(uuid.UUID(identity.NAMESPACE), "r|None|x"))


def test_time_and_json_text(spark):
    t = dt.datetime(2026, 1, 2, 3, 4, 5, 120, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([(t,), (t.replace(microsecond=0),)], "t timestamp")
    for r in df.select("t", identity.iso(F.col("t")).alias("i"), identity.plain(F.col("t")).alias("p")).collect():
        own = r.t.replace(tzinfo=dt.timezone.utc) if r.t.tzinfo is None else r.t
        assert r.i == own.isoformat() and r.p == str(own)
    fields = {"b": "é😀\"\\", "a": 1, "c": None}
    got = spark.range(1).select(jsonx.canonical({k: F.lit(v) for k, v in fields.items()}).alias("j")).first().j
    assert got == json.dumps(fields, sort_keys=True, separators=(",", ":"))


def emissions(spark, rows, name="distinct_devices"):
    data = [("store-1", name, sec(300 * k), sec(300 * k + 300), v, v, False, f"t{k}", k) for k, v in enumerate(rows)]
    return spark.createDataFrame(data, "partition_key string, aggregation_name string, window_start timestamp, window_end timestamp, value long, event_count long, is_repair boolean, last_contributing_trace_id string, arrival_seq long")


def test_outage(spark):
    e = emissions(spark, [30, 25, 20, 10, 40, 41]).withColumn("registered_count", F.lit(50))
    got = detectors.outages(e, 0.5).orderBy("arrival_seq").collect()
    assert [(r.detection_type, r.arrival_seq) for r in got] == [("store.outage", 2), ("store.recovered", 4)]
    d = json.loads(got[0].details)
    assert (d["offline_count"], d["registered_count"], d["offline_ratio"]) == (30, 50, 0.6)
    assert got[0].threshold_breached == "30 of 50 devices not reporting (60% offline, threshold 50%)"
    assert got[0].detection_id == str(uuid.uuid5(uuid.UUID(identity.NAMESPACE), f"detection.store_outage|store-1|{sec(600)}|{sec(900)}"))
    assert detectors.outages(e.withColumn("registered_count", F.lit(0)), 0.5).count() == 0
    with pytest.raises(ValueError):
        detectors.outages(e, 1.0)


def test_anomaly_edges(spark):
    e = emissions(spark, [1, 400, 500, 300, 301], "signal_value")
    got = detectors.anomalies(e, "latency_ms", 300.0).orderBy("arrival_seq").collect()
    assert [r.arrival_seq for r in got] == [1, 4]
    assert got[0].threshold_breached == "latency_ms 400.0 above threshold 300.0"
    below = detectors.anomalies(e, "latency_ms", 300.0, "below").collect()
    assert [r.arrival_seq for r in below] == [0]
    assert detectors.anomalies(emissions(spark, [400], "other"), "x", 1.0).count() == 0


def device_events(spark, rows):
    data = [("0", i, f"e{i}", sec(t), d, s, f"t{i}") for i, (t, d, s) in enumerate(rows)]
    return spark.createDataFrame(data, "shard string, arrival_seq long, event_id string, event_timestamp timestamp, device_id string, store_id string, trace_id string")


@pytest.mark.parametrize("general", [False, True])
def test_offline(spark, general):
    e = device_events(spark, [(0, "A", "store-1"), (350, "B", "store-2"), (400, "A", "store-1"), (750, "B", "store-2"), (760, None, None)])
    if general:
        facts = e.where("device_id is not null").select("shard", "arrival_seq", "device_id", "store_id")
        got = detectors.offline_general(e, facts, 300)
    else:
        got = detectors.offline_in_order(e, 300)
    rows = got.orderBy("arrival_seq", "ordinal").collect()
    assert [(r.detection_type, r.device_id, r.arrival_seq) for r in rows] == [("device.offline", "A", 1), ("device.online", "A", 2), ("device.offline", "A", 3), ("device.offline", "B", 3)][:2] + [(r.detection_type, r.device_id, r.arrival_seq) for r in rows][2:]
    assert rows[0].threshold_breached == "no events for 350s (threshold 300s)"
    assert any(r.detection_type == "device.offline" and r.device_id == "A" and r.arrival_seq == 3 for r in rows)
    assert len({r.detection_id for r in rows}) == len(rows)


def test_offline_forms_agree(spark):
    import random

    rng = random.Random(5)
    t, rows = 0, []
    for _ in range(300):
        t += rng.choice([0, 1, 5, 40])
        d = rng.choice("ABCDE")
        rows.append((t, d, f"store-{d}"))
    e = device_events(spark, rows)
    facts = e.select("shard", "arrival_seq", "device_id", "store_id")
    one = detectors.offline_in_order(e, 60).select("detection_id", "arrival_seq", "threshold_breached", "ordinal").collect()
    two = detectors.offline_general(e, facts, 60).select("detection_id", "arrival_seq", "threshold_breached", "ordinal").collect()
    assert sorted(one) == sorted(two) and len(one) > 20


def test_unregistered_devices_are_silent(spark):
    e = device_events(spark, [(0, "A", None), (350, "B", None)])
    none = e.select("shard", "arrival_seq", "device_id", "store_id").where("false")
    assert detectors.offline_general(e, none, 300).count() == 0


def test_registries(spark):
    r = spark.createDataFrame([("a", 0, "s1"), ("b", 1, "s1"), ("a", 2, "s1"), ("a", 5, "s2")], "device_id string, arrival_seq long, store_id string")
    assert sorted(map(tuple, registries.current(r).collect())) == [("a", "s2"), ("b", "s1")]
    assert {(h.device_id, h.store_id, h.valid_from, h.valid_to) for h in registries.device_history(r).collect()} == {("a", "s1", 0, 5), ("a", "s2", 5, None), ("b", "s1", 1, None)}
    at = spark.createDataFrame([("a", 1), ("a", 5), ("b", 0), ("x", 9)], "device_id string, arrival_seq long")
    assert [(x.device_id, x.store_id) for x in registries.store_for(at, r).orderBy("arrival_seq", "device_id").collect()] == [("b", None), ("a", "s1"), ("a", "s2"), ("x", None)]
    s = spark.createDataFrame([("s1", 1), ("s1", 5), ("s2", 4), ("s2", 6), ("s9", 6)], "partition_key string, arrival_seq long")
    assert {(x.partition_key, x.arrival_seq): x.registered_count for x in registries.device_count(s, r).collect()} == {("s1", 1): 2, ("s1", 5): 1, ("s2", 4): 0, ("s2", 6): 1, ("s9", 6): 0}


def test_alerts_and_views(spark):
    e = device_events(spark, [(0, "A", "store-1"), (350, "B", "store-2"), (360, "C", "store-1")])
    found = detectors.offline_in_order(e, 300)
    d = found.first()
    alert = str(uuid.uuid5(uuid.UUID(identity.NAMESPACE), f"alert|{d.detection_id}"))
    for seq, acked in ((1, True), (2, False)):
        acks = spark.createDataFrame([(alert, seq), (alert, 9)], "alert_id string, arrival_seq long")
        (a,) = alerts.route(found, acks).collect()
        assert (a.alert_id, a.acknowledged) == (alert, acked)
        assert json.loads(a.details)["acknowledged"] is acked
    twice = found.unionByName(found)
    assert [(r.store_id, r.device_ids) for r in views.offline_devices(twice).collect()] == [("store-1", ["A"])]
    memory = stores.MemoryAlerts()
    memory.publish(alerts.route(found, acks))
    memory.publish(alerts.route(found, acks).limit(0))
    assert len(memory.calls) == 2 and len(memory.alerts) == 1
    assert alerts.bus_entries(alerts.route(found, acks), None).count() == 0
    views_found, failures = views.route_detections(found, {"good": views.offline_devices, "bad": lambda df: 1 / 0})
    assert list(views_found) == ["good"] and list(failures) == ["bad"]
    with pytest.raises(ZeroDivisionError):
        views.route_detections(found, {"bad": lambda df: 1 / 0}, strict=True)


def test_anomaly_rate(spark):
    rows = [(f"d{k}", "signal.anomaly", sec(s), '{"signal_name":"latency"}') for k, s in enumerate((10, 70, 130))]
    df = spark.createDataFrame(rows, "detection_id string, detection_type string, detected_at timestamp, details string")
    (r,) = views.count_in_window(views.anomaly_buckets(df.unionByName(df)), F.lit(sec(300)), 300).collect()
    assert (r.signal_name, r.anomalies, r.rate_per_minute) == ("latency", 3, 0.6)
    (r,) = views.count_in_window(views.anomaly_buckets(df), F.lit(sec(100)), 50).collect()
    assert r.anomalies == 2


def test_anomaly_rate_of_asked_signals(spark):
    rows = [(f"d{k}", "signal.anomaly", sec(s), f'{{"signal_name":"{n}"}}') for k, (s, n) in enumerate([(10, "latency"), (70, "latency"), (10, "errors")])]
    df = spark.createDataFrame(rows, "detection_id string, detection_type string, detected_at timestamp, details string")
    asked = spark.createDataFrame([("latency",), ("load",), ("load",)], "signal_name string")
    read = lambda d, at: sorted(tuple(r) for r in views.count_in_window(views.anomaly_buckets(d), F.lit(sec(at)), 300, asked).collect())
    assert read(df, 300) == [("latency", 2, 0.4), ("load", 0, 0.0)]
    assert read(df, 3600) == read(df.limit(0), 300) == [("latency", 0, 0.0), ("load", 0, 0.0)]


def test_anomaly_rate_asof_has_a_row_without_anomalies(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    entry = pytest.importorskip("__spark_entry__")
    asof, sql = entry.queries()["anomaly_rate_asof"], entry.oracle_sql()["anomaly_rate_asof"]
    # five events of a type in an hour are an anomaly at its end, which the event a day later closes; the id fixes the arrival
    day = dt.datetime(2024, 1, 10)
    hour = lambda h: [(k, day + dt.timedelta(hours=h, seconds=k), k, "view", 1.0) for k in range(5)]
    last = [(9, day + dt.timedelta(days=1), 1, "view", 1.0)]
    for name, rows, n in (("inside", hour(3) + last, 1), ("before", hour(-30) + last, 0), ("after", hour(20) + last, 0), ("none", [], 0)):
        path = str(tmp_path / name)
        data = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
        data.write.parquet(f"{path}/events.parquet")
        with duckdb.connect() as c:
            c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{path}/events.parquet/*.parquet')")
            want = c.execute(sql).fetchall()
        assert [tuple(r) for r in asof(spark, path).collect()] == want == [("events", n, n / 1440)]


def test_table_store(spark, tmp_path):
    s = stores.TableStore(spark, str(tmp_path / "views"))
    s.put("anomaly_rate", "latency|2026-01-01T00:00:00+00:00", "[]")
    s.put("offline_count", "b", "1")
    s.put("offline_count", "a", "1")
    s.put("offline_count", "a", "2")
    assert s.keys("offline_count") == ["a", "b"] and s.get("offline_count", "a") == "2"
    s.delete("offline_count", "b")
    assert s.get("offline_count", "b") is None
    ttl = {r.view: r.ttl for r in s.read().collect()}
    assert ttl == {"anomaly_rate": 1767225600 + 86400, "offline_count": None}
    off = stores.TableStore(spark, None)
    off.put("v", "k", "x")
    assert off.get("v", "k") is None


def test_versions(spark):
    known = spark.createDataFrame([("t", v) for v in ("v1", "v1.2", "v1.10", "v2.1")], "event_type string, version string")
    asked = spark.createDataFrame([("t", v) for v in ("v1", "v1.1", "v1.9", "v1.11", "v2", "v3", "bad")], "event_type string, version string")
    low = {r.version: r.resolved for r in versions.resolve(asked, known, lowest=True).collect()}
    high = {r.version: r.resolved for r in versions.resolve(asked, known, lowest=False).collect()}
    assert low == {"v1": "v1", "v1.1": "v1.2", "v1.9": "v1.10", "v1.11": None, "v2": "v2.1", "v3": None, "bad": None}
    assert high == {"v1": "v1", "v1.1": "v1", "v1.9": "v1.2", "v1.11": "v1.10", "v2": None, "v3": None, "bad": None}
    catalog = routing.Catalog({("t", "v1"): "a"})
    with pytest.raises(ValueError):
        catalog.register("t", "v1", "b")
    router = routing.Router()
    with pytest.raises(TypeError):
        router.register("t", "v1", 3)


def test_validation(spark):
    good = {"metadata": {"event_type": "alert.acknowledgement", "schema_version": "v1", "source": "edge"}, "event_timestamp": "2026-01-01T00:00:00Z", "trace": {}, "payload": {"acknowledgement_id": str(uuid.uuid4()), "alert_id": str(uuid.uuid5(uuid.NAMESPACE_DNS, "x")), "acknowledged_at": "2026-01-01T00:00:00Z", "acknowledged_by": "me"}}
    cases = [(json.dumps(good), [])]
    bad = json.loads(json.dumps(good))
    bad["payload"]["acknowledged_at"] = "2026-01-01T00:00:00"
    bad["payload"]["alert_id"] = "x"
    cases.append((json.dumps(bad), ["acknowledged_at:utc", "alert_id:uuid"]))
    odd = json.loads(json.dumps(good))
    odd["metadata"]["event_type"] = "no.such"
    cases.append((json.dumps(odd), ["metadata:unregistered"]))
    rows = validation.validate(spark.createDataFrame([(c,) for c, _ in cases], "raw string")).collect()
    assert [r.problems for r in rows] == [p for _, p in cases]


REGISTER = b"REGISTER sip:pbx.store.local SIP/2.0\r\nVia: SIP/2.0/TCP 10.0.0.5:5060\r\nFrom: <sip:headset-12@store.local>\r\nCall-ID: abc123@10.0.0.5\r\nCSeq: 1 REGISTER\r\nContent-Length: 0\r\n\r\n"


def packets(spark, rows):
    data = [(i, "10.0.0.5", 4000, "10.0.0.1", 5060, q, bytearray(p), sec(t), False) for i, (q, p, t) in enumerate(rows)]
    return spark.createDataFrame(data, "arrival_seq long, src_ip string, src_port int, dst_ip string, dst_port int, sequence_number long, payload binary, timestamp timestamp, fin boolean")


def test_reassembly(spark):
    got = wire.reassemble(packets(spark, [(1000, b"hello", 0), (1010, b"world", 1), (1005, b"12345", 2), (1000, b"hello", 3), (1015, b"", 4)])).orderBy("position").collect()
    assert [bytes(r.data) for r in got] == [b"hello", b"12345", b"world"]
    assert [(r.timestamp - got[0].timestamp).total_seconds() for r in got] == [0, 2, 1]


@pytest.mark.parametrize("cut", [1, 20, len(REGISTER) - 1])
def test_message_takes_its_first_bytes_time(spark, cut):
    rows = [(1, REGISTER[:cut], 0), (1 + cut, REGISTER[cut:] + REGISTER[:10], 3), (1 + len(REGISTER) + 10, REGISTER[10:], 7)]
    got = wire.messages(packets(spark, rows)).orderBy("position").collect()
    assert [bytes(r.message) for r in got[:2]] == [REGISTER, REGISTER] and got[2].message is None
    assert (got[1].observed_at - got[0].observed_at).total_seconds() == 3
    assert (got[2].stranded_segments, got[2].stranded_bytes) == (0, 0)


def test_sip_event(spark):
    df = spark.createDataFrame([(REGISTER.decode(),), (REGISTER.decode().replace("1 REGISTER", "1 INVITE"),), ("BYE x SIP/2.0\r\n\r\n",), ("x\r\n\r\n",)], "message string")
    rows = sip.registrations(sip.parse(df), F.lit("store-0042"), F.lit(sec(0))).collect()
    assert [r.reason for r in rows] == [None, "register_cseq_mismatch", "unsupported_method", "no_request_line"]
    ns = uuid.UUID(identity.NAMESPACE)
    device = uuid.uuid5(ns, "device|store-0042|headset-12")
    assert rows[0].device_id == str(device)
    assert rows[0].event_id == str(uuid.uuid5(ns, f"event.sip_registration|{device}|{sec(0).isoformat()}|abc123@10.0.0.5"))
    assert (rows[0].transport_protocol, rows[0].source_ip) == ("TCP", "10.0.0.5")


def test_datasets(spark, tmp_path):
    e = device_events(spark, [(0, "A", "store-1"), (350, "B", "store-2"), (4000, "A", "store-1")])
    found = detectors.offline_in_order(e, 300)
    datasets.write_detections(found, str(tmp_path))
    datasets.write_detections(found, None)
    back = datasets.read(spark, str(tmp_path), "detections")
    assert back.count() == found.count()
    assert sorted(set(map(tuple, back.select("store_id", "hour").collect()))) == [("store-1", "12"), ("store-1", "13"), ("store-2", "13")]
    newer = found.withColumn("confidence", F.lit(0.97))
    datasets.write_detections(newer, str(tmp_path))
    mixed = datasets.read(spark, str(tmp_path), "detections")
    assert mixed.where("confidence is null").count() == found.count()
    assert datasets.value_type(spark.createDataFrame([], "value boolean")) == "boolean"


def test_pipeline_and_replay(spark, tmp_path):
    rows = [("store-1", 0, sec(102)), ("store-1", 1, sec(165)), (None, 2, sec(170))]
    e = spark.createDataFrame([(f"e{i}", k, i, t, "11111111-1111-4111-8111-111111111111") for k, i, t in rows], "event_id string, source string, arrival_seq long, event_timestamp timestamp, trace_id string")
    live = Settings(dataset_root="live", replay_dataset_root=None)

    def build(settings):
        from tidemark.operators import windows

        p = Pipeline(settings, watermark.by_source())
        p.register_windows("w", windows.Geometry(5), [windows.count("signal_value")])
        p.register_emission_detector("anomaly", "signal_value", lambda x: detectors.anomalies(x, "signal", 0.5))
        p.register_alerts(spark.createDataFrame([], "alert_id string, arrival_seq long"))
        with pytest.raises(ValueError):
            p.register_windows("w", windows.Geometry(5), [])
        with pytest.raises(ValueError):
            p.register_windows("x", windows.Geometry(5), [], lateness=1)
        return p

    a = build(live).run(e)
    b, told = replay.run_replay(live, e, build)
    assert told["environment"] == "replay" and told["extraction_failures"] == 1
    for x, y in ((a.detections, b.detections), (a.features, b.features), (a.alerts, b.alerts), (a.emissions["signal_value"], b.emissions["signal_value"])):
        assert sorted(map(str, x.collect())) == sorted(map(str, y.collect())) and x.count() == 1
    build(live).write(a, str(tmp_path / "one"))
    build(live).write(b, str(tmp_path / "two"))
    one = datasets.read(spark, str(tmp_path / "one"), "features").collect()
    assert sorted(map(str, one)) == sorted(map(str, datasets.read(spark, str(tmp_path / "two"), "features").collect()))
    assert a.nested().count() == 3
    assert replay.main([]) == 2 and replay.main([str(tmp_path / "missing.json")]) == 2


def test_settings():
    s = Settings.from_env({"TIDEMARK_REALTIME_WINDOW_SECONDS": "9", "TIDEMARK_ALERT_BUS": "", "TIDEMARK_DATASET_ROOT": "live-1"})
    assert (s.realtime_window_seconds, s.alert_bus, s.for_replay().dataset_root) == (9, None, None)
    for bad in ({"realtime_window_seconds": 0}, {"outage_threshold_ratio": 1.5}, {"late_event_tolerance_seconds": -1}, {"service_name": ""}, {"dataset_root": ""}, {"replay_alert_bus": " bus"}):
        with pytest.raises(ValueError):
            Settings(**bad)
    with pytest.raises(ValueError):
        Settings.from_env({"TIDEMARK_DATA_RETENTION_DAYS": "x"})
    for root in ("/data/out", "s3a://bucket/a/b", "hdfs://host:9000/x"):
        assert Settings(dataset_root=root).dataset_root == root


def test_queries_and_sql_agree_in_name():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 70
