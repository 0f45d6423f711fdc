"""Registered queries over the driver's tables, each with the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import identity, jsonx, logs, sip, versions
from tidemark.operators import alerts, detectors, registries, routing, validation, views, watermark, windows, wire
from tidemark.plans import replay
from tidemark.plans.pipeline import Pipeline
from tidemark.settings import Settings
from tidemark.sources import datasets, stores
from tidemark.sources.events import jittered

FLAGSHIP = "window_changelog"
LATE = 3600
TUMBLING, SLIDING = windows.Geometry(3600), windows.Geometry(7200, 3600)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a function as a query under its own name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        own = name or f.__name__
        _QUERIES[own] = f
        if sql is not None:
            _SQL[own] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def sql() -> dict[str, str]:
    return dict(_SQL)


def ntz(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


# ---- SQL shared by the oracles -------------------------------------------------------------------

_E = """e AS (SELECT CAST(floor(epoch_us(ts) / 1000000.0 + (event_id * 7919) % 10800) AS BIGINT) * 100000000 + event_id AS seq,
    CAST(event_id AS VARCHAR) AS id, event_type AS k, ts, 'store-' || CAST(user_id % 10 AS VARCHAR) AS store, CAST(user_id AS VARCHAR) AS device, value FROM events)"""
_C = (
    _E
    + """, b AS (SELECT *, max(ts) OVER (PARTITION BY k ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hb FROM e),
c AS (SELECT *, CASE WHEN hb IS NULL OR ts >= hb - INTERVAL 3600 SECOND THEN 'on_time' WHEN hb - INTERVAL 3600 SECOND - ts <= INTERVAL 3600 SECOND THEN 'late_tolerated' ELSE 'late_dropped' END AS cls,
    greatest(coalesce(hb, ts), ts) AS high FROM b)"""
)


def _changes(size: int, slide: int, key: str = "k", base: str = "") -> str:
    """CTEs that end in ch: closures and repairs of count, sum, mean and distinct devices."""
    offsets = ", ".join(str(i) for i in range(size // slide))
    return (
        (base or _C)
        + f""", cw AS (SELECT c.*, time_bucket(INTERVAL {slide} SECOND, ts, TIMESTAMP '1970-01-01') - to_seconds(o.i * {slide}) AS ws FROM c, (SELECT unnest([{offsets}]) AS i) o WHERE cls <> 'late_dropped'),
x AS (SELECT *, ws + INTERVAL {size} SECOND AS we FROM cw),
jj AS (SELECT w.{key} AS jk, w.we AS jwe, min(c.seq) AS j FROM (SELECT DISTINCT {key}, we FROM x) w JOIN c ON c.{key} = w.{key} AND c.ts >= w.we + INTERVAL {LATE} SECOND GROUP BY 1, 2),
r AS (SELECT x.*, greatest(j, min(seq) OVER (PARTITION BY {key}, ws)) AS cl, lead(seq) OVER (PARTITION BY {key}, ws ORDER BY seq) AS nx,
    count(*) OVER p AS n, round(sum(value) OVER p, 6) AS s, round(avg(value) OVER p, 6) AS m, count(DISTINCT device) OVER (PARTITION BY {key}, ws ORDER BY seq) AS d
    FROM x JOIN jj ON jk = {key} AND jwe = we WINDOW p AS (PARTITION BY {key}, ws ORDER BY seq)),
ch AS (SELECT {key} AS k, ws, we, n, s, m, d, id AS trace, seq > cl AS rep, greatest(seq, cl) AS arr FROM r WHERE seq > cl OR nx IS NULL OR nx > cl)"""
    )


_DEVICES = _E.replace("event_type AS k", "'store-' || CAST(user_id % 10 AS VARCHAR) AS k")


def _by_store() -> str:
    return _C.replace("event_type AS k", "'store-' || CAST(user_id % 10 AS VARCHAR) AS k")


def _uuid(name: str) -> str:
    h = f"sha1(unhex('{identity.NAMESPACE.replace('-', '')}') || encode({name}))"
    return f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || substr('89ab', (instr('0123456789abcdef', substr({h}, 17, 1)) - 1) % 4 + 1, 1) || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))"


def _plain(t: str) -> str:
    return f"(strftime({t}, '%Y-%m-%d %H:%M:%S') || CASE WHEN strftime({t}, '%f') <> '000000' THEN '.' || strftime({t}, '%f') ELSE '' END || '+00:00')"


def _iso(t: str) -> str:
    return f"(strftime({t}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime({t}, '%f') <> '000000' THEN '.' || strftime({t}, '%f') ELSE '' END || '+00:00')"


# ---- watermarks ------------------------------------------------------------------------------------


def _classified(spark: SparkSession, d: str) -> DataFrame:
    return watermark.with_watermark(jittered(spark, d), LATE)


def _class_rows(df: DataFrame) -> DataFrame:
    return df.select("event_id", "partition_key", "arrival_seq", "classification", ntz("watermark").alias("watermark"), ntz("high_event_timestamp").alias("high"))


_CLASS_SQL = f"WITH {_C} SELECT id AS event_id, k AS partition_key, seq AS arrival_seq, cls AS classification, high - INTERVAL 3600 SECOND AS watermark, high FROM c"


@query(_CLASS_SQL)
def watermark_classify(spark, d):
    return _class_rows(_classified(spark, d))


@query(_CLASS_SQL)
def watermark_classify_stretched(spark, d):
    """The same result with every key spread over tasks."""
    return _class_rows(watermark.with_watermark(jittered(spark, d), LATE, span=86_400 * 100_000_000))


@query(f"WITH {_E} SELECT k AS partition_key, max(ts) - INTERVAL 3600 SECOND AS watermark FROM e GROUP BY k")
def watermark_per_key(spark, d):
    return watermark.watermark_for(jittered(spark, d), LATE).select("partition_key", ntz("watermark").alias("watermark"))


@query(f"WITH {_E} SELECT min(w) AS watermark FROM (SELECT max(ts) - INTERVAL 3600 SECOND AS w FROM e GROUP BY k)")
def watermark_global(spark, d):
    return watermark.global_watermark(jittered(spark, d), LATE).select(ntz("watermark").alias("watermark"))


@query(f"WITH {_C} SELECT id AS event_id, k AS partition_key FROM c WHERE cls = 'late_dropped'")
def late_dropped(spark, d):
    return _classified(spark, d).where(F.col("classification") == watermark.DROPPED).select("event_id", "partition_key")


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, TRUE AS extraction_failed FROM events WHERE user_id % 7 = 0")
def extraction_failures(spark, d):
    e = jittered(spark, d)
    key = F.when(F.col("device_id").cast("long") % 7 != 0, F.col("store_id"))
    return watermark.extract_key(e, key)[1].select("event_id", "extraction_failed")


@query(
    f"""WITH {_by_store().replace('FROM events)', 'FROM events WHERE user_id % 7 <> 0)')}
    SELECT (SELECT count(*) FROM events) AS events, count(*) FILTER (cls = 'on_time') AS on_time, count(*) FILTER (cls = 'late_tolerated') AS late_tolerated,
    count(*) FILTER (cls = 'late_dropped') AS late_dropped, (SELECT count(*) FROM events WHERE user_id % 7 = 0) AS extraction_failures FROM c"""
)
def batch_summary(spark, d):
    key = F.when(F.col("device_id").cast("long") % 7 != 0, F.col("store_id"))
    good, bad = watermark.extract_key(jittered(spark, d), key)
    return watermark.batch_summary(watermark.with_watermark(good, LATE), bad)


# ---- windows ---------------------------------------------------------------------------------------


def _aggregations() -> list[windows.Aggregation]:
    return [windows.count("n"), windows.total("value", "s"), windows.mean("value", "m"), windows.distinct("device_id", "d")]


def _wide(spark: SparkSession, d: str, geometry: windows.Geometry) -> DataFrame:
    return windows.changelog(_classified(spark, d), geometry, _aggregations(), LATE)


def _wide_rows(df: DataFrame) -> DataFrame:
    return df.select(
        "partition_key", ntz("window_start").alias("window_start"), ntz("window_end").alias("window_end"), "n", F.round("s", 6).alias("s"), F.round("m", 6).alias("m"), "d",
        "event_count", "is_repair", "last_contributing_trace_id", "arrival_seq",
    )


def _wide_sql(size: int, slide: int) -> str:
    return f"WITH {_changes(size, slide)} SELECT k AS partition_key, ws AS window_start, we AS window_end, n, s, m, d, n AS event_count, rep AS is_repair, trace AS last_contributing_trace_id, arr AS arrival_seq FROM ch"


@query(_wide_sql(3600, 3600))
def window_changelog(spark, d):
    return _wide_rows(_wide(spark, d, TUMBLING))


@query(_wide_sql(3600, 3600))
def window_changelog_stretched(spark, d):
    """The same result with every key spread over tasks."""
    classed = watermark.with_watermark(jittered(spark, d), LATE, span=86_400 * 100_000_000)
    return _wide_rows(windows.changelog(classed, TUMBLING, _aggregations(), LATE, stretch=86_400))


@query(_wide_sql(7200, 3600))
def window_changelog_sliding(spark, d):
    return _wide_rows(_wide(spark, d, SLIDING))


def _one(kind: str, geometry: windows.Geometry, aggregation: windows.Aggregation, column: str) -> None:
    size, slide = geometry.size, geometry.slide or geometry.size
    value = f"round(CAST({column} AS DOUBLE), 6)"
    text = f"WITH {_changes(size, slide)} SELECT k AS partition_key, '{aggregation.name}' AS aggregation_name, ws AS window_start, we AS window_end, {value} AS value, n AS event_count, rep AS is_repair FROM ch"

    @query(text, f"{kind}_{aggregation.name}")
    def one(spark, d):
        wide = windows.changelog(_classified(spark, d), geometry, [aggregation], LATE)
        return windows.emissions(wide, aggregation.name).select(
            "partition_key", "aggregation_name", ntz("window_start").alias("window_start"), ntz("window_end").alias("window_end"), F.round(F.col("value").cast("double"), 6).alias("value"), "event_count", "is_repair"
        )


for _kind, _geometry in (("tumbling", TUMBLING), ("sliding", SLIDING)):
    for _a, _c in ((windows.count(), "n"), (windows.total("value"), "s"), (windows.mean("value"), "m"), (windows.distinct("device_id"), "d")):
        _one(_kind, _geometry, _a, _c)


@query(f"WITH {_changes(3600, 3600)} SELECT k AS partition_key, ws AS window_start, n, arr AS arrival_seq FROM ch WHERE rep")
def window_repairs(spark, d):
    wide = windows.changelog(_classified(spark, d), TUMBLING, [windows.count("n")], LATE)
    return wide.where("is_repair").select("partition_key", ntz("window_start").alias("window_start"), "n", "arrival_seq")


@query(f"WITH {_changes(3600, 3600)}, y AS (SELECT ch.*, (SELECT max(value) FROM x WHERE x.k = ch.k AND x.ws = ch.ws AND x.seq <= ch.arr) AS top FROM ch) SELECT k AS partition_key, ws AS window_start, round(top, 6) AS top, rep AS is_repair, arr AS arrival_seq FROM y")
def window_fold(spark, d):
    """An aggregation of the user's own: the greatest contribution, folded in arrival order."""
    top = windows.fold("top", "value", F.lit(None).cast("double"), lambda acc, x: F.greatest(acc, x), lambda acc: acc)
    wide = windows.changelog(_classified(spark, d), TUMBLING, [top], LATE)
    return wide.select("partition_key", ntz("window_start").alias("window_start"), F.round("top", 6).alias("top"), "is_repair", "arrival_seq")


@query(f"WITH {_C}, w AS (SELECT DISTINCT k, time_bucket(INTERVAL 3600 SECOND, ts, TIMESTAMP '1970-01-01') + INTERVAL 3600 SECOND AS we FROM c WHERE cls <> 'late_dropped'), h AS (SELECT k, max(high) - INTERVAL 3600 SECOND AS wm FROM c GROUP BY k) SELECT w.k AS partition_key, count(*) AS open_windows FROM w JOIN h ON h.k = w.k WHERE wm <= we + INTERVAL 3600 SECOND GROUP BY 1")
def window_open(spark, d):
    return windows.open_windows(_classified(spark, d), TUMBLING, LATE)


_FEATURE_ID = _uuid("'event.feature|' || k || '|' || " + _plain("ws") + " || '|' || " + _plain("we") + " || '|v1'")


@query(f"""WITH {_changes(3600, 3600)} SELECT {_FEATURE_ID} AS event_id, k AS partition_key, ws AS window_start, we AS window_end, '{{"d":' || CAST(d AS VARCHAR) || ',"n":' || CAST(n AS VARCHAR) || '}}' AS feature_values, 'v1' AS feature_version, trace AS trace_id, arr AS arrival_seq FROM ch""")
def feature_bundle(spark, d):
    wide = windows.changelog(_classified(spark, d), TUMBLING, [windows.count("n"), windows.distinct("device_id", "d")], LATE)
    return windows.feature_vectors(wide, ["n", "d"]).select("event_id", "partition_key", ntz("window_start").alias("window_start"), ntz("window_end").alias("window_end"), "feature_values", "feature_version", "trace_id", "arrival_seq")


@query(f"""WITH {_changes(3600, 3600)} SELECT {_FEATURE_ID} AS event_id, k AS partition_key, ws AS window_start, '{{"d":' || CAST(CAST(d AS DOUBLE) AS VARCHAR) || ',"n":' || CAST(CAST(n AS DOUBLE) AS VARCHAR) || '}}' AS feature_values, arr AS arrival_seq FROM ch""")
def feature_bundle_long(spark, d):
    """Vectors bundled from separate emissions."""
    wide = windows.changelog(_classified(spark, d), TUMBLING, [windows.count("n"), windows.distinct("device_id", "d")], LATE)
    both = windows.emissions(wide, "n").unionByName(windows.emissions(wide, "d", ordinal=1))
    return windows.bundle(both).select("event_id", "partition_key", ntz("window_start").alias("window_start"), "feature_values", "arrival_seq")


# ---- versions, routing -------------------------------------------------------------------------------

_VERSIONS = ["v1", "v1.1", "v1.2", "v1.2.3", "v1.10", "v2", "v2.0.1", "v3.1", "v01", "v1.", "1.2", "v1.2.3.4", "vx"]
_KNOWN = ["v1", "v1.2", "v1.10", "v2.0.1"]


def _versions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(v,) for v in _VERSIONS], "version string")


_V = f"v AS (SELECT unnest({_VERSIONS}) AS version), p AS (SELECT version, CASE WHEN regexp_full_match(version, 'v(0|[1-9][0-9]*)(\\.(0|[1-9][0-9]*)){{0,2}}') THEN list_transform(string_split(substr(version, 2), '.') || ['0', '0'], lambda x: CAST(x AS INTEGER))[1:3] END AS a FROM v)"


@query(f"WITH {_V} SELECT version, a[1] AS major, a[2] AS minor, a[3] AS patch FROM p")
def version_parse(spark, d):
    p = versions.parse(F.col("version"))
    return _versions(spark).select("version", p[0].alias("major"), p[1].alias("minor"), p[2].alias("patch"))


@query(f"WITH {_V} SELECT x.version AS source, y.version AS target, x.a[1] = y.a[1] AND y.a >= x.a AS compatible FROM p x, p y WHERE x.a IS NOT NULL AND y.a IS NOT NULL")
def version_compat(spark, d):
    good = _versions(spark).where(versions.parse(F.col("version")).isNotNull())
    pairs = good.select(F.col("version").alias("source"), F.explode(F.array(*[F.lit(v) for v in _VERSIONS])).alias("target"))
    return pairs.where(versions.parse(F.col("target")).isNotNull()).select("source", "target", versions.compatible(F.col("source"), F.col("target")).alias("compatible"))


def _resolve_sql(better: str, order: str, out: str) -> str:
    return f"""WITH {_V}, t AS (SELECT DISTINCT event_type FROM events), q AS (SELECT event_type, version, a FROM t, p),
    r AS (SELECT version AS rv, a AS ra FROM p WHERE version IN {tuple(_KNOWN)}),
    m AS (SELECT event_type, version, {order}(rv, ra) AS {out} FROM q LEFT JOIN r ON r.ra[1] = q.a[1] AND r.ra {better} q.a GROUP BY 1, 2)
    SELECT event_type, version, {out} FROM m"""


def _requests(spark: SparkSession, d: str) -> DataFrame:
    kinds = spark.read.parquet(f"{d}/events.parquet").select("event_type").distinct()
    return kinds.withColumn("version", F.explode(F.array(*[F.lit(v) for v in _VERSIONS])))


def _kinds(spark: SparkSession, d: str) -> list[str]:
    """The types that producers have: what a deployment registers is as long a list as its code."""
    return sorted(r[0] for r in spark.read.parquet(f"{d}/events.parquet").select("event_type").distinct().collect())


@query(_resolve_sql("<=", "arg_max", "matched_version").replace("SELECT event_type, version, matched_version FROM m", "SELECT event_type, version, matched_version, coalesce(matched_version <> version, FALSE) AS fell_back FROM m"))
def router_resolve(spark, d):
    router = routing.Router()
    for kind in _kinds(spark, d):
        for v in _KNOWN:
            router.register(kind, v, lambda df: df)
    return router.resolve(_requests(spark, d).withColumnRenamed("version", "schema_version")).select("event_type", F.col("schema_version").alias("version"), "matched_version", "fell_back")


@query(_resolve_sql(">=", "arg_min", "resolved"))
def registry_resolve(spark, d):
    catalog = routing.Catalog({(k, v): v for k in _kinds(spark, d) for v in _KNOWN})
    return catalog.resolve(_requests(spark, d)).select("event_type", "version", "resolved")


@query("SELECT event_type || '/v1' AS matched_key, CASE WHEN event_type < 'm' THEN 1 ELSE 0 END AS handlers_invoked, CASE WHEN event_type < 'm' THEN 0 ELSE 1 END AS handler_failures, count(*) AS events FROM events GROUP BY event_type")
def router_dispatch(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_type", F.lit("v1.5").alias("schema_version"))
    router = routing.Router()

    def broken(df):
        raise ValueError("a handler that fails")

    for kind in _kinds(spark, d):
        router.register(kind, "v1", (lambda df: df) if kind < "m" else broken)
    told, _, _ = router.dispatch(e)
    return told.groupBy("matched_key", "handlers_invoked", "handler_failures").agg(F.count("*").alias("events"))


@query("SELECT * FROM (VALUES ('alert.acknowledgement', 'v1'), ('alert.event', 'v1'), ('detection.event', 'v1'), ('device.registration', 'v1'), ('feature.vector', 'v1'), ('feature.vector.windowed', 'v1'), ('network.connection', 'v1'), ('session.start', 'v1'), ('sip.registration', 'v1')) t(event_type, version)")
def registry_list(spark, d):
    return routing.Catalog({(c.event_type, c.version): c for c in validation.CONTRACTS}).frame(spark).select("event_type", "version")


# ---- validation ----------------------------------------------------------------------------------------

_RAW = """raw AS (SELECT event_id, '{' || CASE WHEN event_id % 5 <> 0 THEN '"event_timestamp":"2026-01-01T00:00:00Z",' ELSE '' END || CASE WHEN event_id % 3 <> 0 THEN '"trace":null,' ELSE '' END
    || CASE WHEN event_id % 11 = 0 THEN '' ELSE '"metadata":{"event_type":"' || CASE WHEN event_id % 4 = 0 THEN '' ELSE 'device.registration' END || '","schema_version":"v1"' || CASE WHEN event_id % 2 = 0 THEN ',"source":"edge"' ELSE '' END || '},' END
    || '"payload":{"n":' || CAST(event_id AS VARCHAR) || '}}' AS raw FROM events)"""


def _raw(spark: SparkSession, d: str) -> DataFrame:
    e, on = spark.read.parquet(f"{d}/events.parquet"), lambda c, t: F.when(c, t).otherwise("")
    i = F.col("event_id")
    meta = F.when(i % 11 == 0, "").otherwise(F.concat(F.lit('"metadata":{"event_type":"'), F.when(i % 4 == 0, "").otherwise("device.registration"), F.lit('","schema_version":"v1"'), on(i % 2 == 0, ',"source":"edge"'), F.lit("},")))
    return e.select("event_id", F.concat(F.lit("{"), on(i % 5 != 0, '"event_timestamp":"2026-01-01T00:00:00Z",'), on(i % 3 != 0, '"trace":null,'), meta, F.lit('"payload":{"n":'), i.cast("string"), F.lit("}}")).alias("raw"))


@query(f"WITH {_RAW} SELECT event_id, concat_ws(',', CASE WHEN NOT json_exists(raw, '$.event_timestamp') THEN 'event_timestamp' END, CASE WHEN NOT json_exists(raw, '$.payload') THEN 'payload' END, CASE WHEN NOT json_exists(raw, '$.trace') THEN 'trace' END) AS missing FROM raw")
def validate_envelope(spark, d):
    return _raw(spark, d).select("event_id", F.array_join(validation.missing_envelope(F.col("raw")), ",").alias("missing"))


@query(f"WITH {_RAW} SELECT event_id, CASE WHEN NOT json_exists(raw, '$.metadata') THEN 'metadata' ELSE concat_ws(',', CASE WHEN coalesce(raw ->> '$.metadata.event_type', '') = '' THEN 'metadata.event_type' END, CASE WHEN coalesce(raw ->> '$.metadata.schema_version', '') = '' THEN 'metadata.schema_version' END, CASE WHEN coalesce(raw ->> '$.metadata.source', '') = '' THEN 'metadata.source' END) END AS missing FROM raw")
def validate_metadata(spark, d):
    return _raw(spark, d).select("event_id", F.array_join(validation.missing_metadata(F.col("raw")), ",").alias("missing"))


@query("SELECT event_id, ts <= ts - to_seconds(event_id % 700) + INTERVAL 300 SECOND AS valid FROM events")
def validate_clock_skew(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    ts = F.col("ts").cast("timestamp")
    ingest = F.timestamp_micros(F.unix_micros(ts) - (F.col("event_id") % 700) * 1_000_000)
    return e.select("event_id", validation.within_skew(ts, ingest).alias("valid"))


_UUIDISH = "substr(md5(CAST(event_id AS VARCHAR)), 1, 8) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 9, 4) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 13, 4) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 17, 4) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 21, 12)"


@query(f"WITH u AS (SELECT event_id, {_UUIDISH} AS u FROM events) SELECT event_id, substr(u, 15, 1) = '4' AND substr(u, 20, 1) IN ('8', '9', 'a', 'b') AS v4, substr(u, 15, 1) IN ('4', '5') AND substr(u, 20, 1) IN ('8', '9', 'a', 'b') AS v45 FROM u")
def validate_uuid(spark, d):
    h = F.md5(F.col("event_id").cast("string").cast("binary"))
    u = F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", validation.uuid_version(u, "4").alias("v4"), validation.uuid_versions(F.array(u)).alias("v45"))


def _literals(spark: SparkSession, rows: list[tuple[str, bool]], check: Callable[[Column], Column]) -> DataFrame:
    return spark.createDataFrame([(t,) for t, _ in rows], "value string").select("value", check(F.col("value")).alias("valid"))


def _values(rows: list[tuple[str, bool]]) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"('{t}', {str(ok).upper()})" for t, ok in rows) + ") t(value, valid)"


_SEMVERS = [("1.2.3", True), ("0.0.0", True), ("1.2", False), ("01.2.3", False), ("1.2.3-rc.1+b5", True), ("1.2.3-", False), ("v1.2.3", False), ("1.2.3-01", False)]
_UTCS = [("2026-01-01T00:00:00Z", True), ("2026-01-01T00:00:00+00:00", True), ("2026-01-01T00:00:00+01:00", False), ("2026-01-01T00:00:00", False)]
_NAMES = [("store-1", True), ("a.b_c-d", True), ("Store-1", False), ("-a", False), ("a--b", False), ("", False)]
_ADDRESSES = [("10.0.0.5", True), ("256.1.1.1", False), ("1.2.3", False), ("01.2.3.4", False), ("::1", True), ("::", True), ("fe80::1%eth0", True), ("2001:db8::8a2e:370:7334", True), ("1:2:3:4:5:6:7:8", True), ("1:2:3:4:5:6:7", False), ("1::2::3", False), ("::ffff:1.2.3.4", True), ("12345::", False), (":1", False), ("x", False)]


@query(_values(_SEMVERS))
def validate_semver(spark, d):
    return _literals(spark, _SEMVERS, validation.semver)


@query(_values(_UTCS))
def validate_utc(spark, d):
    return _literals(spark, _UTCS, validation.is_utc)


@query(_values(_NAMES))
def validate_names(spark, d):
    return _literals(spark, _NAMES, lambda c: c.rlike(validation.NAME))


@query(_values(_ADDRESSES))
def validate_address(spark, d):
    return _literals(spark, _ADDRESSES, validation.ip_address)


@query("SELECT event_id, concat_ws(',', CASE WHEN event_id % 3 = 0 THEN 'latency_ms:range' END, CASE WHEN event_id % 5 = 0 THEN 'protocol:choice' END, CASE WHEN event_id % 2 = 0 THEN 'shape:unknown' END, CASE WHEN event_id % 7 = 0 THEN 'source_ip:address' END) AS problems FROM events")
def validate_payload(spark, d):
    i = F.col("event_id")
    text = F.concat(
        F.lit('{"metadata":{"event_type":"network.connection","schema_version":"v1","source":"edge"},"event_timestamp":"2026-01-01T00:00:00Z","trace":{},"payload":{"connection_id":"11111111-1111-4111-8111-111111111111","source_ip":"'),
        F.when(i % 7 == 0, "10.0.0").otherwise("10.0.0.1"), F.lit('","destination_ip":"::1","connected_at":"2026-01-01T00:00:00Z","direction":"INBOUND","protocol":"'),
        F.when(i % 5 == 0, "SCTP").otherwise("TCP"), F.lit('","latency_ms":'), F.when(i % 3 == 0, "60001").otherwise("60000"), F.when(i % 2 == 0, ',"shape":1').otherwise(""), F.lit("}}"),
    )
    return validation.validate(spark.read.parquet(f"{d}/events.parquet").select("event_id", text.alias("raw"))).select("event_id", F.array_join("problems", ",").alias("problems"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE 'v1' END AS resolved, CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'metadata:identity' WHEN 2 THEN 'metadata:identity' ELSE 'metadata:unregistered' END AS problems FROM events")
def raw_resolved(spark, d):
    """Raw events from text to a contract in one step: versions that are, or only resolve to, a registered one."""
    i = F.col("event_id")
    version = F.when(i % 4 == 0, "v1").when(i % 4 == 1, "v1.0").when(i % 4 == 2, "v1.0.0").otherwise("v2")
    text = F.concat(
        F.lit('{"metadata":{"event_type":"session.start","schema_version":"'), version, F.lit('","source":"edge"},"event_timestamp":"2026-01-01T00:00:00Z","trace":{},"payload":{"session_id":"11111111-1111-4111-8111-111111111111","actor_id":"11111111-1111-4111-8111-111111111111","started_at":"2026-01-01T00:00:00Z"}}'),
    )
    catalog = routing.Catalog({(c.event_type, c.version): c for c in validation.CONTRACTS})
    rows = validation.resolved(spark.read.parquet(f"{d}/events.parquet").select("event_id", text.alias("raw")), catalog)
    return rows.select("event_id", "resolved", F.array_join("problems", ",").alias("problems"))


@query("SELECT event_id, ts AS at, ts AS plain FROM events")
def ensure_utc(spark, d):
    """Times with an offset and without one, whatever the session's zone."""
    ts = F.col("ts").cast("timestamp")
    shown = identity.iso(ts)
    e = spark.read.parquet(f"{d}/events.parquet")
    return e.select("event_id", ntz(identity.ensure_utc(shown)).alias("at"), ntz(identity.ensure_utc(F.replace(shown, F.lit("+00:00"), F.lit("")))).alias("plain"))


# ---- registries ----------------------------------------------------------------------------------------

_REG = f"{_E}, g AS (SELECT device, seq, 'store-' || CAST((CAST(device AS BIGINT) + CAST(id AS BIGINT) // 2000) % 10 AS VARCHAR) AS store FROM e WHERE CAST(id AS BIGINT) % 5 = 0)"


def _registrations(spark: SparkSession, d: str) -> DataFrame:
    """Every fifth event registers its device, in a store that moves on with time."""
    e = jittered(spark, d)
    moved = F.expr("concat('store-', cast((cast(device_id as bigint) + cast(event_id as bigint) div 2000) % 10 as string))")
    return e.where(F.col("event_id").cast("long") % 5 == 0).select("device_id", "arrival_seq", moved.alias("store_id"))


@query(f"WITH {_REG}, m AS (SELECT *, lag(store) OVER (PARTITION BY device ORDER BY seq) AS was FROM g), h AS (SELECT * FROM m WHERE was IS NULL OR was <> store) SELECT device AS device_id, store AS store_id, seq AS valid_from, lead(seq) OVER (PARTITION BY device ORDER BY seq) AS valid_to FROM h")
def registry_history(spark, d):
    return registries.device_history(_registrations(spark, d))


@query(f"WITH {_REG} SELECT device AS device_id, arg_max(store, seq) AS store_id FROM g GROUP BY device")
def registry_latest(spark, d):
    return registries.current(_registrations(spark, d))


@query(f"WITH {_REG} SELECT e.id AS event_id, g.store AS store_id FROM e ASOF LEFT JOIN g ON e.device = g.device AND e.seq >= g.seq")
def registry_asof(spark, d):
    return registries.store_for(jittered(spark, d).drop("store_id"), _registrations(spark, d)).select("event_id", "store_id")


_MOVES = f"{_REG}, m AS (SELECT *, lag(store) OVER (PARTITION BY device ORDER BY seq) AS was FROM g), dl AS (SELECT store, seq, 1 AS ch FROM m WHERE was IS NULL OR was <> store UNION ALL SELECT was, seq, -1 FROM m WHERE was IS NOT NULL AND was <> store)"


@query(f"WITH {_MOVES}, t AS (SELECT store, seq, id, 0 AS ch FROM e UNION ALL SELECT store, seq, NULL, ch FROM dl), w AS (SELECT id, sum(ch) OVER (PARTITION BY store ORDER BY seq, id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS n FROM t) SELECT id AS event_id, CAST(n AS BIGINT) AS registered_count FROM w WHERE id IS NOT NULL")
def store_device_count(spark, d):
    return registries.device_count(jittered(spark, d), _registrations(spark, d), store="store_id").select("event_id", "registered_count")


@query(f"WITH {_REG}, z AS (SELECT device, arg_max(store, seq) AS store FROM g GROUP BY device) SELECT store AS store_id, count(*) AS devices FROM z GROUP BY store")
def store_sizes(spark, d):
    return registries.store_sizes(_registrations(spark, d))


@query(f"WITH {_E} SELECT id AS alert_id, min(seq) AS ack_seq FROM e GROUP BY id")
def ack_registry(spark, d):
    e = jittered(spark, d).select(F.col("event_id").alias("alert_id"), "arrival_seq")
    return registries.acknowledgements(e.unionByName(e.withColumn("arrival_seq", F.col("arrival_seq") + 1)))


# ---- detections ----------------------------------------------------------------------------------------


def _counts(spark: SparkSession, d: str) -> DataFrame:
    return windows.emissions(windows.changelog(_classified(spark, d), TUMBLING, [windows.count("signal_value")], LATE), "signal_value")


def _anomaly_sql(limit: int, word: str, sign: str) -> str:
    coords = "k || '|events|' || " + _plain("ws") + " || '|' || " + _plain("we")
    return f"""WITH {_changes(3600, 3600)}, f AS (SELECT *, n {sign} {limit} AS o FROM ch), t AS (SELECT *, lag(o, 1, FALSE) OVER (PARTITION BY k ORDER BY arr, ws, rep) AS was FROM f), a AS (SELECT *, {_uuid("'detection.signal_anomaly|' || " + coords)} AS did FROM t WHERE o AND NOT was)
    SELECT {_uuid("'event.detection|' || did")} AS event_id, did AS detection_id, 'signal.anomaly' AS detection_type, 'WARNING' AS severity, we AS detected_at, k AS store_id, {_uuid("'source.signal_anomaly|' || " + coords)} AS source_event_id,
    'events ' || CAST(n AS VARCHAR) || ' {word} threshold {limit}' AS threshold_breached,
    '{{"comparison":"{word}","signal_name":"events","threshold":{limit},"value":' || CAST(n AS VARCHAR) || ',"window_end":"' || {_iso('we')} || '","window_start":"' || {_iso('ws')} || '"}}' AS details, trace AS trace_id, arr AS arrival_seq FROM a"""


_SHOWN = ["event_id", "detection_id", "detection_type", "severity", "store_id", "source_event_id", "threshold_breached", "details", "trace_id", "arrival_seq"]


@query(_anomaly_sql(3, "above", ">"))
def anomaly_above(spark, d):
    return detectors.anomalies(_counts(spark, d), "events", 3, whole=True).select(*_SHOWN, ntz("detected_at").alias("detected_at"))


@query(_anomaly_sql(2, "below", "<"))
def anomaly_below(spark, d):
    return detectors.anomalies(_counts(spark, d), "events", 2, "below", whole=True).select(*_SHOWN, ntz("detected_at").alias("detected_at"))


def _outages(spark: SparkSession, d: str) -> DataFrame:
    e = jittered(spark, d).withColumn("partition_key", F.col("store_id"))
    wide = windows.changelog(watermark.with_watermark(e, LATE), TUMBLING, [windows.distinct("device_id", "distinct_devices")], LATE)
    known = registries.device_count(windows.emissions(wide, "distinct_devices"), _registrations(spark, d))
    return detectors.outages(known, 0.9)


_OUTAGE_CTE = (
    _changes(3600, 3600, base=_by_store())
    + f""", g AS (SELECT device, seq, 'store-' || CAST((CAST(device AS BIGINT) + CAST(id AS BIGINT) // 2000) % 10 AS VARCHAR) AS store FROM e WHERE CAST(id AS BIGINT) % 5 = 0),
    mv AS (SELECT *, lag(store) OVER (PARTITION BY device ORDER BY seq) AS was FROM g), dl AS (SELECT store, seq, 1 AS c FROM mv WHERE was IS NULL OR was <> store UNION ALL SELECT was, seq, -1 FROM mv WHERE was IS NOT NULL AND was <> store),
    u AS (SELECT k, arr, 1 AS kind, 0 AS c, ws, we, d, rep, trace FROM ch UNION ALL SELECT store, seq, 0, c, NULL, NULL, NULL, NULL, NULL FROM dl),
    cn AS (SELECT *, CAST(sum(c) OVER (PARTITION BY k ORDER BY arr, kind RANGE UNBOUNDED PRECEDING) AS BIGINT) AS reg FROM u),
    ra AS (SELECT *, greatest(0, reg - d) AS off, greatest(0, reg - d) / reg AS ratio FROM cn WHERE kind = 1 AND reg > 0),
    tr AS (SELECT *, ratio > 0.9 AS o, lag(ratio > 0.9, 1, FALSE) OVER (PARTITION BY k ORDER BY arr, ws, rep) AS was FROM ra), oo AS (SELECT * FROM tr WHERE o <> was)"""
)
_OUT_COORDS = "k || '|' || " + _plain("ws") + " || '|' || " + _plain("we")


@query(
    f"""WITH {_OUTAGE_CTE}, i AS (SELECT *, CASE WHEN o THEN {_uuid("'detection.store_outage|' || " + _OUT_COORDS)} ELSE {_uuid("'detection.store_recovered|' || " + _OUT_COORDS)} END AS did FROM oo)
    SELECT did AS detection_id, CASE WHEN o THEN 'store.outage' ELSE 'store.recovered' END AS detection_type, CASE WHEN o THEN 'CRITICAL' ELSE 'INFO' END AS severity, k AS store_id,
    CASE WHEN o THEN CAST(off AS VARCHAR) || ' of ' || CAST(reg AS VARCHAR) || ' devices not reporting (' || CAST(CAST(round_even(ratio * 100, 0) AS BIGINT) AS VARCHAR) || '% offline, threshold 90%)'
    ELSE CAST(reg - off AS VARCHAR) || ' of ' || CAST(reg AS VARCHAR) || ' devices reporting (' || CAST(CAST(round_even(ratio * 100, 0) AS BIGINT) AS VARCHAR) || '% offline, below threshold 90%)' END AS threshold_breached,
    we AS detected_at, arr AS arrival_seq FROM i"""
)
def outage_transitions(spark, d):
    return _outages(spark, d).select("detection_id", "detection_type", "severity", "store_id", "threshold_breached", ntz("detected_at").alias("detected_at"), "arrival_seq")


SILENCE = 86_400


def _ordered_devices(spark: SparkSession, d: str) -> DataFrame:
    """Events in time order: arrival is the event's id."""
    e = spark.read.parquet(f"{d}/events.parquet")
    return e.select(
        F.concat(F.lit("shard-"), (F.col("user_id") % 4).cast("string")).alias("shard"), F.col("event_id").alias("arrival_seq"), F.col("event_id").cast("string").alias("event_id"), F.col("ts").cast("timestamp").alias("event_timestamp"),
        F.col("user_id").cast("string").alias("device_id"), F.concat(F.lit("store-"), (F.col("user_id") % 10).cast("string")).alias("store_id"), F.col("event_id").cast("string").alias("trace_id"),
    )


_OFFLINE_CTE = f"""v AS (SELECT 'shard-' || CAST(user_id % 4 AS VARCHAR) AS sh, event_id AS seq, ts, CAST(user_id AS VARCHAR) AS dev, 'store-' || CAST(user_id % 10 AS VARCHAR) AS store FROM events),
    n AS (SELECT *, lead(seq) OVER (PARTITION BY dev ORDER BY seq) AS nx FROM v),
    f AS (SELECT n.dev, n.store, n.seq, n.ts, n.nx, n.sh, min(v.seq) AS hit FROM n ASOF JOIN (SELECT sh, ts, min(seq) AS seq FROM v GROUP BY 1, 2) v ON v.sh = n.sh AND n.ts + INTERVAL {SILENCE} SECOND < v.ts GROUP BY 1, 2, 3, 4, 5, 6),
    z AS (SELECT f.*, v.ts AS hts FROM f JOIN v ON v.seq = f.hit WHERE nx IS NULL OR hit < nx),
    dt AS (SELECT 'device.offline' AS kind, dev, store, hit AS arr, hts AS dts, 'no events for ' || CAST((epoch_us(hts) - epoch_us(ts)) // 1000000 AS VARCHAR) || 's (threshold {SILENCE}s)' AS txt FROM z
        UNION ALL SELECT 'device.online', z.dev, z.store, z.nx, v.ts, 'device reporting again after silence' FROM z JOIN v ON v.seq = z.nx)"""
_OFFLINE_ID = _uuid("CASE WHEN kind = 'device.offline' THEN 'detection.device_offline|' ELSE 'detection.device_online|' END || store || '|' || dev || '|' || CAST(arr AS VARCHAR)")
_OFFLINE_SQL = f"WITH {_OFFLINE_CTE} SELECT {_OFFLINE_ID} AS detection_id, kind AS detection_type, dev AS device_id, store AS store_id, txt AS threshold_breached, dts AS detected_at, arr AS arrival_seq FROM dt"


def _offline_rows(df: DataFrame) -> DataFrame:
    return df.select("detection_id", "detection_type", "device_id", "store_id", "threshold_breached", ntz("detected_at").alias("detected_at"), "arrival_seq")


@query(_OFFLINE_SQL)
def offline_transitions(spark, d):
    return _offline_rows(detectors.offline_in_order(_ordered_devices(spark, d), SILENCE))


_FOLLOWED_CTE = f"""{_E}, n AS (SELECT *, lead(seq) OVER (PARTITION BY store, device ORDER BY seq) AS nx FROM e),
    h AS (SELECT n.device AS dev, n.store, n.seq, n.ts, n.nx, min(x.seq) AS hit FROM n JOIN e x ON x.store = n.store AND x.seq > n.seq AND x.seq < coalesce(n.nx, 9223372036854775807) AND x.ts > n.ts + INTERVAL {SILENCE} SECOND GROUP BY ALL),
    dt AS (SELECT 'device.offline' AS kind, dev, h.store, hit AS arr, x.id AS src, x.ts AS dts, 'no events for ' || CAST((epoch_us(x.ts) - epoch_us(h.ts)) // 1000000 AS VARCHAR) || 's (threshold {SILENCE}s)' AS txt FROM h JOIN e x ON x.seq = h.hit
        UNION ALL SELECT 'device.online', dev, h.store, nx, x.id, x.ts, 'device reporting again after silence' FROM h JOIN e x ON x.seq = h.nx)"""


@query(f"WITH {_FOLLOWED_CTE} SELECT {_OFFLINE_ID.replace('CAST(arr AS VARCHAR)', 'src')} AS detection_id, kind AS detection_type, dev AS device_id, store AS store_id, txt AS threshold_breached, dts AS detected_at, arr AS arrival_seq FROM dt")
def offline_followed(spark, d):
    """Events that arrive up to three hours late, followed one by one in each store."""
    e = jittered(spark, d).withColumn("shard", F.col("store_id"))
    facts = e.groupBy("shard", "device_id").agg(F.min("arrival_seq").alias("arrival_seq"), F.first("store_id").alias("store_id"))
    return _offline_rows(detectors.offline_general(e, facts, SILENCE))


# ---- alerts and views ------------------------------------------------------------------------------------


def _detections(spark: SparkSession, d: str) -> DataFrame:
    return detectors.offline_in_order(_ordered_devices(spark, d), SILENCE)


def _alerts(spark: SparkSession, d: str) -> DataFrame:
    found = _detections(spark, d)
    acks = found.where(F.col("arrival_seq") % 3 == 0).select(identity.derive("alert", F.col("detection_id")).alias("alert_id"), (F.col("arrival_seq") + F.col("arrival_seq") % 2).alias("arrival_seq"))
    return alerts.route(found, acks)


_ALERT_CTE = f"{_OFFLINE_CTE}, di AS (SELECT *, {_OFFLINE_ID} AS did FROM dt), al AS (SELECT *, {_uuid(chr(39) + 'alert|' + chr(39) + ' || did')} AS aid, arr % 3 = 0 AND arr % 2 = 0 AS ack, CASE WHEN kind = 'device.offline' THEN 'WARNING' ELSE 'INFO' END AS sev FROM di)"


@query(f"""WITH {_ALERT_CTE} SELECT {_uuid("'event.alert|' || aid")} AS event_id, aid AS alert_id, did AS detection_id, kind AS detection_type, sev AS severity, dts AS routed_at, store AS store_id, dev AS device_id, txt AS summary, '{{"acknowledged":' || CASE WHEN ack THEN 'true' ELSE 'false' END || ',"detected_at":"' || {_iso('dts')} || '"}}' AS details FROM al""")
def alerts_routed(spark, d):
    return _alerts(spark, d).select("event_id", "alert_id", "detection_id", "detection_type", "severity", ntz("routed_at").alias("routed_at"), "store_id", "device_id", "summary", "details")


@query(f"WITH {_ALERT_CTE} SELECT ack AS acknowledged, count(*) AS alerts FROM al GROUP BY 1")
def alerts_acked(spark, d):
    return _alerts(spark, d).groupBy("acknowledged").agg(F.count("*").alias("alerts"))


@query(f"WITH {_ALERT_CTE}, b AS (SELECT *, row_number() OVER (PARTITION BY store) - 1 AS r FROM al) SELECT store AS store_id, r // 10 AS batch, count(*) AS entries FROM b GROUP BY 1, 2")
def alert_batches(spark, d):
    return alerts.bus_entries(_alerts(spark, d), "bus-1").groupBy("store_id", "batch").agg(F.count("*").alias("entries"))


@query(f"WITH {_ALERT_CTE} SELECT sev || ':' || kind AS detail_type, count(*) AS entries FROM al GROUP BY 1")
def alert_detail_type(spark, d):
    return alerts.bus_entries(_alerts(spark, d), "bus-1").groupBy("detail_type").agg(F.count("*").alias("entries"))


@query(f"WITH {_OFFLINE_CTE}, l AS (SELECT store, dev, arg_max(kind, arr * 2 + CASE WHEN kind = 'device.offline' THEN 1 ELSE 0 END) AS last FROM dt GROUP BY 1, 2) SELECT store AS store_id, count(*) AS offline_count, string_agg(dev, ',' ORDER BY dev) AS device_ids FROM l WHERE last = 'device.offline' GROUP BY store")
def view_offline_count(spark, d):
    return views.offline_devices(_detections(spark, d)).select("store_id", F.col("offline_count").cast("long").alias("offline_count"), F.array_join("device_ids", ",").alias("device_ids"))


@query(f"WITH {_OUTAGE_CTE}, l AS (SELECT k, arg_max(o, arr) AS o, arg_max(we, arr) AS we FROM oo GROUP BY k) SELECT k AS store_id, {_iso('we')} AS since FROM l WHERE o")
def view_active_outage(spark, d):
    return views.active_outages(_outages(spark, d))


@query(f"WITH {_OUTAGE_CTE}, l AS (SELECT k, arg_max(o, arr) AS o FROM oo GROUP BY k), s AS (SELECT DISTINCT 'store-' || CAST(user_id % 10 AS VARCHAR) AS store FROM events) SELECT store AS store_id, coalesce(o, FALSE) AS in_outage, (SELECT count(*) FROM l WHERE o) AS active_outages FROM s LEFT JOIN l ON l.k = store")
def outage_reads(spark, d):
    down = views.active_outages(_outages(spark, d))
    stores_ = jittered(spark, d).select("store_id").distinct()
    n = views.active_outage_count(down).first().active_outages
    assert [r.store_id for r in views.stores_in_outage(down).collect()] == sorted(r.store_id for r in down.collect())
    return views.is_in_outage(stores_, down).withColumn("active_outages", F.lit(n).cast("long"))


_ENTRIES = "SELECT 'offline_count' AS view, 'store-' || CAST(user_id % 10 AS VARCHAR) AS key, event_id AS n, CASE WHEN event_id % 7 <> 0 THEN CAST(user_id AS VARCHAR) END AS value FROM events"


@query(f"WITH x AS ({_ENTRIES}), l AS (SELECT *, row_number() OVER (PARTITION BY view, key ORDER BY n % 3 DESC, n DESC) AS r FROM x) SELECT view, key, value FROM l WHERE r = 1 AND value IS NOT NULL")
def projection_store(spark, d):
    """What a table of entries holds after three writes, the last two by a store opened anew: the last value of a key, or nothing."""
    root = _scratch(spark)
    e = spark.read.parquet(f"{d}/events.parquet")
    value = F.when(F.col("event_id") % 7 != 0, F.col("user_id").cast("string"))
    rows = e.select(F.lit("offline_count").alias("view"), F.concat(F.lit("store-"), (F.col("user_id") % 10).cast("string")).alias("key"), F.col("event_id").alias("at"), value.alias("value"))
    for k in range(3):
        stores.TableStore(spark, root).upsert(rows.where(F.col("at") % 3 == k), order="at")
    return stores.TableStore(spark, root).read().select("view", "key", "value")


_ANOMALY_BUCKETS = _anomaly_sql(3, "above", ">")


@query(f"WITH an AS ({_ANOMALY_BUCKETS}) SELECT 'events' AS signal_name, time_bucket(INTERVAL 60 SECOND, detected_at, TIMESTAMP '1970-01-01') AS bucket, count(DISTINCT detection_id) AS detections FROM an GROUP BY 1, 2")
def view_anomaly_buckets(spark, d):
    found = detectors.anomalies(_counts(spark, d), "events", 3, whole=True)
    return views.anomaly_buckets(found).select("signal_name", ntz("bucket").alias("bucket"), F.size("detection_ids").cast("long").alias("detections"))


@query(f"WITH an AS ({_ANOMALY_BUCKETS}) SELECT 'events' AS signal_name, count(DISTINCT detection_id) AS anomalies, count(DISTINCT detection_id) / 1440.0 AS rate_per_minute FROM an WHERE detected_at >= TIMESTAMP '2024-01-09 12:00:00' AND detected_at < TIMESTAMP '2024-01-10 12:00:30'")
def anomaly_rate_asof(spark, d):
    found = detectors.anomalies(_counts(spark, d), "events", 3, whole=True)
    asked = spark.range(1).select(F.lit("events").alias("signal_name"))
    return views.count_in_window(views.anomaly_buckets(found), F.lit("2024-01-10 12:00:30").cast("timestamp"), 86_400, asked).select("signal_name", "anomalies", "rate_per_minute")


@query("SELECT event_id, epoch_us(date_trunc('minute', ts)) // 1000000 + 86400 AS ttl FROM events")
def ttl_resolve(spark, d):
    at = F.date_trunc("minute", F.col("ts").cast("timestamp"))
    key = F.concat(F.lit("latency|"), identity.iso(at))
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", views.time_to_live(F.lit("anomaly_rate"), key).alias("ttl"))


# ---- datasets and replay -----------------------------------------------------------------------------------


@query("SELECT event_id, 'detections/store_id=store-' || CAST(user_id % 10 AS VARCHAR) || strftime(ts, '/year=%Y/month=%m/day=%d/hour=%H/') || lpad(CAST(event_id % 100 AS VARCHAR), 8, '0') || '.parquet' AS object_key FROM events")
def dataset_partition_keys(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    store = F.concat(F.lit("store-"), (F.col("user_id") % 10).cast("string"))
    return e.select("event_id", datasets.object_key("detections", store, F.col("ts").cast("timestamp"), F.col("event_id") % 100).alias("object_key"))


def _scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share; a temporary one only in local mode without a setting."""
    import tempfile
    import uuid

    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.gettempdir()
    return f"{root}/tidemark-datasets/{uuid.uuid4().hex}"


@query(f"WITH {_OFFLINE_CTE} SELECT store AS store_id, strftime(dts, '%Y') AS year, strftime(dts, '%m') AS month, strftime(dts, '%d') AS day, strftime(dts, '%H') AS hour, {_OFFLINE_ID} AS detection_id, kind AS detection_type, dev AS device_id, txt AS threshold_breached, dts AS event_timestamp, arr AS arrival_seq FROM dt")
def dataset_roundtrip(spark, d):
    """Every written detection as it is read back, with its folder's values."""
    root = _scratch(spark)
    datasets.write_detections(_detections(spark, d), root)
    return datasets.read(spark, root, "detections").select("store_id", "year", "month", "day", "hour", "detection_id", "detection_type", "device_id", "threshold_breached", ntz("event_timestamp").alias("event_timestamp"), "arrival_seq")


@query(f"""WITH {_changes(3600, 3600, base=_by_store())},
m AS (SELECT store_id, hr, arr, row_number() OVER (PARTITION BY store_id, hr ORDER BY arr) - 1 AS sq FROM (SELECT DISTINCT k AS store_id, date_trunc('hour', ws) AS hr, arr FROM ch)),
q AS (SELECT 'emissions' AS kind, k AS store_id, date_trunc('hour', ws) AS hr, arr FROM ch UNION ALL SELECT 'detections', store, date_trunc('hour', ts), seq FROM c WHERE CAST(id AS BIGINT) % 3 = 0)
SELECT q.kind, q.store_id, q.hr AS hour, q.arr AS arrival_seq, min(m.arr) AS flushed_by, min(m.sq) AS sequence
FROM (SELECT *, row_number() OVER () AS rn FROM q) q LEFT JOIN m ON m.store_id = q.store_id AND m.hr = q.hr AND m.arr >= q.arr GROUP BY q.rn, q.kind, q.store_id, q.hr, q.arr""")
def dataset_flushes(spark, d):
    """The flush that takes each record: every closure and repair, and for every third event a detection of its time."""
    classed = watermark.with_watermark(jittered(spark, d).withColumn("partition_key", F.col("store_id")), LATE)
    emitted = windows.emissions(windows.changelog(classed, TUMBLING, [windows.count("n")], LATE), "n")
    found = classed.where(F.col("event_id").cast("long") % 3 == 0).select("store_id", "event_timestamp", "arrival_seq", F.lit(0).alias("ordinal"), F.col("event_id").alias("detection_id"))
    return datasets.flush_plan({"emissions": emitted, "detections": found}).select("kind", "store_id", ntz("hour").alias("hour"), "arrival_seq", "flushed_by", "sequence")


@query("SELECT event_id, value, CASE WHEN event_id % 2 = 0 THEN 0.97 END AS confidence FROM events")
def schema_evolution_union(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", "value")
    return datasets.union_versions([e.where("event_id % 2 = 1"), e.where("event_id % 2 = 0").withColumn("confidence", F.lit(0.97))])


@query(f"WITH {_E} SELECT id AS event_id FROM e WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'")
def replay_window(spark, d):
    return jittered(spark, d).where(replay.window(F.lit("2024-01-10").cast("timestamp"), F.lit("2024-01-20").cast("timestamp"))).select("event_id")


@query(f"""WITH {_changes(3600, 3600, base=_C.replace("event_type AS k", "'k-' || CAST(event_id % 5 AS VARCHAR) AS k"))}, o AS (SELECT *, n > 3 AS hot, lag(n > 3, 1, FALSE) OVER (PARTITION BY k ORDER BY arr, ws, rep) AS was FROM ch)
SELECT k AS store_id, ws AS window_start, n AS value, arr AS arrival_seq FROM o WHERE hot AND NOT was""")
def replay_determinism(spark, d):
    """Detections that a replay of an archive wrote to its own target, read back; the live target gets none of them."""
    root = _scratch(spark)
    jittered(spark, d).drop("partition_key").write.parquet(f"{root}/archive")
    live = Settings(late_event_tolerance_seconds=LATE, dataset_root=f"{root}/live", replay_dataset_root=f"{root}/replayed")
    keyed = F.concat(F.lit("k-"), (F.col("trace_id").cast("long") % 5).cast("string"))

    def build(settings: Settings) -> Pipeline:
        pipeline = Pipeline(settings, keyed).register_windows("hours", TUMBLING, [windows.count("signal_value")])
        return pipeline.register_emission_detector("anomaly", "signal_value", lambda e: detectors.anomalies(e, "events", 3, whole=True))

    replay.run_replay(live, spark.read.parquet(f"{root}/archive"), build)
    back = datasets.read(spark, f"{root}/replayed", "detections")
    return back.select("store_id", F.get_json_object("details", "$.window_start").try_cast("timestamp").cast("timestamp_ntz").alias("window_start"), F.get_json_object("details", "$.value").cast("long").alias("value"), "arrival_seq")


@query(f"WITH {_C} SELECT count(*) AS events, count(*) FILTER (cls = 'on_time') AS on_time, count(*) FILTER (cls = 'late_dropped') AS late_dropped, (SELECT count(*) FROM ({_anomaly_sql(3, 'above', '>')})) AS detections FROM c")
def replay_summary(spark, d):
    pipeline = Pipeline(Settings(late_event_tolerance_seconds=LATE), F.col("partition_key")).register_windows("hours", TUMBLING, [windows.count("signal_value")])
    pipeline.register_emission_detector("anomaly", "signal_value", lambda e: detectors.anomalies(e, "events", 3, whole=True))
    return replay.summary(pipeline.run(jittered(spark, d))).select("events", "on_time", "late_dropped", "detections")


@query("SELECT * FROM (VALUES ('bigint', 'bigint'), ('boolean', 'boolean'), ('double', 'double'), ('array<int>', 'string'), ('decimal(10,2)', 'double')) t(given, stored)")
def value_typing(spark, d):
    kinds = ["bigint", "boolean", "double", "array<int>", "decimal(10,2)"]
    return spark.createDataFrame([(k, datasets.value_type(spark.createDataFrame([], f"value {k}"))) for k in kinds], "given string, stored string")


# ---- functions -----------------------------------------------------------------------------------------------


@query(f"SELECT event_id, {_uuid(chr(39) + 'device|store-' + chr(39) + ' || CAST(user_id % 10 AS VARCHAR) || ' + chr(39) + '|é-' + chr(39) + ' || CAST(user_id AS VARCHAR)')} AS device_id FROM events")
def uuid5_identity(spark, d):
    store = F.concat(F.lit("store-"), (F.col("user_id") % 10).cast("string"))
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", identity.device_id(store, F.concat(F.lit("é-"), F.col("user_id").cast("string"))).alias("device_id"))


@query(f"SELECT event_id, {_iso('ts')} AS iso, {_plain('ts')} AS plain, date_trunc('hour', ts) AS hour FROM events")
def time_formats(spark, d):
    ts = F.col("ts").cast("timestamp")
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", identity.iso(ts).alias("iso"), identity.plain(ts).alias("plain"), ntz(datasets.hour(ts)).alias("hour"))


@query("""SELECT event_id, '{"a":' || CAST(event_id AS VARCHAR) || ',"b":null,"c":"\\u00e9\\ud83d\\ude00x"}' AS j FROM events""")
def canonical_json(spark, d):
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", jsonx.canonical({"c": F.lit("é😀x"), "b": F.lit(None).cast("string"), "a": F.col("event_id")}).alias("j"))


_MESSAGE = """'REGISTER sip:pbx.local SIP/2.0' || chr(13) || chr(10) || 'Via: SIP/2.0/TCP 10.0.0.' || CAST(user_id % 250 AS VARCHAR) || ':5060' || chr(13) || chr(10) || 'From: <sip:headset-' || CAST(user_id AS VARCHAR) || '@store.local>' || chr(13) || chr(10) || 'Call-ID: c' || CAST(event_id AS VARCHAR) || chr(13) || chr(10) || 'X: 1' || chr(13) || chr(10) || 'x : 2' || chr(13) || chr(10) || 'CSeq: 1 ' || CASE WHEN event_id % 4 = 0 THEN 'INVITE' ELSE 'REGISTER' END || chr(13) || chr(10) || chr(13) || chr(10)"""


def _messages(spark: SparkSession, d: str) -> DataFrame:
    e, n = spark.read.parquet(f"{d}/events.parquet"), F.lit("\r\n")
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    text = F.concat(
        F.lit("REGISTER sip:pbx.local SIP/2.0\r\nVia: SIP/2.0/TCP 10.0.0."), (F.col("user_id") % 250).cast("string"), F.lit(":5060\r\nFrom: <sip:headset-"), user, F.lit("@store.local>\r\nCall-ID: c"), event,
        F.lit("\r\nX: 1\r\nx : 2\r\nCSeq: 1 "), F.when(F.col("event_id") % 4 == 0, "INVITE").otherwise("REGISTER"), n, n,
    )
    return e.select("event_id", F.col("ts").cast("timestamp").alias("ts"), text.alias("message"))


@query("SELECT event_id, 'REGISTER' AS method, 'headset-' || CAST(user_id AS VARCHAR) AS device_label, 'TCP' AS transport, '10.0.0.' || CAST(user_id % 250 AS VARCHAR) AS source_ip, 'c' || CAST(event_id AS VARCHAR) AS call_id, '2' AS x FROM events")
def sip_headers(spark, d):
    return sip.parse(_messages(spark, d)).select("event_id", "method", "device_label", "transport", "source_ip", "call_id", F.element_at("headers", "x").alias("x"))


_SIP_DEVICE = _uuid("'device|store-0042|headset-' || CAST(user_id AS VARCHAR)")


@query(f"WITH q AS (SELECT *, {_SIP_DEVICE} AS dev FROM events) SELECT event_id AS source_event, CASE WHEN event_id % 4 = 0 THEN 'register_cseq_mismatch' END AS reason, CASE WHEN event_id % 4 <> 0 THEN dev END AS device_id, CASE WHEN event_id % 4 <> 0 THEN {_uuid(chr(39) + 'event.sip_registration|' + chr(39) + ' || dev || ' + chr(39) + '|' + chr(39) + ' || ' + _iso('ts') + ' || ' + chr(39) + '|c' + chr(39) + ' || CAST(event_id AS VARCHAR)')} END AS event_id FROM q")
def sip_register_events(spark, d):
    parsed = sip.parse(_messages(spark, d).withColumnRenamed("event_id", "source_event"))
    return sip.registrations(parsed, F.lit("store-0042"), F.col("ts")).select("source_event", "reason", "device_id", "event_id")


def _packets(spark: SparkSession, d: str) -> DataFrame:
    """Each message in three packets of its user's flow, the last two swapped, and the first sent twice; a user's
    messages follow one another in one flow."""
    m = _messages(spark, d).join(spark.read.parquet(f"{d}/events.parquet").select("event_id", "user_id"), "event_id")
    upto = Window.partitionBy("user_id").orderBy("event_id")
    m = m.withColumn("base", F.coalesce(F.sum(F.length("message")).over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1000).withColumn("final", F.lead("event_id").over(upto).isNull())
    raw = F.col("message").cast("binary")
    n = F.length("message")
    cuts = [(0, 1, F.lit(20)), (1, 21, F.lit(30)), (2, 51, n - 50)]
    parts = [F.struct(F.lit(o).alias("o"), F.lit(a - 1).alias("at"), F.substring(raw, a, k).alias("payload")) for o, (_, a, k) in zip((0, 3, 2), cuts, strict=True)]
    again = F.struct(F.lit(1).alias("o"), F.lit(0).alias("at"), F.substring(raw, 1, 20).alias("payload"))
    x = m.withColumn("p", F.explode(F.array(*parts, again)))
    return x.select(
        (F.col("event_id") * 4 + F.col("p.o")).alias("arrival_seq"), F.concat(F.lit("10.0.0."), (F.col("user_id") % 250).cast("string")).alias("src_ip"), (F.col("user_id") + 1000).cast("int").alias("src_port"),
        F.lit("10.1.0.1").alias("dst_ip"), F.lit(5060).alias("dst_port"), (F.col("base") + F.col("p.at")).cast("long").alias("sequence_number"), F.col("p.payload").alias("payload"),
        F.timestamp_micros(F.unix_micros("ts") + F.col("p.o") * 1_000_000).alias("timestamp"), (F.col("final") & (F.col("p.o") == 3)).alias("fin"), F.col("event_id").alias("source"),
    )


@query(f"SELECT '10.0.0.' || CAST(user_id % 250 AS VARCHAR) || '|' || CAST(user_id + 1000 AS VARCHAR) || '|10.1.0.1|5060' AS flow, ts AS observed_at, sha256({_MESSAGE}) AS message_sha256 FROM events")
def sip_reassembly(spark, d):
    found = wire.messages(_packets(spark, d)).where("message is not null")
    return found.select("flow", ntz("observed_at").alias("observed_at"), F.sha2("message", 256).alias("message_sha256"))


@query("SELECT '10.0.0.' || CAST(user_id % 250 AS VARCHAR) || '|' || CAST(user_id + 1000 AS VARCHAR) || '|10.1.0.1|5060' AS flow, 0 AS stranded_segments, 0 AS stranded_bytes, CAST(count(*) AS INTEGER) AS dropped FROM events GROUP BY user_id")
def parser_metrics(spark, d):
    found = wire.messages(_packets(spark, d)).where("message is null")
    return found.select("flow", *[F.col(c).cast("int").alias(c) for c in ("stranded_segments", "stranded_bytes", "dropped")])


@query("SELECT '10.0.0.' || CAST(user_id % 250 AS VARCHAR) || '|' || CAST(user_id + 1000 AS VARCHAR) || '|10.1.0.1|5060' AS session, min(ts) AS first_seen, max(ts) + INTERVAL 3 SECOND AS last_seen, CAST(4 * count(*) AS INTEGER) AS packets, TRUE AS closed FROM events GROUP BY user_id")
def session_activity(spark, d):
    return wire.sessions(_packets(spark, d)).select("session", ntz("first_seen").alias("first_seen"), ntz("last_seen").alias("last_seen"), F.col("packets").cast("int").alias("packets"), "closed")


@query(f"""WITH u AS (SELECT user_id, '10.0.0.' || CAST(user_id % 250 AS VARCHAR) || '|' || CAST(user_id + 1000 AS VARCHAR) || '|10.1.0.1|5060' AS flow, count(*) AS n, count(*) FILTER (event_id % 4 = 0) AS bad, sum(length({_MESSAGE})) AS bytes FROM events GROUP BY user_id)
SELECT hook, count(*) AS calls, CAST(sum(n) AS BIGINT) AS total FROM (
    SELECT 'session_start' AS hook, 4 * n AS n FROM u UNION ALL SELECT 'session_end', 4 * n FROM u UNION ALL SELECT 'packet_dropped', n FROM u
    UNION ALL SELECT 'message_reconstructed', length({_MESSAGE}) FROM events UNION ALL SELECT 'parse_error', 1 FROM events WHERE event_id % 4 = 0 UNION ALL SELECT 'event_emitted', 1 FROM events WHERE event_id % 4 <> 0) GROUP BY hook""")
def parser_lifecycle(spark, d):
    """The calls that an observer of the parser gets, by hook."""
    packets = _packets(spark, d)
    found = wire.messages(packets)
    parsed = sip.registrations(sip.parse(found.where("message is not null")), F.lit("store-0042"), F.col("observed_at"))
    return wire.lifecycle(packets, found, parsed).groupBy("hook").agg(F.count("*").alias("calls"), F.sum("count").alias("total"))


@query(f"WITH q AS (SELECT *, {_SIP_DEVICE} AS dev FROM events) SELECT event_id AS source_event, 'given-' || CAST(event_id AS VARCHAR) AS event_id FROM q WHERE event_id % 4 <> 0")
def event_id_override(spark, d):
    parsed = sip.parse(_messages(spark, d).withColumnRenamed("event_id", "source_event"))
    rows = sip.registrations(parsed, F.lit("store-0042"), F.col("ts")).where("reason is null")
    return wire.with_event_ids(rows, F.concat(F.lit("given-"), F.col("source_event").cast("string")), preserve=False).select("source_event", "event_id")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS INTEGER) ELSE 0 END AS retries FROM events")
def retry_count(spark, d):
    i = F.col("event_id")
    text = F.when(i % 3 == 0, F.concat(F.lit('{"attributes":{"ApproximateReceiveCount":"'), F.col("user_id").cast("string"), F.lit('"}}'))).when(i % 3 == 1, '{"attributes":{"ApproximateReceiveCount":"x"}}').otherwise('{"attributes":[]}')
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", logs.retry_count(text).alias("retries"))


@query("SELECT event_id, CASE WHEN event_id % 60 >= 50 THEN 'CRITICAL' WHEN event_id % 60 >= 40 THEN 'ERROR' WHEN event_id % 60 >= 30 THEN 'WARNING' WHEN event_id % 60 >= 20 THEN 'INFO' ELSE 'DEBUG' END AS level FROM events")
def log_level_narrow(spark, d):
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", logs.narrow_level(F.col("event_id") % 60).alias("level"))


def _context(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("event_id").cast("string")
    head = F.create_map(F.lit("x-trace-id"), F.when(F.col("event_id") % 4 == 0, "").otherwise(F.concat(F.lit("t"), i)), F.lit("x-trace-span-id"), F.concat(F.lit("s"), i), F.lit("other"), F.lit("1"))
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", head.alias("headers"))


@query("SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN 't' || CAST(event_id AS VARCHAR) END AS trace_id, CASE WHEN event_id % 4 <> 0 THEN 'n' || CAST(event_id AS VARCHAR) END AS span_id, CASE WHEN event_id % 4 <> 0 THEN 's' || CAST(event_id AS VARCHAR) END AS parent_span_id FROM events")
def trace_extract(spark, d):
    c = logs.extract_trace(F.col("headers"), F.concat(F.lit("n"), F.col("event_id").cast("string")))
    return _context(spark, d).withColumn("c", c).select("event_id", "c.trace_id", "c.span_id", "c.parent_span_id")


@query("SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN 'n' || CAST(event_id AS VARCHAR) ELSE 's' || CAST(event_id AS VARCHAR) END AS span, CASE WHEN event_id % 4 <> 0 THEN 4 ELSE 3 END AS headers FROM events")
def trace_inject(spark, d):
    c = logs.extract_trace(F.col("headers"), F.concat(F.lit("n"), F.col("event_id").cast("string")))
    out = _context(spark, d).withColumn("o", logs.inject_trace(F.col("headers"), c))
    return out.select("event_id", F.element_at("o", "x-trace-span-id").alias("span"), F.size("o").alias("headers"))


@query("SELECT event_id, 't' || CAST(event_id AS VARCHAR) AS trace_id, 'k' AS span_id, 'n' AS parent_span_id FROM events WHERE event_id % 4 <> 0")
def span_child(spark, d):
    c = logs.child_span(logs.extract_trace(F.col("headers"), F.lit("n")), F.lit("k"))
    return _context(spark, d).where("event_id % 4 <> 0").withColumn("c", c).select("event_id", "c.trace_id", "c.span_id", "c.parent_span_id")


@query("SELECT event_id, 'id,source' AS kept FROM events")
def safe_metadata(spark, d):
    m = F.create_map(F.lit("source"), F.lit("a"), F.lit("id"), F.col("event_id").cast("string"), F.lit("body"), F.lit("secret"))
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", F.array_join(F.array_sort(F.map_keys(logs.safe_metadata(m))), ",").alias("kept"))


@query("SELECT event_id, round(event_id % 5000 / 1.0, 3) AS latency_ms, CASE WHEN event_id % 9 = 0 THEN 'error' ELSE 'success' END AS status FROM events")
def latency_measure(spark, d):
    ts = F.col("ts").cast("timestamp")
    end = F.timestamp_micros(F.unix_micros(ts) + (F.col("event_id") % 5000) * 1000)
    m = logs.latency(ts, end, F.when(F.col("event_id") % 9 == 0, "ValueError"))
    return spark.read.parquet(f"{d}/events.parquet").withColumn("m", m).select("event_id", "m.latency_ms", "m.status")


@query("""SELECT event_id, '{"level":"INFO","event":"' || event_type || '"' || CASE WHEN event_id % 2 = 0 THEN ',"trace_id":"' || CAST(event_id AS VARCHAR) || '"' ELSE '' END || '}' AS line FROM events""")
def log_lines(spark, d):
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", logs.log_line(F.lit("INFO"), {"event": F.col("event_type"), "trace_id": F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string"))}).alias("line"))
