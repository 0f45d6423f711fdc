"""Contracts of events: envelope, metadata, and the payload of every registered type, as column expressions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.binding import bound
from tidemark.operators.watermark import seconds

#: Required fields and the grammars of names and versions.
ENVELOPE = ["event_timestamp", "payload", "trace"]
METADATA = ["event_type", "schema_version", "source"]
VERSION = r"^v\d+(\.\d+)*$"
EVENT_TYPE = r"^[a-z0-9]+(\.[a-z0-9]+)+$"
NAME = r"^[a-z0-9]+([.\-_][a-z0-9]+)*$"
SEMVER = r"^(0|[1-9]\d*)\.(0|[1-9]\d*)\.(0|[1-9]\d*)(-((0|[1-9]\d*|\d*[a-zA-Z-][0-9a-zA-Z-]*)(\.(0|[1-9]\d*|\d*[a-zA-Z-][0-9a-zA-Z-]*))*))?(\+[0-9a-zA-Z-]+(\.[0-9a-zA-Z-]+)*)?$"
CLIENT_VERSION = r"^\d+\.\d+\.\d+([\-+][A-Za-z0-9\.]+)?$"
STAGES = ["ingestion", "validation", "enrichment", "feature_building", "export", "inference"]
CLOCK_SKEW_SECONDS = 300


def missing_envelope(raw: Column) -> Column:
    """Required fields that a JSON event lacks, sorted; a field that is null is there."""
    keys = F.json_object_keys(raw)
    return F.filter(F.array(*[F.lit(k) for k in ENVELOPE]), lambda k: ~F.coalesce(F.array_contains(keys, k), F.lit(False)))


def missing_metadata(raw: Column) -> Column:
    """metadata.<field> of fields that are missing or empty, sorted; ["metadata"] if there is no such object."""
    whole = F.get_json_object(raw, "$.metadata")
    empty = [(k, F.get_json_object(raw, f"$.metadata.{k}")) for k in METADATA]
    falsy = lambda v: v.isNull() | v.isin("", "0", "0.0", "false", "[]", "{}")
    lacking = F.array_compact(F.array(*[F.when(falsy(v), F.lit(f"metadata.{k}")) for k, v in empty]))
    return F.when(whole.isNull() | ~whole.startswith("{"), F.array(F.lit("metadata"))).otherwise(lacking)


def envelope_valid(raw: Column) -> Column:
    """Whether nothing is missing."""
    return (F.size(missing_envelope(raw)) == 0) & (F.size(missing_metadata(raw)) == 0)


def asserted(raw: Column) -> Column:
    """The event, or an error that ends the query."""
    lacking = F.concat(missing_envelope(raw), missing_metadata(raw))
    return F.when(F.size(lacking) == 0, raw).otherwise(F.raise_error(F.concat(F.lit("incomplete event: "), F.array_join(lacking, ", "))))


def uuid_version(value: Column, versions: str = "45") -> Column:
    """Whether a UUID has one of the versions; null passes."""
    return F.coalesce(F.lower(value).rlike(rf"^[0-9a-f]{{8}}-[0-9a-f]{{4}}-[{versions}][0-9a-f]{{3}}-[89ab][0-9a-f]{{3}}-[0-9a-f]{{12}}$"), F.lit(True))


def uuid_versions(values: Column, versions: str = "45") -> Column:
    """The same for every element of an array."""
    return F.coalesce(F.forall(values, lambda v: uuid_version(v, versions)), F.lit(True))


def is_utc(text: Column) -> Column:
    """Whether a time's text has an offset of zero; one without an offset is not UTC. null passes."""
    return F.coalesce(text.rlike(r"(Z|[+-]00:?00)$"), F.lit(True))


def within_skew(event_ts: Column, ingest_ts: Column) -> Column:
    """Whether an event's time is not more than CLOCK_SKEW_SECONDS after its ingestion; nulls pass."""
    return F.coalesce(event_ts <= ingest_ts + seconds(CLOCK_SKEW_SECONDS), F.lit(True))


def semver(value: Column) -> Column:
    """Strict semantic versions; null passes."""
    return F.coalesce(value.rlike(SEMVER), F.lit(True))


def metadata_source(value: Column) -> Column:
    """The source, unknown if it is not given."""
    return F.coalesce(value, F.lit("unknown"))


def root_trace(root: Column, trace: Column) -> Column:
    """The root of a trace, itself if none is given."""
    return F.coalesce(root, trace)


def ipv4(value: Column) -> Column:
    part = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    return value.rlike(rf"^{part}(\.{part}){{3}}$")


def ip_address(value: Column) -> Column:
    """IPv4, or IPv6 in any of its forms; null passes."""
    four = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(\.(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}"

    def six(v: Column) -> Column:
        # an embedded IPv4 address stands for two groups
        body = F.regexp_replace(F.regexp_replace(v, r"%.*$", ""), rf"{four}$", "0:0")
        return v.rlike(rf"^[0-9A-Fa-f:]*(:{four})?(%[^%]+)?$") & bound(body, grouped)

    def grouped(body: Column) -> Column:
        groups = F.split(body, ":")
        sound = F.forall(groups, lambda g: F.length(g) <= 4)
        gaps = F.size(F.split(body, "::")) - 1
        filled = F.size(F.filter(groups, lambda g: g != ""))
        full = (gaps == 0) & (filled == 8) & (F.size(groups) == 8)
        short = (gaps == 1) & ~body.contains(":::") & (filled <= 7) & ~body.rlike("^:[^:]|[^:]:$")
        return sound & (full | short)

    return bound(value, lambda v: v.isNull() | ipv4(v) | (v.contains(":") & six(v)))


@dataclass(frozen=True)
class Field:
    """A payload field: its checks, each an expression that is true of a good value."""

    kind: str = "string"
    required: bool = False
    pattern: str | None = None
    within: tuple[float, float] | None = None
    length: tuple[int, int] | None = None
    choices: tuple[str, ...] = ()
    uuid: str = ""
    address: bool = False
    utc: bool = False
    semver: bool = False

    def problem(self, c: Column) -> Column:
        """A word for what is wrong with a value, else null."""
        bad = F.when(c.isNull(), F.lit("missing") if self.required else F.lit(None))
        if self.kind == "long":
            bad = bad.when(c.try_cast("long").isNull(), "type")
        if self.pattern:
            bad = bad.when(~c.rlike(self.pattern), "pattern")
        if self.within:
            bad = bad.when(~c.try_cast("double").between(*map(float, self.within)), "range")
        if self.length:
            bad = bad.when(~F.length(c).between(*self.length), "length")
        if self.choices:
            bad = bad.when(~c.isin(list(self.choices)), "choice")
        if self.uuid:
            bad = bad.when(~uuid_version(c, self.uuid), "uuid")
        if self.address:
            bad = bad.when(~ip_address(c), "address")
        if self.utc:
            bad = bad.when(c.try_cast("timestamp").isNull() | ~is_utc(c), "utc")
        if self.semver:
            bad = bad.when(~semver(c), "semver")
        return bad


def _f(**kw) -> Field:
    return Field(**kw)


_SEVERITIES = ("INFO", "WARNING", "CRITICAL")
_STORE = {"pattern": NAME, "length": (1, 1 << 30)}
_WORDS = {"pattern": EVENT_TYPE, "length": (1, 1 << 30)}
_SOME = (1, 1 << 30)


@dataclass(frozen=True)
class Contract:
    event_type: str
    version: str
    fields: dict[str, Field] = field(default_factory=dict)


#: The registered event types and their payload fields.
CONTRACTS = [
    Contract("device.registration", "v1", {
        "device_id": _f(required=True, uuid="4"), "store_id": _f(required=True, **_STORE), "device_type": _f(required=True, choices=("SENSOR", "GATEWAY", "EDGE_NODE")),
        "firmware_version": _f(semver=True), "registered_at": _f(required=True, utc=True)}),
    Contract("network.connection", "v1", {
        "connection_id": _f(required=True, uuid="4"), "source_ip": _f(required=True, address=True), "source_port": _f(kind="long", within=(0, 65535)),
        "destination_ip": _f(required=True, address=True), "destination_port": _f(kind="long", within=(0, 65535)), "protocol": _f(required=True, choices=("TCP", "UDP", "TLS")),
        "connected_at": _f(required=True, utc=True), "latency_ms": _f(kind="long", within=(0, 60000)), "direction": _f(required=True, choices=("INBOUND", "OUTBOUND"))}),
    Contract("session.start", "v1", {
        "session_id": _f(required=True, uuid="4"), "actor_id": _f(required=True, uuid="4"), "started_at": _f(required=True, utc=True), "client_version": _f(pattern=CLIENT_VERSION),
        "platform": _f(choices=("ios", "android", "web", "backend", "cli")), "entrypoint": _f(), "region": _f(), "network_type": _f(choices=("wifi", "cellular", "ethernet", "unknown")), "experiment_id": _f()}),
    Contract("sip.registration", "v1", {
        "device_id": _f(required=True, uuid="45"), "device_label": _f(required=True, length=(1, 128)), "store_id": _f(required=True, **_STORE), "registration_status": _f(required=True, choices=("REGISTERED",)),
        "observed_at": _f(required=True, utc=True), "transport_protocol": _f(choices=("TCP", "UDP", "TLS")), "source_ip": _f(address=True), "registration_call_id": _f(length=(0, 256))}),
    Contract("detection.event", "v1", {
        "detection_id": _f(required=True, uuid="45"), "detection_type": _f(required=True, **_WORDS), "severity": _f(required=True, choices=_SEVERITIES), "detected_at": _f(required=True, utc=True),
        "store_id": _f(required=True, length=_SOME), "device_id": _f(uuid="45"), "source_event_id": _f(required=True, uuid="45"), "threshold_breached": _f(required=True, length=_SOME), "details": _f()}),
    Contract("feature.vector", "v1", {
        "entity_id": _f(required=True, uuid="4"), "feature_timestamp": _f(required=True, utc=True), "feature_values": _f(required=True), "feature_version": _f(required=True, pattern=VERSION), "source_event_id": _f(required=True, uuid="4")}),
    Contract("feature.vector.windowed", "v1", {
        "partition_key": _f(required=True, **_STORE), "window_start": _f(required=True, utc=True), "window_end": _f(required=True, utc=True), "feature_values": _f(required=True), "feature_version": _f(required=True, pattern=VERSION)}),
    Contract("alert.event", "v1", {
        "alert_id": _f(required=True, uuid="45"), "detection_id": _f(required=True, uuid="45"), "detection_type": _f(required=True, **_WORDS), "severity": _f(required=True, choices=_SEVERITIES), "routed_at": _f(required=True, utc=True),
        "store_id": _f(required=True, length=_SOME), "device_id": _f(uuid="45"), "summary": _f(required=True, length=_SOME), "details": _f()}),
    Contract("alert.acknowledgement", "v1", {
        "acknowledgement_id": _f(required=True, uuid="4"), "alert_id": _f(required=True, uuid="45"), "acknowledged_at": _f(required=True, utc=True), "acknowledged_by": _f(required=True, length=_SOME), "note": _f()}),
]


def fields_of(text: Column) -> Column:
    """A JSON object's fields as a map of texts, nested values as their JSON; null for what is no object."""
    return F.from_json(text, "map<string,string>")


def _payload_problems(fields: Column, contract: Contract) -> Column:
    """The same of a payload's fields, a bound map."""
    found = []
    for name, f in sorted(contract.fields.items()):
        bad = bound(F.element_at(fields, name), f.problem)
        found.append(F.when(bad.isNotNull(), F.concat(F.lit(f"{name}:"), bad)))
    known = F.array(*[F.lit(n) for n in contract.fields])
    keys = F.coalesce(F.map_keys(fields), F.array().cast("array<string>"))
    extra = F.transform(F.array_except(keys, known), lambda k: F.concat(k, F.lit(":unknown")))
    return F.array_sort(F.concat(F.array_compact(F.array(*found)), extra))


def payload_problems(payload: Column, contract: Contract) -> Column:
    """field:problem of everything wrong with a JSON payload, unknown fields included, sorted."""
    return bound(fields_of(payload), lambda fields: _payload_problems(fields, contract))


def _problems(event: Column) -> Column:
    """All that is wrong with an event's fields, a bound map of texts."""
    meta = fields_of(F.element_at(event, "metadata"))
    payload = fields_of(F.element_at(event, "payload"))
    return bound(F.struct(meta.alias("m"), payload.alias("p")), lambda e: _checked(event, e["m"], e["p"]))


def _checked(event: Column, meta: Column, payload: Column) -> Column:
    kind, version, source = (F.element_at(meta, k) for k in METADATA)
    has = F.coalesce(F.map_keys(event), F.array().cast("array<string>"))
    falsy = lambda v: v.isNull() | v.isin("", "0", "0.0", "false", "[]", "{}")
    lacking = F.filter(F.array(*[F.lit(k) for k in ENVELOPE]), lambda k: ~F.array_contains(has, k))
    partial = F.array_compact(F.array(*[F.when(falsy(F.element_at(meta, k)), F.lit(f"metadata.{k}")) for k in METADATA]))
    missing = F.concat(lacking, F.when(meta.isNull(), F.array(F.lit("metadata"))).otherwise(partial))
    own = F.lit(None).cast("array<string>")
    for c in CONTRACTS:
        own = F.when((kind == c.event_type) & (version == c.version), _payload_problems(payload, c)).otherwise(own)
    shape = lambda v, pattern: ~F.coalesce(v.rlike(pattern), F.lit(True))
    time = lambda k: F.element_at(event, k).try_cast("timestamp")
    names = F.array_compact(F.array(
        F.when(shape(kind, EVENT_TYPE), F.lit("metadata.event_type:pattern")),
        F.when(shape(version, VERSION), F.lit("metadata.schema_version:pattern")),
        F.when(shape(source, NAME), F.lit("metadata.source:pattern")),
        F.when(~within_skew(time("event_timestamp"), time("ingest_timestamp")), F.lit("event_timestamp:skew")),
    ))
    told = F.transform(missing, lambda k: F.concat(k, F.lit(":missing")))
    return F.concat(told, names, F.coalesce(own, F.array(F.lit("metadata:unregistered"))))


def validate(events: DataFrame, raw: str = "raw") -> DataFrame:
    """events(raw JSON) with problems, an array that is empty for a valid event: envelope, metadata, identity of the
    contract, clock skew, and its payload's fields. The event, its metadata and its payload are each parsed once.
    Resolving a version to another is separate (see resolved)."""
    whole = F.coalesce(fields_of(F.col(raw)), F.create_map().cast("map<string,string>"))
    return events.withColumn("problems", bound(whole, _problems))


def resolved(events: DataFrame, catalog, raw: str = "raw") -> DataFrame:
    """Raw events resolved to a registered version and validated as one step: events with event_type, schema_version,
    resolved (the least registered version that is compatible and not lower) and problems.

    An event is checked against the contract it resolves to. That its metadata names this very contract is part of
    the check: metadata:identity stands for a version that only resolves to it, metadata:unregistered for none at all.
    """
    told = events.withColumn("__m", fields_of(F.get_json_object(F.col(raw), "$.metadata")))
    named = told.withColumns({"event_type": F.element_at("__m", "event_type"), "schema_version": F.element_at("__m", "schema_version")}).drop("__m")
    wanted = named.select("event_type", F.col("schema_version").alias("version")).where("event_type is not null and version is not null").distinct()
    found = catalog.resolve(wanted).select("event_type", F.col("version").alias("schema_version"), "resolved")
    both = validate(named.join(found, ["event_type", "schema_version"], "left"), raw)
    odd = F.col("resolved").isNotNull() & (F.col("resolved") != F.col("schema_version"))
    other = F.transform("problems", lambda p: F.when(p == "metadata:unregistered", "metadata:identity").otherwise(p))
    return both.withColumn("problems", F.when(odd, other).otherwise(F.col("problems")))
