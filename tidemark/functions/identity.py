"""Derived identities and the text forms of times that they are made of, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the namespace of all derived ids.
NAMESPACE = "f600ea3b-e95a-5ef4-8e1f-467cf395dd14"


def uuid5(name: Column, namespace: str = NAMESPACE) -> Column:
    """UUID version 5 of a name."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    part = lambda a, n: F.substring(digest, a, n)
    return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(variant, part(18, 3)), part(21, 12))


def _micros(ts: Column) -> Column:
    return F.date_format(ts, "SSSSSS")


def iso(ts: Column) -> Column:
    """YYYY-MM-DDTHH:MM:SS[.ffffff]+00:00, the fraction only if there is one."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.when(_micros(ts) != "000000", F.concat(F.lit("."), _micros(ts))).otherwise(""), F.lit("+00:00"))


def plain(ts: Column) -> Column:
    """The same with a space in the middle, as times are written inside ids."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.when(_micros(ts) != "000000", F.concat(F.lit("."), _micros(ts))).otherwise(""), F.lit("+00:00"))


def derive(role: str, *parts: Column) -> Column:
    """The id of a role and its coordinates; a null part reads None."""
    return uuid5(F.concat_ws("|", F.lit(role), *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts]))


def device_id(store: Column, label: Column) -> Column:
    """A device's id, from its store and its label in it."""
    return derive("device", store, label)


def ensure_utc(text: Column) -> Column:
    """A time's text as a point in time; one without an offset is taken as UTC, whatever the session's zone. Null for no time."""
    zoned = text.rlike(r"([zZ]|[+-]\d{2}(:?\d{2})?)$") & text.contains(":")
    return F.coalesce(F.when(zoned, text.try_cast("timestamp")), F.when(~zoned, F.concat(F.trim(text), F.lit("Z")).try_cast("timestamp")), F.to_utc_timestamp(text.try_cast("timestamp_ntz").cast("timestamp"), F.current_timezone()))
