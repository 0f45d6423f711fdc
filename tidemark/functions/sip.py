"""SIP messages as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.binding import bound
from tidemark.functions.identity import derive, device_id, iso
from tidemark.operators.validation import ip_address


def text_of(message: Column) -> Column:
    """A message's bytes as text; bytes that are no UTF-8 are left out."""
    text = message.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.translate(F.make_valid_utf8(text), "\ufffd", ""))


def request_tokens(message: Column) -> Column:
    """The words of the request line; null if there are fewer than three."""
    line = F.substring_index(message, "\r\n", 1)
    return bound(F.filter(F.split(line, r"\s+"), lambda w: w != ""), lambda words: F.when(F.size(words) >= 3, words))


def headers(message: Column) -> Column:
    """map of lower-case names to trimmed values; the last of a name wins, lines without a colon are skipped."""
    lines = F.filter(F.slice(F.split(message, "\r\n"), 2, 1_000_000), lambda x: x.contains(":"))
    pairs = F.transform(lines, lambda x: F.struct(F.lower(F.trim(F.substring_index(x, ":", 1))).alias("k"), F.trim(x.substr(F.instr(x, ":") + 1, F.length(x))).alias("v")))

    def last_of_each(back: Column) -> Column:
        # read backwards, the first of a name is its last
        names = F.transform(back, lambda p: p["k"])
        return bound(names, lambda ks: F.map_from_entries(F.filter(back, lambda p, i: F.array_position(ks, p["k"]) == i + 1)))

    return bound(F.reverse(pairs), last_of_each)


def device_label(from_header: Column) -> Column:
    """What stands between the first sip: and the next @, without angle brackets; null without sip:."""
    rest = F.get(F.split(from_header, "sip:"), F.lit(1))
    return F.translate(F.substring_index(rest, "@", 1), "<>", "")


def via(header: Column) -> tuple[Column, Column]:
    """(transport, address): the last part of the first word, and the second word up to a colon."""
    words = F.filter(F.split(header, r"\s+"), lambda w: w != "")
    some = F.size(words) >= 2
    return F.when(some, F.element_at(F.split(words[0], "/"), -1)), F.when(some, F.substring_index(words[1], ":", 1))


def parse(messages: DataFrame, message: str = "message") -> DataFrame:
    """messages with method, headers, device_label, call_id, transport and source_ip; rows without a request line have
    a null method. A message may be text or bytes."""

    def read(h: Column) -> Column:
        transport, address = via(F.element_at(h, "via"))
        return F.struct(h.alias("headers"), device_label(F.element_at(h, "from")).alias("device_label"), F.element_at(h, "call-id").alias("call_id"), transport.alias("transport"), address.alias("source_ip"))

    def both(text: Column) -> Column:
        return F.struct(F.upper(request_tokens(text)[0]).alias("method"), bound(headers(text), read).alias("h"))

    raw = F.col(message)
    text = text_of(raw) if messages.schema[message].dataType.typeName() == "binary" else raw
    out = messages.withColumn("__sip", bound(text, both))
    return out.withColumns({"method": F.col("__sip.method"), **{c: F.col(f"__sip.h.{c}") for c in ("headers", "device_label", "call_id", "transport", "source_ip")}}).drop("__sip")


def registrations(parsed: DataFrame, store: Column, observed_at: Column, trace: Column | None = None) -> DataFrame:
    """Parsed messages with reason, null for those that make a sip.registration event, and the event's fields.

    Other methods, contradicting CSeq headers and missing labels are skipped; what the event's contract would not
    take (transport, address, lengths) is kept with its reason rather than ending the stream.
    """
    cseq = F.coalesce(F.element_at("headers", "cseq"), F.lit(""))
    transport = F.upper("transport")
    reason = (
        F.when(F.col("method").isNull(), "no_request_line")
        .when(F.col("method") != "REGISTER", "unsupported_method")
        .when(~cseq.contains("REGISTER"), "register_cseq_mismatch")
        .when(F.col("device_label").isNull(), "register_missing_device_label")
        .when(~F.length("device_label").between(1, 128), "device_label_length")
        .when(~transport.isin("TCP", "UDP", "TLS"), "transport")
        .when(~ip_address(F.col("source_ip")), "address")
        .when(F.length("call_id") > 256, "call_id_length")
    )
    out = parsed.withColumn("reason", reason).withColumn("store_id", store).withColumn("observed_at", observed_at)
    good = F.col("reason").isNull()
    device = device_id(F.col("store_id"), F.col("device_label"))
    return (
        out.withColumn("device_id", F.when(good, device))
        .withColumn("event_id", F.when(good, derive("event.sip_registration", F.col("device_id"), iso(F.col("observed_at")), F.col("call_id"))))
        .withColumn("registration_status", F.when(good, "REGISTERED"))
        .withColumn("transport_protocol", F.when(good, transport))
        .withColumnRenamed("call_id", "registration_call_id")
        .withColumn("trace_id", trace if trace is not None else F.lit(None).cast("string"))
    )
