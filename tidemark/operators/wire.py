"""TCP packets to framed messages, one direction of a session at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = b"\r\n\r\n"


def with_event_ids(events: DataFrame, ids: Column | None, preserve: bool = True) -> DataFrame:
    """Events as they are emitted: with their own event_id, or, unless they are to be preserved, with ids (an expression
    over the event) where it is given."""
    return events if preserve or ids is None else events.withColumn("event_id", ids)


def lifecycle(packets: DataFrame, found: DataFrame, parsed: DataFrame) -> DataFrame:
    """(hook, subject, at, count, detail): what an observer of the parser is told, as rows.

    session_start and session_end a session, packet_dropped and message_reconstructed a flow and message (found:
    messages()), parse_error and event_emitted for each parsed message (flow, reason, event_id, observed_at).
    """
    hook = lambda df, name, subject, at, count, detail: df.select(F.lit(name).alias("hook"), subject.cast("string").alias("subject"), at.cast("timestamp").alias("at"), count.cast("long").alias("count"), detail.cast("string").alias("detail"))
    seen, none = sessions(packets), F.lit(None)
    length = (F.unix_micros("last_seen") - F.unix_micros("first_seen")) / 1_000_000
    parts = [
        hook(seen, "session_start", F.col("session"), F.col("first_seen"), F.col("packets"), none),
        hook(seen.where("closed"), "session_end", F.col("session"), F.col("last_seen"), F.col("packets"), length),
        hook(found.where("dropped > 0"), "packet_dropped", F.col("flow"), none, F.col("dropped"), F.lit("retransmission")),
        hook(found.where("message is not null"), "message_reconstructed", F.col("flow"), F.col("observed_at"), F.octet_length("message"), none),
        hook(parsed.where("reason is not null"), "parse_error", F.col("flow"), F.col("observed_at"), F.lit(1), F.col("reason")),
        hook(parsed.where("reason is null"), "event_emitted", F.col("event_id"), F.col("observed_at"), F.lit(1), F.lit("sip.registration")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def session_key(src_ip: Column, src_port: Column, dst_ip: Column, dst_port: Column) -> Column:
    """The same for both directions: the lesser endpoint first, addresses compared as text."""
    a, b = F.struct(src_ip.alias("ip"), src_port.alias("port")), F.struct(dst_ip.alias("ip"), dst_port.alias("port"))
    low, high = F.least(a, b), F.greatest(a, b)
    return F.concat_ws("|", low["ip"], low["port"].cast("string"), high["ip"], high["port"].cast("string"))


def sessions(packets: DataFrame) -> DataFrame:
    """(session, first_seen, last_seen, packets, closed)."""
    key = session_key(F.col("src_ip"), F.col("src_port"), F.col("dst_ip"), F.col("dst_port"))
    return packets.groupBy(key.alias("session")).agg(F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"), F.count("*").alias("packets"), F.max("fin").alias("closed"))


class Flow:
    """Reassembly and framing of one direction: in-order bytes, the times of the packets they came in, and counts."""

    def __init__(self) -> None:
        self.expected = 0
        self.waiting: dict[int, tuple[object, bytes]] = {}
        self.buffer = bytearray()
        self.marks: list[tuple[int, object]] = []
        self.dropped = 0

    def packet(self, seq: int, data: bytes, at: object) -> Iterator[tuple[object, bytes]]:
        """(time, bytes) of what becomes readable: each with the time of its own packet."""
        self.expected = self.expected or seq
        if seq < self.expected:
            self.dropped += 1
            return
        if seq > self.expected:
            self.waiting[seq] = (at, data)
            return
        if not data:
            return
        chunk: tuple[object, bytes] | None = (at, data)
        while chunk:
            yield chunk
            self.expected += len(chunk[1])
            chunk = self.waiting.pop(self.expected, None) if len(chunk[1]) else None

    def frame(self, at: object, data: bytes) -> Iterator[tuple[object, bytes]]:
        """(time of the first byte, message with its terminator) of the messages that data completes."""
        # a terminator that data completes begins in its last bytes at the earliest
        look = max(0, len(self.buffer) - len(END) + 1)
        self.marks.append((len(self.buffer), at))
        self.buffer += data
        start, mark = 0, 0
        while (end := self.buffer.find(END, look)) >= 0:
            mark = self._mark(mark, start)
            yield self.marks[mark][1], bytes(self.buffer[start : end + len(END)])
            start = look = end + len(END)
        if start:
            mark = self._mark(mark, start)
            self.marks = [(max(0, offset - start), t) for offset, t in self.marks[mark:]] if start < len(self.buffer) else []
            del self.buffer[:start]

    def _mark(self, mark: int, start: int) -> int:
        """The last mark at or before start, from mark on: marks and messages both go forward."""
        while mark + 1 < len(self.marks) and self.marks[mark + 1][0] <= start:
            mark += 1
        return mark


CHUNKS = "flow string, position long, timestamp timestamp, data binary"
MESSAGES = "flow string, position long, observed_at timestamp, message binary, stranded_segments long, stranded_bytes long, dropped long"


def _flows(packets: DataFrame) -> DataFrame:
    """Packets dealt by flow and in the order of each; a task follows many flows, one after another, a batch at a time."""
    flow = F.concat_ws("|", "src_ip", F.col("src_port").cast("string"), "dst_ip", F.col("dst_port").cast("string"))
    own = packets.select(flow.alias("flow"), "arrival_seq", "sequence_number", "payload", "timestamp")
    return own.repartition("flow").sortWithinPartitions("flow", "arrival_seq")


def _followed(batches: Iterator[pa.RecordBatch], step: Callable[[Flow, int, bytes, object], list[tuple]], end: Callable[[Flow], list[tuple]]) -> Iterator[tuple[str, list[tuple]]]:
    """(flow, rows) of every flow in sorted batches: step for each packet, end after the last; rows of a batch come at once."""
    name, state = None, Flow()
    for batch in batches:
        rows: list[tuple] = []
        for flow, _, seq, data, at in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if flow != name:
                if name is not None:
                    rows += end(state)
                    yield name, rows
                name, state, rows = flow, Flow(), []
            rows += step(state, seq, data or b"", at)
        if name is not None and rows:
            yield name, rows
    if name is not None:
        yield name, end(state)


def _batches(found: Iterator[tuple[str, list[tuple]]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows numbered within their flow, in batches of about a thousand."""
    held: list[tuple] = []
    last, at = None, 0
    for flow, rows in found:
        at = at if flow == last else 0
        last = flow
        for r in rows:
            held.append((flow, at, *r))
            at += 1
        if len(held) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array([h[k] for h in held], f.type) for k, f in enumerate(schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([h[k] for h in held], f.type) for k, f in enumerate(schema)], schema=schema)


def reassemble(packets: DataFrame) -> DataFrame:
    """(flow, position, timestamp, data): bytes of every flow in order."""
    schema = pa.schema([("flow", pa.string()), ("position", pa.int64()), ("timestamp", pa.timestamp("us", "UTC")), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_followed(batches, lambda s, seq, data, at: list(s.packet(seq, data, at)), lambda s: []), schema)

    return _flows(packets).mapInArrow(run, CHUNKS)


def messages(packets: DataFrame) -> DataFrame:
    """(flow, position, observed_at, message): framed messages, dated by the packet of their first byte.

    A flow's last row has a null message and what was left at its end: segments and bytes that never became readable or
    complete, and retransmissions dropped.
    """
    counts = [(n, pa.int64()) for n in ("stranded_segments", "stranded_bytes", "dropped")]
    schema = pa.schema([("flow", pa.string()), ("position", pa.int64()), ("observed_at", pa.timestamp("us", "UTC")), ("message", pa.binary()), *counts])

    def step(state: Flow, seq: int, data: bytes, at: object) -> list[tuple]:
        return [(t, m, None, None, None) for when, chunk in state.packet(seq, data, at) for t, m in state.frame(when, chunk)]

    def end(state: Flow) -> list[tuple]:
        left = sum(len(d) for _, d in state.waiting.values()) + len(state.buffer)
        return [(None, None, len(state.waiting), left, state.dropped)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_followed(batches, step, end), schema)

    return _flows(packets).mapInArrow(run, MESSAGES)
