"""Personal data: regular expressions propose, checksums confirm, nearby words adjust the score.

Four base kinds (email, ip, card, phone) keep every span their pattern and check give. Further kinds are
proposals whose score must reach a threshold: IBANs (mod 97), national numbers in the 3-2-4 form, and
credentials (access key ids, assigned tokens). A confirmed checksum raises a score, so do words such as
"iban" or "ssn" within CONTEXT characters, and words such as "order" or "version" lower it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "national_id", "credential")
CONTEXT = 48
THRESHOLD = 0.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])(?!000|666|9[0-9]{2})[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_KEY = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])")
_ASSIGNED = re.compile(r"\b(?:token|secret|password|passwd|api_key|apikey)\b ?[=:] ?([\"'])([A-Za-z0-9+/_.=-]{16,128})\1")
_HELPS = {
    "email": re.compile(r"mail|contact|write to", re.I),
    "ip": re.compile(r"\bip\b|address|host|server", re.I),
    "card": re.compile(r"card|visa|credit|payment", re.I),
    "phone": re.compile(r"phone|call|tel\b|mobile|fax", re.I),
    "iban": re.compile(r"iban|account|bank|konto|compte|cuenta", re.I),
    "national_id": re.compile(r"ssn|social security|national|tax id", re.I),
    "credential": re.compile(r"token|secret|password|key", re.I),
}
_HURTS = re.compile(r"version|order|isbn|serial|example|figure", re.I)
#: Score before context; a checksum that holds is in it.
_SCORE = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "national_id": 0.4, "credential": 0.8}


def luhn(digits: str) -> bool:
    """The check digit rule of payment cards."""
    own = sum(map(int, digits[-1::-2]))
    return (own + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def mod97(iban: str) -> bool:
    """The check digit rule of account numbers."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of [A-Za-z0-9._%+-]+@ and a domain, read outwards from each @ so that time stays linear."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            done = at + 1
            at = text.find("@", at + 1)


def _short(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and (not part or int(part) <= 255)


def base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """The spans of the base kinds, by kind and then start."""
    if "@" in text:
        for a, b in emails(text):
            yield "email", a, b
    for m in _IP.finditer(text):
        if all(map(_short, m[0].split("."))):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "") if m.end() - m.start() >= 13 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield "card", *m.span()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                yield "phone", *m.span()


def added_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Proposals of the further kinds, before their score is known."""
    for m in _IBAN.finditer(text):
        if 15 <= len(own := m[0].replace(" ", "")) <= 34 and mod97(own):
            yield "iban", *m.span()
    if "-" in text:
        for m in _NATIONAL.finditer(text):
            yield "national_id", *m.span()
    found = [m.span() for m in _KEY.finditer(text)] if "AKIA" in text or "ASIA" in text else []
    if "=" in text or ":" in text:
        found += [m.span(2) for m in _ASSIGNED.finditer(text)]
    for a, b in sorted(found):
        yield "credential", a, b


def scored(text: str, kind: str, start: int, end: int) -> float:
    """The kind's score, raised or lowered by the words around the span."""
    near = text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT]
    score = _SCORE[kind] + 0.2 * bool(_HELPS[kind].search(near)) - 0.2 * bool(_HURTS.search(near))
    return round(min(1.0, max(0.0, score)), 3)


def find(text: str | None, threshold: float = THRESHOLD) -> list[dict]:
    """All spans of a text: base kinds always, further ones from threshold on; offsets are code points."""
    if not text:
        return []
    out = [{"kind": k, "start": a, "end": b, "score": scored(text, k, a, b), "base": True} for k, a, b in base_spans(text)]
    for k, a, b in added_spans(text):
        if (score := scored(text, k, a, b)) >= threshold:
            out.append({"kind": k, "start": a, "end": b, "score": score, "base": False})
    return out


def redact(text: str, spans: list[dict]) -> str:
    """The text with every span replaced by its kind in brackets; spans that touch or overlap become one."""
    out, done = [], 0
    joined: list[list] = []
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if joined and s["start"] < joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], s["end"])
        else:
            joined.append([s["start"], s["end"], s["kind"]])
    for a, b, kind in joined:
        out += text[done:a], f"[{kind.upper()}]"
        done = b
    return "".join([*out, text[done:]])


SPANS = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"
_SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("base", pa.bool_())])
)


def detect(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, spans) for every row; a null or empty text has no spans, an empty table no results. Repeated rows are
    answered each; other columns are not read. Texts are scanned whole, one pass for each kind, in linear time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [find(t.as_py(), threshold) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPAN_TYPE)], names=["doc_id", "spans"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col)).mapInArrow(run, f"doc_id long, spans {SPANS}")


def redacted(docs: DataFrame, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with every span of text_col replaced by its kind; all other columns as they are, null stays null, and repeated
    rows and an empty table stay as many rows."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(at)]
            new = [redact(t, s) if (s := find(t, threshold)) else t for t in texts]
            columns = [pa.array(new, pa.string()) if k == at else c for k, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def joined(spans: Column) -> Column:
    """kind:start:end of each span in its order, with commas between."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
