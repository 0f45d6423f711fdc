"""Canonical JSON: keys in order, no spaces, characters beyond ASCII escaped."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascii_only(text: Column) -> Column:
    """JSON text with every character beyond ASCII as \\uXXXX, in surrogate pairs where needed."""
    units = F.regexp_extract_all(F.hex(F.encode(text, "UTF-16BE")), F.lit("(....)"), F.lit(1))
    wide = F.transform(
        units,
        lambda u: F.when(u < "0080", F.decode(F.unhex(u), "UTF-16BE")).otherwise(F.concat(F.lit("\\u"), F.lower(u))),
    )
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.array_join(wide, "")).otherwise(text)


def canonical(fields: dict[str, Column]) -> Column:
    """A JSON object of the fields, nulls kept."""
    return ascii_only(F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"}))


def canonical_map(entries: Column) -> Column:
    """A JSON object of a map, its keys in order."""
    return ascii_only(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(entries)))))
