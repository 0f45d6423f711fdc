"""Sharding by proportional stratified interleaving, with DataFrame functions only.

Within a source rows are ranked in a seeded random order; row r of n gets the fraction (r - u) / n, where u in
(0, 1) is the source's own, so that many small sources do not all come at once. Sorted by fraction, every
stretch of the table holds the sources in proportion, so cutting it into stretches of equal row counts makes
shards of equal mixture. Ranks come from counts of small cells of the sort key and row numbers within a cell, so no
source or sort is ever one task's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a cell holds on average; a coarse cell is CELL cells.
CELL = 2048
#: Strata are broadcast up to this count, and joined by shuffle beyond it.
BROADCAST_ROWS = 10_000


def _unit(key: Column) -> Column:
    """A number in [0, 1) from the first 13 hexadecimal digits of a hash."""
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / float(1 << 52)


def numbered(rows: DataFrame, by: str | None, unit: str, order: list[str], name: str, totals: DataFrame | int) -> DataFrame:
    """rows with name, their place from 1 on in order within by (or in all), in three exact levels.

    unit, a double in [0, 1), must not fall where order rises. totals is the count of rows, or has
    one row for each value of by with `total`, its count.
    """
    keys = [by] if by else []
    cells = F.ceil(F.col("total") / float(CELL))
    if by:
        small = totals.count() <= BROADCAST_ROWS
        joined = rows.join(F.broadcast(totals) if small else totals, by)
    else:
        joined = rows.withColumn("total", F.lit(totals).cast("long"))
    joined = joined.withColumn("__cell", F.floor(F.col(unit) * cells)).withColumn("__coarse", F.floor(F.col("__cell") / CELL))
    counts = joined.groupBy(*keys, "__coarse", "__cell").agg(F.count("*").alias("__n"))
    coarse = counts.groupBy(*keys, "__coarse").agg(F.sum("__n").alias("__m"))
    before = Window.partitionBy(*keys).orderBy("__coarse").rowsBetween(Window.unboundedPreceding, -1)
    coarse = coarse.withColumn("__base", F.coalesce(F.sum("__m").over(before), F.lit(0))).drop("__m")
    within = Window.partitionBy(*keys, "__coarse").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counts.withColumn("__in", F.coalesce(F.sum("__n").over(within), F.lit(0)))
        .join(coarse, [*keys, "__coarse"])
        .select(*keys, "__cell", (F.col("__base") + F.col("__in")).alias("__start"))
    )
    place = F.row_number().over(Window.partitionBy(*keys, "__cell").orderBy(*order))
    # dealt by cell, or the windows would take over a join's dealing by source alone
    return (
        joined.repartition(*keys, "__cell")
        .withColumn("__place", place)
        .join(starts, [*keys, "__cell"])
        .withColumn(name, F.col("__start") + F.col("__place"))
        .drop("__cell", "__coarse", "__place", "__start")
    )


def interleaved_shards(
    docs: DataFrame,
    shards: int = 40,
    *,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """(doc_id, source, size, text_crc32, position, shard, slot) for every row.

    position runs from 0 without gaps over the interleaved table, shard is floor(position * shards / rows)
    and slot the position within the shard, so shards' row counts differ by one at most. A null source is
    a source of its own; a null text has size 16 and the checksum of no bytes; long texts are read whole. The random
    order is of doc_id, size and checksum, so that rows without an id are spread like others; rows equal in all of
    these are interchangeable. Other columns are not read, and an empty table has no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text).alias("text_crc32"),
    ).select(
        "*",
        F.concat(F.when(F.col("source").isNull(), F.lit("0")).otherwise("1"), F.coalesce("source", F.lit(""))).alias("__s"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size", "text_crc32").cast("binary")).alias("__h"),
    )
    base = base.withColumn("__u", _unit(F.col("__h")))
    phase = _unit(F.md5(F.concat_ws(":", F.lit(str(seed)), "__s").cast("binary")))
    strata = base.groupBy("__s").agg(F.count("*").alias("total"))
    ranked = numbered(base, "__s", "__u", ["__h", "doc_id", "size", "text_crc32"], "__r", strata)
    ranked = ranked.withColumn("__f", (F.col("__r") - phase) / F.col("total").cast("double")).drop("total")
    # (1 - u) / 1 may round to 1
    ranked = ranked.withColumn("__f", F.least("__f", F.lit(1 - 2.0**-53)))
    placed = numbered(ranked, None, "__f", ["__f", "__s", "__r"], "__p", docs.count())
    position = F.col("__p") - 1
    shard = F.expr(f"(__p - 1) * {int(shards)} div total")
    first = F.expr(f"(shard * total + {int(shards) - 1}) div {int(shards)}")
    return placed.withColumn("position", position).withColumn("shard", shard).select(
        "doc_id", "source", "size", "text_crc32", "position", F.col("shard").cast("int").alias("shard"), (F.col("position") - first).alias("slot")
    )
