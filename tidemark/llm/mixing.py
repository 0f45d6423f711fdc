"""Mixing sources to target weights by temperature.

A source's weight is its share of tokens raised to an exponent in [0, 1], normalised. The exponent is found by
bisection: the largest mixture entropy or the fewest repeats that are asked for. Weights become quotas of
tokens, and quotas become epochs: whole ones take every row of the source, a last partial one takes as much as is
left. Rows of a source are dealt into blocks; every epoch permutes the blocks, and the partial one takes them in its
order until the quota is spent, the last block row by row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Rows of a block, on average.
BLOCK = 2048
#: Exponents tried at once when a sum over sources is needed.
FAN = 32


def exponent_for_repeats(most: int, least: int, repeats: float) -> float:
    """The least exponent at which no source is repeated over `repeats` times when the largest is used once."""
    if repeats < 1:
        raise ValueError("repeats is 1 at least")
    low, high = 0.0, 1.0
    if most <= 0 or least <= 0 or (most / least) <= repeats:
        return 0.0
    for _ in range(60):
        mid = (low + high) / 2
        if (1 - mid) * math.log(most / least) > math.log(repeats):
            low = mid
        else:
            high = mid
    return high


def exponent_for_entropy(sources: DataFrame, total: int, entropy: float) -> float:
    """The largest exponent at which the mixture's entropy (nats) is at least `entropy`; 0 if none is.

    Sources stay where they are: each step sums FAN exponents at once, so six steps give 2 ** -30.
    """
    low, high = 0.0, 1.0
    share = F.log(F.col("tokens") / float(total))
    for _ in range(6):
        tried = [low + (high - low) * k / FAN for k in range(FAN + 1)]
        sums = []
        for k, a in enumerate(tried):
            sums += [F.sum(F.exp(a * share)).alias(f"z{k}"), F.sum(F.exp(a * share) * a * share).alias(f"e{k}")]
        row = sources.where("tokens > 0").agg(*sums).first()
        reached = [k for k in range(FAN + 1) if row[f"z{k}"] and math.log(row[f"z{k}"]) - row[f"e{k}"] / row[f"z{k}"] >= entropy - 1e-12]
        if not reached:
            return low
        if reached[-1] == FAN:
            return high
        low, high = tried[reached[-1]], tried[reached[-1] + 1]
    return low


def word_count(text: Column) -> Column:
    """Tokens of a text: its words between white space; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _own(row_id: Column, text: Column) -> Column:
    """A row's own 32 hexadecimal digits, from its id and text: rows without an id are not one place."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.coalesce(row_id.cast("string"), F.lit("")), F.crc32(text.cast("binary")), F.length(text)).cast("binary"))


def _block(own: Column, n: Column) -> Column:
    """The block that a row is dealt into, of a source of n rows."""
    return F.floor(F.conv(F.substring(own, 1, 13), 16, 10).cast("double") / float(1 << 52) * F.ceil(n / float(BLOCK)))


def _turn(seed: int, epoch: Column, key: Column, block: Column) -> Column:
    """A block's place in the permutation of an epoch, as 32 hexadecimal digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), block.cast("string"), key).cast("binary"))


def mixture(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    tokens: Column | None = None,
    repeats: float | None = None,
    entropy: float | None = None,
    budget: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows, quotas). quotas: source key, tokens, weight, quota, whole epochs, tokens left for a partial one.

    Without a budget the table is as large as it takes for every source to be used once at least: nothing
    is dropped, and small sources repeat. With one, it is the total number of tokens. A source without tokens costs nothing
    and is used once. rows holds key, own (a hash of id and text) and tokens of every document.
    """
    if (repeats is None) == (entropy is None):
        raise ValueError("either repeats or entropy is needed")
    key = F.concat(F.when(F.col(source_col).isNull(), F.lit("0")).otherwise("1"), F.coalesce(F.col(source_col).cast("string"), F.lit("")))
    rows = written(docs.select(key.alias("key"), _own(F.col(id_col), F.col(text_col)).alias("own"), (word_count(F.col(text_col)) if tokens is None else tokens).alias("tokens")))
    sources = written(rows.groupBy("key").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")))
    total, most, least = sources.where("tokens > 0").agg(F.sum("tokens"), F.max("tokens"), F.min("tokens")).first()
    total = total or 0
    power = exponent_for_repeats(most or 0, least or 0, repeats) if repeats is not None else exponent_for_entropy(sources, max(total, 1), entropy)
    raw = F.when(F.col("tokens") > 0, F.exp(power * F.log(F.col("tokens") / float(max(total, 1))))).otherwise(0.0)
    weighed = sources.withColumn("raw", raw)
    z = weighed.agg(F.sum("raw")).first()[0] or 1.0
    weighed = weighed.withColumn("weight", F.col("raw") / z).drop("raw")
    if budget is None:
        whole = weighed.where("weight > 0").agg(F.max(F.col("tokens") / F.col("weight"))).first()[0] or 0.0
    else:
        whole = float(budget)
    # a quota that comes to a whole number of epochs but for rounding is one
    quota = F.round(F.col("weight") * whole).cast("long")
    quotas = weighed.withColumn("quota", quota).withColumn("whole", F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens"))).otherwise(1))
    return rows, written(quotas.withColumn("left", F.col("quota") - F.col("whole") * F.col("tokens")))


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    tokens: Column | None = None,
    repeats: float | None = 1.25,
    entropy: float | None = None,
    budget: int | None = None,
    seed: int = 29,
    name: str = "mix",
) -> DataFrame:
    """docs' columns and one more, called name: struct<epoch int, block long, place string>, for every copy used.

    A block holds about BLOCK rows; place is the order within all of an epoch: the block's place in the epoch's
    permutation, then the row's in its block. Rows equal in id and text in one source are equally placed and cut
    together. A null source is a source; null texts have no tokens; long texts are counted whole. An empty table
    gives an empty one. An input column of that name is replaced.

    A partial epoch is cut exactly: sums over blocks find the block in which the quota ends, and running sums in
    this block find the last row. What joins with the table has one row for each source.
    """
    rows, quotas = mixture(docs, id_col=id_col, text_col=text_col, source_col=source_col, tokens=tokens, repeats=repeats, entropy=entropy, budget=budget)
    last = rows.join(quotas.where("left > 0").select("key", "n", "whole", "left"), "key").withColumn("block", _block(F.col("own"), F.col("n")))
    sums = last.groupBy("key", "block").agg(F.sum("tokens").alias("t"), F.first("left").alias("left"), F.first("whole").alias("whole"))
    sums = sums.withColumn("turn", _turn(seed, F.col("whole"), F.col("key"), F.col("block")))
    upto = Window.partitionBy("key").orderBy("turn", "block")
    before = F.coalesce(F.sum("t").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # the block in which the quota ends, if the sum of the blocks up to it exceeds it
    edge = written(sums.withColumn("before", before).where("before <= left and before + t > left").select("key", "block", "turn", "before"))
    running = F.sum("tokens").over(Window.partitionBy("key").orderBy("own").rangeBetween(Window.unboundedPreceding, 0))
    inside = last.join(edge, ["key", "block"]).withColumn("sum", F.col("before") + running).where("sum <= left")
    cut = inside.groupBy("key").agg(F.max("own").alias("cut_own"))
    plan = written(
        quotas.join(edge.select("key", F.col("block").alias("edge_block"), F.col("turn").alias("edge_turn")), "key", "left")
        .join(cut, "key", "left")
        .select(F.col("key").alias("__key"), "n", "whole", "left", "edge_block", "edge_turn", "cut_own")
    )
    key = F.concat(F.when(F.col(source_col).isNull(), F.lit("0")).otherwise("1"), F.coalesce(F.col(source_col).cast("string"), F.lit("")))
    kept = [c for c in docs.columns if c != name]
    wide = docs.select(F.struct(*kept).alias("__row"), key.alias("__key"), _own(F.col(id_col), F.col(text_col)).alias("__own")).join(plan, "__key")
    epochs = F.sequence(F.lit(0), F.when(F.col("left") > 0, F.col("whole")).otherwise(F.col("whole") - 1).cast("int"))
    wide = wide.where("whole > 0 or left > 0").withColumn("__block", _block(F.col("__own"), F.col("n"))).withColumn("__epoch", F.explode(epochs))
    wide = wide.withColumn("__turn", _turn(seed, F.col("__epoch"), F.col("__key"), F.col("__block")))
    taken = (
        (F.col("__epoch") < F.col("whole"))
        | F.col("edge_block").isNull()
        | (F.struct("__turn", "__block") < F.struct("edge_turn", "edge_block"))
        | ((F.col("__block") == F.col("edge_block")) & (F.col("__own") <= F.col("cut_own")))
    )
    place = F.concat("__turn", "__own")
    return wide.where(taken).select("__row.*", F.struct(F.col("__epoch").alias("epoch"), F.col("__block").alias("block"), place.alias("place")).alias(name))
