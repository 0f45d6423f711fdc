"""MinHash near-dedup with tensored banding.

Two collections of HALVES short MinHash keys each are computed per shingle set. A table of the index is keyed
by a pair (i, j), one key from each collection, so HALVES ** 2 tables cost only 2 * HALVES * WIDTH MinHash
values. Sets meet in a table when both keys agree; what meets is verified on the full sets.

A set pair of similarity s agrees in one key with probability s ** WIDTH, and is found with probability
(1 - (1 - s ** WIDTH) ** HALVES) ** 2: 0.9991 at 0.75, more above. Before it is verified, a pair's values are
compared by 16 bits each, and it goes if more differ than in any but one of 20,000 pairs of similarity 0.75.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import merged, scratch, written
from tidemark.llm.textbuf import flat, pieces

WORDS = 5
HALVES = 14
WIDTH = 3
#: Tables (i, i) that are tried first; all of these are tried before all pairs of keys are.
FIRST = 2
#: Heads of a bucket up to each of the rounds before all that is left is decided, about.
HEADS = (2, 16, 128)
#: Bits of a set's map. What one map has and another lacks bounds an intersection.
MAP_BITS = 2048

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two rounds of xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
_STEP = np.uint64(0xA0761D6478BD642F)


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.empty(n + 1, np.uint64)
    out[0] = 1
    out[1:] = base
    return np.multiply.accumulate(out, out=out)


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """For each text (nulls are empty) the sorted distinct 64-bit hashes of its word shingles."""
    texts = texts.fill_null("")
    inverse = np.uint64(pow(int(_STEP), -1, 1 << 64))
    for start, end in pieces(texts):
        raw, offsets = flat(texts.slice(start, end - start))
        low = _LOWER[raw]
        solid = ~_SPACE[low]
        edge = np.diff(np.concatenate(([False], solid, [False])).astype(np.int8))
        if len(offsets) > 2:  # a word never crosses a text's end
            inner = offsets[1:-1]
            inner = inner[(inner > 0) & (inner < len(raw))]
            cut = np.unique(inner[solid[inner - 1] & solid[inner]])
        else:
            cut = np.empty(0, np.int64)
        begins = np.sort(np.concatenate((np.flatnonzero(edge == 1), cut)))
        ends = np.sort(np.concatenate((np.flatnonzero(edge == -1), cut)))
        with np.errstate(over="ignore"):
            # H(word) = sum byte_k * step^k, read off prefix sums and shifted back by the inverse's power
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[low] * _powers(max(len(low) - 1, 0), _STEP)[: len(low)], dtype=np.uint64)))
            back = _powers(len(low), inverse)
            word = mixed((total[ends] - total[begins]) * back[begins] + (ends - begins).astype(np.uint64) * _ODD)
            first = np.searchsorted(begins, offsets)
            joint = _powers(words, np.uint64(0x8EBC6AF09C88C6E3))
            rolled = np.zeros(max(len(word) - words + 1, 0), np.uint64)
            for k in range(words):
                rolled += word[k : k + len(rolled)] * joint[k]
            rolled = mixed(rolled)
            for d in range(end - start):
                a, b = int(first[d]), int(first[d + 1])
                if b - a >= words:
                    yield np.unique(rolled[a : b - words + 1])
                elif b > a:
                    short = np.uint64(b - a) * _ODD + (word[a:b] * joint[: b - a]).sum(dtype=np.uint64)
                    yield mixed(np.array([short], np.uint64))
                else:
                    yield np.empty(0, np.uint64)


@lru_cache(8)
def _family(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    state = np.random.default_rng(seed)
    odd = state.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, state.integers(0, 1 << 63, count, dtype=np.uint64)


def values(hashes: np.ndarray, halves: int, width: int, seed: int) -> np.ndarray:
    """The 2 * halves * width MinHash values of a set."""
    odd, add = _family(2 * halves * width, seed)
    low = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        # the hashes are mixed already, so a multiplication and an addition make a family of orders
        room = np.empty((min(len(hashes), 512), len(odd)), np.uint64)
        for k in range(0, len(hashes), 512):
            own = hashes[k : k + 512, None]
            part = np.multiply(own, odd, out=room[: len(own)])
            part += add
            np.minimum(low, np.minimum.reduce(part, axis=0), out=low)
        return mixed(low)


def short_keys(low: np.ndarray) -> np.ndarray:
    """Keys of WIDTH values by 16 bits each, of any number of sets at once; the first half is the first collection."""
    lanes = (low & np.uint64(0xFFFF)).reshape(len(low), -1, WIDTH)
    return (lanes << (np.arange(WIDTH, dtype=np.uint64) * np.uint64(16))).sum(axis=2, dtype=np.uint64)


def unlike(a: str, b: str, count: int) -> Column:
    """In how many values the keys a and b, columns of count numbers, differ."""
    low, top = 0x7FFF7FFF7FFF, 0x800080008000
    total = F.lit(0)
    for k in range(count):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        total = total + F.bit_count((x.bitwiseAND(F.lit(low)) + F.lit(low)).bitwiseOR(x).bitwiseAND(F.lit(top)))
    return total


def most_unlike(values: int, share: float) -> int:
    """Differing values allowed to a pair of similarity `share`: the mean and four standard deviations."""
    return int(values * (1 - share) + 4 * (values * share * (1 - share)) ** 0.5)


_SIGNATURE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("h", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("s1", T.LongType()),
        T.StructField("s2", T.LongType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
    ]
)


def signatures(docs: DataFrame, words: int, halves: int, seed: int) -> DataFrame:
    """(doc_id, h, n, s1, s2, keys) of docs (doc_id, h, text): set size, a 128-bit digest of the set, the keys of both collections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, s1, s2, lows = [], [], [], []
            for own in shingle_sets(batch.column(2), words):
                n.append(len(own))
                with np.errstate(over="ignore"):
                    s1.append(own.sum(dtype=np.uint64))
                    s2.append(mixed(own * _STEP).sum(dtype=np.uint64))
                lows.append(values(own, halves, WIDTH, seed))
            keys = short_keys(np.array(lows, np.uint64).reshape(-1, 2 * halves * WIDTH))
            lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, 2 * halves, dtype=np.int32), np.ascontiguousarray(keys).view(np.int64).ravel())
            digests = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (s1, s2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), *digests, lists], names=[f.name for f in _SIGNATURE])

    return docs.mapInArrow(run, _SIGNATURE)


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """For each set the MAP_BITS bits that its hashes name, in 64-bit numbers."""
    out = np.zeros((len(sets), MAP_BITS), np.uint8)
    for k, own in enumerate(sets):
        out[k, own & np.uint64(MAP_BITS - 1)] = 1
    return np.packbits(out, axis=1, bitorder="little").view(np.int64)


def shingle_table(docs: DataFrame, words: int) -> DataFrame:
    """(id, shingles, bits) of docs (id, text): the full sets, as sorted arrays, and their bitmaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in pieces(batch.column(1), 1 << 22):
                part = batch.slice(start, end - start)
                sets = list(shingle_sets(part.column(1), words))
                ends = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32)
                values = np.concatenate(sets) if sets else np.empty(0, np.uint64)
                bits = bitmaps(sets)
                maps = pa.ListArray.from_arrays(np.arange(0, bits.size + 1, MAP_BITS // 64, dtype=np.int32), bits.ravel())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(ends, values.view(np.int64)), maps], names=["id", "shingles", "bits"])

    return docs.mapInArrow(run, "id long, shingles array<long>, bits array<long>")


def _place(class_id: Column) -> Column:
    """A class's place in the order of all, from 0 to 2 ** 40."""
    return F.pmod(F.xxhash64(class_id, F.lit(1)), F.lit(1 << 40))


class _Links:
    """Links between classes (id, n, keys), found table by table and joined into components.

    A class is live while a key of each collection is shared with a class of another component: only then can
    a table bring it to a link that matters.
    """

    def __init__(self, classes: DataFrame, texts: DataFrame, words: int, percent: int, halves: int):
        """classes also has `at`, the h and doc_id of a row of texts (doc_id, h, text) that has the set."""
        self.percent, self.halves = percent, halves
        self.labels: DataFrame | None = None
        self.tested: DataFrame | None = None
        live = self._shared(classes.select("id", "n", "keys", F.col("n").alias("most"), F.col("at.h").alias("at_h"), F.col("at.doc_id").alias("at_id")))
        at = live.select("id", "at_h", "at_id")
        wanted = texts.join(at, (F.col("h") == F.col("at_h")) & F.col("doc_id").eqNullSafe(F.col("at_id")))
        # rows that repeat id and text are one
        self.sets = written(shingle_table(wanted.select("id", "text").dropDuplicates(["id"]), words))
        self.live = written(live.drop("at_h", "at_id").join(self.sets.select("id", "bits"), "id"))

    def _named(self, rows: DataFrame) -> DataFrame:
        """rows with c, the component of their id."""
        if self.labels is None:
            return rows.withColumn("c", F.col("id"))
        return rows.join(self.labels.withColumnRenamed("component", "__c"), "id", "left").withColumn("c", F.coalesce("__c", "id")).drop("__c")

    def _shared(self, rows: DataFrame) -> DataFrame:
        """The rows (id, n, keys, ...) that are live, with mask, the keys they share, and least, a bound below the sizes there."""
        keyed = self._named(rows.select("id", "n", "keys")).select("id", "n", "c", F.posexplode("keys").alias("k", "key"))
        open_ = keyed.groupBy("k", "key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("n").alias("least")).where("lo < hi").select("k", "key", "least")
        masks = (
            keyed.select("id", "k", "key")
            .join(open_, ["k", "key"])
            .groupBy("id")
            .agg(F.bit_or(F.expr("shiftleft(1L, k)")).alias("mask"), F.min("least").alias("least"))
            .where(f"mask % {1 << self.halves} > 0 and shiftright(mask, {self.halves}) > 0")
        )
        return written(rows.drop("mask", "least").join(masks, "id"))

    def retire(self) -> None:
        """Drops live classes that provably have no link outside their component.

        A shingle that no other live class has is in no intersection. `most`, the count of the others, bounds
        the intersection with any partner, and a link needs percent / (100 + percent) of both sizes in common.
        """
        self.live = self._shared(self.live)
        single = (
            self.sets.join(self.live.select("id"), "id", "left_semi")
            .select("id", F.explode("shingles").alias("s"))
            .groupBy("s")
            .agg(F.min("id").alias("id"), F.max("id").alias("to"))
            .where("id = to")
            .groupBy("id")
            .agg(F.count("*").alias("own"))
        )
        p = self.percent
        counted = self.live.join(single, "id", "left").withColumn("most", F.col("n") - F.coalesce("own", F.lit(0))).drop("own")
        least = F.greatest(F.col("least"), F.ceil(F.col("n") * p / 100))
        self.live = self._shared(written(counted.where((100 + p) * F.col("most") >= p * (F.col("n") + least))))

    def _tables(self, tables: list[tuple[int, int]]) -> tuple[Column, Callable[[Column], Column]]:
        """(the numbers of those tables that a live class may meet another component in, the bucket in table t)."""
        numbers = F.array(*[F.lit(i * self.halves + j) for i, j in tables])
        one, two = lambda t: F.floor(t / self.halves).cast("int"), lambda t: self.halves + t % self.halves
        on = F.filter(numbers, lambda t: (F.getbit("mask", one(t)) > 0) & (F.getbit("mask", two(t)) > 0))
        return on, lambda t: F.xxhash64(t, F.col("keys")[one(t)], F.col("keys")[two(t)])

    def stars(self, tables: list[tuple[int, int]], heads: tuple[int, ...]) -> None:
        """Tries tables in rounds: a bucket that spans several components holds all its classes against about so many of them.

        That joins most of a large group by a few pairs for each class, whose order is one in all tables. A pair is
        tested in the first table that it meets in, when the class that comes first is a head.
        """
        on, bucket = self._tables(tables)
        slim = self._named(self.live.select("id", "keys", F.explode(on).alias("t"))).select(bucket(F.col("t")).alias("bucket"), "t", "id", "c")
        held = slim.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("m")).where("lo < hi").select("bucket", "m")
        members = written(slim.join(held, "bucket").select("bucket", "t", "id", "m"))
        for low, high in zip((0, *heads), heads, strict=False):
            if members.isEmpty():
                return
            rows = self._named(members.join(self.live, "id")).withColumn("u", _place(F.col("id"))).withColumn("head", F.lit(True))
            at = F.col("u") * F.col("m") / float(1 << 40)
            if self._decide(self._met(rows.where((at >= low) & (at < high)), rows, tables)):
                members = self._open(members)

    def finish(self) -> None:
        """Decides all pairs of different components that any of all tables (i, j) brings together.

        In a bucket of a first key, classes of one component may be left to the others: that which has most of it.
        Classes that are so left in all their buckets are of one component wherever they meet; all others are heads, and
        held against every class they meet.
        """
        tables = [(i, j) for i in range(self.halves) for j in range(self.halves)]
        firsts = self._named(self.live.select("id", "keys")).select("id", "c", F.posexplode(F.slice("keys", 1, self.halves)).alias("k", "key"))
        top = firsts.groupBy("k", "key", "c").agg(F.count("*").alias("m")).groupBy("k", "key").agg(F.max(F.struct("m", "c")).alias("top"))
        heads = firsts.join(top.select("k", "key", F.col("top.c").alias("top")), ["k", "key"]).where("c != top").select("id", F.lit(True).alias("head")).distinct()
        rows = self._named(self.live.join(heads, "id", "left")).withColumn("u", _place(F.col("id"))).withColumn("head", F.coalesce("head", F.lit(False)))
        # every class becomes a row for each of its tables, so classes are dealt evenly first
        rows = written(rows).hint("rebalance")
        on, bucket = self._tables(tables)
        left = rows.where("head").withColumn("t", F.explode(on)).withColumn("bucket", bucket(F.col("t")))
        right = rows.withColumn("bucket", F.explode(F.transform(on, bucket)))
        self._decide(self._met(left, right, tables))

    def _open(self, members: DataFrame) -> DataFrame:
        """The members of buckets that still span several components."""
        spans = self._named(members.select("bucket", "id")).groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
        return written(members.join(spans.select("bucket"), "bucket", "left_semi"))

    def _met(self, heads: DataFrame, rows: DataFrame, tables: list[tuple[int, int]]) -> DataFrame:
        """Pairs (a, b, na, nb) of a head and another class of its bucket that sizes, keys and bitmaps do not rule out."""
        h, p = self.halves, self.percent
        columns = ("id", "u", "n", "most", "c", "keys", "bits")
        left = heads.select("bucket", "t", *[F.col(c).alias(f"{c}_a") for c in columns])
        right = rows.select("bucket", "head", *[F.col(c).alias(f"{c}_b") for c in columns])
        agree = lambda k: F.col("keys_a")[k] == F.col("keys_b")[k]
        first = F.lit(True)
        if len(tables) == h * h:
            for k in range(h):
                first = first & ((F.floor(F.col("t") / h) <= k) | ~agree(k)) & ((F.col("t") % h <= k) | ~agree(h + k))
        else:
            for i, j in tables:
                first = first & ((F.col("t") <= i * h + j) | ~(agree(i) & agree(j + h)))
        enough = lambda most: (100 + p) * most >= p * (F.col("n_a") + F.col("n_b"))
        fits = (100 * F.least("n_a", "n_b") >= p * F.greatest("n_a", "n_b")) & enough(F.least("most_a", "most_b"))
        ahead = (F.col("u_a") < F.col("u_b")) | ((F.col("u_a") == F.col("u_b")) & (F.col("id_a") < F.col("id_b")))
        # a pair of two heads comes up from one side, one with another class from its head's
        side = ~F.col("head") | ahead
        alike = unlike("keys_a", "keys_b", 2 * h) <= most_unlike(2 * h * WIDTH, p / 100)
        lack = lambda x, y: sum((F.bit_count(F.col(x)[k].bitwiseAND(F.bitwise_not(F.col(y)[k]))) for k in range(1, MAP_BITS // 64)), F.bit_count(F.col(x)[0].bitwiseAND(F.bitwise_not(F.col(y)[0]))))
        dense = enough(F.col("n_a") - lack("bits_a", "bits_b")) & enough(F.col("n_b") - lack("bits_b", "bits_a"))
        met = left.join(right, "bucket").where((F.col("c_a") != F.col("c_b")) & side & fits & first & alike & dense)
        a_first = F.col("id_a") < F.col("id_b")
        pairs = met.select(*[F.when(a_first, F.col(f"{c}_{x}")).otherwise(F.col(f"{c}_{y}")).alias(n) for c, x, y, n in (("id", "a", "b", "a"), ("id", "b", "a", "b"), ("n", "a", "b", "na"), ("n", "b", "a", "nb"))])
        return pairs if self.tested is None else pairs.join(self.tested, ["a", "b"], "left_anti")

    def _decide(self, pairs: DataFrame) -> bool:
        """Verifies pairs on the full sets and joins components by the links; whether there are any."""
        pairs = written(pairs)
        side = lambda x, y: self.sets.select(F.col("id").alias(x), F.col("shingles").alias(y))
        both = F.size(F.array_intersect("x", "y"))
        sure = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").withColumn("both", both)
        sure = written(sure.where(100 * F.col("both") >= self.percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b"))
        self.tested = pairs.select("a", "b") if self.tested is None else self.tested.unionByName(pairs.select("a", "b"))
        if sure.isEmpty():
            return False
        self.labels = merged(self.labels, sure)
        return True


def grouped(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = 75, halves: int = HALVES, seed: int = 5) -> DataFrame:
    """(doc_id, h, n, component_id, group) for every row of docs; h is xxhash64 of the text.

    Rows of one group are linked; group is null for rows without shingles. component_id is the least id of the group.
    """
    spark = docs.sparkSession
    with scratch(spark):
        text = F.col(text_col)
        base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
        sig = written(signatures(base, words, halves, seed))
        # a set's class is known by a number of its own, as one id can have several texts
        sets = sig.where("n > 0").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"), F.min(F.struct("h", "doc_id")).alias("at"), F.any_value("keys").alias("keys"))
        classes = written(sets.select(F.monotonically_increasing_id().alias("id"), "s1", "s2", "n", "rep", "at", "keys"))
        links = _Links(classes.select("id", "n", "keys", "at"), base, words, percent, halves)
        diagonal = [(k, k) for k in range(halves)]
        links.stars(diagonal[:FIRST], HEADS[:1])
        links.stars(diagonal[FIRST:], HEADS)
        links.retire()
        links.finish()
        named = written(links._named(classes.select("id", "s1", "s2", "n", "rep")))
        least = named.groupBy("c").agg(F.min("rep").alias("of"))
        named = named.join(least, "c").select(F.col("s1").alias("c1"), F.col("s2").alias("c2"), F.col("n").alias("cn"), "of", "c")
        found = sig.select("doc_id", "h", "n", "s1", "s2").join(named, (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")) & (F.col("n") == F.col("cn")), "left")
        own = F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("of"))
        return written(found.select("doc_id", "h", "n", own.alias("component_id"), F.col("c").alias("group")), outlives=True)


def near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs. how: the options of grouped().

    A row's set holds its distinct word shingles; a text with fewer words is one shingle; a null or empty
    text, or one of white space, has no shingle and links with nothing. Texts are read whole, however long. Rows
    with equal sets form a class; classes that meet in a table are linked if 100 * |intersection| >= percent *
    |union| on the full sets; a component is what links reach, and its id the least doc_id there. A row that
    repeats an id is a document of its own, with a result row of its own; equal rows have equal results. An id
    with several texts belongs to the component of each. Rows without an id are linked like others; a
    component of such rows only has a null id, and all its rows are kept. An empty table gives an empty result. Other
    columns of docs are not read, whatever their names.

    Large buckets: what a round compares grows with a bucket's classes times its heads. Buckets within one
    component are closed, and classes that provably link with nothing else are retired, so that a large group
    of copies takes few heads. No bucket is capped: in the end all pairs of different components are decided.
    """
    own = F.col("component_id")
    return grouped(docs, **how).select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == own, own.isNull()).alias("kept"))


def representatives(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of docs that stay: one of each group of near-duplicates, the one with the least id (any, without ids).

    Rows without shingles link with nothing and all stay, but for rows with an id that repeat id and text. An empty
    table gives an empty one. Columns keep their names and order, whatever they are.
    """
    spark = docs.sparkSession
    with scratch(spark):
        found = grouped(docs, id_col=id_col, text_col=text_col, **how)
        rows = written(found.groupBy("doc_id", "h").agg(F.count("*").alias("times"), F.any_value("group").alias("group")))
        least = rows.where("group is not null").groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("r"))
        stays = F.col("group").isNull() | (F.col("doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("h") == F.col("r.h")))
        again = (F.col("times") > 1) & (F.col("group").isNotNull() | F.col("doc_id").isNotNull())
        named = rows.join(least, "group", "left").select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), stays.alias("stays"), again.alias("again"))
        plan = written(named.where("not stays or again"), outlives=True)
    same = lambda: docs[id_col].cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text_col]) == F.col("__h"))
    rest = docs.join(plan, same(), "left_anti")
    # of rows that repeat an id and text one stays; they are few as a rule, and only they are compared
    return rest.unionByName(docs.join(plan.where("stays and again"), same(), "left_semi").dropDuplicates([id_col, text_col]))
