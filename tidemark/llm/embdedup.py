"""Embedding near-dedup by an epsilon grid order join.

Vectors of unit length with cosine c are sqrt(2 - 2c) apart, and no further in any projection. They are
projected on their leading principal dimensions, sorted by the cells of a grid of that width, and cut into
intervals. Intervals join if their boxes are near enough; inside a pair, intervals are halved recursively
and halves that are provably distant are skipped; what remains is compared exactly in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_rows, components, scratch, written
from tidemark.llm.topk import usable

#: Leading principal dimensions kept, and those whose cells pair intervals.
DIMS, KEYED = 12, 3
#: Bytes of components in an interval, about; rows compared at once.
BLOCK_BYTES, LEAF = 1 << 20, 256
#: Least width of the cells that pair intervals: coordinates are within 1 of 0, so a box is in 18 ** KEYED cells at most.
STEP = 0.125
#: Longer vectors are first projected on this many fixed random directions.
WIDE = 256


def unit(data: np.ndarray, dim: int) -> np.ndarray:
    """Rows scaled to length 1 in double precision, without overflow."""
    x = np.asarray(data, np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _narrow(x: np.ndarray) -> np.ndarray:
    """Vectors of more than WIDE dimensions on orthonormal directions, which brings none further apart."""
    if x.shape[1] <= WIDE:
        return x
    q, _ = np.linalg.qr(np.random.default_rng(x.shape[1]).standard_normal((x.shape[1], WIDE)))
    return x @ q


def _rows(lists: pa.Array, dim: int) -> np.ndarray:
    return unit(np.asarray(lists.flatten()), dim)


def principal(rows: DataFrame, dim: int) -> np.ndarray:
    """The leading principal directions of all rows: sums of products are added up on the executors."""
    width = min(dim, WIDE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            if batch.num_rows:
                x = _narrow(_rows(batch.column(0), dim))
                x = np.hstack((np.ones((len(x), 1)), x))
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["cell", "x"])

    total = np.zeros((width + 1) ** 2)
    for cell, x in rows.select("v").mapInArrow(run, "cell long, x double").groupBy("cell").agg(F.sum("x").alias("x")).collect():
        total[cell] = x
    total = total.reshape(width + 1, width + 1)
    n = max(total[0, 0], 1.0)
    mean = total[0, 1:] / n
    _, vectors = np.linalg.eigh(total[1:, 1:] / n - np.outer(mean, mean))
    return np.ascontiguousarray(vectors[:, ::-1][:, : min(DIMS, width)])


def _labels(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least node that each of n nodes is joined with by the edges u, v."""
    out = np.arange(n)
    while True:
        low = np.minimum(out[u], out[v])
        if (low == out[u]).all() and (low == out[v]).all():
            return out
        for side in (u, v):
            np.minimum.at(out, out[side], low)
            np.minimum.at(out, side, low)
        out = out[out]


class Pair:
    """Two intervals, or one with itself, compared recursively."""

    def __init__(self, a: dict, b: dict, same: bool, least: float, epsilon: float):
        self.a, self.b, self.same, self.least, self.epsilon = a, b, same, least, epsilon
        self.links = [np.zeros(len(a["id"]), np.int64), np.zeros(len(b["id"]), np.int64)]
        self.u: list[np.ndarray] = []
        self.v: list[np.ndarray] = []
        self._join(0, len(a["id"]), 0, len(b["id"]))

    def _join(self, i: int, j: int, k: int, m: int) -> None:
        if self.same and k < i or j <= i or m <= k:
            return  # the mirrored half is compared
        a, b = self.a["y"][i:j], self.b["y"][k:m]
        gap = np.maximum(0.0, np.maximum(a.min(axis=0) - b.max(axis=0), b.min(axis=0) - a.max(axis=0)))
        if gap @ gap > self.epsilon**2:
            return
        if max(j - i, m - k) <= LEAF:
            return self._compare(i, j, k, m)
        p, q = (i + j) // 2 if j - i > LEAF else j, (k + m) // 2 if m - k > LEAF else m
        for x in ((i, p), (p, j)):
            for y in ((k, q), (q, m)):
                self._join(*x, *y)

    def _compare(self, i: int, j: int, k: int, m: int) -> None:
        near = self.a["x"][i:j] @ self.b["x"][k:m].T >= self.least
        if self.same and i == k:
            np.fill_diagonal(near, False)
        r, c = near.any(axis=1), near.any(axis=0)
        if not r.any():
            return
        self.links[0][i:j] += near @ self.b["n"][k:m]
        if not (self.same and i == k):
            self.links[1][k:m] += near.T @ self.a["n"][i:j]
        # a spanning set of the links: least linked partners, until each tree is one
        rows, cols = np.flatnonzero(r), np.flatnonzero(c)
        small = near[np.ix_(rows, cols)]
        lr, lc = np.arange(len(rows)), np.full(len(cols), len(rows))
        while True:
            new_c = np.minimum(lc, np.where(small, lr[:, None], len(rows)).min(axis=0))
            new_r = np.minimum(lr, np.where(small, new_c[None, :], len(rows)).min(axis=1))
            if (new_c == lc).all() and (new_r == lr).all():
                break
            lr, lc = new_r, new_c
        base = 0 if self.same else len(self.a["id"])
        root = rows[lr] + i
        self.u += [rows + i, cols + k + base]
        self.v += [root, rows[lc] + i]

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(id, links, the least id that the links reach) of the vectors with links."""
        if self.same:
            ids, links = self.a["id"], self.links[0] + self.links[1]
        else:
            ids, links = np.concatenate((self.a["id"], self.b["id"])), np.concatenate(self.links)
        if not self.u:
            return ids[:0], links[:0], ids[:0]
        order = np.argsort(ids, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        label = _labels(len(ids), place[np.concatenate(self.u)], place[np.concatenate(self.v)])
        to = ids[order][label][place]
        on = links > 0
        return ids[on], links[on], to[on]


def _block(ids: pa.Scalar, counts: pa.Scalar, data: pa.Scalar, dim: int, axes: np.ndarray) -> dict:
    x = unit(np.asarray(data.values), dim)
    return {"id": np.asarray(ids.values, np.int64), "n": np.asarray(counts.values, np.int64), "x": x, "y": _narrow(x) @ axes}


def near_vectors(vectors: DataFrame, least: float = 0.95, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Two vectors link if their cosine is at least `least`. Vectors that are null, empty or zero, or hold null or
    non-finite components, link with nothing, nor do vectors of different lengths. Rows with equal
    components are compared as one and count as many. A row that repeats an id is a vector of its own, with its own
    links; component_id is the least id that a row's links reach. Rows without an id link with nothing. An empty
    table has no results; other columns are not read.
    """
    spark = vectors.sparkSession
    with scratch(spark):
        base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
        fit = usable(F.col("v")) & F.col("id").isNotNull() & F.exists("v", lambda x: x != 0)
        # -0.0 and 0.0 are one component
        base = base.withColumn("ok", F.coalesce(fit, F.lit(False))).withColumn("v", F.when(F.col("ok"), F.transform("v", lambda x: x + F.lit(0).cast("float"))))
        keyed = written(base.select("id", "ok", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"), F.size("v").alias("dim")))
        # vectors are known by a number of their own, as one id can have several
        single = keyed.where("ok").groupBy("dim", "h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.min_by("v", "id").alias("v"))
        classes = written(single.select(F.monotonically_increasing_id().alias("id"), "dim", "h1", "h2", "rep", "n", "v"))
        epsilon = float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-6
        found = None
        for dim, count in sorted((r["dim"], r["c"]) for r in classes.groupBy("dim").agg(F.count("*").alias("c")).collect()):
            part = _linked(classes.where(F.col("dim") == dim), dim, count, least, epsilon)
            found = part if found is None else found.unionByName(part)
        if found is None:
            found = spark.createDataFrame([], "id long, links long, to long")
        with arrow_rows(spark, 8):  # a row holds two intervals
            found = written(found)
        labels = components(found.where("id != to").select(F.col("id").alias("a"), F.col("to").alias("b")))
        links = found.groupBy("id").agg(F.sum("links").alias("links"))
        named = written(
            classes.select("id", "dim", "h1", "h2", "rep", "n").join(links, "id", "left").join(labels, "id", "left")
            .select(F.col("dim").alias("cd"), F.col("h1").alias("c1"), F.col("h2").alias("c2"), "rep", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "id").alias("c"))
        )
        named = named.join(named.groupBy("c").agg(F.min("rep").alias("of")), "c").drop("c", "rep")
        own = F.coalesce("of", "id")
        done = keyed.select("id", "ok", "dim", "h1", "h2").join(
            named, F.col("ok") & (F.col("dim") == F.col("cd")) & (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")), "left"
        ).select(F.col("id").alias("vec_id"), F.coalesce("links", F.lit(0)).alias("n_links"), own.alias("component_id"), F.coalesce(F.col("id") == own, F.lit(True)).alias("kept"))
        return written(done, outlives=True)


def _linked(classes: DataFrame, dim: int, count: int, least: float, epsilon: float) -> DataFrame:
    """(id, links, to) of the classes of one length: link counts by part, and spanning links."""
    axes = principal(classes, dim)
    sizes = max(LEAF, BLOCK_BYTES // (4 * dim))
    blocks = max(1, -(-count // sizes))
    k = axes.shape[1]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                y = _narrow(_rows(batch.column(2), dim)) @ axes
                lists = pa.ListArray.from_arrays(np.arange(0, y.size + 1, k, dtype=np.int32), y.ravel())
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["id", "n", "v", "y"])

    kind = classes.schema["v"].dataType.simpleString()
    placed = classes.select("id", "n", "v").mapInArrow(project, f"id long, n long, v {kind}, y array<double>")
    cell = F.transform("y", lambda y: F.floor(y / epsilon))
    placed = written(placed.withColumn("cell", cell))
    # the sequence in grid order; an id ends the key, so that one cell can fill many intervals
    ordered = placed.repartitionByRange(blocks, "cell", "y", "id").sortWithinPartitions("cell", "y", "id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(rows).combine_chunks()
            for low in range(0, len(table), sizes):
                t = table.slice(low, sizes)
                y = np.asarray(t["y"].combine_chunks().flatten()).reshape(-1, k)
                lists = [pa.array([t[c].to_pylist()]) if c != "v" else pa.ListArray.from_arrays([0, len(t) * dim], t["v"].combine_chunks().flatten()) for c in ("id", "n", "v")]
                yield pa.RecordBatch.from_arrays([pa.array([t["id"][0].as_py()]), *lists, pa.array([y.min(axis=0).tolist()]), pa.array([y.max(axis=0).tolist()])], names=["block", "ids", "counts", "data", "low", "high"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= sizes:
                full = pa.Table.from_batches(held).combine_chunks()
                yield from out(full.slice(0, sizes).to_batches())
                held = full.slice(sizes).to_batches()
        if any(b.num_rows for b in held):
            yield from out(held)

    packs = written(ordered.mapInArrow(pack, f"block long, ids array<long>, counts array<long>, data {kind}, low array<double>, high array<double>"))
    boxes = packs.select("block", "low", "high")
    keyed = range(min(KEYED, k))
    # any grid at least epsilon wide will do; a finer one than STEP would only name more cells for a box
    step = max(epsilon, STEP)
    spans = lambda by: [F.sequence(F.floor(F.col("low")[d] / step) - by, F.floor(F.col("high")[d] / step) + by) for d in keyed]

    def spread(by: int, prefix: str) -> DataFrame:
        df = boxes
        for d, span in zip(keyed, spans(by), strict=True):
            df = df.withColumn(f"k{d}", F.explode(span))
        return df.select(F.col("block").alias(prefix), F.col("low").alias(f"{prefix}l"), F.col("high").alias(f"{prefix}h"), *[f"k{d}" for d in keyed])

    def far(i: int):
        return F.greatest(F.lit(0.0), F.col("al")[i] - F.col("bh")[i], F.col("bl")[i] - F.col("ah")[i])

    apart = sum((far(i) * far(i) for i in range(1, k)), far(0) * far(0))
    pairs = written(
        spread(0, "a").join(spread(1, "b"), [f"k{d}" for d in keyed]).where("a <= b").where(apart <= epsilon * epsilon).select("a", "b").distinct()
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, *sides in zip(*batch.columns, strict=True):
                same = a.as_py() == b.as_py()
                one = _block(*sides[:3], dim, axes)
                two = one if same else _block(*sides[3:], dim, axes)
                columns = Pair(one, two, same, least, epsilon).result()
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "links", "to"])

    side = lambda x: packs.select(F.col("block").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ("ids", "counts", "data")])
    met = pairs.repartition(max(1, min(2 * blocks, 4096))).join(side("a"), "a").join(side("b"), "b")
    return met.select("a", "b", *[f"{x}_{c}" for x in "ab" for c in ("ids", "counts", "data")]).mapInArrow(run, "id long, links long, to long")
