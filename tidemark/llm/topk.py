"""Exact top-k inner products over vector-approximation files.

Every component becomes the number of the cell it lies in, one byte, on a grid of CELLS equal intervals between
the least and the largest value of its dimension. These cells are the approximation file. It is scanned in blocks:
cell centres and widths bound every score, and a block passes on only what can be among its best. Over all
blocks the kth largest lower bound of a query then leaves few candidates; their exact vectors are read in the order
of their upper bounds, the first ones at once, and of the rest only those that the kth exact score does not exclude.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_rows, scratch, written

CELLS = 256
#: Bytes of cells in a block of candidates, about, and queries in a block.
BLOCK_BYTES, BLOCK_QUERIES = 1 << 20, 512
#: Candidates whose bounds are worked out at once.
CHUNK = 4096
SCALE = 1024.0


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    whole = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & whole, F.lit(False))


def scaled(lists: pa.Array, dim: int) -> np.ndarray:
    """floor(SCALE * component) of vectors of one length, as doubles."""
    return np.floor(SCALE * np.asarray(lists.flatten(), np.float64).reshape(-1, dim))


class Grid:
    """The cells of vectors of one length: low and width of each dimension."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        with np.errstate(over="ignore", invalid="ignore"):
            width = high / CELLS - low / CELLS
        # cells are a little wider than they need be, so that rounding leaves no value outside its own
        self.low, self.width = low, np.maximum(width * (1 + 1e-9), np.maximum(np.abs(low), np.abs(high)) * 1e-12 + 1e-9)

    def cells(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.floor(x / self.width - self.low / self.width), 0, CELLS - 1).astype(np.uint8)

    def bounds(self, q: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) bounds of the scores of queries (rows) and candidates (columns)."""
        with np.errstate(over="ignore", invalid="ignore"):
            centre = self.low + (cells + 0.5) * self.width
            estimate = q @ centre.T
            reach = np.abs(q) @ np.maximum(np.abs(self.low), np.abs(self.low + CELLS * self.width))
            # half a cell, and what sums in double precision may be off
            slack = (np.abs(q) @ self.width * (0.5 + 1e-6) + 1e-9 * reach + 1e-6)[:, None]
            low, high = estimate - slack, estimate + slack
        return np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high)


def grids(rows: DataFrame) -> dict[int, Grid]:
    """The grid of every length of vectors, from all rows (v): one row for each dimension reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            dims = np.asarray(pa.compute.list_value_length(batch.column(0)))
            for dim in np.unique(dims).tolist():
                x = scaled(batch.column(0).filter(pa.array(dims == dim)), dim)
                low, high = found.get(dim, (np.full(dim, np.inf), np.full(dim, -np.inf)))
                found[dim] = (np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0)))
        for dim, (low, high) in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim] * dim), pa.array(np.arange(dim)), pa.array(low), pa.array(high)], names=["dim", "k", "low", "high"])

    sums = rows.select("v").mapInArrow(run, "dim long, k long, low double, high double").groupBy("dim", "k").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    sides: dict[int, list] = {}
    for r in sums.collect():
        sides.setdefault(r.dim, []).append((r.k, r.low, r.high))
    return {dim: Grid(*np.array([x[1:] for x in sorted(own)]).T) for dim, own in sides.items()}


def exact(x: np.ndarray, y: np.ndarray) -> list[int]:
    """Inner products of rows of whole numbers, without rounding, kept within 64 bits."""
    with np.errstate(over="ignore"):
        most = np.abs(x).max(axis=1, initial=0) * np.abs(y).max(axis=1, initial=0) * x.shape[1]
    plain = most < 2.0**53
    out = np.zeros(len(x), np.int64)
    out[plain] = np.einsum("ij,ij->i", x[plain], y[plain]).astype(np.int64)
    bound = 1 << 63
    for k in np.flatnonzero(~plain):
        out[k] = min(bound - 1, max(-bound, sum(int(a) * int(b) for a, b in zip(x[k], y[k], strict=True))))
    return out.tolist()


def _scored(pairs: DataFrame) -> DataFrame:
    """(q, row, score) of pairs (q, row, qv, v), vectors of one length in a pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(pa.compute.list_value_length(batch.column(2)))
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                scores = exact(scaled(own.column(2), dim), scaled(own.column(3), dim))
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(scores, pa.int64())], names=["q", "row", "score"])

    return pairs.select("q", "row", "qv", "v").mapInArrow(run, "q long, row long, score long")


def _bounded(met: DataFrame, known: dict[int, Grid], k: int) -> DataFrame:
    """(q, row, low, high): of every block (dim, rows, cells, qs, qdata) what can be among its k best for a query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows, cells, qs, qdata in zip(*batch.columns, strict=True):
                grid, dim = known[dim.as_py()], dim.as_py()
                ids, own = np.asarray(rows.values, np.int64), np.asarray(qs.values, np.int64)
                c = np.frombuffer(b"".join(cells.as_py()), np.uint8).reshape(len(ids), dim)
                q = np.floor(SCALE * np.asarray(qdata.values, np.float64).reshape(len(own), dim))
                held: list[tuple[np.ndarray, ...]] = []
                kth = np.full(len(own), -np.inf)
                best = np.full((len(own), 0), -np.inf)
                for at in range(0, len(ids), CHUNK):
                    low, high = grid.bounds(q, c[at : at + CHUNK])
                    best = np.concatenate((best, low), axis=1)
                    if best.shape[1] > k:
                        best = -np.partition(-best, k - 1, axis=1)[:, :k]
                    if best.shape[1] == k:
                        kth = best.min(axis=1)
                    i, j = np.nonzero(high >= kth[:, None])
                    held.append((i, ids[at + j], low[i, j], high[i, j]))
                i, row, low, high = (np.concatenate(x) for x in zip(*held, strict=True))
                on = high >= kth[i]
                yield pa.RecordBatch.from_arrays([pa.array(own[i[on]]), pa.array(row[on]), pa.array(low[on]), pa.array(high[on])], names=["q", "row", "low", "high"])

    return met.mapInArrow(run, "q long, row long, low double, high double")


def top_k(vectors: DataFrame, asked: Column, k: int = 10, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of every row that is asked for, or of all if there are fewer.

    Scores are exact inner products of floor(1024 * component) (as saturating longs), ties go to the smaller
    vec_id. Every other row is a candidate: rows that repeat an id, with whatever vectors, are each a candidate and,
    if asked for, a query with results of its own under that id. Vectors that are null or empty, or hold null
    or non-finite components, and rows without an id take no part; vectors of another length than the query's
    are no candidates for it. An empty table has no results; other columns are not read. Rows with one vector are
    searched once, and of these the k + 1 smallest ids are candidates: no others can be in a result.
    """
    spark, wide = vectors.sparkSession, k + 1
    with scratch(spark):
        clean = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.coalesce(asked, F.lit(False)).alias("asked"))
        # -0.0 and 0.0 are one component
        clean = clean.where("id is not null").where(usable(F.col("v"))).withColumn("v", F.transform("v", lambda x: x + F.lit(0).cast("float")))
        rows = written(clean.select(F.monotonically_increasing_id().alias("row"), "id", "asked", "v", F.size("v").alias("dim"), F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")))
        known = grids(rows)
        if not known:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        # of vectors with more rows than a result has, those that come first in every tie
        same = ["dim", "h1", "h2"]
        crowded = written(rows.groupBy(same).agg(F.count("*").alias("n")).where(F.col("n") > wide).select(same))
        ahead = F.row_number().over(Window.partitionBy(same).orderBy("id", "row"))
        few = rows.join(crowded, same, "left_semi").select("row", "id", *same).withColumn("__k", ahead).where(F.col("__k") <= wide).select("row")
        single = rows.join(crowded, same, "left_anti")
        candidates = written(single.unionByName(rows.join(few, "row", "left_semi")).select("row", "id", "dim", "v"))
        queries = written(rows.where("asked").groupBy(same).agg(F.min_by("v", "row").alias("qv"), F.min("row").alias("q")))

        def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims = np.asarray(batch.column(0))
                for dim in np.unique(dims).tolist():
                    own = batch.filter(pa.array(dims == dim))
                    made = known[dim].cells(scaled(own.column(2), dim))
                    yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array([x.tobytes() for x in made], pa.binary())], names=["dim", "row", "cells"])

        size = {r["dim"]: r["n"] for r in candidates.groupBy("dim").agg(F.count("*").alias("n")).collect()}
        # blocks of candidates of each length, numbered by a hash; every block meets every block of queries
        blocks = {dim: max(1, -(-n * dim // BLOCK_BYTES)) for dim, n in size.items()}
        number = F.element_at(F.create_map(*[F.lit(x) for kv in blocks.items() for x in kv]), F.col("dim"))
        file = candidates.select("dim", "row", "v").mapInArrow(cells, "dim int, row long, cells binary")
        packed = file.groupBy("dim", F.pmod(F.xxhash64("row"), number).cast("int").alias("block")).agg(F.collect_list(F.struct("row", "cells")).alias("x"))
        packed = packed.select("dim", "block", F.col("x.row").alias("rows"), F.col("x.cells").alias("cells"))
        n_queries = queries.count()
        part = F.pmod(F.xxhash64("q"), F.lit(max(1, -(-n_queries // BLOCK_QUERIES))))
        sent = queries.join(candidates.select("dim").distinct(), "dim", "left_semi").groupBy("dim", part.alias("part")).agg(F.collect_list(F.struct("q", "qv")).alias("x"))
        sent = sent.select("dim", F.col("x.q").alias("qs"), F.flatten("x.qv").alias("qdata"), F.explode(F.sequence(F.lit(0), number - 1)).alias("block"))
        with arrow_rows(spark, 2):  # a row holds a block of each
            bounded = written(_bounded(packed.join(sent, ["dim", "block"]).select("dim", "rows", "cells", "qs", "qdata"), known, wide))
        # over all blocks: the kth largest lower bound excludes whatever cannot reach it
        place = lambda by: F.row_number().over(Window.partitionBy("q").orderBy(F.desc(by), "row"))
        floor = bounded.select("q", "row", "low").withColumn("__k", place("low")).where(F.col("__k") <= wide).groupBy("q").agg(F.when(F.count("*") >= wide, F.min("low")).alias("floor"))
        left = bounded.join(floor, "q").where("floor is null or high >= floor").select("q", "row", "high")
        left = written(left)
        side = lambda pairs: pairs.join(queries.select("q", "qv"), "q").join(candidates.select("row", "v"), "row")
        # exact vectors by falling upper bounds: first so many that a query may be done with them
        head = left.withColumn("__k", place("high")).where(F.col("__k") <= 2 * wide)
        first = written(_scored(side(head)))
        kth = first.withColumn("__k", place("score")).where(F.col("__k") <= wide).groupBy("q").agg(F.when(F.count("*") >= wide, F.min("score")).alias("kth"))
        # integer scores and bounds in doubles: one more step of slack
        rest = left.join(kth, "q").where(F.col("kth").isNull() | (F.col("high") >= F.col("kth").cast("double") - 1)).join(first.select("q", "row"), ["q", "row"], "left_anti")
        found = first.unionByName(_scored(side(rest)))
        named = found.join(candidates.select("row", "id"), "row").join(queries.select("q", *same), "q")
        own = rows.where("asked").select(F.col("row").alias("query_row"), F.col("id").alias("query_id"), *same)
        best = written(named.withColumn("__k", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id", "row"))).where(F.col("__k") <= wide))
        met = own.join(best, same).where("query_row != row")
        rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "id", "row"))
        done = met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
        return written(done, outlives=True)
