"""Multilingual language identification by mixture inference.

Byte trigrams of the lower-cased text, letters and single spaces only, are hashed into BUCKETS. Training
gives each language its smoothed bucket probabilities. A document's trigrams are taken as drawn from a
mixture of languages; expectation-maximisation estimates the proportions. The languages with the largest
proportions are then added one by one, and the set with the best penalised likelihood wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textbuf import flat, pieces

BUCKETS = 1 << 15
#: Labelled rows that a model is fitted on, for each language.
SAMPLE = 3000
#: Languages of a model: those with the most labelled rows.
LANGUAGES = 200
ALPHA = 0.5
STEPS = 12
#: Languages under this share of the full mixture are not candidates.
LEAST = 0.03
#: Penalty for each further language, times half the logarithm of the number of trigrams.
PENALTY = 12.0

_MAP = np.full(256, 32, np.uint8)
_MAP[97:123] = np.arange(97, 123)
_MAP[65:91] = np.arange(97, 123)
_MAP[128:] = np.arange(128, 256)


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every trigram of the texts; each text has a space before and after it."""
    padded = pc.binary_join_element_wise(pa.scalar(" "), pc.utf8_lower(texts.fill_null("")), pa.scalar(" "), "")
    raw, offsets = flat(padded)
    b = _MAP[raw].astype(np.uint32)
    rows = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(offsets))
    if len(b) < 3:
        return rows[:0], b[:0].astype(np.int64)
    good = (rows[2:] == rows[:-2]) & ~((b[:-2] == 32) & (b[1:-1] == 32)) & ~((b[1:-1] == 32) & (b[2:] == 32))
    code = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435761)
    return rows[:-2][good], (code >> np.uint32(17)).astype(np.int64)[good]


class Model:
    """Bucket probabilities of each language: table[bucket, language]."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        smooth = counts.astype(np.float64) + ALPHA
        self.table = (smooth / smooth.sum(axis=0, keepdims=True)).astype(np.float32)

    def infer(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(proportions[row, language], trigrams[row]); proportions of the chosen set, 0 outside it."""
        rows, buckets = trigrams(texts)
        n_rows, k = len(texts), len(self.langs)
        key, count = np.unique(rows * BUCKETS + buckets, return_counts=True)
        rows, p = key // BUCKETS, self.table[key % BUCKETS].astype(np.float64)
        count = count.astype(np.float64)
        sizes = np.bincount(rows, count, n_rows)
        starts = np.searchsorted(rows, np.arange(n_rows + 1))
        share = np.full((n_rows, k), 1.0 / k)
        share, _ = self._em(p, count, rows, starts, share, STEPS)
        order = np.argsort(-share, axis=1, kind="stable")
        ranked = np.take_along_axis(share, order, 1)
        candidates = np.maximum(1, (ranked >= LEAST).sum(axis=1))
        best = np.zeros((n_rows, k))
        best[np.arange(n_rows), order[:, 0]] = 1.0
        many = np.flatnonzero((candidates > 1) & (sizes > 0))
        if len(many):
            pick = np.isin(rows, many)
            own, p2, c2 = np.searchsorted(many, rows[pick]), p[pick], count[pick]
            starts2 = np.searchsorted(own, np.arange(len(many) + 1))
            top = np.full(len(many), -np.inf)
            for size in range(1, int(candidates[many].max()) + 1):
                mask = np.zeros((len(many), k))
                np.put_along_axis(mask, order[many, :size], 1.0, 1)
                start = np.maximum(share[many], 1e-6) * mask
                got, loglik = self._em(p2, c2, own, starts2, start / start.sum(axis=1, keepdims=True), 1 if size == 1 else STEPS // 2)
                value = loglik - PENALTY * size * np.log(np.maximum(sizes[many], 2.0)) / 2
                better = (value > top) & (candidates[many] >= size)
                top[better], best[many[better]] = value[better], got[better]
        return best, sizes

    @staticmethod
    def _em(p, count, rows, starts, share, steps):
        total = np.maximum(np.bincount(rows, count, len(share)), 1.0)
        filled = np.flatnonzero(np.diff(starts))
        loglik = np.zeros(len(share))
        for step in range(steps):
            joint = p * share[rows]
            mass = joint.sum(axis=1)
            joint *= (count / mass)[:, None]
            new = share.copy()
            if len(filled):
                new[filled] = np.add.reduceat(joint, starts[filled], axis=0) / total[filled, None]
                if step == steps - 1:
                    loglik[filled] = np.add.reduceat(count * np.log(mass), starts[filled])
            share = new
        return share, loglik


def fit(rows: DataFrame, *, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, languages: int = LANGUAGES) -> Model:
    """A model of the rows with a text and a language, from at most about sample rows of each language.

    Of more than `languages` values the most frequent ones are learned, so that a column of stray values
    cannot outgrow the driver. The rows are those with the least hash of their text, so that a hot source or
    language has no more say than its bound; trigram counts are summed on the executors, and what reaches the driver has one
    row for each language and partition of the sums.
    """
    labelled = rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = labelled.groupBy(F.col(lang_col).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    langs = sorted(r["lang"] for r in sizes)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0)))
    keep = F.lit(0.0)
    for r in sizes:
        keep = F.when(F.col(lang_col) == r["lang"], F.lit(sample / r["count"])).otherwise(keep)
    unit = F.pmod(F.xxhash64(F.col(text_col), F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = labelled.where(unit < keep).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    place = {x: k for k, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(langs), BUCKETS), np.int64)
        for batch in batches:
            which = np.array([place[x] for x in batch.column(1).to_pylist()], np.int64)
            for start, end in pieces(batch.column(0)):
                at, buckets = trigrams(batch.column(0).slice(start, end - start))
                counts += np.bincount(which[start:end][at] * BUCKETS + buckets, minlength=counts.size).reshape(counts.shape)
        where = np.flatnonzero(counts)
        if len(where):
            yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(counts.ravel()[where])], names=["cell", "n"])

    counts = np.zeros(len(langs) * BUCKETS)
    for cell, n in picked.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[cell] = n
    return Model(langs, counts.reshape(len(langs), BUCKETS).T)


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, mixture) for every row: the language with the largest proportion of the
    chosen set (ties to the first by name), that proportion, and the whole mixture. A text that is null or has no letter,
    and any text under a model without languages, is `und` with score 0 and an empty mixture. Repeated rows
    are answered each; other columns are not read; an empty table has no results. Texts are read whole, one piece at
    a time, a longer text than a piece as one of its own. The model is languages * BUCKETS floats."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((model.langs, model.table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.__new__(Model)
        own.langs, own.table = sent.value
        for batch in batches:
            for start, end in pieces(batch.column(1), max(1 << 15, (1 << 22) // max(4, len(own.langs)))):
                part = batch.slice(start, end - start)
                if own.langs:
                    share, _ = own.infer(part.column(1))
                else:
                    share = np.zeros((part.num_rows, 0))
                letters = part.column(2).to_pylist()
                names, scores, mixes = [], [], []
                for k in range(part.num_rows):
                    if not letters[k] or not own.langs:
                        names.append("und"), scores.append(0.0), mixes.append([])
                        continue
                    top = int(np.argmax(share[k]))
                    names.append(own.langs[top]), scores.append(float(min(1.0, share[k, top])))
                    mixes.append([{"lang": own.langs[j], "share": float(share[k, j])} for j in np.argsort(-share[k], kind="stable") if share[k, j] > 0])
                kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(mixes, kind)],
                    names=["doc_id", "lang_pred", "score", "mixture"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, mixture array<struct<lang:string,share:double>>")


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
