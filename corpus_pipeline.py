"""From documents to token ids in five stages: quality, near-duplicates, personal data, mixture, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, langid, minhash, mixing, pii, quality
from tidemark.llm.common import scratch, written

#: Documents whose score is below this go.
LEAST_QUALITY = 0.7
REPEATS = 1.25


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted on the labels outside the held-out quarter, accepts, with all their
    rows. Null and empty texts have one score like any text; without documents the model is a constant and nothing is left."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~langid.held_out(F.col("doc_id")))
    model = quality.fit(docs.select("doc_id", "text"), labels)
    return docs.where(quality.score_column(F.col("text"), model) >= LEAST_QUALITY)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id; also among rows without an id. Rows
    without words link with nothing and stay; rows that repeat an id and text are one."""
    return minhash.representatives(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, each span of personal data replaced by its kind; n_chars is counted anew."""
    clean = pii.redacted(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and documents of small sources again, up to REPEATS times their source.

    A null source is a source; documents without words cost nothing and are used once if their source has no words at all, else
    like the rest of it. No row goes, repeated ones included.
    """
    name = "mix"
    while name in docs.columns:
        name = f"_{name}"
    return mixing.mix(docs, repeats=REPEATS, name=name).select(docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and their number for every row, repeated ones included; the ids decode to the whole text, and null
    and empty texts have none."""
    ids = bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return ids.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("PII", redact_personal_data),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", tokenize),
]

#: Fitted rules, MinHash and merges are no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written as Parquet and read again; what a stage needed goes with it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        with scratch(spark):
            docs = written(stage(spark, docs, sf_dir), outlives=True)
    return STAGES[-1][1](spark, docs, sf_dir)
