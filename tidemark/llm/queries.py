"""The registered queries of this package's operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, chat, embdedup, langid, minhash, mixing, pii, quality, shard, topk

TOKENIZER = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~held))
    found = langid.predict(docs, model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", F.size("mixture").alias("n_langs"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(k) for k in pii.BASE],
        F.sha2(pii.joined(base), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("top_score"),
    )


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text")
    )
    done = chat.format_conversations(turns.unionByName(extra))
    read = done.select("conv_id", "formatted", chat.parse(F.col("formatted")).alias("turns"), chat.under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard.interleaved_shards(_table(spark, sf_dir, "documents"), 40)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, repeats=1.25)
    return mixed.select("doc_id", "source", F.col("mix.epoch").alias("epoch"), F.col("mix.block").alias("block"), F.col("mix.place").alias("place"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embdedup.near_vectors(_table(spark, sf_dir, "embeddings"), 0.95)


def op9_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held = langid.held_out(F.col("doc_id"))
    model = quality.fit(docs.select("doc_id", "text"), labels.where(~held))
    scored = quality.score(docs, model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), TOKENIZER), TOKENIZER)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


def queries() -> dict:
    import corpus_pipeline  # noqa: F401  the pipeline is part of this package

    own = [op1_language_mixture, op2_personal_data, op3_chat_format, op4_exact_top_k, op5_interleaved_shards, op6_minhash_near_dedup, op7_temperature_mix, op8_embedding_near_dedup, op9_rule_quality, op10_byte_bpe, pipeline]
    return {f.__name__: f for f in own}


_CONTROLS = ["<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"]


def _escaped_length(column: str) -> str:
    """Length of an escaped text: one more for each backslash and each control string."""
    more = [f"(length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}" for c in [*_CONTROLS, "\\"]]
    return f"length({column}) + " + " + ".join(more)


def oracle_sql() -> dict[str, str]:
    said = "</s>[INST] ok [/INST]"
    return {
        "op3_chat_format": f"""
            WITH t AS (
              SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL SELECT -7, 0, 'user', '{said}' UNION ALL SELECT -7, 1, 'assistant', '{said}'
            ), o AS (
              SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS was FROM t
            ), l AS (
              SELECT *, CASE WHEN was IS NULL OR was <> role THEN 1 ELSE 0 END AS opens, {_escaped_length('text')} AS own, {_escaped_length('role')} AS named FROM o
            )
            SELECT conv_id, count(*) AS n_turns,
              sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
              CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
              sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
              CAST(sum(own + opens * ({len(chat.START) + len(chat.TEXT) + len(chat.END)} + named) + (1 - opens) * {len(chat.SEP)}) AS BIGINT) AS formatted_chars
            FROM l GROUP BY conv_id""",
        "op4_exact_top_k": """
            WITH v AS (
              SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            ), s AS (
              SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
            )
            SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
            FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10""",
        "op8_embedding_near_dedup": """
            WITH RECURSIVE v AS (
              SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
            ), ok AS (
              SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
            ), l AS (
              SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.95
            ), r AS (
              SELECT vec_id AS id, vec_id AS reached FROM v UNION SELECT r.id, l.b FROM r JOIN l ON r.reached = l.a
            )
            SELECT v.vec_id, coalesce(n.c, 0) AS n_links, m.component_id, v.vec_id = m.component_id AS kept
            FROM v LEFT JOIN (SELECT a, count(*) AS c FROM l GROUP BY a) n ON n.a = v.vec_id
            JOIN (SELECT id, min(reached) AS component_id FROM r GROUP BY id) m ON m.id = v.vec_id""",
    }
