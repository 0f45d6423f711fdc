"""The corpus pipeline against plain versions of its stages."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, pii
from tidemark.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs[-1], SF).write.parquet(f"{root}/{k}")
        docs.append(spark.read.parquet(f"{root}/{k}"))
    return docs


def test_columns(staged):
    for d in staged[1:-1]:
        assert d.columns == staged[0].columns
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality classifier" and corpus_pipeline.ORACLE_SQL is None


def test_quality_stage(spark, staged):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")
    kept = {r.doc_id for r in staged[1].collect()}
    right = [(k in kept) == bool(q) for k, q in labels.quality.items()]
    assert sum(right) >= 0.95 * len(right)


def test_dedup_stage(staged):
    from tests.llm.test_operators import plain_components

    rows = [(r.doc_id, r.text) for r in staged[1].collect()]
    _, want = plain_components(rows)
    assert sorted(r.doc_id for r in staged[2].collect()) == sorted(k for k, c in want.items() if k == c)


def test_redaction_stage(staged):
    before = {r.doc_id: r.text for r in staged[2].collect()}
    for r in staged[3].collect():
        assert r.text == pii.redact(before[r.doc_id], pii.find(before[r.doc_id]))
        assert not list(pii.base_spans(r.text)) and r.n_chars == len(r.text)


def test_mixture_stage(staged):
    before, after = staged[3].toPandas(), staged[4].toPandas()
    assert set(before.doc_id) == set(after.doc_id)
    assert after.groupby("doc_id").size().max() <= 2


def test_tokens(spark, staged):
    import collections

    from tidemark.llm.queries import TOKENIZER

    back = bpe.decode(staged[5].select("doc_id", "ids"), TOKENIZER).collect()
    want = collections.Counter((r.doc_id, r.text) for r in staged[4].collect())
    assert collections.Counter((r.doc_id, bytes(r.bytes).decode()) for r in back) == want


def test_run_is_the_stages(spark, staged):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, got.collect())) == sorted(map(str, staged[5].collect()))


def test_repeated_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    twice = docs.unionByName(docs)
    assert corpus_pipeline.drop_near_duplicates(spark, twice, SF).count() == corpus_pipeline.drop_near_duplicates(spark, docs, SF).count()
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
    extra = docs.withColumn("score", F.lit(1)).withColumn("ids", F.lit(2))
    assert corpus_pipeline.keep_quality(spark, extra, SF).columns == extra.columns


def test_columns_of_other_meaning_and_rows_without_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    odd = docs.withColumn("mix", F.lit("mine")).withColumn("doc_id", F.expr("if(doc_id % 2 = 0, null, doc_id)"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, odd, SF)
        assert done.schema == odd.schema, name
        assert {r.mix for r in done.select("mix").collect()} <= {"mine"}, name
    assert corpus_pipeline.drop_near_duplicates(spark, odd.unionByName(odd), SF).count() <= 40


def test_tables_of_a_stage_go(spark):
    from tidemark.llm.common import scratch, shared_dir, written

    place = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tidemark")
    left = lambda: {str(f.getPath()) for f in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)}
    written(spark.range(3))
    before = left()
    with scratch(spark):
        kept = written(corpus_pipeline.drop_near_duplicates(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF), outlives=True)
        assert len(left()) > len(before)
    assert len(left() - before) == 1 and kept.count()


def test_names():
    names = list(queries())
    assert [n.split("_")[0] for n in names] == [*[f"op{k}" for k in range(1, 11)], "pipeline"]
    assert set(oracle_sql()) <= set(names)
