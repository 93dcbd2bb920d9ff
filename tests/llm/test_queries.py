"""The registered queries of the subpackage against their SQL, and the pipeline, on the smallest tables."""

import corpus_pipeline
import pytest
from oracle_check import compare, duck
from pyspark.sql import functions as F

from unirec.llm.registry import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_one_query_per_operator():
    assert {int(n[2:].split("_")[0]) for n in queries()} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, SF, queries()[name], oracle_sql()[name]) is None


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    extra = spark.createDataFrame([(10_001, None, "en", "x", 0), (10_002, "123", None, None, 3)], docs.schema)
    # A row that comes three times, from two sources.
    first = docs.filter("lang = 'en' AND n_chars > 200").orderBy("doc_id").first()
    again = spark.createDataFrame([(first.doc_id, first.text, first.lang, s, first.n_chars) for s in (first.source, "a")], docs.schema)
    docs, sizes = docs.unionByName(extra).unionByName(again), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        sizes.append(docs.count())
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "stage")
        assert k == 4 or docs.columns == columns
        if k == 1:
            same = docs.filter(docs.doc_id == first.doc_id).collect()
            assert len(same) <= 1 and all(r.source == "a" for r in same)
        if k == 0:
            assert docs.filter("doc_id > 10000").count() == 0 and docs.count() >= 0.95 * sizes[0]
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert docs.count() and sizes[1] > sizes[2] > sizes[3]
    end = docs.agg({"start": "max"}).first()[0]
    assert docs.agg({"n_tokens": "sum"}).first()[0] == end + docs.filter(docs.start == end).first().n_tokens


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("words", F.lit("clash")).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "stage")
    assert docs.count() == 0
