import corpus_pipeline
import pytest
from compare import database, spark_rows, sql_rows

from stepwave.llm.oracle import ORACLE
from stepwave.llm.queries import QUERIES
from stepwave.llm.shared import stored


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == sql_rows(database(sf_dir), ORACLE[name])


def test_stages_keep_columns_and_pack_all_that_is_left(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stored(stage(spark, docs, sf_dir), "test-stage")
        assert kept.schema == docs.schema
        assert 0 < kept.count() <= docs.count()
        docs = kept
    assert docs.groupBy("doc_id").count().filter("count > 1").count() == 0
    pieces = corpus_pipeline.packing(spark, docs, sf_dir)
    assert pieces.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).filter("`sum(length)` <> `max(doc_tokens)`").count() == 0
    assert pieces.select("doc_id").distinct().count() == docs.count()
