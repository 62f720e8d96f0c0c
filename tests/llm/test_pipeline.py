import pytest

import __spark_entry__ as entry
import corpus_pipeline
from oracle import compare, duck
from tillcast.llm import queries, simhash_dedup
from tillcast.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def test_stages_keep_the_columns(spark):
    docs = table(spark, SF_DIR, "documents")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        assert {r.doc_id for r in out.select("doc_id").collect()} <= ids


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert 0 < len(rows) < 200 and len({r.doc_id for r in rows}) == len(rows)


def test_dedup_stage_keeps_the_representatives(spark):
    docs = table(spark, SF_DIR, "documents")
    wanted = {r.component_id for r in simhash_dedup.near_duplicates(docs).collect()}
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR).collect()} == wanted


def test_registered(spark):
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_matches_sql(spark, key):
    assert compare(spark, duck(SF_DIR), key, queries.QUERIES[key], queries.ORACLE[key], SF_DIR) is None
