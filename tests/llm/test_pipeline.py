"""The pipeline's stages and the registered queries of the operators."""

import corpus_pipeline
import pytest
from oracle_util import duck, same_result

from tidemark.llm.common import cut
from tidemark.llm.oracle import ORACLE_SQL
from tidemark.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, sf_small, name):
    same_result(QUERIES[name](spark, sf_small), duck(sf_small), ORACLE_SQL[name])


def test_stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = cut(stage(spark, before, sf_small), name)
        assert after.columns == docs.columns
        assert 0 < after.count() <= before.count()
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, sf_small)
    assert packed.select("doc_id").distinct().count() == before.count()
