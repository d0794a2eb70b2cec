"""The pipeline's stages chained over small tables, and its queries' registration."""

import corpus_pipeline
from tidemark.llm import registry

from tests.conftest import SF_SMALL


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    sizes, now = [docs.count()], docs
    for i, (_, function) in enumerate(corpus_pipeline.STAGES):
        now = function(spark, now, SF_SMALL)
        if i + 1 < len(corpus_pipeline.STAGES):
            assert now.columns == docs.columns
            now = corpus_pipeline.stage(now, "test")
        sizes.append(now.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] == sizes[4] == sizes[5] > 0
    assert now.filter("not round_trip").count() == 0


def test_registered():
    assert {q.split("_")[0] for q in registry.QUERIES} == {"pipeline", *(f"op{n}" for n in range(1, 14))}
    assert set(registry.ORACLES) <= set(registry.QUERIES)
