"""The pipeline's stages, each on its own input, and the registered queries."""

import pytest
from compare import same

import corpus_pipeline
from epochal.llm import queries

ORACLES = queries.oracle_sql()


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name in ("toxicity", "quality", "neardup"):
            assert 0 < after.count() <= docs.count()
            assert after.exceptAll(docs).isEmpty()
        if name == "mixing":
            assert after.join(docs, "doc_id", "left_anti").isEmpty()
        docs = after
    assert docs.count() == spark.read.parquet(str(tmp_path / "mixing")).count()


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_pipeline_of_nothing(spark, empty, sf):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, sf, name):
    same(queries.queries()[name](spark, sf), ORACLES[name], sf)
