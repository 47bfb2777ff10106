"""The registered queries beside their SQL, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
from oracle import compare, connect
from sluice.llm import queries  # noqa: F401
from sluice.llm.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [q for q in QUERIES])
def test_query(spark, name):
    assert compare(spark, connect(SF_DIR), name, QUERIES[name], ORACLES.get(name), SF_DIR) is None


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, out = kept.count(), stage(spark, kept, SF_DIR)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out = spark.createDataFrame(out.collect(), docs.schema)
        assert 0 < out.count() <= before
        assert (name == "secret_scan") == (out.count() == before)
        kept = out
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).collect()} == ids


def test_stages_on_edges(spark, docs, empty, repeated):
    own = docs.columns
    for given in (docs, empty, repeated):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, given, SF_DIR).columns == own
            stage(spark, given, SF_DIR).count()
        assert corpus_pipeline.STAGES[-1][1](spark, given, SF_DIR).count() == given.count()
