"""The pipeline against its stages, and against what each stage promises."""

import corpus_pipeline
from riskloom.llm import quality
from riskloom.llm.common import DOCUMENT_COLUMNS


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(*DOCUMENT_COLUMNS).cache()
    expected = {r.doc_id for r in quality.judge(docs, quality.RULES).collect() if r.kept}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, sf).cache()
        if name == "packing":
            assert {r.doc_id for r in after.select("doc_id").distinct().collect()} == ids
            break
        assert after.columns == DOCUMENT_COLUMNS
        ids = {r.doc_id for r in after.collect()}
        if name == "quality rules":
            assert ids == expected
        elif name == "near duplicates":
            assert ids < expected
        else:
            assert ids == {r.doc_id for r in before.collect()}
        before = after
    whole = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, after.collect()))
