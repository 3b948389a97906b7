"""The pipeline's stages take effect, one after the other."""

import corpus_pipeline
from tidemark.llm.storage import saved, table

SMALL = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = table(spark, SMALL, "documents")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = saved(stage(spark, docs, SMALL), name)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
        assert not {r["doc_id"] for r in after.collect()} - {r["doc_id"] for r in docs.collect()}
        docs = after
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[2] < counts[1]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}


def test_run_is_the_stages(spark):
    first, second = (sorted(map(tuple, corpus_pipeline.run(spark, SMALL).select("doc_id", "piece", "ids_crc32").collect())) for _ in range(2))
    assert first and first == second
