"""Registered queries against SQL, and the shape of those without."""

import pytest
from compare import difference

import corpus_pipeline
from cityweave.llm.queries import LLM_ORACLES, LLM_QUERIES


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_against_sql(spark, small, duck, name):
    assert difference(LLM_QUERIES[name](spark, small), duck, LLM_ORACLES[name]) is None


def test_registry():
    assert set(LLM_ORACLES) <= set(LLM_QUERIES)
    assert [name.split("_")[0] for name in LLM_QUERIES] == [f"op{n}" for n in range(1, 14)] + ["pipeline"]


def test_pipeline(spark, small):
    """Each stage against a plain version of its decision on its own input."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, by_stage = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, by_stage[-1], small).cache()
        by_stage.append(out)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
    counts = [d.count() for d in by_stage]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    kept = {r.doc_id for r in by_stage[1].select("doc_id").collect()}
    known = [(i, q) for i, q in labels.items() if q is not None]
    assert sum((i in kept) == (q == 1) for i, q in known) >= 0.95 * len(known)
    assert counts[2] == counts[1]  # line dedup only edits
    ids = [r.doc_id for r in by_stage[3].collect()]
    assert len(ids) == len(set(ids)) < counts[2]
    taken = [r.doc_id for r in by_stage[4].collect()]
    assert set(taken) <= set(ids) and max(taken.count(i) for i in set(taken)) <= 2
    last = by_stage[5].collect()
    assert len(last) == counts[4] and all(r.lossless for r in last)
