"""The pipeline: every stage on its own input, and the packed rows against the documents that reach them."""

import zlib

import numpy as np

import corpus_pipeline
from siftwork.llm.tokens import byte_tokenizer, tokenizer_path
from siftwork.sources.shared import stage


def test_stages(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs, sizes = documents, []
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near duplicates", "mixing", "packing"]
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = stage(step(spark, docs, sf_dir), "test-pipeline")
        assert docs.columns == documents.columns, name
        after = [r.doc_id for r in docs.select("doc_id").collect()]
        assert set(after) <= before
        if name in ("line dedup", "mixing"):
            assert set(after) == before
        sizes.append(len(set(after)))
    assert 0 < sizes[-1] < documents.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    model = byte_tokenizer(tokenizer_path())
    wanted = sum(len(model.ids(r.text)) + 1 for r in docs.collect())
    assert sum(r.length for r in packed) == wanted
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(np.frombuffer(r.ids, "<u4")) == r.length for r in packed)


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, sf_dir), "test-pipeline")
    assert docs.count() == 0
