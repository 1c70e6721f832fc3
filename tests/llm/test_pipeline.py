"""The pipeline's stages on given and on awkward documents."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402


@pytest.mark.parametrize("clash", [False, True])
def test_stages(spark, sf_dir, clash):
    from test_llm import SCHEMA, awkward

    docs = spark.createDataFrame(awkward(), SCHEMA) if clash else spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "test")
        if name == "token ids":
            break
        assert docs.columns == columns
        after = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        if name == "near duplicates":
            sets, roots = brute.components(before, 5, 80)
            assert len(after) == len({r for s, r in zip(sets, roots) if s}) + sum(not s for s in sets)
        elif name == "repeated passages":
            cut = [(i, x[3].decode("utf-8", "replace")) for (i, _), x in zip(before, brute.passages([t for _, t in before], 400)) if not x[1] or x[3].split()]
            assert sorted(after, key=repr) == sorted(cut, key=repr)
        elif name == "quality classifier":
            assert set(after) <= set(before)
    assert docs.count() == len(after)
    assert docs.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]


def test_stages_of_no_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "test")
    assert docs.count() == 0
