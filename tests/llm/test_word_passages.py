"""Runs of 50 words that occur twice: removed whole, and gone from the pipeline's documents."""

import re
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
from test_llm import SCHEMA, awkward, base_text  # noqa: E402

import corpus_pipeline  # noqa: E402
from shipreport.llm import suffix_dedup  # noqa: E402


def words_of(text):
    return [(m.start(), m[0]) for m in re.finditer(rb"[^\x20\x09-\x0D]+", (text or "").encode())]


def runs(text, size):
    w = [x for _, x in words_of(text)]
    return [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]


def plain(texts, size):
    """(n_bytes, n_removed, n_spans, kept bytes) of each text; a word goes with the gap behind it."""
    seen = Counter(x for t in texts for x in runs(t, size))
    out = []
    for t in texts:
        raw, places = (t or "").encode(), words_of(t)
        gone = [False] * len(places)
        for i, x in enumerate(runs(t, size)):
            if seen[x] > 1:
                gone[i : i + size] = [True] * size
        ends = [a for a, _ in places[1:]] + [len(raw)]
        kept = raw[: places[0][0]] if places else raw
        for (a, _), b, g in zip(places, ends, gone):
            kept += b"" if g else raw[a:b]
        out.append((len(raw), len(raw) - len(kept), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), kept))
    return out


def rows():
    short = " ".join(f"p{i}" for i in range(55))  # 209 bytes
    return [*[(r[0], r[1]) for r in awkward()],
            (30, base_text(60, 30) + " " + short + " " + base_text(60, 31)), (31, short.replace(" ", "\n") + "\t" + base_text(70, 32)), (32, "  " + base_text(30, 33) + " " + short),
            (33, " ".join(f"q{i}" for i in range(49)) + " " + base_text(20, 34)), (34, " ".join(f"q{i}" for i in range(49)) + " " + base_text(20, 35)),
            (35, " ".join(f"r{i}" for i in range(50)) + " " + base_text(20, 36)), (36, base_text(20, 37) + " " + " ".join(f"r{i}" for i in range(50)))]


def frame_of(spark, given):
    return spark.createDataFrame(given, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("together, step, size", [(20_000, 1 << 20, 50), (0, 1 << 20, 50), (20_000, 1000, 50), (20_000, 1 << 20, 43)])
def test_runs_of_words(spark, monkeypatch, together, step, size):
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    monkeypatch.setattr(suffix_dedup, "STEP_BYTES", step)
    given = rows()
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.repeated_passages(frame_of(spark, given), words_span=size).collect()]
    want = [(i, *x) for (i, _), x in zip(given, plain([t for _, t in given], size))]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.repeated_passages(docs, words_span=50).collect()]
    assert sorted(got, key=repr) == sorted([(i, *x) for (i, _), x in zip(given, plain([t for _, t in given], 50))], key=repr)


def test_too_few_words(spark):
    with pytest.raises(ValueError, match="43 words"):
        suffix_dedup.repeated_passages(frame_of(spark, [(1, "a")]), words_span=42)


def test_no_run_of_50_words_is_left_shared(spark, sf_dir):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows()], "doc_id long, text string, lang string, source string, n_chars long")
    names = [name for name, _ in corpus_pipeline.STAGES]
    for name, stage in corpus_pipeline.STAGES[names.index("near duplicates") + 1 : names.index("repeated passages") + 1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "test")
    left = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    assert max(Counter(x for t in left.values() for x in runs(t, 50)).values()) == 1
    assert "p7 " not in left[30] and left[31] == base_text(70, 32) and left[32] == "  " + base_text(30, 33) + " "
    assert "q48" in left[33] and "q48" in left[34]  # 49 words stay
    assert left[35] == base_text(20, 36) and left[36] == base_text(20, 37) + " "


def test_given_documents_keep_no_shared_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "test")
        if name == "repeated passages":
            break
    seen = Counter(x for r in docs.select("text").collect() for x in runs(r.text, 50))
    assert not [x for x, n in seen.items() if n > 1]
