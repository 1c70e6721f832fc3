"""Large groups of near copies in several components: right links, and sets sent once a block and not once a pair."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402

from shipreport.llm import near_dedup  # noqa: E402


def crowd(seed, n, words=120):
    """Copies of one text with few or many edits: some join, others stay below the threshold or are joined by one copy only."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6])):
            w[rng.randrange(len(w))] = f"e{rng.randrange(60)}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(near_dedup, "NODES", 32)
    monkeypatch.setattr(near_dedup, "CHUNK", 16)


@pytest.mark.parametrize("whole, few", [(4096, 16), (32, 2), (32, 16), (32, 10_000)])
def test_crowd_of_several_components(spark, monkeypatch, small_blocks, whole, few):
    monkeypatch.setattr(near_dedup, "WHOLE", whole)
    monkeypatch.setattr(near_dedup, "FEW", few)
    rows = crowd(3, 250)
    _, roots = brute.components(rows, 3, 85)
    want = [min(i for (i, _), x in zip(rows, roots) if x == r) for r in roots]
    assert 10 < len(set(want)) < 200
    got = {r.id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), width=3, percent=85).collect()}
    assert [got[i] for i, _ in rows] == want


def test_sets_travel_once_a_block(spark, monkeypatch, small_blocks):
    monkeypatch.setattr(near_dedup, "CHUNK", 64)
    sent = {}
    real = near_dedup.stored

    def watched(df, label):
        out = real(df, label)
        if label == "rest":
            sent["rows"], sent["nodes"] = out.count(), out.select("node").distinct().count()
        return out

    monkeypatch.setattr(near_dedup, "stored", watched)
    rows = crowd(4, 300)
    near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), width=3, percent=85).count()
    blocks = 2 * (sent["nodes"] / near_dedup.CHUNK + 1)  # a block of one component holds half its share at least
    assert 0 < sent["rows"] <= 2 * blocks * sent["nodes"]
