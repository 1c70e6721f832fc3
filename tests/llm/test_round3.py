"""Lexical search, vector near-duplicates and importance resampling against plain Python versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from shipreport.llm import importance, lexical_search, vector_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def texts(seed, n):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "gamma", "delta", "éclair", "x1", "Zeta", "eta", "theta", "iota", "kappa"]
    out = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(n)]
    return out + [None, "", "  ,,; ", "alpha ALPHA alpha", "beta-gamma_delta", "日本語 テキスト", out[0], out[0]]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i if i % 17 else None, t, "clash", 1) for i, t in enumerate(texts(1, 120))]
    rows += [(3, "gamma delta", "clash", 1), (3, "gamma delta", "clash", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, item_id string, score int").repartition(4)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "alpha beta"), (2, "Gamma delta Éclair"), (2, "eta"), (3, None), (4, "..."), (5, "x1 zeta kappa iota theta")]
    return spark.createDataFrame(rows, "item_id long, text string")


def brute_search(docs, items, top=50):
    terms = [TERM.findall((t or "").translate(LOWER)) for _, t in docs]
    big_n, big_l = sum(1 for x in terms if x), sum(len(x) for x in terms)
    df = {}
    for x in terms:
        for t in set(x):
            df[t] = df.get(t, 0) + 1
    queries = {}
    for item, text in items:
        if text is not None:
            queries.setdefault(item, set()).update(TERM.findall(text.translate(LOWER)))
    out = []
    for item, q in queries.items():
        scored = []
        for (doc, _), x in zip(docs, terms):
            if not x:
                continue
            m = 50 + (50 * len(x) * big_n) // big_l
            score = 0
            for t in q:
                tf = x.count(t)
                if tf:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((score, doc))
        scored.sort(key=lambda p: (-p[0], p[1] is None, p[1] or 0))
        out += [(item, r + 1, doc, score) for r, (score, doc) in enumerate(scored[:top])]
    return out


def test_search_equals_brute_force(corpus, items):
    got = lexical_search.search(corpus, items, top=7).collect()
    want = brute_search([(r.doc_id, r.text) for r in corpus.collect()], [(r.item_id, r.text) for r in items.collect()], top=7)
    assert sorted((r.item_id, r.rank, r.doc_id, r.score) for r in got) == sorted(want, key=lambda r: (r[0], r[1]))
    for item in {r.item_id for r in got}:
        assert sorted(r.rank for r in got if r.item_id == item) == list(range(1, 1 + sum(1 for r in got if r.item_id == item)))


def test_search_bound_keeps_every_top_document(corpus, items):
    """With few documents an item gets all its matches; with a top of 1 only the best."""
    every = lexical_search.search(corpus, items, top=10_000).collect()
    best = lexical_search.search(corpus, items, top=1).collect()
    for r in best:
        assert r.score == max(x.score for x in every if x.item_id == r.item_id)


def test_search_empty(spark, items):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lexical_search.search(empty, items).collect() == []
    assert lexical_search.search(spark.createDataFrame([(1, None)], "doc_id long, text string"), items).collect() == []


def brute_resample(docs, target, percent=5):
    def buckets(text):
        w = WORD.findall((text or "").translate(LOWER))
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]
    d = [(i,) + buckets(t) for i, t in docs]
    s, t = np.zeros(10000), np.zeros(10000)
    for _, _, b in d:
        np.add.at(s, b, 1)
    for text in target:
        np.add.at(t, buckets(text)[1], 1)
    big_s, big_t = s.sum(), t.sum()
    gain = [math.floor(1000 * math.log((t[i] + 1) * (big_s + 10000) / ((s[i] + 1) * (big_t + 10000)))) for i in range(10000)]
    out = []
    for i, n, b in d:
        weight = sum(gain[x] for x in b)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    eligible = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(eligible[: percent * len(eligible) // 100]):
        r[4] = rank + 1
    return sorted(tuple(r[:5]) for r in out if r[0] is not None)


def test_resample_equals_brute_force(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice(["a", "b", "c", "d", "Ee", "f", "g"]) for _ in range(rng.randrange(0, 80)))) for i in range(300)] + [(400, None), (401, "")]
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, weight string").repartition(3)
    target = ["a b c a b c", "Ee f g", None]
    got = importance.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), percent=20).collect()
    assert sorted((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in got) == brute_resample(docs, target, percent=20)


def test_bit_slices_are_exact():
    rng = np.random.default_rng(5)
    gains = rng.integers(-30000, 30000, importance.BUCKETS)
    positive, negative = importance.planes(np.maximum(gains, 0)), importance.planes(np.maximum(-gains, 0))
    for _ in range(20):
        counts = rng.integers(0, 3000, importance.BUCKETS) * (rng.random(importance.BUCKETS) < 0.05)
        assert importance.sliced_weight(counts, positive, negative) == int((counts * gains).sum())


def test_resample_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resample(empty, empty).collect() == []


def vectors(seed):
    rng = np.random.default_rng(seed)
    rows, vid = [], 0
    for _ in range(40):
        center, label = rng.normal(size=16), int(rng.integers(0, 2))
        for _ in range(int(rng.integers(1, 8))):
            v = center / np.linalg.norm(center) + rng.normal(size=16) * rng.uniform(0.02, 0.3) / 4
            rows.append((vid, [float(x) for x in v], label))
            vid += 1
    rows += [(vid, rows[0][1], rows[0][2]), (vid, rows[0][1], rows[0][2]), (vid + 1, rows[0][1], None), (vid + 2, None, 1), (vid + 3, [0.0] * 16, 1),
             (vid + 4, [float("nan")] + [1.0] * 15, 1), (vid + 5, [None] + [1.0] * 15, 1), (None, rows[0][1], rows[0][2]), (vid + 6, [x * 3 for x in rows[1][1]], rows[1][2])]
    return rows


def brute_vectors(rows):
    ok = [i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for i, v, lab in rows]
    links = {k: set() for k in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2]:
                va, vb = np.array(rows[a][1]), np.array(rows[b][1])
                if va @ vb / (math.sqrt(va @ va) * math.sqrt(vb @ vb)) >= 0.93:
                    links[a].add(b)
                    links[b].add(a)
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, stack = {k}, [k]
        while stack:
            for y in links[stack.pop()] - seen:
                seen.add(y)
                stack.append(y)
        component = min(rows[y][0] for y in seen) if ok[k] else i
        out.append((i, len(links[k]), component, i is not None and i == component))
    return out


def test_vector_links_equal_brute_force(spark):
    rows = vectors(7)
    frame = spark.createDataFrame([(i, v, lab, "x") for i, v, lab in rows], "vec_id long, embedding array<double>, label int, n_links string").repartition(3)
    got = vector_dedup.vector_duplicates(frame).collect()
    want = brute_vectors(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept if r.vec_id is not None else False) for r in got), key=key) == sorted(
        [(i, n, c, k) for i, n, c, k in want], key=key)


def test_vector_recall_is_measured(spark):
    """Recall of the index against all pairs, on clusters of near copies; no link below the threshold by construction."""
    rows = [r for r in vectors(11) if r[0] is not None and r[1] is not None and r[2] is not None]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sum(r.n_links for r in vector_dedup.vector_duplicates(frame).collect())
    want = sum(n for _, n, _, _ in brute_vectors(rows))
    assert want > 50 and got <= want and got >= 0.9 * want


def test_vectors_empty(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_dedup.vector_duplicates(empty).collect() == []
