"""The corpus operators against plain versions, on given documents and on awkward rows."""

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402

from shipreport.llm import cotraining, fingerprints, near_dedup, page_text, sentencepieces, source_mixing, suffix_dedup, text_rules, token_counts  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, d string, t string, id int, kept string, size string, chunk int, list string, part int, name string, node int"


def base_text(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.1 else f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward():
    """Nulls everywhere, empty and blank and very long texts, ties, repeated rows, shared passages, near copies."""
    passage = base_text(140, 1)
    near = base_text(120, 2).split()
    edited = [*near[:60], "new", *near[61:]]
    rows = [
        (1, base_text(50, 3) + "\n" + passage), (2, passage + " " + base_text(80, 4)), (3, " ".join(near)), (4, " ".join(edited)),
        (5, " ".join(near)), (6, None), (7, ""), (8, " \t\n\x0b"), (9, "one"), (10, "one Two"), (11, "ONE two"), (12, base_text(40_000, 5, 5000)),
        (None, " ".join(near)), (None, None), (None, "lone text without an id"), (13, "same row"), (13, "same row"), (13, "same id, other text"),
        (14, "ab" * 900), (15, "日本語 テキスト 🙂 " * 60), (16, "a\nb\n\n# c\nd\n" + base_text(300, 6).replace(" w1", "\nw1")), (17, base_text(300, 7)), (17, base_text(300, 7)),
        (-5, "x " * 700), (18, "<|endoftext|>hello<|endoftext|>  don't stop'll \x00\x85 ½²Ⅷ"), (19, "▁▁ x▁y ▁"), (20, passage[:450]),
    ]
    return [(i, t, None if k % 5 == 0 else ["en", "fr"][k % 2], None if k % 7 == 3 else f"s{k % 3}", None, "d", None, k, "no", "x", k, "l", k, None, 1) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def given(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def same(got, want):
    assert sorted(got, key=repr) == sorted(want, key=repr)


# ---- fingerprints ---------------------------------------------------------------------------


def test_edit_trial(given):
    rows = sorted(pairs(given), reverse=True)
    got = {r.doc_id: r for r in fingerprints.edit_trial(given).collect()}
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        n = len(text)
        edited = text[: n - n // 3] + after[: n // 3]
        assert (got[i].n_chars, got[i].edited_sha256) == (n, brute.sha(edited))
    by_text = {}
    for i, text in rows:
        by_text.setdefault(text, set()).add(got[i].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert len({x for s in by_text.values() for x in s}) == len(by_text)
    long = [r for r in got.values() if r.n_chars > 500]
    assert all(r.near_edited > r.near_next and 0 <= r.near_next <= 1 for r in long)


def test_edit_trial_of_awkward_rows(docs, none, spark):
    got = fingerprints.edit_trial(docs).collect()
    assert len(got) == docs.count()
    assert sum(r.doc_id is None for r in got) == 3
    assert {r.n_chars for r in got if r.doc_id in (6, 7)} == {0}
    assert fingerprints.edit_trial(none).count() == 0
    lone = fingerprints.edit_trial(docs.where("doc_id = 9")).collect()
    assert lone[0].near_next == 1.0 and lone[0].edited_sha256 == brute.sha("ono")
    assert fingerprints.fingerprints(docs).where("id = 7").first().root == fingerprints.fingerprints(docs).where("id = 6").first().root


def test_edits_are_located(spark):
    lines = [f"paragraph number {i} of a text" for i in range(60)]
    changed = [*lines[:40], "something else", *lines[41:]]
    pair = spark.createDataFrame([("\n".join(lines), "\n".join(changed))], "x string, y string")
    found = pair.select(*[fingerprints.written(fingerprints.tree(F.col(c))).alias(c) for c in "xy"]).select(
        fingerprints.edited_paragraphs(F.col("x"), F.col("y")).alias("e"), fingerprints.edited_paragraphs(F.col("x"), F.col("x")).alias("none")).first()
    assert found.e == [40] and found.none == []


def test_fingerprints_are_native(given):
    plan = fingerprints.edit_trial(given)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# ---- main text of pages ---------------------------------------------------------------------

PAGE = """<html><head><title>T</title></head><body class="no-sidebar"><header><h1>Site</h1></header><div id="cookie-banner">We use cookies, please accept all of them
now or later.</div><nav><a href=x>Home</a></nav><div class="content"><h2>My &amp; title</h2><p>First   paragraph of the text,<br>long enough to count as one of them.
<p>Second <a href=y>with link</a> &eacute;t&#233; &#x41;.</p><ul><li>one<li>two</ul><div class="ad">Buy <p>now</p></div><p>Short end.</p></div>
<div class="sidebar"><p>A long sidebar text that should not be there at all, as it is no main text.</p></div><section id="comments"><p>Great article, I loved it so much
and will come back.</p></section><form><label>Mail</label></form><footer>&copy; x</footer><script>if(a<b){"</p>"}</script></body></html>"""


def test_main_text(spark, sf_dir):
    import html
    import re

    assert page_text.main_text(PAGE) == "My & title\nFirst paragraph of the text, long enough to count as one of them.\nSecond with link été A.\none\ntwo\nShort end."
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in page_text.extract_text(pages).collect():
        article = re.search(r"<article>(.*?)(</article>|$)", source[r.page_id], re.S).group(1)
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


@pytest.mark.parametrize("page, text", [(None, ""), ("", ""), ("plain words", "plain words"), ("<p>x", "x"), ("<" * 60, "<" * 60), ("<!-- open", ""), ("<div class='a", ""),
                                        ("<script>x", ""), ("<article><p>a<p>b</article><p>c", "a\nb"), ("</p></div>x<br/>y", "x y"), ("<p>&#xZZ; &nbsp;&lt;b&gt;", "&#xZZ; <b>"),
                                        ("<form><main><p>in form</p></main></form>", "in form")])
def test_main_text_of_odd_pages(spark, page, text):
    got = page_text.extract_text(spark.createDataFrame([(1, None, page, "x")], "page_id long, url string, html string, text string")).first()
    assert got.text == text and got.url is None and got.n_chars == len(text)


def test_no_pages(spark):
    assert page_text.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# ---- quality classifier ---------------------------------------------------------------------


def test_classifier_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    learn, rest = labels.where("doc_id % 3 > 0"), labels.where("doc_id % 3 = 0")
    model = cotraining.fit_quality(docs, learn)
    scored = cotraining.score_quality(docs, model, ("doc_id",)).join(rest, "doc_id").collect()
    clean = [r.kept for r in scored if r.quality == 1 and r.toxic == 0]
    bad = [r.kept for r in scored if r.quality == 0]
    assert sum(clean) >= 0.985 * len(clean) and sum(bad) <= 0.1 * len(bad)
    again = cotraining.score_quality(docs, cotraining.fit_quality(docs, learn), ("doc_id",)).agg(F.sum("score")).first()[0]
    assert again == pytest.approx(cotraining.score_quality(docs, model, ("doc_id",)).agg(F.sum("score")).first()[0])


def test_classifier_on_awkward_rows(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, None), (2, None, None), (None, 1, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    model = cotraining.fit_quality(docs, labels)
    assert cotraining.score_quality(docs, model, tuple(docs.columns)).count() == docs.count()
    empty = cotraining.fit_quality(none, labels.limit(0))
    assert cotraining.score_quality(docs, empty, ("doc_id", "kept"), only_kept=True).count() == docs.count()
    assert cotraining.score_quality(none, empty, ("doc_id",)).count() == 0


# ---- SentencePiece --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pieces():
    import public_tokenizers

    return open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()


@pytest.mark.parametrize("which", ["given", "docs"])
def test_sentencepiece(request, which, pieces):
    from sentencepiece import SentencePieceProcessor

    rows = request.getfixturevalue(which)
    library = SentencePieceProcessor(model_proto=pieces)
    got = [(r.doc_id, r.ids, r.decoded) for r in sentencepieces.encode(rows, pieces).collect()]
    want = [(i, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t in pairs(rows)]
    same(got, want)


def test_piece_spans(spark, pieces):
    text = "Hello  wörld 日本 🙂 ½\n end "
    row = sentencepieces.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), pieces).first()
    raw, model = text.encode(), sentencepieces.model(pieces)
    for k, a, b in zip(row.ids, row.starts, row.ends):
        piece = model.library.id_to_piece(k)
        if not piece.startswith("<0x"):
            assert raw[a:b].decode().replace(" ", "▁") in (piece, piece[1:])
    assert row.ends[-1] == len(raw)
    slow = model.encode(text)
    assert [slow[k].tolist() for k in range(3)] == [row.ids, row.starts, row.ends]


def test_character_map(pieces):
    """Longest prefixes win, and each normalised character keeps its place in the source."""
    model = sentencepieces.Model(pieces)
    model.rules = {"ﬁ": "fi", "A": "a", "AE": "ä", "\t": " "}
    model.heads = {"ﬁ": [1], "A": [2, 1], "\t": [1]}
    normal, starts = model.normalise("ﬁAEA\tx")
    assert normal == "▁fiäa▁x" and starts.tolist() == [0, 0, 0, 3, 5, 6, 7, 8]


def test_compiled_map_round_trip():
    """A small double-array trie, built by hand: 'a' gives 'b', 'ac' gives 'd'."""
    import struct

    units = [0] * 2048
    units[0] = 256 << 10
    a = 256 ^ ord("a")
    units[a] = (512 ^ a) << 10 | 0x100 | ord("a")
    units[512] = 1 << 31 | 0
    c = 512 ^ ord("c")
    units[c] = (1024 ^ c) << 10 | 0x100 | ord("c")
    units[1024] = 1 << 31 | 2
    blob = struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + b"b\0d\0"
    assert sentencepieces.char_map(blob) == {"a": "b", "ac": "d"}
    assert sentencepieces.char_map(b"") == {}


# ---- token counts ---------------------------------------------------------------------------


@pytest.mark.parametrize("which", ["given", "docs"])
def test_token_counts(request, which):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = request.getfixturevalue(which)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = [tuple(r) for r in token_counts.count_tokens(rows, open(path, encoding="utf-8").read()).collect()]
    want = []
    for i, t in pairs(rows):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 1024))
    same(got, want)


# ---- near duplicates ------------------------------------------------------------------------


@pytest.mark.parametrize("which, width, percent", [("given", 3, 85), ("docs", 3, 85), ("docs", 5, 80)])
def test_near_duplicates(request, which, width, percent):
    frame = request.getfixturevalue(which)
    rows = pairs(frame)
    sets, roots = brute.components(rows, width, percent)
    least = {}
    for (i, _), s, r in zip(rows, sets, roots):
        if s and i is not None:
            least[r] = min(least.get(r, i), i)
    want = [(i, len(s), least.get(r) if s else i) for (i, _), s, r in zip(rows, sets, roots)]
    got = [(r.id, r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(frame, width=width, percent=percent).collect()]
    same(got, want)


def test_crowded_regions(spark, monkeypatch):
    """A star of near copies that is larger than a comparison holds."""
    monkeypatch.setattr(near_dedup, "NODES", 16)
    monkeypatch.setattr(near_dedup, "CHUNK", 8)
    rng, base = random.Random(5), base_text(150, 9).split()
    rows = [(0, " ".join(base))]
    for i in range(1, 120):
        w = list(base)
        for _ in range(rng.randrange(1, 5)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    _, roots = brute.components(rows, 3, 85)
    want = [min(i for (i, _), x in zip(rows, roots) if x == r) for r in roots]
    got = {r.id: r.component_id for r in near_dedup.near_duplicates(frame, width=3, percent=85).collect()}
    assert [got[i] for i, _ in rows] == want


def test_crowded_mesh(spark, monkeypatch):
    """Pages of one template, no two of them similar, with planted pairs just above the threshold."""
    monkeypatch.setattr(near_dedup, "NODES", 16)
    monkeypatch.setattr(near_dedup, "CHUNK", 8)
    template = [f"t{k}" for k in range(910)]
    pages = [[*template, *(f"p{i}n{k}" for k in range(90))] for i in range(400)]
    rows = [(i, " ".join(w)) for i, w in enumerate(pages)]
    rows += [(10_000 + i, " ".join([*pages[i][:920], *(f"e{i}n{k}" for k in range(80))])) for i in range(60)]
    sets = [brute.shingles(t, 3) for _, t in rows]
    alike = [len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i, j in ((0, 400), (0, 1), (400, 401), (0, 401))]
    assert 0.85 < alike[0] < 0.86 and max(alike[1:]) < 0.85
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r.id: r.component_id for r in near_dedup.near_duplicates(frame, width=3, percent=85).collect()}
    assert got == {i: i - 10_000 if i >= 10_000 else i for i, _ in rows}


def test_one_of_each(docs, none):
    kept = near_dedup.one_of_each(docs)
    assert kept.columns == docs.columns and near_dedup.one_of_each(none).count() == 0
    ids = [r.doc_id for r in kept.collect()]
    assert 3 in ids and not {4, 5} & set(ids) and ids.count(13) == 2 and ids.count(17) == 1 and {6, 7, 8} <= set(ids)


# ---- source mix -----------------------------------------------------------------------------


@pytest.mark.parametrize("which", ["given", "docs"])
def test_source_mix(request, which):
    frame = request.getfixturevalue(which)
    rows = source_mixing.mix_sources(frame).collect()
    assert len(rows) == frame.count()
    names = sorted({r.source for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = {s: sum(r.size for r in rows if r.source == s) for s in names}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    budget, target, free = 1.5 * sum(sizes.values()), {}, set(names)
    while True:  # share what is left, cap, share again
        each = (budget - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if each * weight[s] > 2 * sizes[s]}
        if not over:
            break
        target |= {s: 2 * sizes[s] for s in over}
        free -= over
    target |= {s: each * weight[s] for s in free}
    for s in names:
        mine = [r for r in rows if r.source == s]
        assert {round(r.target, 6) for r in mine} == {round(target[s], 6)} and {r.source_size for r in mine} == {sizes[s]}
        assert abs(sum(r.size * r.copies for r in mine) - target[s]) <= max(r.size for r in mine)
        assert all(0 <= r.copies <= 2 for r in mine)
    again = source_mixing.mix_sources(frame.repartition(5)).collect()
    same([(r.id, r.size, r.copies) for r in rows], [(r.id, r.size, r.copies) for r in again])


def test_source_mix_tree(given, monkeypatch):
    """Many chunks and levels of the reduction tree still meet the targets."""
    monkeypatch.setattr(source_mixing, "CHUNK", 2)
    monkeypatch.setattr(source_mixing, "FAN_IN", 2)
    rows = source_mixing.mix_sources(given).collect()
    for s in {r.source for r in rows}:
        mine = [r for r in rows if r.source == s]
        assert abs(sum(r.size * r.copies for r in mine) - mine[0].target) <= max(r.size for r in mine)


def test_mixed_documents(docs, none):
    mixed = source_mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    want = sum(r.copies for r in source_mixing.mix_sources(docs).collect())
    assert mixed.count() == want and source_mixing.mixed_documents(none).count() == 0


# ---- quality rules --------------------------------------------------------------------------


@pytest.mark.parametrize("which", ["given", "docs"])
def test_quality_rules(request, which):
    frame = request.getfixturevalue(which)
    rows = text_rules.quality_rules(frame).collect()
    want = []
    for i, t in pairs(frame):
        n = brute.base_counts(t)
        want.append((i, *n, n[0] < 10 or 100 * n[4] > 20 * n[0]))
    same([tuple(r)[:7] for r in rows], want)
    assert not any(r.kept for r in rows if r.base_failed)


def test_quality_rules_reject_other_looks(spark, given):
    clean = given.limit(60).select("doc_id", "text", F.lit("en").alias("lang"))
    odd = clean.limit(3).select((F.col("doc_id") + 10**6).alias("doc_id"), F.upper("text").alias("text"), "lang").where("length(text) > 400")
    rows = text_rules.quality_rules(clean.unionByName(odd)).collect()
    assert not any(r.kept for r in rows if r.doc_id >= 10**6)


def test_quality_rules_are_native(given, none):
    plan = text_rules.quality_rules(given)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert text_rules.quality_rules(none).count() == 0


# ---- repeated passages ----------------------------------------------------------------------


@pytest.mark.parametrize("which, together", [("given", 20_000), ("docs", 20_000), ("docs", 0)])
def test_repeated_passages(request, which, together, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    frame = request.getfixturevalue(which)
    rows = pairs(frame)
    want = [(i, *x) for (i, _), x in zip(rows, brute.passages([t for _, t in rows], 400))]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.repeated_passages(frame).collect()]
    same(got, want)


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STEP_BYTES", 1000)
    rows = [(1, base_text(1500, 1)), (2, base_text(300, 2) + base_text(1500, 1)[200:3000] + base_text(300, 3)), (3, base_text(200, 4))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.repeated_passages(frame).collect()}
    assert [got[i] for i, _ in rows] == brute.passages([t for _, t in rows], 400)


def test_repeated_passages_of_no_rows(none):
    assert suffix_dedup.repeated_passages(none).count() == 0


# ---- licence scans --------------------------------------------------------------------------


def plain_licenses(text, least=0.8):
    """Best likeness over all stretches and templates, and the licences that reach the bound."""
    import re

    from shipreport.llm import license_scan

    def grams(t):
        w = re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        return list(zip(w, w[1:]))

    best, mine = 0.0, grams(text or "")
    for _, template in license_scan.templates():
        want = set(grams(template))
        high = int(len(want) * (2 - least) / least + 1e-9)
        for i in range(len(mine)):
            for j in range(i + 1, min(len(mine), i + high) + 1):
                have = set(mine[i:j])
                best = max(best, 2 * len(have & want) / (len(have) + len(want)))
    return best if best >= least else None


def test_license_scan(spark, docs, none):
    from shipreport.llm import license_scan

    lines = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "ALL RIGHTS\nRESERVED", "Licensed under CC BY-NC 4.0.",
             "This work is licensed under the GNU General Public License, version 3.", "This work is licensed under the GNU General Public License, version 2.",
             "this work was licensed under the apache license version 2 0", "license to drive under the bridge", "rights reserved", None, ""]
    texts = [(i, None if t is None else f"{base_text(20, i)} {t} {base_text(15, i + 50)}" if t else t) for i, t in enumerate(lines)]
    texts += [(20, " ".join(lines[:5])), (21, lines[1] * 3)]
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert [got[i].license for i in range(8)] == ["Apache-2.0", "MIT", "All-Rights-Reserved", "CC-BY-NC-4.0", "GPL-3.0", "GPL-2.0", "Apache-2.0", None]
    for i, t in texts:
        want = plain_licenses(t)
        assert got[i].score == (None if want is None else pytest.approx(want))
    assert {m.license for m in got[20].matches} == {"Apache-2.0", "MIT", "All-Rights-Reserved", "CC-BY-NC-4.0", "GPL-3.0"}
    assert license_scan.scan_licenses(docs).count() == docs.count() and license_scan.scan_licenses(none).count() == 0


def test_license_scan_of_other_wordings(spark):
    """Statements, versions, SPDX lines and whole texts that the few statement forms miss or take for another version."""
    from shipreport.llm import license_scan

    want = {"Distributed under the MIT License": "MIT", "The MIT License (MIT)": "MIT", "This project is available under the MIT License": "MIT", "SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
            "SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL-2.1", "Licensed under GPLv3": "GPL-3.0", "we use the GNU Lesser General Public License v2.1 here": "LGPL-2.1", "ISC License": "ISC",
            "Licensed under the GNU General Public License": "GPL", "This work is licensed under a Creative Commons Attribution 3.0 International License": "CC-BY-3.0", "Licensed under the Apache License, Version 1.1": "Apache-1.1",
            "the Eclipse Public License v2.0": "EPL-2.0", "a public road under the bridge is free": None}
    rows = [(i, f"{base_text(20, i)} {t} {base_text(15, i + 50)}") for i, t in enumerate(want)]
    bodies = sorted(license_scan.BODIES.glob("*.txt"))
    for k, path in enumerate(bodies):  # each with a word changed
        text = path.read_text().split()
        text[len(text) // 3] = "changed"
        rows.append((100 + k, f"{base_text(20, k)} {' '.join(text)} {base_text(20, k + 9)}"))
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert [got[i].license for i in range(len(want))] == list(want.values())
    for k, path in enumerate(bodies):
        assert (got[100 + k].license, len(got[100 + k].matches)) == (path.stem, 1), path.stem
        assert got[100 + k].matches[0].n_words > 0.9 * len(path.read_text().split())
