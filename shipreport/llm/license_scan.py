"""Licence statements found by the Dice coefficient of word bigrams.

A text is normalised to its lower-case words (runs of letters and digits). A stretch of it and a
template are alike by twice the bigrams they share over the bigrams of both. A likeness of at
least `least` bounds the stretch's size by the template's, so only templates with enough of their
bigrams in a text are compared, and only on stretches within the bounds that begin and end with one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from .common import documents, mix, query, ship_code, steps, words

# Public licences by identifier, as statements name them. The names without a version
# stand beside those with one, so that the best likeness tells which of them a statement means.
NAMES = {
    "MIT": ["the MIT License"],
    "MIT-0": ["the MIT No Attribution License", "the MIT-0 License"],
    "BSD": ["the BSD License"],
    "0BSD": ["the 0BSD License", "the Zero-Clause BSD License", "the BSD Zero Clause License"],
    "ISC": ["the ISC License"],
    "Zlib": ["the zlib License", "the zlib/libpng License"],
    "Unlicense": ["the Unlicense License"],
    "All-Rights-Reserved": [],
}
#: Names that mean a licence only in a statement: short, or words of other uses.
SHORT = {
    "MIT": ["MIT"], "MIT-0": ["MIT-0"], "BSD": ["BSD"], "0BSD": ["0BSD"], "ISC": ["ISC"], "Zlib": ["zlib"], "Unlicense": ["Unlicense", "the Unlicense"],
}
#: Identifier without version: names, names that need a statement, versions.
VERSIONED = {
    "Apache": (["the Apache License", "the Apache Software License"], ["Apache"], ["1.0", "1.1", "2.0"]),
    "GPL": (["the GNU General Public License", "the GNU GPL"], ["the GPL", "GPL"], ["1.0", "2.0", "3.0"]),
    "LGPL": (["the GNU Lesser General Public License", "the GNU Library General Public License", "the GNU LGPL"], ["the LGPL", "LGPL"], ["2.0", "2.1", "3.0"]),
    "AGPL": (["the GNU Affero General Public License", "the Affero General Public License", "the GNU AGPL"], ["the AGPL", "AGPL"], ["1.0", "3.0"]),
    "GFDL": (["the GNU Free Documentation License", "the GNU FDL"], ["GFDL"], ["1.1", "1.2", "1.3"]),
    "MPL": (["the Mozilla Public License"], ["the MPL", "MPL"], ["1.0", "1.1", "2.0"]),
    "EPL": (["the Eclipse Public License"], ["the EPL", "EPL"], ["1.0", "2.0"]),
    "BSL": (["the Boost Software License"], ["Boost"], ["1.0"]),
    "Artistic": (["the Artistic License"], [], ["1.0", "2.0"]),
}
BSD_CLAUSES = {"2": ("two", "simplified"), "3": ("three", "new", "modified", "revised"), "4": ("four", "original")}
CC_PARTS = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
CC_KINDS = ["BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"]
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
# How statements go, and notices with wordings of their own.
FORMS = ["Licensed under {}", "Released under {}", "This work is licensed under {}", "Distributed under the terms of {}"]
MORE_FORMS = ["Distributed under {}", "Available under {}", "Licensed under the terms of {}", "Released under the terms of {}", "License: {}", "Licence: {}"]
NOTICES = {
    "All-Rights-Reserved": ["All rights reserved."],
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "The MIT License (MIT)"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
                   "See the License for the specific language governing permissions and limitations under the License."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "EPL-1.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
}
#: GNU licences by their header's name and version.
GNU = {
    "GPL-1.0": ("General", "1"), "GPL-2.0": ("General", "2"), "GPL-3.0": ("General", "3"), "LGPL-2.0": ("Library General", "2"),
    "LGPL-2.1": ("Lesser General", "2.1"), "LGPL-3.0": ("Lesser General", "3"), "AGPL-3.0": ("Affero General", "3"),
}
GRANT = "you can redistribute it and/or modify it under the terms of {}"
LATER = "the GNU {} Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version"
ONLY = ["the GNU {} Public License as published by the Free Software Foundation, version {} of the License", "the GNU {} Public License version {} as published by the Free Software Foundation",
        "version {1} of the GNU {0} Public License as published by the Free Software Foundation"]
HEADER = ("This program is free software: {}. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
          "FITNESS FOR A PARTICULAR PURPOSE. See the GNU {} Public License for more details.")
#: Bigrams from which a template is a header, and from which it is a whole text: what lies inside of a larger kind is part of it.
KINDS = (40, 85)
BODIES = Path(__file__).resolve().parent / "licenses"


def version_names(name: str, version: str) -> list[str]:
    """The ways to write a name with its version."""
    short = version.removesuffix(".0")
    written = [version] if short == version else [short, version]
    return [f"{name}{link}{v}" for v in written for link in (" ", ", version ", " v")]


def licence_names() -> tuple[dict[str, list[str]], dict[str, list[str]]]:
    """Names that stand for themselves and names that need a statement, by licence."""
    plain, short = {k: list(v) for k, v in NAMES.items()}, {k: list(v) for k, v in SHORT.items()}
    for family, (names, shorts, versions) in VERSIONED.items():
        plain[family], short[family] = list(names), list(shorts)
        for v in versions:
            key = f"{family}-{v}"
            mine = [n for n in names if not (("Library" in n and v != "2.0") or ("Lesser" in n and v == "2.0"))]
            plain[key] = [x for n in mine for x in version_names(n, v)]
            short[key] = [x for n in shorts for x in [*version_names(n, v), f"{n}v{v}", f"{n}v{v.removesuffix('.0')}"]]
    for n, others in BSD_CLAUSES.items():
        plain[f"BSD-{n}-Clause"] = [f"the BSD {n}-Clause License", f"the {n}-Clause BSD License", *(f"the {w}{'-clause' if i == 0 else ''} BSD License" for i, w in enumerate(others))]
        short[f"BSD-{n}-Clause"] = [f"BSD {n}-Clause"]
    for kind in CC_KINDS:
        full = "-".join(CC_PARTS[x] for x in kind.split("-"))
        plain[f"CC-{kind}"], short[f"CC-{kind}"] = [f"a Creative Commons {full} License"], [f"CC {kind}"]
        for v in CC_VERSIONS:
            whole = ["International"] if v == "4.0" else ["Unported", "Generic"]
            plain[f"CC-{kind}-{v}"] = [f"CC {kind} {v}", f"a Creative Commons {full} {v} License", f"Creative Commons {full} {v}", *(f"a Creative Commons {full} {v} {w} License" for w in whole)]
    plain["CC0-1.0"] = ["CC0 1.0", "the CC0 1.0 Universal Public Domain Dedication", "CC0 1.0 Universal"]
    short["CC0-1.0"] = ["CC0"]
    return plain, short


def spdx_names(licence: str) -> list[str]:
    """The SPDX identifiers of a licence."""
    if licence.split("-")[0] in ("GPL", "LGPL", "AGPL", "GFDL"):
        return [licence, f"{licence}-only", f"{licence}-or-later"]
    return [licence]


def templates() -> list[tuple[str, str]]:
    """(licence, text) of all templates: names in statements and by themselves, SPDX lines, notices, headers, whole texts."""
    plain, short = licence_names()
    bodies = {p.name.removesuffix(".txt"): p.read_text(encoding="utf-8") for p in sorted(BODIES.glob("*.txt"))}
    out = [(k, form.format(name)) for names, forms in ((plain, FORMS), (short, FORMS + MORE_FORMS)) for k, mine in names.items() for name in mine for form in forms]
    out += [(k, re.sub("^(the|an?) ", "", name)) for k, names in plain.items() for name in names]
    known = [k for k in dict.fromkeys([*plain, *short, *bodies]) if k not in VERSIONED and k not in ("BSD", "All-Rights-Reserved") and not k.removeprefix("CC-") in CC_KINDS]
    out += [(k, f"SPDX-License-Identifier: {name}") for k in known for name in spdx_names(k)]
    out += [(k, text) for k, texts in NOTICES.items() for text in texts]
    for k, at in GNU.items():
        for terms in [LATER, *ONLY]:
            grant = GRANT.format(terms.format(*at))
            out += [(k, grant), (k, HEADER.format(grant, at[0]))]
    return list(dict.fromkeys([*out, *bodies.items()]))


_GAPS = np.ones(256, bool)
_GAPS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def bigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, number in its row) of the word bigrams of a run of texts."""
    hashes, _, row = words(data, offsets, True, _GAPS)
    pair = np.flatnonzero(row[1:] == row[:-1])
    first = np.searchsorted(row, np.arange(len(offsets)))
    return mix(hashes[pair] * np.uint64(0x9E3779B97F4A7C15) + hashes[pair + 1]), row[pair], pair - first[row[pair]]


class Scanner:
    """The templates' bigrams and size bounds."""

    def __init__(self, given: list[tuple[str, str]], least: float):
        self.least, self.names, self.sets = least, [k for k, _ in given], []
        lengths = []
        for _, text in given:
            raw = np.frombuffer(text.encode(), np.uint8)
            mine = bigrams(raw, np.array([0, len(raw)]))[0].tolist()
            self.sets.append(set(mine))
            lengths.append(len(mine) if len(self.sets[-1]) > KINDS[0] else len(self.sets[-1]))  # long texts repeat bigrams
        self.all = np.array(sorted(set().union(*self.sets)), np.uint64)
        ratio = least / (2 - least)
        self.bounds = [(int(np.ceil(ratio * len(s) - 1e-9)), int(n / ratio + 1e-9)) for s, n in zip(self.sets, lengths)]
        self.need = np.array([least * (len(s) + low) / 2 - 1e-9 for s, (low, _) in zip(self.sets, self.bounds)])
        self.members = [np.searchsorted(self.all, np.fromiter(s, np.uint64, len(s))) for s in self.sets]
        bigram, owner = np.concatenate(self.members), np.repeat(np.arange(len(self.sets)), [len(s) for s in self.sets])
        order = np.argsort(bigram, kind="stable")
        #: The templates of bigram i of `all` are owner[first[i] : first[i + 1]].
        self.owner, self.first = owner[order], np.searchsorted(bigram[order], np.arange(len(self.all) + 1))

    def stretches(self, row: list[int], hits: list[int], k: int) -> list[tuple[float, int, int]]:
        """(likeness, first, end) of the stretches of a text that are like template k."""
        mine, (low, high) = self.sets[k], self.bounds[k]
        out = []
        for n, a in enumerate(hits):
            seen: set[int] = set()
            at, best = a, None
            for b in hits[n:]:
                if b - a + 1 > high:
                    break
                seen.update(row[at : b + 1])
                at = b + 1
                if len(seen) >= low:
                    dice = 2 * len(seen & mine) / (len(seen) + len(mine))
                    if dice >= self.least and (best is None or dice > best[0]):
                        best = (dice, a, b + 1)
            if best:
                out.append(best)
        return out

    def long_stretches(self, row: np.ndarray, hits: np.ndarray, k: int) -> list[tuple[float, int, int]]:
        """As stretches(), by running counts and with the longest of equal ones; starts with too few hits ahead are left out."""
        size, (low, high) = len(self.sets[k]), self.bounds[k]
        order = np.argsort(row, kind="stable")
        before = np.full(len(row), -1)
        again = np.flatnonzero(row[order[1:]] == row[order[:-1]])
        before[order[again + 1]] = order[again]
        mine = np.zeros(len(row), bool)
        mine[hits] = True
        ahead = np.searchsorted(hits, hits + high) - np.arange(len(hits))
        out = []
        for a in hits[ahead >= self.need[k]].tolist():
            new, here = before[a : a + high] < a, mine[a : a + high]
            ends = np.flatnonzero(here)
            have, shared = np.cumsum(new)[ends], np.cumsum(new & here)[ends]
            dice = np.where(have >= low, 2 * shared / (have + size), 0)
            best = len(dice) - 1 - int(np.argmax(dice[::-1]))
            if dice[best] >= self.least:
                out.append((float(dice[best]), a, a + int(ends[best]) + 1))
        return out

    def matches(self, row: np.ndarray, place: np.ndarray) -> list[tuple[str, float, int, int]]:
        """Licence, likeness, first word and number of words of the statements in a text, best first, none overlapping."""
        known = np.searchsorted(self.all, row[place])
        there = np.unique(known)
        counts = np.bincount(np.concatenate([self.owner[self.first[i] : self.first[i + 1]] for i in there]), minlength=len(self.sets))
        listed = row.tolist()
        found = []
        for k in np.flatnonzero(counts >= self.need).tolist():  # enough of the template is there at all
            own = np.zeros(len(self.all), bool)
            own[self.members[k]] = True
            hits = place[own[known]]
            kind = sum(len(self.sets[k]) > x for x in KINDS)
            near = self.long_stretches(row, hits, k) if kind else self.stretches(listed, hits.tolist(), k)
            found += [(-kind, -d, -len(self.sets[k]), a, self.names[k], b) for d, a, b in near]
        out, taken = [], []
        for _, d, size, a, name, b in sorted(found):
            if all(b <= x or a >= y for x, y in taken):
                taken.append((a, b))
                out.append((d, size, a, name, b - a + 1))
        return [(name, -d, a, n) for d, _, a, name, n in sorted(out)]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8, given: list[tuple[str, str]] | None = None) -> DataFrame:
    """(id, license, score, matches) of every row.

    matches: the statements found (license, score, first word, words), best first; license and
    score are those of the best. Equal scores prefer the longer template, then the earlier place,
    then the name. Whole texts take their stretch first, then headers (KINDS), then the rest, so a
    name inside of a licence's text is no statement of its own. Null, empty and short texts have none. Null ids stay null, repeated rows come
    out once a row, an empty table gives no rows; other columns are not read. One pass, no shuffle;
    a stretch is at most as long as the size bound of its template.
    """
    ship_code(docs.sparkSession)
    given = templates() if given is None else given
    match = StructType([StructField("license", StringType()), StructField("score", DoubleType()), StructField("first_word", IntegerType()), StructField("n_words", IntegerType())])
    schema = StructType([StructField(id_col, docs.schema[id_col].dataType), StructField("matches", ArrayType(match))])
    kinds = pa.struct([("license", pa.string()), ("score", pa.float64()), ("first_word", pa.int32()), ("n_words", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(given, least)
        for batch in batches:
            for start, end, data, offsets in steps(batch.column(1)):
                hashes, row, place = bigrams(data, offsets)
                hit = scanner.all[np.minimum(np.searchsorted(scanner.all, hashes), len(scanner.all) - 1)] == hashes
                out: list[list] = [[] for _ in range(end - start)]
                edge = np.searchsorted(row, np.arange(end - start + 1))
                for r in np.unique(row[hit]).tolist():
                    a, b = edge[r], edge[r + 1]
                    out[r] = [dict(zip(("license", "score", "first_word", "n_words"), m)) for m in scanner.matches(hashes[a:b], np.flatnonzero(hit[a:b]))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), pa.array(out, pa.list_(kinds))], names=schema.names)

    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    found = docs.select(docs[id_col], text.alias("_text")).mapInArrow(run, schema)
    best = F.get("matches", F.lit(0))
    return found.select(id_col, best["license"].alias("license"), best["score"].alias("score"), "matches")


@query("op9_license_scan")
def op9(spark, sf_dir):
    found = scan_licenses(documents(spark, sf_dir))
    return found.select("doc_id", "license", "score", F.size("matches").cast("long").alias("n_matches"), F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"]))), ",").alias("licenses"))
