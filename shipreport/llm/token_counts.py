"""Token counts with a whole-token shortcut.

Once a worker, every vocabulary string is merged alone; those that come out as one token are
kept by hash. A text is cut into pre-tokens with array operations; a pre-token whose hash is
among them counts 1 at once, and only the distinct others are merged.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .common import STEP_BYTES, Hasher, documents, query, ship_code

#: Counts of merged pre-tokens one worker keeps; a full cache starts anew.
CACHE = 1_000_000
LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
#: What the byte-level pattern splits off after a word.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(shown)))
    return [letters[b] for b in range(256)]


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for kind, value in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", SPACE)):
        for run in regex.finditer(kind, every):
            table[ord(run.group()[0]) : ord(run.group()[-1]) + 1] = value
    return table


def pre_token_starts(points: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the byte-level pattern starts its pre-tokens; begins: the first character of each text.

    A run of letters, of numbers or of other characters is one pre-token and takes the one
    blank before it along. Of a run of white space before a text goes on, the last character
    stands apart from the rest. 's, 't, 're, 've, 'm, 'll and 'd split off where ' opens a run.
    """
    n = len(points)
    kind = classes()[points]
    head = np.zeros(n + 1, bool)
    head[begins] = True
    head[n] = True
    run = head.copy()
    run[1:n] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    last = space & run[1:] & ~head[1:]  # the last of a run with a text going on
    starts = run[:n] | last
    joins = last & (points == 32)
    starts[1:] &= ~joins[:-1]
    quote = np.flatnonzero((points == 39) & run[:n])
    quote = quote[(quote == 0) | head[quote] | ~joins[np.maximum(quote - 1, 0)]]
    left = np.ones(len(quote), bool)
    for word in CONTRACTIONS:
        end = quote + 1 + len(word)
        hit = left & (end <= n)
        for k, c in enumerate(word, 1):
            at = np.minimum(quote + k, n - 1)
            hit &= (points[at] == ord(c)) & ~head[at]
        left &= ~hit
        starts[quote[hit] + 1] = False
        after = end[hit]
        after = after[after < n]
        starts[after[kind[after] == LETTER]] = True
    return np.flatnonzero(starts)


class Counter:
    """Counts the tokens of whole texts as the tokenizer file says."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        parsed = json.loads(spec)
        before = parsed.get("pre_tokenizer") or {}
        if parsed["model"].get("type") != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or parsed.get("normalizer"):
            raise ValueError("a byte-level BPE tokenizer without normaliser or added first space is needed")
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(byte_letters())})
        self.bpe = Tokenizer.from_str(spec).model
        special = sorted((t["content"] for t in parsed.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        back = {c: b for b, c in enumerate(byte_letters())}
        whole = [bytes(back[c] for c in piece) for piece in parsed["model"]["vocab"]
                 if all(c in back for c in piece) and len(self.bpe.tokenize(piece)) == 1]
        ends = np.cumsum([len(w) for w in whole])
        self.whole = np.sort(Hasher(np.frombuffer(b"".join(whole), np.uint8))(np.concatenate([[0], ends[:-1]]), ends))
        self.merged: dict[int, int] = {}

    def rest(self, hashes: np.ndarray, at: np.ndarray, end: np.ndarray, raw: bytes) -> np.ndarray:
        """Counts of distinct pre-tokens that are no whole token."""
        if len(self.merged) > CACHE:
            self.merged.clear()
        out = np.empty(len(hashes), np.int64)
        for i, h in enumerate(hashes.tolist()):
            n = self.merged.get(h)
            if n is None:
                n = self.merged[h] = len(self.bpe.tokenize(raw[at[i] : end[i]].decode("latin-1").translate(self.letters)))
            out[i] = n
        return out

    def __call__(self, texts: list[str]) -> np.ndarray:
        """The token count of each text; special strings are one token each."""
        counts = np.zeros(len(texts), np.int64)
        parts, owner = [], []
        for row, text in enumerate(texts):
            if self.special is not None and self.special.search(text):
                pieces = self.special.split(text)
                counts[row] += len(pieces) - 1
            else:
                pieces = [text]
            parts += [p for p in pieces if p]
            owner += [row] * sum(map(bool, pieces))
        joined = "".join(parts)
        if not joined:
            return counts
        raw = joined.encode()
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        first = np.cumsum([0] + [len(p) for p in parts[:-1]])
        starts = pre_token_starts(points, first)
        place = np.zeros(len(points) + 1, np.int64)
        np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF), out=place[1:])
        at = place[starts]
        end = np.append(at[1:], len(raw))
        hashes = Hasher(np.frombuffer(raw, np.uint8))(at, end)
        found = np.minimum(np.searchsorted(self.whole, hashes), len(self.whole) - 1)
        n = np.ones(len(starts), np.int64)
        other = np.flatnonzero(self.whole[found] != hashes)
        distinct, where, back = np.unique(hashes[other], return_index=True, return_inverse=True)
        n[other] = self.rest(distinct, at[other][where], end[other][where], raw)[back]
        rows = np.asarray(owner)[np.searchsorted(first, starts, "right") - 1]
        return counts + np.bincount(rows, n, len(texts)).astype(np.int64)


@lru_cache(maxsize=2)
def counter(spec: str) -> Counter:
    return Counter(spec)


def count_tokens(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row.

    spec: the text of a tokenizer.json of a byte-level BPE. Special strings inside a text are
    one token each, as the library does by default; no begin or end tokens are added.
    Nulls and empty texts have 0 bytes and tokens. A null id stays null, repeated rows and
    ids come out once a row, an empty table gives no rows; other columns are not read.
    A text is counted whole, in one task; memory is bounded by the longest text.
    """
    ship_code(docs.sparkSession)
    schema = StructType([StructField(id_col, docs.schema[id_col].dataType), StructField("n_bytes", LongType()),
                         StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(spec)
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
            total, row, n = np.cumsum(sizes), 0, []
            while row < len(sizes):
                done = total[row - 1] if row else 0
                end = max(row + 1, int(np.searchsorted(total, done + STEP_BYTES, "right")))
                n.append(count(batch.column(1).slice(row, end - row).to_pylist()))
                row = end
            n = np.concatenate(n) if n else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(n), pa.array(n > limit)], names=schema.names)

    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(docs[id_col], text.alias("text")).mapInArrow(run, schema)


@query("op5_token_counts")
def op5(spark, sf_dir):
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return count_tokens(documents(spark, sf_dir), file.read())
