"""SentencePiece BPE with the byte span of every piece.

A text is normalised by the longest prefix the model's compiled character map holds, and each
normalised character remembers the source bytes it came from. Pieces then project to spans of
the source. Pieces hold the space mark only at their front, so text falls into chunks (space
marks and what follows them) whose merges never meet; a chunk's pieces are computed once and kept.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import Hasher, documents, query, ship_code, steps

MARK = "▁"
#: Chunks whose pieces one worker keeps; a full cache starts anew.
CACHE = 400_000


def char_map(blob: bytes) -> dict[str, str]:
    """The rules of a compiled character map: a double-array trie of prefixes, then the replacements."""
    if not blob:
        return {}
    (size,) = struct.unpack_from("<I", blob)
    units, texts = np.frombuffer(blob, "<u4", size // 4, 4).tolist(), blob[4 + size :]
    shift = lambda unit: (unit >> 10) << ((unit & 0x200) >> 6)
    rules, open_nodes = {}, [(shift(units[0]), b"")]
    while open_nodes:
        node, prefix = open_nodes.pop()
        for byte in range(1, 256):
            child = node ^ byte
            if child >= len(units) or units[child] & 0x800000FF != byte:
                continue
            below = child ^ shift(units[child])
            if units[child] >> 8 & 1:
                at = units[below] & 0x7FFFFFFF
                rules[(prefix + bytes([byte])).decode("utf-8", "replace")] = texts[at : texts.index(b"\0", at)].decode()
            open_nodes.append((below, prefix + bytes([byte])))
    return rules


class Model:
    """A SentencePiece BPE model and the pieces of the chunks met so far."""

    def __init__(self, blob: bytes):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(blob)
        spec = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or proto.trainer_spec.treat_whitespace_as_suffix or not spec.escape_whitespaces:
            raise ValueError("a BPE model with the space mark at the front is needed")
        if any(p.type in (4, 5) for p in proto.pieces) or any(MARK in p.piece.lstrip(MARK) for p in proto.pieces):
            raise ValueError("user-defined, unused or space-crossing pieces are not handled")
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == 1}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == 6}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == 2)
        self.rules, self.prefix, self.squeeze = char_map(spec.precompiled_charsmap), spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.heads: dict[str, list[int]] = {}
        for key in self.rules:
            self.heads.setdefault(key[0], []).append(len(key))
        self.heads = {k: sorted(set(v), reverse=True) for k, v in self.heads.items()}
        self.chunks = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall
        # Source bytes of a piece (a mark is one blank), and which pieces are bytes inside a character.
        self.widths = np.array([1 if p.type == 6 else len(p.piece.replace(MARK, " ").encode()) for p in proto.pieces])
        self.inner = np.array([p.type == 6 and 0x80 <= int(p.piece[3:5], 16) < 0xC0 for p in proto.pieces])
        self.cache: dict[int, tuple[int, int]] = {}
        self.kept, self.used = np.zeros((3, 1 << 16), np.int32), 0
        self.library = SentencePieceProcessor(model_proto=blob)

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and the source byte where each of its characters begins (with the end)."""
        out, starts, at, i = [], [], 0, 0
        while i < len(text):  # longest prefix of the map, else one character
            size = next((n for n in self.heads.get(text[i], ()) if text[i : i + n] in self.rules), 0)
            source = text[i : i + max(size, 1)]
            for c in self.rules[source] if size else source:
                out.append(c)
                starts.append(at)
            at += len(source.encode())
            i += len(source)
        end = at
        if self.squeeze:
            keep = [k for k, c in enumerate(out) if c != " " or (k and out[k - 1] != " ")]
            while keep and out[keep[-1]] == " ":
                end = starts[keep.pop()]
            out, starts = [out[k] for k in keep], [starts[k] for k in keep]
        if not out:
            return "", np.zeros(1, np.int64)
        first = [starts[0]] if self.prefix else []
        return (MARK if self.prefix else "") + "".join(out).replace(" ", MARK), np.array(first + starts + [end], np.int64)

    def merged(self, chunk: str) -> list[str]:
        """The chunk's pieces: the best-scored neighbours are joined first, the leftmost among equals."""
        scores, parts = self.scores, list(chunk)
        if len(parts) <= 48:
            while len(parts) > 1:
                best, at = None, -1
                for i in range(len(parts) - 1):
                    s = scores.get(parts[i] + parts[i + 1])
                    if s is not None and (best is None or s > best):
                        best, at = s, i
                if at < 0:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            return parts
        left, right = [*range(-1, len(parts) - 1)], [*range(1, len(parts)), -1]
        heap = [(-s, i, x) for i in range(len(parts) - 1) if (s := scores.get(x := parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, x = heapq.heappop(heap)
            j = right[i]
            if not parts[i] or j < 0 or parts[i] + parts[j] != x:
                continue
            parts[i], parts[j], right[i] = x, "", right[j]
            if right[i] >= 0:
                left[right[i]] = i
            for k in (left[i], i):
                if k >= 0 and right[k] >= 0 and (s := scores.get(y := parts[k] + parts[right[k]])) is not None:
                    heapq.heappush(heap, (-s, k, y))
        return [p for p in parts if p]

    def pieces(self, chunk: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """Ids of the chunk's pieces and the normalised characters each covers; bytes for what no piece holds."""
        ids, sizes = [], []
        for piece in self.merged(chunk):
            known = self.ids.get(piece)
            if known is not None:
                ids.append(known)
                sizes.append(len(piece))
            elif self.bytes:
                raw = piece.encode()
                ids += [self.bytes[b] for b in raw]
                sizes += [0] * (len(raw) - 1) + [len(piece)]  # the last byte carries the character
            else:
                ids.append(self.unknown)
                sizes.append(len(piece))
        return tuple(ids), tuple(sizes)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the first and end source byte of each; the byte pieces of one character share its span."""
        normal, starts = self.normalise(text)
        pieces = [self.pieces(c) for c in self.chunks(normal)]
        ids = np.fromiter(chain.from_iterable(p[0] for p in pieces), np.int64)
        sizes = np.fromiter(chain.from_iterable(p[1] for p in pieces), np.int64)
        ends = np.cumsum(sizes)
        begin = ends - sizes
        solid = np.flatnonzero(sizes)
        if len(solid) < len(sizes):  # a byte piece lies in the character that its last byte carries
            ends = ends[solid[np.searchsorted(solid, np.arange(len(sizes)))]]
        return ids, starts[begin], starts[ends]

    def add(self, hashes: list[int], raw: list[bytes]) -> None:
        """Keep ids and byte spans of chunks no rule touches; each opens with a blank, which is its mark."""
        found = self.library.encode([c[1:].decode() for c in raw], num_threads=1)
        if b" " in raw:  # a mark alone, which the library puts before a text only
            found[raw.index(b" ")] = list(self.pieces(MARK)[0])
        n = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.int64, int(n.sum()))
        first = np.cumsum(n) - n
        ends = np.cumsum(self.widths[ids])
        begin = ends - self.widths[ids]
        zero = np.repeat(begin[first], n)
        if (inner := self.inner[ids]).any():  # the bytes of one character share its span
            k = np.arange(len(ids))
            lead = np.maximum.accumulate(np.where(inner, -1, k))
            tail = np.minimum.accumulate(np.where(np.append(inner[1:], False), len(ids), k)[::-1])[::-1]
            begin, ends = begin[lead], ends[tail]
        where = self.used + first
        need = self.used + len(ids)
        if need > self.kept.shape[1]:
            self.kept = np.concatenate([self.kept, np.zeros((3, need), np.int32)], axis=1)
        self.kept[:, self.used : need] = ids, begin - zero, ends - zero
        self.used = need
        self.cache.update(zip(hashes, zip(where.tolist(), n.tolist())))

    def encode_all(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, ends, ids of each row) of a run of rows.

        Without rules every blank is one space mark and every other byte stays, so the pieces of
        a chunk depend on its bytes alone and are looked up by hash.
        """
        raw = data.tobytes()
        if self.rules or self.squeeze or not self.prefix or not self.bytes or MARK.encode() in raw:
            rows = [self.encode(raw[a:b].decode()) for a, b in zip(offsets[:-1], offsets[1:])]
            parts = [np.concatenate([r[k] for r in rows]).astype(np.int64) for k in range(3)]
            return (*parts, np.array([len(r[0]) for r in rows]))
        live = np.flatnonzero(offsets[1:] > offsets[:-1])
        spaced = np.insert(data, offsets[live], 32)  # the mark before each text
        head = offsets[live] + np.arange(len(live))
        start = np.zeros(len(spaced), bool)
        start[1:] = (spaced[1:] == 32) & (spaced[:-1] != 32)
        start[head] = True
        at = np.flatnonzero(start)
        end = np.append(at[1:], len(spaced))
        distinct, where, back = np.unique(Hasher(spaced)(at, end), return_index=True, return_inverse=True)
        if len(self.cache) > CACHE:
            self.cache.clear()
            self.used = 0
        keys = distinct.tolist()
        missing = [i for i, h in enumerate(keys) if h not in self.cache]
        text = spaced.tobytes()
        self.add([keys[i] for i in missing], [text[at[where[i]] : end[where[i]]] for i in missing])
        place = np.array([self.cache[h] for h in keys], np.int64).reshape(-1, 2)
        each = place[back, 1]
        total = np.cumsum(each)
        take = np.arange(total[-1] if len(total) else 0) + np.repeat(place[back, 0] - (total - each), each)
        ids, begins, ends = self.kept[:, take]
        row = np.searchsorted(head, at, "right") - 1
        base = np.repeat(at - head[row] - 1, each)  # chunk start in its source text
        counts = np.zeros(len(offsets) - 1, np.int64)
        counts[live] = np.bincount(row, each, len(live)).astype(np.int64)
        return ids, np.maximum(base + begins, 0), np.maximum(base + ends, 0), counts


@lru_cache(maxsize=2)
def model(blob: bytes) -> Model:
    return Model(blob)


def encode(docs: DataFrame, blob: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, starts, ends, decoded) of every row: token ids, the source byte span of each, and decode(ids).

    blob: the bytes of a SentencePiece BPE model. No begin or end ids, no sampling.
    Nulls and empty texts have no ids and decode to an empty text. A null id stays null, repeated
    rows and ids come out once a row, an empty table gives no rows; other columns are not read.
    A text is handled whole; memory is bounded by the longest one.
    """
    ship_code(docs.sparkSession)
    schema = StructType([StructField(id_col, docs.schema[id_col].dataType), StructField("ids", ArrayType(IntegerType())),
                         StructField("starts", ArrayType(LongType())), StructField("ends", ArrayType(LongType())), StructField("decoded", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(blob)
        for batch in batches:
            for row, end, data, offsets in steps(batch.column(1)):
                ids, starts, ends, n = m.encode_all(data, offsets)
                edges = np.concatenate([[0], np.cumsum(n)])
                flat = ids.tolist()
                decoded = m.library.decode([flat[a:b] for a, b in zip(edges[:-1], edges[1:])], num_threads=1)
                lists = [pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(x.astype(kind))) for x, kind in ((ids, np.int32), (starts, np.int64), (ends, np.int64))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), *lists, pa.array(decoded, pa.string())], names=schema.names)

    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(docs[id_col], text.alias("text")).mapInArrow(run, schema)


@query("op4_sentencepiece")
def op4(spark, sf_dir):
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        coded = encode(documents(spark, sf_dir), file.read())
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
