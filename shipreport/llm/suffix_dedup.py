"""Removal of passages that occur twice, by prefix doubling over sampled positions.

A position's rank is a name of the bytes that follow. Names of 64 bytes pair up at offsets 64, 128
and 144 into names of 128, 256 and 400 bytes. Sorting pairs of all positions would move hundreds
of times the input, so Spark ranks positions in two steps only, and each drops what is unique:

1. Every start p picks an anchor: the smallest 64-byte name in the WINDOW positions from p on,
   which depends on the first 255 of the 400 bytes alone. Starts with one anchor are a segment,
   one row. Equal 400-byte strings have equal anchors at equal distances, so a segment whose
   anchor's name is unique is done.
2. Segments whose whole bytes, up to 400 past their last start, have the same name have only
   repeated starts. The others are compared start by start on names of 400 bytes, among segments
   with the same anchor name, each distinct repeated segment standing for all its copies.

Passages can be counted in words instead: every task then puts CODE bytes of each word's hash in the
place of the text, so that the same steps run over words whatever their length and the gaps between.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import STEP_BYTES, Hasher, documents, keyed, mix, query, ship_code, steps, stored, text_buffer, words

#: Bytes of a first name, and positions a start looks over for its anchor.
GRAM, WINDOW = 64, 192
#: Segments with one anchor name that one task compares; more are compared by a row for each start.
TOGETHER = 20_000
#: Bytes of a word's hash that stand for it in passages of words.
CODE = 6

#: What passages are looked for in: the bytes of a column of texts and the offsets of its rows in them.
View = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]

SEGMENT = "d long, t long, s long, e long, a long, anchor long, content long"
CONTEXT = "anchor long, d long, t long, s long, a long, kind int, bytes binary"
RUN = "d long, t long, first long, final long"


def word_places(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every word, its first byte in its text, offsets of the rows in the words)."""
    hashes, starts, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
    for _, _, data, offsets in steps(column):
        name, start, row = words(data, offsets, lower=False)
        hashes.append(name)
        starts.append(start - offsets[row])
        counts.append(np.bincount(row, minlength=len(offsets) - 1))
    return np.concatenate(hashes), np.concatenate(starts), np.cumsum(np.concatenate(counts))


def word_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """CODE bytes for every word of the texts, and the offsets of the rows in them."""
    hashes, _, at = word_places(column)
    return hashes.view(np.uint8).reshape(-1, 8)[:, :CODE].ravel(), at * CODE


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every `width` neighbours, by doubling."""
    size, low = 1, x
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    n = len(x) - width + 1
    return np.minimum(low[:n], low[width - size : width - size + n])


def names(hasher: Hasher, span: int) -> np.ndarray:
    """Names of the `span` bytes from each position on: pairs of shorter names at growing offsets."""
    name, size = hasher.windows(GRAM), GRAM
    while size < span:
        offset = min(size, span - size)
        name = mix(name[:-offset] * np.uint64(0x9E3779B97F4A7C15) + name[offset:])
        size += offset
    return name


def segments(data: np.ndarray, offsets: np.ndarray, span: int, most: int) -> tuple[np.ndarray, ...] | None:
    """(row, first, final, anchor, anchor name, content name) of the segments of a run of rows.

    All windows of a text of `span` bytes count, also those after its last start: an anchor in
    the end of one text may be one inside another. At most the first `most` windows are taken.
    """
    if len(data) < span:
        return None
    hasher = Hasher(data)
    gram = hasher.windows(GRAM)
    low = np.uint64((1 << 24) - 1)  # the name's last bits make room for the place, the rightmost first
    place = (gram & ~low) | (low - np.arange(len(gram), dtype=np.uint64))
    anchor = (low - (sliding_min(place, WINDOW) & low)).astype(np.int64)[:most]
    at = np.arange(len(anchor))
    row = np.searchsorted(offsets, at, "right") - 1
    take = np.flatnonzero((at + WINDOW + GRAM - 1 <= offsets[row + 1]) & (np.diff(offsets)[row] >= span))
    if not len(take):
        return None
    anchor, row = anchor[take], row[take]
    new = np.ones(len(take) + 1, bool)
    new[1:-1] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    edge = np.flatnonzero(new)
    first, final, row, anchor = take[edge[:-1]], take[edge[1:] - 1], row[edge[:-1]], anchor[edge[:-1]]
    end = np.maximum(np.minimum(final + span, offsets[row + 1]), first + GRAM)
    content = mix(hasher(first, end) + (anchor - first).astype(np.uint64))
    return row, first, final, anchor, gram[anchor], content


def pieces(column: pa.Array, span: int, view: View) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """(first row, byte of it, bytes, offsets, windows to take): runs of rows; a long row in overlapping pieces."""
    data, offsets = view(column)
    row = 0
    while row < len(offsets) - 1:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + STEP_BYTES, "right")) - 1)
        a, b = int(offsets[row]), int(offsets[end])
        if b - a <= 2 * STEP_BYTES:
            yield row, 0, data[a:b], offsets[row : end + 1] - a, b - a
        else:
            stops = [*range(a, b - STEP_BYTES, STEP_BYTES), b]
            for at, stop in zip(stops, stops[1:]):
                part = data[at : min(b, stop + span - 1)]
                yield row, at - a, part, np.array([0, len(part)]), stop - at
        row = end


def all_segments(rows: DataFrame, span: int, view: View) -> DataFrame:
    """The segments of all texts of `span` bytes and more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
            for row, shift, data, offsets, most in pieces(batch.column(2), span, view):
                found = segments(data, offsets, span, most)
                if found is None:
                    continue
                at, first, final, anchor, name, content = found
                zero = offsets[at] - shift
                at = at + row
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys[0][at], keys[1][at], first - zero, final - zero, anchor - zero, name.view(np.int64), content.view(np.int64))],
                                                 names=["d", "t", "s", "e", "a", "anchor", "content"])

    return rows.select("d", "t", "text").mapInArrow(run, SEGMENT)


def segment_lists(rows: DataFrame, span: int, view: View) -> DataFrame:
    """(d, t, list) of the segments that are not unique, with a kind.

    0: its starts are to be compared; 1: all its starts are repeated; 2: the same, and it stands
    for its copies in a comparison. `many` marks anchors with more segments than one task compares.
    """
    every = all_segments(rows, span, view)
    by_content = every.groupBy("anchor", "content").agg(F.count("*").alias("n"))
    by_anchor = by_content.groupBy("anchor").agg(F.sum("n").alias("total"), F.count_if(F.col("n") == 1).alias("single"), F.count("*").alias("kinds")).where("total > 1")
    ranked = by_content.join(by_anchor, "anchor").select("anchor", "content", (F.col("n") > 1).alias("again"), (F.col("single") > 0).alias("mixed"), (F.col("kinds") > TOGETHER).alias("many"))
    live = every.join(ranked, ["anchor", "content"]).withColumn("kind", F.col("again").cast("int"))
    live = stored(live.select("d", "t", "s", "e", "a", "anchor", "content", "kind", "mixed", "many"), "segments")
    stand = live.where("kind = 1 and mixed").groupBy("anchor", "content", "many").agg(F.min(F.struct("d", "t", "s", "e", "a")).alias("x"))
    stand = stand.select("x.*", "anchor", F.lit(2).alias("kind"), "many")
    both = live.select("d", "t", "s", "e", "a", "anchor", "kind", "many").unionByName(stand)
    return both.groupBy("d", "t").agg(F.collect_list(F.struct("s", "e", "a", "anchor", "kind", "many")).alias("list"))


def flat(column: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Offsets and numpy columns of a list of structs."""
    inner = column.flatten()
    offsets = np.concatenate([[0], np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
    return offsets, {inner.type.field(i).name: inner.field(i).to_numpy(zero_copy_only=False) for i in range(inner.type.num_fields)}


def open_segments(part: dict[str, np.ndarray], span: int) -> np.ndarray:
    """The last start of each segment of a document that can still be repeated, from its neighbours.

    A start needs every anchor of the windows inside its `span` bytes to be one that repeats.
    """
    order = np.lexsort((part["kind"] == 2, part["s"]))
    s, e = part["s"][order], part["e"][order].astype(np.int64)
    body = np.flatnonzero(part["kind"][order] != 2)
    edge = np.flatnonzero(np.append(s[body][1:] != e[body][:-1] + 1, [True] * (len(body) > 0)))
    run = edge[np.searchsorted(edge, np.arange(len(body)))]
    limit = e.copy()
    limit[body] = np.minimum(e[body], e[body][run] - (span - (WINDOW + GRAM - 1)))
    out = np.empty(len(s), np.int64)
    out[order] = limit
    return out


def contexts(joined: DataFrame, span: int, view: View, many: bool) -> DataFrame:
    """The bytes of every segment to compare, with its starts that can be repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = view(batch.column(2))
            offsets, part = flat(batch.column(3))
            out: list[tuple] = []
            size = 0
            for row in range(batch.num_rows):
                mine = {k: v[offsets[row] : offsets[row + 1]] for k, v in part.items()}
                limit = np.minimum(open_segments(mine, span), ends[row + 1] - ends[row] - span)
                d, t = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                take = np.flatnonzero((mine["kind"] != 1) & (mine["many"] == many) & (limit >= mine["s"]))
                for i in take.tolist():
                    s = int(mine["s"][i])
                    raw = data[ends[row] + s : ends[row] + limit[i] + span].tobytes()
                    out.append((int(mine["anchor"][i]), d, t, s, int(mine["a"][i]), int(mine["kind"][i]), raw))
                    size += len(raw)
                if size > 4 * STEP_BYTES:
                    yield batch_of(out, CONTEXT)
                    out, size = [], 0
            yield batch_of(out, CONTEXT)

    wanted = F.exists("list", lambda x: (x["kind"] != 1) & (x["many"] == many))
    return joined.where(wanted).select("d", "t", "text", "list", "more").mapInArrow(run, CONTEXT)


KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], KINDS[kind]) for i, (_, kind) in enumerate(fields)], names=[name for name, _ in fields])


def start_names(raw: bytes, s: int, a: int, span: int) -> np.ndarray:
    """Names of the starts of a context: 400 bytes and the distance to the anchor."""
    name = names(Hasher(np.frombuffer(raw, np.uint8)), span)
    return mix(name + (a - s - np.arange(len(name))).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))


def runs_of(hit: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of each run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


def compared_together(rows: DataFrame, span: int) -> DataFrame:
    """(d, t, first, final): repeated starts among the contexts of each anchor name, one task an anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple] = []

        def close() -> None:
            if len(held) > 1:
                found = [start_names(r[6], r[3], r[4], span) for r in held]
                _, back, count = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
                twice, at = count[back] > 1, 0
                for r, x in zip(held, found):
                    if r[5] == 0:
                        out.extend((r[1], r[2], r[3] + i, r[3] + j) for i, j in runs_of(twice[at : at + len(x)]))
                    at += len(x)
            held.clear()

        for batch in batches:
            for r in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if held and held[0][0] != r[0]:
                    close()
                held.append(r)
            yield batch_of(out, RUN)
            out.clear()
        close()
        yield batch_of(out, RUN)

    columns = [f.split()[0] for f in CONTEXT.split(", ")]
    return rows.select(*columns).repartition("anchor").sortWithinPartitions("anchor", "d", "t", "s").mapInArrow(run, RUN)


def compared_apart(rows: DataFrame, span: int) -> DataFrame:
    """The same for anchor names in very many segments: a row for each start, counted by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, d, t, s, a, kind, raw in zip(*(batch.column(i).to_pylist() for i in range(7))):
                name = start_names(raw, s, a, span).view(np.int64)
                n = len(name)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, anchor)), pa.array(name), pa.array(np.full(n, d)), pa.array(np.full(n, t)), pa.array(s + np.arange(n)), pa.array(np.full(n, kind, np.int32))],
                                                 names=["anchor", "name", "d", "t", "first", "kind"])

    starts = rows.mapInArrow(run, "anchor long, name long, d long, t long, first long, kind int")
    twice = starts.groupBy("anchor", "name").agg(F.count("*").alias("n")).where("n > 1").select("anchor", "name")
    return starts.where("kind = 0").join(twice, ["anchor", "name"]).select("d", "t", "first", F.col("first").alias("final"))


def cut_texts(joined: DataFrame, span: int, view: View, keep_text: bool) -> DataFrame:
    """What is left of every text without the bytes of its repeated starts, as text or as a SHA-256."""
    schema = StructType([joined.schema["more"], StructField("n_bytes", LongType()), StructField("n_removed", LongType()), StructField("n_spans", LongType()), StructField("kept", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = text_buffer(batch.column(0))
            by_words = view is word_codes
            _, places, units = word_places(batch.column(0)) if by_words else (None, None, ends)
            seg_at, seg = flat(batch.column(1))
            run_at, runs = flat(batch.column(2))
            out, size, done = [], 0, 0

            def result(end: int) -> pa.RecordBatch:
                made = batch_of(out, "n_bytes long, n_removed long, n_spans long, kept binary")
                return pa.RecordBatch.from_arrays([batch.column(4).slice(done, end - done), *made.columns], names=schema.names)

            for row in range(batch.num_rows):
                text = data[ends[row] : ends[row + 1]]
                n = int(units[row + 1] - units[row]) * (CODE if by_words else 1)
                a, b = seg_at[row], seg_at[row + 1]
                whole = (seg["kind"][a:b] == 1) & (seg["s"][a:b] <= n - span)
                first = np.concatenate([seg["s"][a:b][whole], runs["first"][run_at[row] : run_at[row + 1]]]).astype(np.int64)
                final = np.concatenate([np.minimum(seg["e"][a:b][whole], n - span), runs["final"][run_at[row] : run_at[row + 1]]]).astype(np.int64)
                if batch.column(3)[row].as_py() and n >= span:
                    first, final = np.array([0]), np.array([n - span])
                kept, removed, spans = text.tobytes(), 0, 0
                if len(first):
                    depth = np.zeros(n + 1, np.int32)
                    np.add.at(depth, first, 1)
                    np.add.at(depth, final + span, -1)
                    gone = np.cumsum(depth[:-1]) > 0
                    if by_words:  # each word goes with the gap behind it
                        edge = np.concatenate([[0], places[units[row] : units[row + 1]], [len(text)]])
                        gone = np.repeat(np.append(False, gone.reshape(-1, CODE).all(axis=1)), np.diff(edge))
                    kept, removed, spans = text[~gone].tobytes(), int(gone.sum()), len(runs_of(gone))
                kept = kept if keep_text else hashlib.sha256(kept).hexdigest().encode()
                out.append((len(text), removed, spans, kept))
                size += len(kept)
                if size > 4 * STEP_BYTES:
                    yield result(row + 1)
                    out, size, done = [], 0, row + 1
            yield result(batch.num_rows)

    return joined.select("text", "list", "runs", "twice", "more").mapInArrow(run, schema)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 400, keep_text: bool = True, carry: tuple[str, ...] = (), words_span: int | None = None) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of every row; with carry, row (a struct of id and carry) for id.

    A byte goes if a string of `span` bytes that covers it starts anywhere else too, in any row,
    its own included; all strings are judged on the texts as given. kept holds the bytes left
    (at a cut, part of a character may stay), or with keep_text=False their SHA-256 in hex.
    Null texts count as empty; texts under `span` bytes stay whole. Rows repeated whole remove
    each other. Null ids stay null; an empty table gives no rows; other columns are not read.
    With words_span, passages are that many words in a row, as written, in place of `span` bytes: a
    word goes, with the gap behind it, if it is in such a run that starts at another word too.
    A text passes whole through a task; anchors shared by very many segments are compared by rows.
    """
    view: View = text_buffer
    if words_span is not None:
        span, view = words_span * CODE, word_codes
    if span < WINDOW + GRAM - 1:
        raise ValueError(f"a passage must have at least {WINDOW + GRAM - 1} bytes, or {-(-(WINDOW + GRAM - 1) // CODE)} words")
    ship_code(docs.sparkSession)
    more = F.struct(*[docs[c] for c in dict.fromkeys((id_col, *carry))])
    rows = keyed(docs.select(id_col, text_col, more.alias("more")), id_col, text_col, "more").select("d", "t", "text", "more")
    lists = stored(segment_lists(rows, span, view), "segment_lists")
    joined = rows.join(lists, ["d", "t"])
    found = compared_together(contexts(joined, span, view, False), span)
    if not lists.where(F.exists("list", lambda x: x["many"])).isEmpty():
        found = found.unionAll(compared_apart(contexts(joined, span, view, True), span))
    runs = found.groupBy("d", "t").agg(F.collect_list(F.struct("first", "final")).alias("runs"))
    copies = rows.groupBy("d", "t").agg((F.count("*") > 1).alias("twice")).where("twice")
    marks = lists.select("d", "t", F.filter("list", lambda x: x["kind"] == 1).alias("list")).join(runs, ["d", "t"], "left").join(copies, ["d", "t"], "left")
    whole = rows.join(marks, ["d", "t"], "left").select("text", "list", "runs", F.coalesce("twice", F.lit(False)).alias("twice"), "more")
    return cut_texts(whole, span, view, keep_text).select(F.col("more").alias("row") if carry else F.col("more")[id_col].alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")


@query("op10_repeated_passages")
def op10(spark, sf_dir):
    found = repeated_passages(documents(spark, sf_dir), keep_text=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.col("kept").cast("string").alias("kept_sha256"))
