"""Merkle fingerprints of documents.

A text's lines are its paragraphs. Paragraphs form sections: a heading or a blank line opens
one, and so does the line after a paragraph whose hash is divisible by SECTION, so that a long
run of lines still has branches and an edit moves only the cuts beside it. A section's hash is
over its paragraphs' hashes, the root's over the sections'. Equal roots mean equal texts;
walking down from unequal roots leads to the edited paragraphs. Under the paragraphs lie pieces
of up to eight words; their shared part is the likeness of two fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shipreport.session import cut

from .common import documents, keyed, let, query

#: One paragraph in so many closes its section, on average.
SECTION = 8
#: Up to eight words of one line, up to the end of a sentence; longer words than 64 are split.
PIECE = r"(?:\S{0,63}[^\s.!?][ \t]+){0,7}\S{1,64}"


def hex_long(x: Column) -> Column:
    return F.lower(F.lpad(F.hex(x), 16, "0"))


def piece_hashes(text: Column) -> Column:
    """The distinct 32-bit hashes of a text's pieces."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PIECE), 0), lambda p: F.shiftright(F.xxhash64(p), 32).cast("int")))


def tree(text: Column) -> Column:
    """struct(root, sections, paragraphs, pieces) of a text; sections hold their hash and number of paragraphs."""

    def build(lines: Column) -> Column:
        def hashed(h: Column) -> Column:
            n = F.size(h)
            opens = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | F.get(lines, i).rlike(r"^(?:#|\s*$)") | (F.pmod(F.get(h, i - 1), F.lit(SECTION)) == 0))

            def sections(at: Column) -> Column:
                def section(start: Column, k: Column) -> Column:
                    size = F.coalesce(F.get(at, k + 1), n) - start
                    return F.struct(F.xxhash64(F.slice(h, start + 1, size)).alias("hash"), size.alias("size"))

                return F.transform(at, section)

            return let(let(opens, sections), lambda s: F.struct(
                F.sha2(F.array_join(F.transform(s, lambda x: hex_long(x["hash"])), ""), 256).alias("root"), s.alias("sections"), h.alias("paragraphs")))

        return let(F.transform(lines, lambda p: F.xxhash64(p)), hashed)

    top = let(F.split(text, "\n", -1), build)
    return let(top, lambda x: F.struct(x["root"].alias("root"), x["sections"].alias("sections"), x["paragraphs"].alias("paragraphs"), piece_hashes(text).alias("pieces")))


def written(f: Column) -> Column:
    """A tree as text: root, sections (hash*paragraphs), paragraphs, pieces, parted by colons."""
    return F.concat_ws(
        ":", f["root"], F.array_join(F.transform(f["sections"], lambda s: F.concat(hex_long(s["hash"]), F.lit("*"), s["size"].cast("string"))), ","),
        F.array_join(F.transform(f["paragraphs"], hex_long), ","), F.array_join(F.transform(f["pieces"], lambda p: F.lower(F.lpad(F.hex(p.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))), 8, "0"))), ""))


def likeness(same: Column, mine: Column, other: Column) -> Column:
    """1 for equal roots, else the shared part of the pieces (Dice), 0 where there are none."""
    shared = 2.0 * F.size(F.array_intersect(mine, other)) / F.greatest(F.size(mine) + F.size(other), F.lit(1))
    return F.when(same, 1.0).otherwise(shared)


def edited_paragraphs(mine: Column, other: Column) -> Column:
    """Numbers (from 0) of the paragraphs of `mine` that lie in sections `other` has not and are not in it either.

    Both are written fingerprints. Equal roots need no walk; only differing branches are opened.
    """
    def part(f: Column, k: int) -> Column:
        return F.split(F.get(F.split(f, ":"), F.lit(k)), ",")

    def walk(p: Column) -> Column:
        sections = F.transform(p["sections"], lambda s: F.struct(s.alias("name"), F.split(s, r"\*")[1].cast("int").alias("size")))
        starts = F.aggregate(sections, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("open")), lambda a, s: F.struct(
            (a["at"] + s["size"]).alias("at"),
            F.when(F.array_contains(p["others"], s["name"]), a["open"]).otherwise(F.concat(a["open"], F.sequence(a["at"], a["at"] + s["size"] - 1))).alias("open")))
        return F.filter(starts["open"], lambda i: ~F.array_contains(p["theirs"], F.get(p["mine"], i)))

    parts = F.struct(part(mine, 1).alias("sections"), part(other, 1).alias("others"), part(mine, 2).alias("mine"), part(other, 2).alias("theirs"))
    return F.when(F.get(F.split(mine, ":"), F.lit(0)) == F.get(F.split(other, ":"), F.lit(0)), F.array().cast("array<int>")).otherwise(let(parts, walk))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, root, fingerprint) of every row, in one pass without a shuffle."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(docs[id_col].alias("id"), F.length(text).cast("long").alias("n_chars"), tree(text).alias("f")).select("id", "n_chars", F.col("f.root").alias("root"), written(F.col("f")).alias("fingerprint"))


def following(keys: DataFrame) -> DataFrame:
    """(d, next_d, next_t): the next id in descending order, the first after the last.

    Ids are range-partitioned and stored, each slice looks one row ahead, and the ends of the
    slices, one row each, are joined in a table of their own.
    """
    placed = cut(keys.repartitionByRange(F.desc("d")).withColumn("part", F.spark_partition_id()))
    ahead = Window.partitionBy("part").orderBy(F.desc("d"))
    inner = placed.withColumn("next", F.lead(F.struct("d", "t")).over(ahead))
    heads = placed.groupBy("part").agg(F.max(F.struct("d", "t")).alias("head"))
    order = Window.orderBy("part")
    ends = heads.select("part", F.coalesce(F.lead("head").over(order), F.first("head").over(order)).alias("after"))
    return inner.join(ends, "part").select("d", F.coalesce("next", "after").alias("n")).select("d", F.col("n.d").alias("next_d"), F.col("n.t").alias("next_t"))


def edit_trial(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every row and of its text after an edit, and how alike they are.

    The edit replaces the last third of the code points by as many (or all) of the first ones of
    the next document in descending id; the last is followed by the first, a lone one by itself.
    Nulls count as empty texts, and two empty texts are alike. A null id comes last. Of rows with
    one id but different texts the one with the least text hash is what follows the id before;
    repeated rows have equal results. An empty table gives no rows; other columns are not read.
    Texts are shuffled once; a third of each and its piece hashes go to the document before it.
    """
    rows = keyed(docs, id_col, text_col).select("d", "t", "text")
    keys = rows.groupBy("d", "t").agg(F.max(F.floor(F.length("text") / 3)).cast("int").alias("k"))
    pairs = keys.join(following(rows.groupBy("d").agg(F.min("t").alias("t"))), "d").withColumnsRenamed({"d": "for_d", "t": "for_t", "next_d": "d", "next_t": "t"})
    # repeated rows would bring the same next text again
    given = rows.join(pairs, ["d", "t"]).select("for_d", "for_t", F.left("text", F.col("k")).alias("head"), piece_hashes(F.col("text")).alias("next_pieces"), F.sha2("text", 256).alias("next_sha"))
    given = given.groupBy("for_d", "for_t").agg(F.first("head").alias("head"), F.first("next_pieces").alias("next_pieces"), F.first("next_sha").alias("next_sha"))
    joined = rows.join(given, (F.col("d") == F.col("for_d")) & (F.col("t") == F.col("for_t")))
    n = F.length("text")
    edited = joined.select("d", n.cast("long").alias("n_chars"), "text", F.concat(F.left("text", n - F.floor(n / 3).cast("int")), "head").alias("edited"), "next_pieces", "next_sha")
    both = edited.select("d", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), tree(F.col("text")).alias("f"), tree(F.col("edited")).alias("e"), "next_pieces",
                         (F.sha2("text", 256) == F.col("next_sha")).alias("same_next"))
    row_id = F.when(F.col("d") != F.lit(-(2**63)), F.col("d")).cast(docs.schema[id_col].dataType)
    return both.select(row_id.alias(id_col), "n_chars", "edited_sha256", written(F.col("f")).alias("fingerprint"), written(F.col("e")).alias("edited_fingerprint"),
                       likeness(F.col("f.root") == F.col("e.root"), F.col("f.pieces"), F.col("e.pieces")).alias("near_edited"),
                       likeness(F.col("same_next"), F.col("f.pieces"), F.col("next_pieces")).alias("near_next"))


@query("op1_fingerprints")
def op1(spark, sf_dir):
    return edit_trial(documents(spark, sf_dir))
