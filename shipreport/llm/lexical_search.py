"""Ranked lexical search: every benchmark item against all documents, top documents by an integer BM25-like score.

Method (presence-mask grouping): a document's matched terms of an item form a bitmap (OR of
bits, 64 terms a word, so a mask costs a few longs). Documents are grouped by (item, mask); each group knows
its least and greatest score. Masks ordered by their least score give a proven lower bound of an
item's 50th score as soon as they hold 50 documents; only masks whose greatest score reaches that
bound are evaluated, and only their documents at or above it go on to the final top-k. The top-k
is itself two-level (per item and salt, then per item), so no item's documents meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, query, stored

# Fixed values of the contract.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Distinct item terms up to which the term tables are broadcast; beyond, they are shuffled.
BROADCAST_TERMS = 1_000_000
#: Tasks an item's top-k is first split over.
SALTS = 64


def terms(text: Column) -> Column:
    """All terms of a text with A-Z lower-cased; none for null."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), 0)


def maybe_broadcast(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def search(docs: DataFrame, items: DataFrame, top: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score, n_matched) of each item's `top` best documents with score > 0.

    Every row of docs is a document, repeated rows included (each counts in N, L and df and
    may take a rank of its own); a null text has no terms. Null doc_ids rank after equal scores
    with ids. Items with a null text or without terms get no rows; an item's terms are those of all its
    rows (repeated items count once), each counted once. An empty table gives no rows. Other
    columns of either table are not read, so clashing names do no harm.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), terms(F.col(text_col)).alias("ts")).withColumn("u", F.monotonically_increasing_id())
    # The terms are taken once: the counts, df and postings below read this table.
    rows = stored(rows.select("u", "doc", "ts", F.size("ts").cast("long").alias("n")), "search-terms")
    totals = rows.agg(F.count(F.when(F.col("n") > 0, 1)).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("L")).first()
    big_n, big_l = int(totals["N"]), int(totals["L"])
    # An item's distinct terms, numbered from 1 in code-point order.
    item_terms = items.where(F.col(query_col).isNotNull()).select(F.col(item_col).alias("item"), F.explode(terms(F.col(query_col))).alias("term"))
    item_terms = item_terms.groupBy("item").agg(F.array_sort(F.collect_set("term")).alias("ts"))
    item_terms = item_terms.select("item", F.posexplode("ts").alias("pos", "term")).select("item", "term", (F.col("pos") + 1).alias("bit"))
    vocabulary = item_terms.select("term").distinct()
    small = vocabulary.count() <= BROADCAST_TERMS
    if big_l == 0:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long, n_matched long")
    m = F.lit(50) + F.expr(f"(50 * n * {big_n}L) div {big_l}L")
    # df from each row's distinct terms, summed inside tasks before the shuffle by term.
    held = rows.select(F.explode(F.array_distinct("ts")).alias("term")).join(maybe_broadcast(vocabulary, small), "term", "left_semi")
    weights = held.groupBy("term").agg(F.count("*").alias("df")).select(
        "term", F.floor(1000 * F.log((2.0 * big_n + 2) / (2 * F.col("df") + 1))).cast("long").alias("w"))
    # Postings are partitioned by row, so an item's matches of a document are summed in the task
    # that holds them and only one (item, document) row a match moves on.
    postings = (rows.select("u", "doc", "n", F.explode("ts").alias("term")).join(maybe_broadcast(vocabulary, small), "term", "left_semi")
                .repartition("u").groupBy("u", "doc", "n", "term").agg(F.count("*").alias("tf")))
    part = F.col("w") * F.expr("(1000000000L * tf) div (1000L * tf + 20L * m)")
    scored = (postings.withColumn("m", m).join(maybe_broadcast(weights, small), "term").join(maybe_broadcast(item_terms, small), "term")
              .select("item", "u", "doc", "bit", part.alias("part")))
    per_doc = masks_and_scores(scored, item_terms.agg(F.max("bit")).first()[0] or 1)
    per_doc = stored(per_doc.where("score > 0"), "search-scores")
    bound = lower_bounds(per_doc, top)  # one row an item
    evaluated = per_doc.join(maybe_broadcast(bound, small), "item", "left").where(F.col("floor").isNull() | (F.col("score") >= F.col("floor")))
    return top_k(evaluated, top)


#: Mask words up to which a mask is built by one aggregation, a bit_or a word.
FLAT_WORDS = 16


def masks_and_scores(scored: DataFrame, most_bits: int) -> DataFrame:
    """(item, u, doc, mask, score, n_matched): the bitmap of an item's terms a document holds, and its score.

    Bit b of the item lies in word (b - 1) div 64. Masks of up to FLAT_WORDS words are built in one
    aggregation; longer ones word by word, then gathered as a sorted list of (word, bits).
    """
    word = F.floor((F.col("bit") - 1) / 64).cast("int")
    bit = F.expr("shiftleft(1L, cast(pmod(bit - 1, 64) as int))")
    words = (most_bits + 63) // 64
    if words <= FLAT_WORDS:
        parts = [F.bit_or(F.when(word == w, bit).otherwise(F.lit(0).cast("long"))) for w in range(words)]
        return scored.groupBy("item", "u", "doc").agg(F.array(*parts).alias("mask"), F.sum("part").alias("score"), F.count("*").alias("n_matched"))
    per_word = scored.groupBy("item", "u", "doc", word.alias("bucket")).agg(F.bit_or(bit).alias("bits"), F.sum("part").alias("s"), F.count("*").alias("k"))
    return per_word.groupBy("item", "u", "doc").agg(
        F.array_sort(F.collect_list(F.struct("bucket", "bits"))).alias("mask"),
        F.sum("s").alias("score"), F.sum("k").alias("n_matched"))


def lower_bounds(per_doc: DataFrame, top: int) -> DataFrame:
    """(item, floor): a score at least `top` documents of the item reach, from the mask groups.

    Groups are dealt to salts by their mask; each salt alone proves a bound once its groups,
    by descending least score, hold `top` documents, and the item takes the highest proven one.
    Items that no salt proves have no row: all their documents are evaluated.
    """
    masks = per_doc.groupBy("item", "mask").agg(F.count("*").alias("docs"), F.min("score").alias("least"), F.max("score").alias("most"))
    masks = masks.withColumn("salt", F.pmod(F.xxhash64("mask"), F.lit(SALTS)))
    order = Window.partitionBy("item", "salt").orderBy(F.desc("least"), "mask").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    proven = masks.withColumn("held", F.sum("docs").over(order)).where(F.col("held") >= top)
    return proven.groupBy("item").agg(F.max("least").alias("floor"))


def top_k(scored: DataFrame, top: int) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("doc"), "u"]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("u"), F.lit(SALTS)))
    local = salted.withColumn("r", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("r") <= top)
    ranked = local.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select(F.col("item").alias("item_id"), F.col("rank").cast("int"), F.col("doc").alias("doc_id"), F.col("score").cast("long"), F.col("n_matched").cast("long"))


def _sql() -> str:
    lower = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    pattern = "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'"
    return f"""WITH d AS (SELECT row_number() OVER () AS u, doc_id, regexp_extract_all({lower}, {pattern}) AS ts FROM documents),
s AS (SELECT count(*) FILTER (WHERE len(ts) > 0)::BIGINT AS big_n, sum(len(ts))::BIGINT AS big_l FROM d),
p AS (SELECT u, doc_id, any_value(len(ts))::BIGINT AS n, t AS term, count(*)::BIGINT AS tf FROM (SELECT u, doc_id, ts, unnest(ts) AS t FROM d) GROUP BY u, doc_id, t),
w AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, s GROUP BY term, big_n),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({lower}, {pattern})) AS term FROM benchmark WHERE text IS NOT NULL),
sc AS (SELECT item_id, u, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l))))::BIGINT AS score, count(*)::BIGINT AS n_matched
  FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY item_id, u, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM sc WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score, n_matched FROM r WHERE rank <= 50"""


@query("op11_lexical_search", _sql())
def op11(spark, sf_dir):
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
