"""Importance resampling of documents towards the feature distribution of a target table.

Method (bit-sliced aggregation): a document's counts over the 10,000 hashed feature buckets
are cut into bit planes (plane j holds the buckets whose count has bit j set); the signed gains
are cut the same way into positive and negative planes. The weight is the sum over plane pairs
of 2**(j+k) times popcount(C_j AND G_k), positive planes added and negative ones taken off:
exact integer arithmetic, 157 64-bit words a plane. The features' buckets come from Spark's
own crc32; numpy does the planes inside tasks.

The draw adds a Gumbel key from a hash of the id to the weight and takes the highest scores:
a distributed sort by (score, id), with ranks from per-partition counts, never one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, query, ship_code, stored

# Fixed values of the contract.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKETS = 10_000
SEED = 42
#: 64-bit words of one plane of BUCKETS bits.
PLANE_WORDS = (BUCKETS + 63) // 64


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), 0)


def feature_buckets(w: Column) -> Column:
    """Buckets of all runs of 1 to 3 consecutive words (joined by one space), repeats kept."""
    n = F.size(w)

    def bucket(feature: Column) -> Column:
        return F.pmod(F.crc32(feature.cast("binary")), F.lit(BUCKETS)).cast("int")

    def shifted(k: int, length: Column) -> Column:
        return F.slice(w, k, length)

    # Runs of two and three words by zipping the word array with itself shifted, no array a position.
    two = F.greatest(n - 1, F.lit(0))
    pairs = F.zip_with(shifted(1, two), shifted(2, two), lambda a, b: F.concat(a, F.lit(" "), b))
    three = F.greatest(n - 2, F.lit(0))
    triples = F.zip_with(F.slice(pairs, 1, three), shifted(3, three), lambda ab, c: F.concat(ab, F.lit(" "), c))
    return F.concat(F.transform(w, bucket), F.transform(pairs, bucket), F.transform(triples, bucket))


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of non-negative integers by bucket: row j holds bit j of every value, packed in 64-bit words."""
    hit = np.flatnonzero(values)
    out = np.zeros((max(int(values.max()).bit_length(), 1) if hit.size else 1, PLANE_WORDS), np.uint64)
    value = values[hit].astype(np.uint64)
    word, bit = hit >> 6, np.left_shift(np.uint64(1), (hit & 63).astype(np.uint64))
    for j in range(len(out)):
        on = ((value >> np.uint64(j)) & np.uint64(1)).astype(bool)
        np.bitwise_or.at(out[j], word[on], bit[on])
    return out


def sliced_weight(counts: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> int:
    """sum(counts * gains) from bit planes alone: popcounts of plane ANDs, scaled by powers of two."""
    mine = planes(counts)
    total = 0
    for gains, sign in ((positive, 1), (negative, -1)):
        pops = np.bitwise_count(mine[:, None, :] & gains[None, :, :]).sum(axis=2, dtype=np.int64)
        scale = np.left_shift(np.int64(1), np.add.outer(np.arange(len(mine)), np.arange(len(gains))).astype(np.int64))
        total += sign * int((pops * scale).sum())
    return total


def histogram(rows: DataFrame, column: str) -> np.ndarray:
    """Features by bucket over all rows, summed inside tasks first (at most BUCKETS rows a task move)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for b in batch[column]:
                if b is not None and len(b):
                    total += np.bincount(np.asarray(b, np.int64), minlength=BUCKETS)
        hit = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": hit.astype(np.int32), "n": total[hit]})

    counted = rows.select(column).mapInPandas(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for row in counted.collect():  # at most BUCKETS rows
        out[row["bucket"]] = row["n"]
    return out


def gains(docs_hist: np.ndarray, target_hist: np.ndarray) -> np.ndarray:
    big_s, big_t = float(docs_hist.sum()), float(target_hist.sum())
    ratio = ((target_hist + 1.0) * (big_s + BUCKETS)) / ((docs_hist + 1.0) * (big_t + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank, n_words) of every row of docs.

    A null text has no words (weight 0). Rows of at least `least_words` words are drawn from:
    floor(percent * N / 100) of them by descending score, ties by ascending id (null ids last,
    repeated rows in a fixed order, each with a rank of its own); rank is null for all others.
    A null id is hashed as the empty text. An empty table gives no rows; empty targets give
    gains from the documents alone. Other columns are not read, so clashing names do no harm.
    """
    spark = docs.sparkSession
    ship_code(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), words(F.col(text_col)).alias("w")).withColumn("u", F.monotonically_increasing_id())
    # two passes read the buckets; cutting words and hashing features takes most of the time and is done once
    rows = stored(rows.select("u", "doc", F.size("w").cast("long").alias("n_words"), feature_buckets(F.col("w")).alias("b")), "importance-buckets")
    aimed = target.select(feature_buckets(words(F.col(target_col))).alias("b"))
    gain = gains(histogram(rows, "b"), histogram(aimed, "b"))
    positive, negative = planes(np.maximum(gain, 0)), planes(np.maximum(-gain, 0))

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            weight = [sliced_weight(np.bincount(np.asarray(b, np.int64), minlength=BUCKETS), positive, negative) if b is not None and len(b) else 0 for b in batch["b"]]
            yield pd.DataFrame({"u": batch["u"], "doc": batch["doc"], "n_words": batch["n_words"], "n_features": [0 if b is None else len(b) for b in batch["b"]], "weight": weight})

    weighed = rows.mapInPandas(weigh, "u long, doc long, n_words long, n_features long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    scored = stored(weighed.withColumn("score", F.col("weight") + gumbel), "importance")
    eligible = scored.where(F.col("n_words") >= least_words)
    drawn = percent * eligible.count() // 100
    ranks = sorted_ranks(eligible, drawn)
    out = scored.join(ranks, "u", "left")
    return out.select(F.col("doc").alias("doc_id"), "n_features", "weight", "score", "rank", "n_words")


def sorted_ranks(rows: DataFrame, drawn: int) -> DataFrame:
    """(u, rank) of the first `drawn` rows by descending score, ascending id (nulls last), then u.

    Range-partitioned sort; each row's place is its partition's offset plus its place inside.
    """
    if drawn <= 0:
        return rows.sparkSession.createDataFrame([], "u long, rank long")
    placed = rows.select("u", "doc", "score").orderBy(F.desc("score"), F.asc_nulls_last("doc"), "u").select(
        "u", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    placed = stored(placed, "importance-order")
    sizes = placed.groupBy("part").agg(F.count("*").alias("size"))  # one row a partition
    offsets = sizes.select("part", (F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    ranked = placed.join(F.broadcast(offsets), "part").select("u", (F.coalesce("before", F.lit(0)) + inside + 1).alias("rank"))
    return ranked.where(F.col("rank") <= drawn)


@query("op13_importance_resampling")
def op13(spark, sf_dir):
    out = resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.drop("n_words")
