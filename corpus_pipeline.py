"""The corpus pipeline: six stages over documents, each one of five corpus operators.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; its result is written as
Parquet and read again as the next one's docs.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from shipreport.llm import cotraining, near_dedup, sentencepieces, source_mixing, suffix_dedup  # noqa: E402
from shipreport.llm.common import corpus_settings, stored  # noqa: E402

#: Co-training and coding have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the co-trained classifier accepts."""
    corpus_settings(spark)
    model = cotraining.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return cotraining.score_quality(docs, model, tuple(docs.columns), only_kept=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its runs of five words."""
    corpus_settings(spark)
    return near_dedup.one_of_each(docs)


def passages_of_words(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of 50 words that occur twice; those left without a word go."""
    return _without_passages(spark, docs, words_span=50)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 400 bytes that occur twice; those left without a word go."""
    return _without_passages(spark, docs)


def _without_passages(spark: SparkSession, docs: DataFrame, **passage: int) -> DataFrame:
    corpus_settings(spark)
    found = suffix_dedup.repeated_passages(docs, carry=tuple(c for c in docs.columns if c != "text"), **passage)
    left = F.col("kept").cast("string")
    made = found.select("row", "n_removed", F.when(F.col("n_removed") > 0, F.make_valid_utf8(left)).otherwise(left).alias("left"))
    made = made.where((F.col("n_removed") == 0) | F.col("left").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("left"), "n_chars": F.length("left").cast("long")}
    return made.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    corpus_settings(spark)
    return source_mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document of the mix, and digests of them and of the decoded text."""
    import public_tokenizers

    corpus_settings(spark)
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        coded = sentencepieces.encode(docs, file.read())
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("passages of 50 words", passages_of_words),
    ("repeated passages", repeated_passages),
    ("source mix", source_mix),
    ("token ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result stored before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
