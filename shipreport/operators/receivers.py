"""Receiver names that say nothing, replaced by the consignee."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shipreport.functions.text import col

LONGEST_CHECKED = 15
THRESHOLD = 85.0


def _common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def token_set_score(a: str, b: str) -> float:
    """Similarity 0-100 of two texts as token sets (insert/delete distance, best of three pairings)."""
    ta, tb = set(a.split()), set(b.split())
    if not ta or not tb:
        return 0.0
    shared, rest_a, rest_b = sorted(ta & tb), " ".join(sorted(ta - tb)), " ".join(sorted(tb - ta))
    if shared and (not rest_a or not rest_b):
        return 100.0
    base = len(" ".join(shared))
    joint = 1 if base else 0
    len_a, len_b = base + joint + len(rest_a), base + joint + len(rest_b)
    distance = len(rest_a) + len(rest_b) - 2 * _common_length(rest_a, rest_b)
    best = 100 - 100 * distance / (len_a + len_b)
    if base:
        best = max(best, 100 - 100 * (joint + len(rest_a)) / (base + len_a),
                   100 - 100 * (joint + len(rest_b)) / (base + len_b))
    return best


def empty_names(names: DataFrame, words: list[str]) -> DataFrame:
    """Of distinct lower-case names (column ``name``), those equal or close to a listed word."""
    listed = sorted({w.strip().lower() for w in words} - {""})

    @F.pandas_udf("boolean")
    def close(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t in listed or any(token_set_score(t, w) >= THRESHOLD for w in listed))

    return names.where(close("name")).select("name")


def clean_receivers(
    df: DataFrame, words: list[str], receiver: str = "RECEIVED/REASON", consignee: str = "CONSIGNEE_NAME"
) -> DataFrame:
    """Put the consignee where the receiver is an empty phrase of at most 15 characters.

    Names are scored once per distinct short text, not once per row.
    """
    text = F.trim(F.coalesce(col(receiver), F.lit("")))
    key = F.lower(text)
    short = F.when((F.length(key) > 0) & (F.length(key) <= LONGEST_CHECKED), key)
    names = df.select(short.alias("name")).where("name is not null").distinct()
    flagged = empty_names(names, words).select(F.col("name").alias("_bad"))
    replacement = F.nullif(F.trim(F.coalesce(col(consignee), F.lit(""))), F.lit(""))
    joined = df.withColumn("_short", short).join(flagged, F.col("_short") == F.col("_bad"), "left")
    value = F.when(F.col("_bad").isNotNull(), F.coalesce(replacement, text)).otherwise(text)
    return joined.withColumn(receiver, value).drop("_short", "_bad")
