"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shipreport.functions.text import col


def latest_per_key(
    df: DataFrame,
    key: str = "AWB",
    version: str = "TGL_TARIK_REPORT",
    *,
    tie_break: list[Column] | None = None,
    nulls_win: bool = False,
) -> DataFrame:
    """Newest row per key; rows without a version lose unless ``nulls_win``.

    The row_number = 1 filter lets Spark keep one row per key in every map task
    before the shuffle, so a key holding a large share of all rows (null keys
    included, which form one group) moves one row per task only.
    """
    newest = col(version).desc_nulls_first() if nulls_win else col(version).desc_nulls_last()
    ties = tie_break if tie_break is not None else [
        col(f.name).desc_nulls_last() for f in df.schema if f.name not in (key, version)
    ]
    place = F.row_number().over(Window.partitionBy(col(key)).orderBy(newest, *ties))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key in the given order, pre-aggregated before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*map(col, keys)).distinct()
    picked = df.groupBy(*map(col, keys)).agg(
        F.min_by(F.struct(*map(col, rest)), F.struct(*map(col, order))).alias("_row"))
    return picked.select(*[
        col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns
    ])


def first_non_null(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """Per key and column the first value that is not null."""
    return df.groupBy(col(key)).agg(*[
        F.min_by(col(c), F.when(col(c).isNotNull(), col(order))).alias(c) for c in columns
    ])


def distinct_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*map(col, columns)).distinct()


def require_unique(df: DataFrame, key: str, what: str = "reference") -> DataFrame:
    """The same rows, failing at run time if a key occurs twice."""
    rest = [c for c in df.columns if c != key]
    counted = df.groupBy(col(key)).agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(col(c)).alias(c) for c in rest])
    twice = F.raise_error(F.concat(F.lit(f"{what} holds a key more than once: "), col(key).cast("string")))
    return counted.select(
        F.when(F.col("_n") > 1, twice.cast(df.schema[key].dataType)).otherwise(col(key)).alias(key),
        *map(col, rest),
    )
