"""Forward as-of fill over codes made of a letter prefix and a number."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shipreport.functions.text import col

CODE_PATTERN = r"^([A-Z]+)\s*(\d+)$"
# Numbers per block: codes of up to six digits give at most a thousand blocks of
# at most a thousand numbers, so neither window ever sees a large group.
BLOCK = 1000


def fill_forward(codes: DataFrame, code: str, value: str, anchors: DataFrame | None = None) -> DataFrame:
    """Fill null values from the smallest code not below the own one with the same prefix.

    ``codes`` and ``anchors`` hold one row per code; anchors are further codes that
    may supply values. The fill runs in two levels: inside blocks of neighbouring
    numbers, then from block to block, so a prefix that holds most of the codes is
    still spread over many tasks.
    """
    known = codes if anchors is None else codes.select(code, col(value)).unionByName(
        anchors.select(code, col(value)))
    parsed = known.select(
        F.regexp_extract(col(code), CODE_PATTERN, 1).alias("_prefix"),
        F.regexp_extract(col(code), CODE_PATTERN, 2).try_cast("long").alias("_num"),
        col(value).alias("_value"),
    ).where("_prefix <> '' and _num is not null")
    points = parsed.groupBy("_prefix", "_num").agg(F.max("_value").alias("_value"))
    points = points.withColumn("_block", F.floor(F.col("_num") / BLOCK))

    inside = Window.partitionBy("_prefix", "_block").orderBy("_num").rowsBetween(0, Window.unboundedFollowing)
    near = points.withColumn("_near", F.first("_value", ignorenulls=True).over(inside))

    heads = points.groupBy("_prefix", "_block").agg(
        F.min_by("_value", F.when(F.col("_value").isNotNull(), F.col("_num"))).alias("_head"))
    later = Window.partitionBy("_prefix").orderBy("_block").rowsBetween(1, Window.unboundedFollowing)
    heads = heads.select("_prefix", "_block", F.first("_head", ignorenulls=True).over(later).alias("_next"))

    filled = near.join(heads, ["_prefix", "_block"]).select(
        F.col("_prefix").alias("_p"), F.col("_num").alias("_n"), F.coalesce("_near", "_next").alias("_filled"))
    keyed = codes.withColumns({
        "_prefix": F.regexp_extract(col(code), CODE_PATTERN, 1),
        "_num": F.regexp_extract(col(code), CODE_PATTERN, 2).try_cast("long"),
    })
    joined = keyed.join(filled, (F.col("_prefix") == F.col("_p")) & (F.col("_num") == F.col("_n")), "left")
    return joined.withColumn(value, F.coalesce(col(value), F.col("_filled"))).select(*map(col, codes.columns))
