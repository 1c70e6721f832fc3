"""Joins that keep the customer's side: lists, pickups, returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shipreport.functions.derive import pickup_columns
from shipreport.functions.text import col, first_match, is_blank_key, list_key, pattern_of_example, pickup_key
from shipreport.operators.dedup import first_per_key


def _find(df: DataFrame, name: str) -> str | None:
    wanted = name.strip().upper()
    return next((c for c in df.columns if c.strip().upper() == wanted), None)


# Columns searched for a key when the key column is blank.
FALLBACK_COLUMNS = ["GOODS_DESCR", "NOTICE", "INTRUCTION", "NOREF"]


def back_fill_key(df: DataFrame, key: str, examples: list[str], columns: list[str] | None = None) -> DataFrame:
    """Fill blank keys with the first text shaped like one of the examples."""
    found = [f for f in (_find(df, c) for c in columns or FALLBACK_COLUMNS) if f and f != key]
    if not examples or not found:
        return df
    patterns = [pattern_of_example(e) for e in examples]
    hit = first_match([col(c) for c in found], patterns)
    return df.withColumn(key, F.when(is_blank_key(col(key)), F.coalesce(hit, col(key))).otherwise(col(key)))


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Give rows without a key a join value of their own per input task.

    They match nothing, and without this all of them would meet in one task.
    """
    own = F.concat(F.lit("\u0000"), F.spark_partition_id().cast("string"))
    return df.withColumn("_jk", F.coalesce(col(key), own))


def join_customer_list(
    listing: DataFrame, master: DataFrame, keys: tuple[str, str], *, requested: list[str] = (),
    list_wins: bool = False,
) -> DataFrame:
    """Every list row with the master row of the same key.

    ``keys`` is (list key, master key); a swapped pair is put right. Columns both
    sides have come from the master, except the requested ones and the list key;
    with ``list_wins`` they all come from the list.
    """
    list_name, master_name = _find(listing, keys[0]), _find(master, keys[1])
    if not (list_name and master_name):
        list_name, master_name = _find(listing, keys[1]), _find(master, keys[0])
    if not (list_name and master_name):
        raise ValueError(f"key columns {keys} not found in the list and the master")
    wanted = {r.strip().upper() for r in requested}
    listing = listing.withColumn(list_name, list_key(col(list_name)))
    master = master.withColumn(master_name, list_key(col(master_name)))
    master_columns = {c.upper() for c in master.columns}
    from_list = [
        c for c in listing.columns
        if (list_wins or c == list_name or c.upper() not in master_columns or c.upper() in wanted) and not c.endswith("_M")
    ]
    taken = {c.upper() for c in from_list}
    from_master = [c for c in master.columns if c.upper() not in taken and not c.endswith("_M")]
    left = _spread(listing.select(*map(col, from_list)), list_name)
    right = master.withColumn("_mk", col(master_name)).where("_mk is not null").select(
        "_mk", *map(col, from_master))
    return left.join(right, F.col("_jk") == F.col("_mk"), "left").drop("_jk", "_mk")


def join_pickups(master: DataFrame, pickups: DataFrame, *, order: list[str] | None = None) -> DataFrame:
    """Every pickup (first row per reference number) with the shipments that carry its number."""
    rest = [c for c in pickups.columns if c != "REFF NUM"]
    trimmed = pickups.withColumn("REFF NUM", F.trim(col("REFF NUM")))
    once = first_per_key(trimmed, ["REFF NUM"], order or rest)
    right = master.drop("REFF NUM", *rest).withColumn("REFNO_UOB", pickup_key(col("REFNO_UOB")))
    joined = _spread(once, "REFF NUM").join(
        right.where(col("REFNO_UOB").isNotNull()), F.col("_jk") == col("REFNO_UOB"), "left").drop("_jk")
    return pickup_columns(joined)


def join_returns(report: DataFrame, returns: DataFrame) -> DataFrame:
    """Rows of the returns table whose waybill is a return number of the report."""
    key = "AWB - COPY" if "AWB - COPY" in returns.columns else "AWB"
    numbers = report.select(col("CONNOTE_RETURN_RT").alias("_rt")).where("_rt is not null")
    return returns.join(numbers, F.col("_rt") == col(key)).drop("_rt")
