"""Running numbers over an explicit order, without one window per output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shipreport.functions.text import col
from shipreport.session import cut


def number_rows(df: DataFrame, order: list[Column], *, per: list[str] | None = None, name: str = "NO") -> DataFrame:
    """Number rows 1..n in order, restarting per output where ``per`` is given.

    Rows are range-partitioned by output and order and stored; each task then
    numbers its own slice and adds the rows that lie before it. An output that
    holds most of the rows is spread over many slices. End ``order`` with a
    unique column: rows equal in all of them get their numbers in any order.
    """
    per = per or []
    kept = [c for c in df.columns if c != name]
    keys = [col(c).asc_nulls_first() for c in per]
    placed = df.select(*map(col, kept)).repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = cut(placed.withColumn("_slot", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftrightunsigned("_slot", 33))

    # One row per slice, so this table is as small as the number of tasks and outputs.
    slices = placed.groupBy(*map(col, per), "_part").agg(
        F.min("_slot").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*map(col, per)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(
        *[col(c).alias(f"_per{i}") for i, c in enumerate(per)], F.col("_part").alias("_p"), "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(per):
        same = same & col(c).eqNullSafe(F.col(f"_per{i}"))
    number = (F.col("_before") + F.col("_slot") - F.col("_first") + 1).alias(name)
    return placed.join(slices, same).select(number, *map(col, kept))
