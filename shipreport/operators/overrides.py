"""Manual corrections laid over the master."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shipreport.functions.text import blank_to_null, col, waybill_key
from shipreport.operators.dedup import first_non_null


def patches(table: DataFrame, order: str = "row_idx") -> DataFrame:
    """One patch per waybill: its first non-blank value in every column."""
    columns = [c for c in table.columns if c not in ("AWB", order)]
    cleaned = table.select(
        waybill_key(blank_to_null(col("AWB"))).alias("_patch_key"), col(order),
        *[blank_to_null(col(c)).alias(c) for c in columns],
    ).where("_patch_key is not null")
    return first_non_null(cleaned, "_patch_key", order, columns)


def apply_patches(df: DataFrame, patch: DataFrame) -> DataFrame:
    """Non-null patch values replace the master's; a STATUS_POD patch also sets STATUS_POD_UPDATE.

    Patch columns the master lacks are added.
    """
    columns = [c for c in patch.columns if c != "_patch_key"]
    renamed = patch.select("_patch_key", *[col(c).alias(f"_p_{c}") for c in columns])
    joined = df.withColumn("_key", waybill_key(col("AWB"))).join(
        renamed, F.col("_key") == F.col("_patch_key"), "left")
    values = {}
    for c in columns:
        new = col(f"_p_{c}")
        values[c] = F.coalesce(new.try_cast(df.schema[c].dataType), col(c)) if c in df.columns else new
    if "STATUS_POD" in columns and "STATUS_POD_UPDATE" in df.columns and "STATUS_POD_UPDATE" not in columns:
        values["STATUS_POD_UPDATE"] = F.coalesce(col("_p_STATUS_POD"), col("STATUS_POD_UPDATE"))
    return joined.withColumns(values).drop("_key", "_patch_key", *[f"_p_{c}" for c in columns])


def patched_counts(df: DataFrame, patch: DataFrame) -> DataFrame:
    """How many cells each patch column changes: columns (column_name, cells)."""
    columns = [c for c in patch.columns if c != "_patch_key"]
    joined = df.select(waybill_key(col("AWB")).alias("_key")).join(patch, F.col("_key") == F.col("_patch_key"))
    row = joined.agg(*[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(columns)])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("cells")) for i, c in enumerate(columns)])
    return row.select(F.inline(pairs))
