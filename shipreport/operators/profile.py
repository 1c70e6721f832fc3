"""Column-wise date normalisation and how well it went."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shipreport.functions.moments import parse_numbers, parse_text
from shipreport.functions.text import col


def date_like(columns: list[str]) -> list[str]:
    """Columns whose name suggests dates; an explicit list is the better choice."""
    return [
        c for c in columns
        if any(k in c.lower() for k in ("tgl", "date", "eta")) and c.lower() != "status_pod_update"
    ]


def profile_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: filled cells, numeric cells, largest number, serial-like cells, numeric rule.

    A numeric rule applies only to a column whose every filled cell is a number.
    All columns are profiled in one pass.
    """
    parts = []
    for i, c in enumerate(columns):
        text = F.trim(col(c).cast("string"))
        number = F.when(text.rlike(r"^\d+(\.\d+)?$"), text.try_cast("double"))
        parts += [
            F.count(text).alias(f"f{i}"), F.count(number).alias(f"n{i}"), F.max(number).alias(f"m{i}"),
            F.count(F.when(number.between(29500, 50000), 1)).alias(f"s{i}"),
        ]
    row = df.agg(*parts)
    lines = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"f{i}").alias("filled"), F.col(f"n{i}").alias("numeric"),
            F.col(f"m{i}").alias("largest"), F.col(f"s{i}").alias("serial_like"),
        )
        for i, c in enumerate(columns)
    ])
    rule = (
        F.when((F.col("filled") == 0) | (F.col("numeric") < F.col("filled")), "text")
        .when(F.col("largest") > 1e12, "epoch_ms")
        .when(F.col("largest") > 1e9, "epoch_s")
        .when(F.col("serial_like") > 0, "serial")
        .otherwise("text")
    )
    return row.select(F.inline(lines)).withColumn("rule", rule)


def column_rules(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """The numeric rule per column: one small row per column comes to the driver."""
    return {r.column_name: r.rule for r in profile_dates(df, columns).collect()}


def parsed(df_column: str, rule: str) -> Column:
    by_number = parse_numbers(col(df_column), rule)
    by_text = parse_text(col(df_column))
    return by_text if by_number is None else F.coalesce(by_number, by_text)


def normalise_dates(df: DataFrame, columns: list[str] | None = None, rules: dict[str, str] | None = None) -> DataFrame:
    """Replace date text by timestamps; what no rule can read becomes null."""
    columns = columns if columns is not None else date_like(df.columns)
    columns = [c for c in columns if df.schema[c].dataType.typeName() not in ("timestamp", "timestamp_ntz", "date")]
    if not columns:
        return df
    rules = rules or column_rules(df, columns)
    return df.withColumns({c: parsed(c, rules.get(c, "text")) for c in columns})


def parse_report(df: DataFrame, columns: list[str], rules: dict[str, str]) -> DataFrame:
    """Filled and parsed cells per column and the parsed share in percent."""
    parts = []
    for i, c in enumerate(columns):
        parts += [F.count(col(c)).alias(f"f{i}"), F.count(parsed(c, rules.get(c, "text"))).alias(f"p{i}")]
    row = df.agg(*parts)
    lines = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(rules.get(c, "text")).alias("rule"),
                 F.col(f"f{i}").alias("filled"), F.col(f"p{i}").alias("parsed"))
        for i, c in enumerate(columns)
    ])
    return row.select(F.inline(lines)).withColumn(
        "parsed_pct", F.round(F.col("parsed") / F.greatest(F.col("filled"), F.lit(1)) * 100, 2))
