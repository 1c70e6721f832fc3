"""Writing reports: cleaning, splitting, manifests, snapshots."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shipreport.functions.moments import month_label
from shipreport.functions.text import blank_to_null, col, file_label, joined_list, strip_scheme
from shipreport.operators.runstate import status_counts
from shipreport.schema import NUMERIC_OUTPUT, URL_COLUMNS
from shipreport.session import stored


def clean_output(df: DataFrame) -> DataFrame:
    """URL schemes removed, list cells flattened, blank marks to null, measures to numbers."""
    out = []
    for field in df.schema:
        c, name = col(field.name), field.name
        if name in URL_COLUMNS:
            c = strip_scheme(c)
        elif isinstance(field.dataType, T.ArrayType):
            c = joined_list(c)
        elif name in NUMERIC_OUTPUT:
            c = c.try_cast("double")
        elif isinstance(field.dataType, T.StringType):
            c = F.when(blank_to_null(c).isNotNull(), c)
        out.append(c.alias(name))
    return df.select(*out)


def by_account(name: str = "ID_ACCOUNT") -> Column:
    return file_label(F.trim(col(name)))


def by_value(name: str) -> Column:
    return file_label(col(name))


def by_month(name: str) -> Column:
    """Year, month number and month name, so equal months of different years stay apart."""
    return month_label(col(name))


def by_column(name: str) -> Column:
    """Month of a date column (its name holds TGL or DATE), else the value itself."""
    return by_month(name) if any(k in name.upper() for k in ("TGL", "DATE")) else by_value(name)


def by_year(name: str) -> Column:
    return F.date_format(col(name), "yyyy")


def split_labels(
    active_date: str,
    *,
    period: str | None = None,
    by_id: bool = False,
    by_column: str | None = None,
    one_sheet: bool = False,
    monthly: bool = False,
) -> dict[str, Column]:
    """Output label columns by priority: account, then column value, then month; by year on top.

    Reports gathered on one sheet are split by year only.
    """
    labels: dict[str, Column] = {}
    if (period or "").strip().lower() == "year":
        labels["year_label"] = by_year(active_date)
    if by_id:
        labels["output_label"] = by_account()
    elif by_column:
        labels["output_label"] = by_value(by_column)
    elif one_sheet:
        return labels
    if monthly:
        labels["period_label"] = by_month(active_date)
    return labels


def is_blank(c: Column) -> Column:
    text = F.trim(c.cast("string"))
    return c.isNull() | text.isin("", "nan", "None")


def tag_listed_values(df: DataFrame, name: str, values) -> DataFrame:
    """A ``sheet`` column for rows with one of the listed values; the other rows are left out.

    ``values`` is a list or {value: sheet name}; None or a blank stands for blank cells.
    """
    actual = next((c for c in df.columns if c.strip().lower() == name.strip().lower()), None)
    if actual is None:
        raise ValueError(f"split column {name} not found")
    pairs = values.items() if isinstance(values, dict) else [(v, v) for v in values]
    text = F.trim(col(actual).cast("string"))
    sheets = []
    for value, sheet in pairs:
        if value is None or str(value).strip() == "":
            hit = is_blank(col(actual))
        else:
            hit = F.coalesce(text == str(value).strip(), F.lit(False))
        sheets.append(F.when(hit, F.lit(str(sheet))))
    # A row may belong to several sheets when the list names a value twice.
    return df.withColumn("sheet", F.explode(F.array_compact(F.array(*sheets))))


def write_split(
    df: DataFrame, path: str, labels: dict[str, Column], *, kind: str = "parquet", order: list[Column] = (),
) -> None:
    """One folder per label; rows without a label keep a folder of their own. Each file is in ``order``.

    Rebalancing lets adaptive execution cut a large output into several files and
    pack small ones, so one dominant output is not written by one task.
    """
    if labels:
        df = df.withColumns(labels).hint("rebalance", *labels)
    if order:
        df = df.sortWithinPartitions(*[col(name) for name in labels], *order)
    writer = df.write.mode("overwrite")
    if labels:
        writer = writer.partitionBy(*labels)
    if kind == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def manifest(spark: SparkSession, path: str, labels: list[str]) -> DataFrame:
    """Rows per output, counted from what was written."""
    return spark.read.parquet(path).groupBy(*labels).agg(F.count(F.lit(1)).alias("n_rows"))


def append_snapshot(df: DataFrame, path: str, report: Column | str, as_of) -> None:
    """Put the status counts of a day into the snapshot table; a second run of the day replaces its reports."""
    append_counts(status_counts(df, report), path, as_of)


def append_counts(counts: DataFrame, path: str, as_of) -> None:
    """Put (report, status, n) of a day into the snapshot table: one folder a day, however many reports.

    The day's other reports are read back and written again with the new ones; a dynamic overwrite
    puts the new folder in place only when it is whole.
    """
    rows = counts.select("report", "status", "n")
    try:
        old = counts.sparkSession.read.schema("report string, status string, n long").parquet(f"{path}/as_of={as_of.isoformat()}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        rows = stored(rows, "counts")
        again = rows.select(F.col("report").alias("_again")).distinct()
        rows = old.join(again.hint("merge"), F.col("report").eqNullSafe(F.col("_again")), "left_anti").unionByName(rows)
    writer = rows.withColumn("as_of", F.lit(as_of)).hint("rebalance").write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("as_of").parquet(path)


def project_extract(table: DataFrame) -> DataFrame:
    """The four columns reports need from the account sheet; its second id column is the account id."""
    source = {"CUST_ID": "CUST_ID_2", "CUST_NAME": "CUST_NAME", "BIG_GROUPING_CUST": "BIG_GROUPING_CUST",
              "CATEGORY": "CATEGORY"}
    return table.select(*[col(old).alias(new) for new, old in source.items()])


def refresh_projects(table: DataFrame, path: str) -> None:
    project_extract(table).write.mode("overwrite").option("header", True).csv(path)
