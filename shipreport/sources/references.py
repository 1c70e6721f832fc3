"""Reading reference tables, customer lists and pickup texts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shipreport.functions.moments import MONTHS
from shipreport.functions.text import clean, col
from shipreport.operators.lookups import require_columns
from shipreport.operators.projection import normalise_headers
from shipreport.operators.profile import normalise_dates
from shipreport.session import apply_settings
from shipreport.sources.shipments import months_back, read_by_header


def _csv(spark: SparkSession, path: str, sep: str, encoding: str) -> DataFrame:
    table = spark.read.csv(path, header=True, sep=sep, encoding=encoding, inferSchema=False)
    return table.select(*[clean(col(c)).alias(c.strip()) for c in table.columns])


def read_table(
    spark: SparkSession, path: str, required: list[str] = (), *, sep: str = ",", encoding: str | None = None,
    kind: str | None = None,
) -> DataFrame:
    """A reference sheet as CSV or Parquet, every CSV cell a cleaned text.

    Without a given encoding a CSV is read as UTF-8, and as Latin-1 where some
    cell does not decode.
    """
    apply_settings(spark)
    kind = kind or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    if kind == "parquet":
        return require_columns(spark.read.parquet(path), list(required), path)
    table = _csv(spark, path, sep, encoding or "UTF-8")
    if encoding is None:
        broken = F.lit(any("\ufffd" in c for c in table.columns))
        for c in table.columns:
            broken = broken | F.coalesce(col(c).contains("\ufffd"), F.lit(False))
        if not table.where(broken).isEmpty():
            table = _csv(spark, path, sep, "ISO-8859-1")
    return require_columns(table, list(required), path)


def with_row_index(table: DataFrame, name: str = "row_idx") -> DataFrame:
    """File-order index for "first row wins" rules; meaningful for tables of one file."""
    return table.withColumn(name, F.monotonically_increasing_id())


def list_window(listing: DataFrame, date_column: str, months: int, as_of: date) -> DataFrame:
    """Rows of a customer list dated within the last months, tagged with their file and period."""
    listing = normalise_headers(listing)
    name = date_column.strip().upper()
    if name not in listing.columns:
        raise ValueError(f"date column {date_column} not found in the list")
    listing = normalise_dates(listing, [name])
    start = F.add_months(F.lit(as_of), 1 - months).cast("timestamp")
    return listing.where(col(name) >= start).withColumn("_source_period", F.date_format(col(name), "yyMM"))


def read_list_file(spark: SparkSession, path: str, date_column: str, months: int, as_of: date, **options) -> DataFrame:
    apply_settings(spark)
    read = spark.read.csv(path, header=True, inferSchema=False, **options)
    tagged = read.select("*", F.col("_metadata.file_name").alias("_source_file"))
    out = list_window(tagged, date_column, months, as_of)
    return out.withColumnRenamed("_SOURCE_FILE", "_source_file")


def read_list_folders(spark: SparkSession, root: str, months: int, as_of: date, folder: str = "{}") -> DataFrame:
    """All CSV files of the last months' folders, by column name, tagged with period and file.

    ``folder`` names a month's folder, with ``{}`` for its ``yymm``; absent months are skipped.
    Files of one customer differ in their columns: those with one header are read together.
    """
    apply_settings(spark)
    periods = [f"{y % 100:02d}{m:02d}" for y, m in months_back(as_of, months)]
    pattern = f"{root}/{{{','.join(folder.format(p) for p in periods)}}}/*.csv"
    before = F.regexp_extract("_source_file", r"([^/]+)/[^/]+$", 1)
    rows = read_by_header(spark, [pattern], source="_source_file")
    return rows.withColumns({"_source_period": F.right(before, F.lit(4)), "_source_file": F.regexp_extract("_source_file", r"([^/]+)$", 1)})


def split_fields(line: Column) -> Column:
    """Trimmed non-empty fields of a semicolon-separated line."""
    return F.filter(F.transform(F.split(line, ";"), lambda x: F.trim(x)), lambda x: x != "")


# Short codes of the pickup categories.
PICKUP_CATEGORY = {"BS CREDIT CARD": "BSCC", "BS UOB CASHPLUS": "BSCP"}


def folder_attributes(folder: Column, file_name: Column) -> dict[str, Column]:
    """Cycle, file label, cycle kind and billing kind told by folder and file names."""
    upper, file_upper = F.upper(folder), F.upper(file_name)
    cycle = F.regexp_extract(upper, r"(CY\s[0-9\-]+\s+[A-Z]+\s+\d{4})", 1)
    raw = F.trim(F.split_part(F.replace(upper, F.lit("DATA "), F.lit("")), F.lit("CY"), F.lit(1)))
    pairs = [F.lit(x) for pair in PICKUP_CATEGORY.items() for x in pair]
    short = F.coalesce(F.try_element_at(F.create_map(*pairs), raw), F.replace(raw, F.lit(" "), F.lit("")))
    stamped = file_upper.contains("SD_OUTPUT")
    label = F.concat(F.lit("JNE_"), short, F.lit(" "), F.regexp_replace(cycle, r" [^ ]*$", ""),
                     F.when(stamped, "_SD.txt").otherwise(".txt"))
    number = F.trim(F.regexp_replace(cycle, r"\s+[A-Z]+\s+\d{4}$", ""))
    billed = F.when(F.upper(label).contains("BSCC"), "BS").when(F.upper(label).contains("BSCP"), "BSCP")
    return {
        "CYCLE NAME": cycle,
        "NAMA FILE PICK UP": label,
        "CYCLE & JENIS": F.concat_ws(" ", F.when(short == "BSCC", "BS").otherwise("CP"), number,
                                     F.when(stamped, "STAMP").otherwise("NON STAMP")),
        "JENIS BILLING": F.concat(billed, F.when(stamped, " STAMP").otherwise(" NON STAMP")),
    }


def parse_pickups(lines: DataFrame) -> DataFrame:
    """Pickup rows from (line, folder, file_name); lines with fewer than three fields are dropped."""
    parts = lines.withColumn("_f", split_fields(F.col("line"))).where(F.size("_f") >= 3)
    return parts.select(
        F.element_at("_f", 1).alias("REFF NUM"),
        F.element_at("_f", 2).alias("CUSTOMER NAME"),
        F.to_date(F.try_to_timestamp(F.element_at("_f", -1), F.lit("M/d/yyyy"))).alias("PICK UP DATE"),
        *[c.alias(n) for n, c in folder_attributes(F.col("folder"), F.col("file_name")).items()],
    )


def read_pickups(spark: SparkSession, root: str, months: int, as_of: date) -> DataFrame:
    """Latin-1 pickup texts in folders named after the last months; the first line of a file is its header."""
    apply_settings(spark)
    labels = [f"{MONTHS[m - 1]} {y}" for y, m in months_back(as_of, months)]
    pattern = f"{root}/*{{{','.join(labels)}}}*/*.txt"
    lines = (
        spark.read.schema("line string")
        .csv(pattern, header=True, sep="\u0001", quote="", encoding="ISO-8859-1", enforceSchema=True)
        .select("line", F.url_decode(F.col("_metadata.file_path")).alias("path"))
    )
    named = lines.select(
        "line",
        # a text may also be a folder of part files, as Spark writes it
        F.regexp_extract("path", r"([^/]+)/[^/]+\.txt(/[^/]+)?$", 1).alias("folder"),
        F.regexp_extract("path", r"([^/]+\.txt)(/[^/]+)?$", 1).alias("file_name"),
    )
    month = F.element_at(F.split(F.col("CYCLE NAME"), r"\s+"), -2)
    return parse_pickups(named).withColumn("PERIODE UOB", month)
