"""Reading the shipment master."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shipreport.functions.moments import MONTHS
from shipreport.functions.predicates import account_in, date_window, status_in, stored_account_in
from shipreport.functions.text import account_id, account_key, col, upper_header
from shipreport.operators.projection import normalise_headers, present_columns
from shipreport.session import apply_settings, in_slices

# Partition columns. The master has a CATEGORY column of its own, so the folder
# key carries another name; a folder key named like a column would replace it.
YEAR, MONTH, CATEGORY = "tahun", "bulan", "p_category"


def months_between(start: date, end: date) -> list[tuple[int, int]]:
    """Months touched by the half-open window."""
    out, year, month = [], start.year, start.month
    while date(year, month, 1) < date(end.year, end.month, end.day):
        out.append((year, month))
        year, month = (year, month + 1) if month < 12 else (year + 1, 1)
    return out


def write_shipments(
    df: DataFrame, root: str, *, entry: str = "TGL_ENTRY", category: str = "CATEGORY", columns: dict[str, Column] | None = None,
) -> None:
    """Store the master by year, month and category, account ids in one spelling (one apostrophe, no padding).

    ``columns`` are the columns to store, made of those of ``df`` after the rows were dealt to the write
    tasks, so texts made of a few numbers are not shuffled; by default ``df`` is stored as it is.
    Rows with waybills are stored slice by slice, so the rows are never all in shuffle files
    at a time; ``_SUCCESS`` is written with the last slice.
    """
    columns = dict(columns or {c: col(c) for c in df.columns if c.lower() not in (YEAR, MONTH, CATEGORY)})
    when = columns.get(entry, col(entry))
    folder = {YEAR: F.date_format(when, "yyyy"), MONTH: F.date_format(when, "MM"), CATEGORY: columns.get(category, col(category))}
    if "ID_ACCOUNT" in columns:
        columns["ID_ACCOUNT"] = F.concat(F.lit("'"), account_id(columns["ID_ACCOUNT"]))

    def write(rows: DataFrame, first: bool, last: bool) -> None:
        # Rebalancing splits a large folder over several tasks and merges small ones.
        rows = rows.withColumns(folder).hint("rebalance", *folder)
        writer = rows.select(*[c.alias(name) for name, c in columns.items()], *folder).write.mode("overwrite" if first else "append")
        writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(last).lower()).partitionBy(*folder).parquet(root)

    in_slices(df, columns.get("AWB"), write)


def write_bucketed_shipments(df: DataFrame, table: str, *, buckets: int = 64, entry: str = "TGL_ENTRY", category: str = "CATEGORY") -> None:
    """Store the master as a table by year, month and category, bucketed by AWB and sorted by account inside a bucket.

    The newest row of a waybill and joins on AWB then read each bucket in one task with no
    shuffle. Sorted by account, a file's row groups hold narrow account ranges, so an account
    filter skips row groups by their statistics. Ids are stored in one spelling, as
    ``write_shipments`` does. Rows are dealt to write tasks by folder and bucket, so a large
    folder is spread over its buckets.
    """
    if "ID_ACCOUNT" in df.columns:
        df = df.withColumn("ID_ACCOUNT", F.concat(F.lit("'"), account_id(col("ID_ACCOUNT"))))
    df = df.withColumns({YEAR: F.date_format(col(entry), "yyyy"), MONTH: F.date_format(col(entry), "MM"), CATEGORY: col(category)})
    bucket = F.pmod(F.hash(col("AWB")), F.lit(buckets))
    sort = [c for c in ("ID_ACCOUNT", "AWB") if c in df.columns]
    (df.repartition(YEAR, MONTH, CATEGORY, bucket).write.mode("overwrite").partitionBy(YEAR, MONTH, CATEGORY)
     .bucketBy(buckets, "AWB").sortBy(*sort).saveAsTable(table))


def scan_table_period(spark: SparkSession, table: str, start: date, end: date, *, category: str | None = None) -> DataFrame:
    """The folders of a stored master table a date window needs, its buckets kept."""
    apply_settings(spark)
    keys = [f"{y:04d}{m:02d}" for y, m in months_between(start, end)]
    df = spark.table(table).where(F.concat(F.col(YEAR), F.col(MONTH)).isin(keys))
    return df.where(F.col(CATEGORY) == category) if category is not None else df


def _needles(value) -> list[str]:
    values = value if isinstance(value, (list, tuple, set)) else [value]
    return [str(v).lower() for v in values if str(v).strip()]


def _any_contains(c: Column, needles: list[str]) -> Column:
    hit = F.lit(False)
    for needle in needles:
        hit = hit | F.lower(c).contains(needle)
    return hit


def file_filter(df: DataFrame, name_contains=None, path_contains=None) -> DataFrame:
    """Keep rows of files whose name or path holds any of the texts, ignoring case."""
    if name_contains and _needles(name_contains):
        df = df.where(_any_contains(F.col("_metadata.file_name"), _needles(name_contains)))
    if path_contains and _needles(path_contains):
        path = F.url_decode(F.col("_metadata.file_path"))
        df = df.where(_any_contains(path, _needles(path_contains)))
    return df


def scan_period(
    spark: SparkSession,
    root: str,
    start: date,
    end: date,
    *,
    category: str | None = None,
    name_contains=None,
    path_contains=None,
) -> DataFrame:
    """The partitions a date window needs; the predicate touches folder keys only."""
    apply_settings(spark)
    keys = [f"{y:04d}{m:02d}" for y, m in months_between(start, end)]
    df = spark.read.parquet(root).where(F.concat(F.col(YEAR), F.col(MONTH)).isin(keys))
    if category is not None:
        df = df.where(F.col(CATEGORY) == category)
    return file_filter(df, name_contains, path_contains)


def month_folder(root: str, year: int, month: int, category: str, *, padded: bool = True) -> str:
    """Folder of the older layout, e.g. ``1998/03. MARET 1998/CATEGORY/RETAIL``."""
    number = f"{month:02d}" if padded else str(month)
    return f"{root}/{year}/{number}. {MONTHS[month - 1]} {year}/CATEGORY/{category}"


def scan_month_folders(spark: SparkSession, root: str, start: date, end: date, category: str) -> DataFrame:
    """Parquet files of the older month-folder layout; absent months are skipped."""
    apply_settings(spark)
    folders = [month_folder("", y, m, category).lstrip("/") for y, m in months_between(start, end)]
    return spark.read.option("recursiveFileLookup", "true").parquet(root + "/{" + ",".join(folders) + "}")


def select_shipments(
    df: DataFrame,
    *,
    columns: list[str] | None = None,
    window: tuple[str, date, date] | None = None,
    accounts: list[str] | DataFrame | None = None,
    statuses: list[str] | None = None,
    normalised_ids: bool = False,
) -> DataFrame:
    """Projection and row filters of a report.

    The date window is compared in the column's own type, so the file reader
    evaluates it. Accounts match whatever the padding and apostrophes of either
    side, listed or given as a table (column account_id, a semi join). A caller
    who knows the stored ids to be in the spelling of ``write_shipments`` says so
    with ``normalised_ids``; then the file reader evaluates a list as well.
    """
    if window:
        df = df.where(date_window(df, *window))
    if isinstance(accounts, DataFrame):
        # account sheets may spell a number with .0; the master compares as stored
        wanted = accounts.select(account_key(col("account_id")).alias("_wanted")).distinct()
        df = df.join(wanted, account_id(col("ID_ACCOUNT")) == F.col("_wanted"), "left_semi")
    elif accounts:
        match = stored_account_in if normalised_ids else account_in
        df = df.where(match(col("ID_ACCOUNT"), accounts))
    if statuses:
        df = df.where(status_in(col("STATUS_POD"), statuses))
    return present_columns(df, columns) if columns else df


# English and indonesian month names a config may start with.
ENGLISH = [
    "JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE",
    "JULY", "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER",
]


def months_back(as_of: date, count: int) -> list[tuple[int, int]]:
    """The last ``count`` months up to the current one, oldest first."""
    first = as_of.year * 12 + as_of.month - 1
    return [((first - i) // 12, (first - i) % 12 + 1) for i in range(count - 1, -1, -1)]


def months_since(start_name: str, as_of: date) -> int:
    """Number of months from the named one to the current one, across the year end if needed."""
    name = start_name.strip().upper()
    names = MONTHS if name in MONTHS else ENGLISH
    if name not in names:
        raise ValueError(f"unknown month name: {start_name}")
    return (as_of.month - 1 - names.index(name)) % 12 + 1


def read_month_csv(spark: SparkSession, paths: list[str], keep: list[str] | None = None) -> DataFrame:
    """Monthly CSV extracts laid under each other by column name, every cell a text."""
    apply_settings(spark)
    if not paths:
        raise ValueError("no monthly extract to read")
    whole = read_by_header(spark, paths)
    return present_columns(whole, keep) if keep else whole


def read_by_header(spark: SparkSession, paths: list[str], source: str | None = None) -> DataFrame:
    """CSV files of any headers laid under each other by upper-cased column name, in one scan of rows.

    The rows of all files are one text scan with their paths, whatever the number of header
    layouts. A file's header is its first line (found by a pass that keeps the first split's
    lines of each file); it is joined back to the file's lines by path, and each line is parsed
    by ``from_csv`` with the fields of its own header. Only the distinct header texts reach the
    driver, never a list of files. Columns come in the order of the sorted headers, absent ones null, every cell a
    text; blank lines are skipped, as the CSV reader does. ``source`` names a column for the
    path of a row's file.
    """
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_place"))
    firsts = lines.where("_at = 0").groupBy("_file").agg(F.min_by("value", "_place").alias("_header"), F.min("_place").alias("_first"))
    headers = sorted(r["_header"] for r in firsts.select("_header").distinct().collect())  # one row a header layout
    if not headers:
        raise ValueError("no file with a header line")
    layouts = [header_names(h) for h in headers]
    body = lines.join(firsts, "_file").where(~((F.col("_at") == 0) & (F.col("_place") == F.col("_first")))).where(F.trim("value") != "")
    parsed = body.select("_file", *[F.when(F.col("_header") == F.lit(h), F.from_csv("value", ", ".join(f"c{i} STRING" for i in range(len(names))))).alias(f"_p{k}")
                                    for k, (h, names) in enumerate(zip(headers, layouts))])
    columns = list(dict.fromkeys(n for names in layouts for n in names))
    cells = [F.coalesce(*[F.col(f"_p{k}.c{names.index(c)}") for k, names in enumerate(layouts) if c in names]).alias(c) for c in columns]
    return parsed.select(*cells, *([F.col("_file").alias(source)] if source else []))


def header_names(line: str) -> list[str]:
    """Upper-cased column names of a CSV header line; blanks named _C<i>, repeats given their position, as the CSV reader does."""
    import csv

    fields = next(csv.reader([line]), [])
    names = [upper_header(f) if f.strip() else f"_C{i}" for i, f in enumerate(fields)]
    twice = {n for n in names if names.count(n) > 1}
    return [f"{n}{i}" if n in twice else n for i, n in enumerate(names)]


def month_extract_paths(root: str, start_name: str, category: str, as_of: date) -> list[str]:
    """A glob of the extracts of a category from the named month to the current one; absent months are skipped."""
    months = months_back(as_of, months_since(start_name, as_of))
    folders = [month_folder("", y, m, category).lstrip("/") for y, m in months]
    return [f"{root}/{{{','.join(folders)}}}/*.csv"]
