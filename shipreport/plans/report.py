"""One report from its config, and several reports into one output."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, fields
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shipreport.functions.predicates import account_in, all_of, date_window, status_in, stored_account_in, tree
from shipreport.functions.text import account_id, account_key, col
from shipreport.operators.dedup import latest_per_key
from shipreport.operators.listjoin import back_fill_key, join_customer_list
from shipreport.operators.numbering import number_rows
from shipreport.operators.overrides import apply_patches
from shipreport.operators.projection import select_report, unique_names, with_insurance_id
from shipreport.operators.receivers import clean_receivers
from shipreport.plans.periods import period_window, splits_by_month
from shipreport.plans.registry import Context, columns_read, derive_columns
from shipreport.sinks.outputs import clean_output, split_labels, write_split
from shipreport.session import stored
from shipreport.sources.shipments import file_filter, select_shipments


@dataclass(frozen=True)
class ReportConfig:
    """A validated report config; field names are those of the config files."""

    group_name: str | list[str] | None = None
    id_account: list[str] = field(default_factory=list)
    selected_cols: list[str] | None = None
    exclude_cols: list[str] = field(default_factory=list)
    rename_cols: list[str] | None = None
    save_as: str | None = None
    period: str | None = None
    jumlah_bulan: int | None = None
    split_by_month: object = None
    split_by_id: bool = False
    split_by_col_val: str | None = None
    selected_statuses: list[str] = field(default_factory=list)
    filter_cols: list = field(default_factory=list)
    filters: dict | list | None = None
    cust_ref: dict = field(default_factory=dict)
    edit_file: dict = field(default_factory=dict)
    clean_receiver: bool = False
    parquet_name_contains: object = None
    parquet_path_contains: object = None
    append_to_sheet: bool = False
    move_to_sheet_of_file: str | None = None
    category: str | None = None
    industry: str | None = None
    contact: object = None
    extra: dict = field(default_factory=dict)

    @classmethod
    def from_dict(cls, criteria: dict) -> "ReportConfig":
        known = {f.name for f in fields(cls)} - {"extra"}
        given = {k: v for k, v in criteria.items() if k in known and v is not None}
        config = cls(**given, extra={k: v for k, v in criteria.items() if k not in known})
        if not (config.save_as or config.group_name):
            raise ValueError("a report needs save_as or group_name")
        return config

    @property
    def name(self) -> str:
        return self.save_as or str(self.group_name)


def expand_combined(criteria: list[dict]) -> list[dict]:
    """Configs with a ``reports`` list become one config per report; children inherit what they do not set."""
    out = []
    for parent in criteria:
        if not parent.get("reports"):
            out.append(parent)
            continue
        target = parent.get("save_as") or parent.get("groups_name") or parent.get("group_name")
        if not target:
            raise ValueError("a combined report needs groups_name or save_as")
        shared = {k: v for k, v in parent.items() if k not in ("reports", "group_name", "groups_name", "save_as")}
        for report in parent["reports"]:
            child = {**shared, **report, "append_to_sheet": True, "move_to_sheet_of_file": target,
                     "industry": parent.get("industry") or "UNKNOWN"}
            child["save_as"] = report.get("save_as") or report.get("group_name")
            out.append(child)
    return out


def build_report(
    shipments: DataFrame,
    config: ReportConfig,
    ctx: Context,
    *,
    accounts: DataFrame | None = None,
    patch: DataFrame | None = None,
    listing: DataFrame | None = None,
    receiver_words: list[str] = (),
    tie_break: list[Column] | None = None,
    sort_order: Callable[[DataFrame], list[Column]] | None = None,
    normalised_ids: bool = False,
) -> DataFrame:
    """The rows of one report. Looking up zips and numbering rows run jobs while the plan is built.

    ``shipments`` is the partition-pruned master. Unless the caller gives orders of
    its own (``tie_break``, ``sort_order``), only the columns the report can touch
    are read, and equally new rows of a waybill are told apart by a hash of those. ``accounts`` (column account_id)
    is used where the config lists no account of its own. ``patch`` holds manual
    corrections, applied before and after the derivations when the config asks
    for them. ``sort_order`` gives the order of the running number NO.
    """
    start, end = period_window(config.period, config.jumlah_bulan, ctx.as_of)
    shipments = file_filter(shipments, config.parquet_name_contains, config.parquet_path_contains)
    df = select_shipments(shipments, window=("TGL_ENTRY", start, end), accounts=config.id_account or accounts,
                          statuses=config.selected_statuses, normalised_ids=normalised_ids)
    if tie_break is None and sort_order is None:
        df = df.select(*map(col, touched_columns(df, config, patch)))
        tie_break = [F.xxhash64(*map(col, df.columns))]
    version = "TGL_TARIK_REPORT" if "TGL_TARIK_REPORT" in df.columns else "TGL_ENTRY"
    df = latest_per_key(df, "AWB", version, tie_break=tie_break)
    return finish_report(df, config, ctx, patch=patch, listing=listing, receiver_words=receiver_words, sort_order=sort_order)


def finish_report(
    df: DataFrame,
    config: ReportConfig,
    ctx: Context,
    *,
    patch: DataFrame | None = None,
    listing: DataFrame | None = None,
    receiver_words: list[str] = (),
    sort_order: Callable[[DataFrame], list[Column]] | None = None,
) -> DataFrame:
    """A report from its newest rows: receivers, corrections, customer list, derivations, filters, labels, numbers."""
    if config.clean_receiver and "RECEIVED/REASON" in df.columns:
        df = clean_receivers(df, list(receiver_words))
    patched = patch is not None and config.edit_file.get("replace_values")
    if patched:
        df = apply_patches(df, patch)

    selected = list(config.selected_cols or [])
    active_date = "TGL_ENTRY"
    if config.cust_ref:
        if listing is None:
            raise ValueError(f"report {config.name} needs its customer list")
        keys = tuple(config.cust_ref.get("key_col", ["AWB", "AWB"]))
        requested = config.cust_ref.get("selected_ref_cols", [])
        if config.cust_ref.get("key_format"):
            df = back_fill_key(df, keys[1], config.cust_ref["key_format"], config.cust_ref.get("key_fallback_cols"))
        df = join_customer_list(listing, df, keys, requested=requested)
        selected = list(dict.fromkeys([*requested, *selected]))
        active_date = next((c for c in df.columns if c.upper() == str(config.cust_ref.get("date_col")).upper()),
                           active_date)
    if selected:
        names = unique_names(with_insurance_id(selected))
        df = derive_columns(df, names, ctx)
        df = df.withColumns({c: F.lit("") for c in names if c not in df.columns})
        if patched:
            df = apply_patches(df, patch)
    if config.filter_cols:
        df = df.where(all_of(df, config.filter_cols))
    if config.filters:
        df = df.where(tree(df, config.filters))

    labels = output_labels(config, active_date)
    df = df.withColumns(labels)
    if "NO" in df.columns:
        order = sort_order(df) if sort_order else [col(active_date).asc_nulls_last(), col("AWB")]
        df = number_rows(df, order, per=list(labels))
    return select_report(
        df, selected, exclude=config.exclude_cols, rename=config.rename_cols,
        order=config.cust_ref.get("col_order"), carry=list(labels))


def build_reports_together(
    shipments: DataFrame,
    configs: list[ReportConfig],
    ctx: Context,
    *,
    accounts: dict[str, DataFrame] | None = None,
    patches: dict[str, DataFrame] | None = None,
    listings: dict[str, DataFrame] | None = None,
    receiver_words: list[str] = (),
    normalised_ids: bool = False,
    tie_break: list[Column] | None = None,
) -> dict[str, DataFrame]:
    """The rows of several reports (children of a combined report) from one scan of the master.

    Every master row is tagged with the reports whose date window, accounts and statuses it
    meets, as an array, and exploded once; one window over (report, AWB) keeps each report's
    newest rows, told apart by the same hash of its own columns as ``build_report`` uses. The
    tagged rows are stored once; each report then finishes from its own slice of them, so the
    result equals the reports built one by one. Account tables become one row per account
    holding the reports that list it, joined once. Configs with a file filter need the file
    names and are built by ``build_report``. A given ``tie_break`` orders equally new rows of
    every report, which then read all columns, as in ``build_report``.
    """
    accounts, patches, listings = accounts or {}, patches or {}, listings or {}
    alone = [c for c in configs if c.parquet_name_contains or c.parquet_path_contains]
    together = [c for c in configs if c not in alone]
    out = {c.name: build_report(shipments, c, ctx, accounts=accounts.get(c.name), patch=patches.get(c.name), listing=listings.get(c.name),
                                receiver_words=receiver_words, normalised_ids=normalised_ids, tie_break=tie_break) for c in alone}
    if not together:
        return out
    touched = [shipments.columns if tie_break is not None else touched_columns(shipments, c, patches.get(c.name)) for c in together]
    df = shipments.select(*[col(c) for c in shipments.columns if any(c in t for t in touched)])
    tables = [(i, accounts[c.name]) for i, c in enumerate(together) if not c.id_account and c.name in accounts]
    if tables:
        listed = reduce(DataFrame.unionByName, [a.select(F.lit(i).alias("_report"), account_key(col("account_id")).alias("_key")) for i, a in tables])
        holders = listed.distinct().groupBy("_key").agg(F.collect_set("_report").alias("_listed"))  # one row an account
        df = df.join(holders, account_id(col("ID_ACCOUNT")) == F.col("_key"), "left").drop("_key")
    tags = []
    for i, c in enumerate(together):
        start, end = period_window(c.period, c.jumlah_bulan, ctx.as_of)
        meets = date_window(df, "TGL_ENTRY", start, end)
        if c.id_account:
            meets = meets & (stored_account_in if normalised_ids else account_in)(col("ID_ACCOUNT"), c.id_account)
        elif c.name in accounts:
            meets = meets & F.coalesce(F.array_contains(F.col("_listed"), i), F.lit(False))
        if c.selected_statuses:
            meets = meets & status_in(col("STATUS_POD"), c.selected_statuses)
        tags.append(F.when(meets, F.lit(i)))
    tagged = df.withColumn("_report", F.explode(F.array_compact(F.array(*tags))))
    ties = tie_break or [F.coalesce(*[F.when(F.col("_report") == i, F.xxhash64(*[col(c) for c in t])) for i, t in enumerate(touched)])]
    version = "TGL_TARIK_REPORT" if "TGL_TARIK_REPORT" in df.columns else "TGL_ENTRY"
    tagged = tagged.withColumn("_key", F.struct(F.col("_report"), col("AWB")))
    newest = stored(latest_per_key(tagged, "_key", version, tie_break=ties).drop("_key", "_listed"), "together")
    for i, c in enumerate(together):
        mine = newest.where(F.col("_report") == i).select(*[col(x) for x in touched[i]])
        out[c.name] = finish_report(mine, c, ctx, patch=patches.get(c.name), listing=listings.get(c.name), receiver_words=receiver_words)
    return out


def _texts(value) -> set[str]:
    """Every text inside a config value, as column names are compared."""
    if isinstance(value, dict):
        return set().union(*[_texts(k) | _texts(v) for k, v in value.items()])
    if isinstance(value, (list, tuple, set)):
        return set().union(*map(_texts, value))
    return {value.strip().upper()} if isinstance(value, str) else set()


# Master columns every report reads.
ALWAYS_READ = ["AWB", "TGL_ENTRY", "TGL_TARIK_REPORT", "ID_ACCOUNT", "STATUS_POD", "STATUS_POD_UPDATE"]


def touched_columns(df: DataFrame, config: ReportConfig, patch: DataFrame | None = None) -> list[str]:
    """The master columns a report can touch: what it selects and derives, and all its config names."""
    if not config.selected_cols:
        return df.columns
    wanted = {c.upper() for c in columns_read(unique_names(with_insurance_id(list(config.selected_cols))))}
    wanted |= {*ALWAYS_READ, *_texts([getattr(config, f.name) for f in fields(config)])}
    wanted |= {c.upper() for c in patch.columns} if patch is not None else set()
    wanted |= {"RECEIVED/REASON", "CONSIGNEE_NAME"} if config.clean_receiver else set()
    return [c for c in df.columns if c.strip().upper() in wanted]


def output_labels(config: ReportConfig, active_date: str = "TGL_ENTRY") -> dict[str, Column]:
    """The label columns that say which output a row belongs to."""
    return split_labels(
        active_date, period=config.period, by_id=config.split_by_id, by_column=config.split_by_col_val,
        one_sheet=config.append_to_sheet,
        monthly=bool(config.jumlah_bulan) and splits_by_month(config.period, config.split_by_month))


def write_report(rows: DataFrame, config: ReportConfig, path: str) -> None:
    """Clean the cells and write one folder per output label."""
    order = [col("IS_CLOSE").desc_nulls_last()] if "IS_CLOSE" in rows.columns else []
    order += [col("TGL_ENTRY").asc_nulls_last()] if "TGL_ENTRY" in rows.columns else []
    write_split(clean_output(rows), path, {name: col(name) for name in output_labels(config)}, order=order)


def combine(reports: dict[str, DataFrame]) -> DataFrame:
    """Several reports in one output, each row naming its report."""
    named = [df.withColumn("report", F.lit(name)) for name, df in reports.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def sorted_output(df: DataFrame, date_column: str = "TGL_ENTRY") -> DataFrame:
    """Oldest first, undated rows last."""
    return df.orderBy(col(date_column).asc_nulls_last())


def closed_first(df: DataFrame, *tie_break: Column) -> DataFrame:
    """Closed shipments first, then by status.

    There are few statuses: a hash of the row ends the order, so that the rows of one status are
    sorted by many tasks.
    """
    spread = F.pmod(F.xxhash64(*[col(name) for name, kind in df.dtypes if "map<" not in kind]), F.lit(4096)).cast("smallint")
    return df.orderBy(col("IS_CLOSE").desc(), col("STATUS_POD").asc_nulls_last(), *tie_break, spread)
