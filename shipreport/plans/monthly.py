"""Reports over whole monthly extracts, the older order of steps.

It differs from the snapshot report in that columns are derived before the
customer list is joined, filters respect case, the full status rules apply, the
list's columns win name clashes, and the window spans whole months.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from shipreport.functions.derive import fix_regional_spelling
from shipreport.functions.predicates import all_of, date_window, group_in, status_in
from shipreport.functions.text import col
from shipreport.operators.dedup import latest_per_key
from shipreport.operators.listjoin import join_customer_list
from shipreport.operators.profile import normalise_dates
from shipreport.operators.projection import select_report, unique_names, with_insurance_id
from shipreport.operators.receivers import clean_receivers
from shipreport.plans.periods import month_table_window
from shipreport.plans.registry import Context, derive_columns
from shipreport.plans.report import ReportConfig
from shipreport.schema import TIMESTAMPS


def newest_rows(extract: DataFrame, tie_break: list[Column] | None = None) -> DataFrame:
    """The shared base of all reports of one extract: one row per waybill.

    Dates that come as text are read first, or the newest row would be the last in
    the alphabet; regional names get one spelling.
    """
    extract = fix_regional_spelling(normalise_dates(extract, [c for c in TIMESTAMPS if c in extract.columns]))
    version = "TGL_TARIK_REPORT" if "TGL_TARIK_REPORT" in extract.columns else "TGL_ENTRY"
    return latest_per_key(extract, "AWB", version, tie_break=tie_break)


def build_monthly_report(
    base: DataFrame,
    config: ReportConfig,
    ctx: Context,
    now: datetime,
    *,
    listing: DataFrame | None = None,
    receiver_words: list[str] = (),
) -> DataFrame:
    """One report over the newest rows of the months."""
    df = base.where(group_in(col("BIG_GROUPING_CUST"), config.group_name)) if config.group_name else base
    if config.id_account:
        df = df.where(F.coalesce(col("ID_ACCOUNT").isin(config.id_account), F.lit(False)))
    if config.selected_statuses:
        df = df.where(status_in(col("STATUS_POD"), config.selected_statuses, cased=True))
    if config.jumlah_bulan:
        df = df.where(date_window(df, "TGL_ENTRY", *month_table_window(config.jumlah_bulan, now)))
    if config.clean_receiver:
        df = clean_receivers(df, list(receiver_words))
    selected = list(config.selected_cols or [])
    if selected:
        selected = unique_names(with_insurance_id(selected))
        df = derive_columns(df, selected, replace(ctx, full_status=True))
        df = df.withColumns({c: F.lit("") for c in selected if c not in df.columns})
    df = df.where(all_of(df, config.filter_cols, cased=True))
    if config.cust_ref:
        if listing is None:
            raise ValueError(f"report {config.name} needs its customer list")
        requested = config.cust_ref.get("selected_ref_cols", [])
        df = join_customer_list(listing, df, tuple(config.cust_ref.get("key_col", ["AWB", "AWB"])),
                                requested=requested, list_wins=True)
        selected = list(dict.fromkeys([*requested, *selected]))
    return select_report(df, selected, exclude=config.exclude_cols, rename=config.rename_cols)
