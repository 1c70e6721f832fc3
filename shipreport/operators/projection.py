"""Column choice, names and order of a report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shipreport.functions.text import col, upper_header
from shipreport.schema import MASTER_COLUMNS


def normalise_headers(df: DataFrame) -> DataFrame:
    """Stripped upper-case column names."""
    return df.toDF(*[upper_header(c) for c in df.columns])


def present_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns the table has, ignoring case; the whole table if it has none of them."""
    have = {upper_header(c): c for c in df.columns}
    found = list(dict.fromkeys(have[upper_header(w)] for w in wanted if upper_header(w) in have))
    return df.select(*map(col, found)) if found else df


def unique_names(names: list[str]) -> list[str]:
    """First spelling of every name, ignoring case."""
    seen: dict[str, str] = {}
    for name in names:
        seen.setdefault(upper_header(name), name)
    return list(seen.values())


def with_insurance_id(names: list[str], master: list[str] = MASTER_COLUMNS) -> list[str]:
    """INSURANCE_ID behind the goods description, else behind the last column in master order, else in front."""
    if "INSURANCE_ID" in names:
        return list(names)
    at = 0
    if "GOODS_DESCR" in names:
        at = names.index("GOODS_DESCR") + 1
    else:
        known = [c for c in master if c in names]
        if known:
            at = names.index(known[-1]) + 1
    return names[:at] + ["INSURANCE_ID"] + names[at:]


def select_report(
    df: DataFrame,
    selected: list[str] | None,
    *,
    exclude: list[str] = (),
    rename: list[str] | None = None,
    order: list[str] | None = None,
    carry: list[str] = (),
) -> DataFrame:
    """Listed columns (blank where absent), minus exclusions, renamed by position, then ordered.

    Renaming needs exactly one new name per selected column and is left out
    otherwise. Columns in ``carry`` (output labels) follow untouched.
    """
    if selected:
        names = unique_names(with_insurance_id(list(selected)))
    else:
        names = [c for c in df.columns if c not in carry]
    new = dict(zip(names, rename)) if selected and rename and len(rename) == len(names) else {}
    shown = {
        new.get(c, c): col(c) if c in df.columns else F.lit("")
        for c in names if c not in exclude
    }
    if order:
        shown = {c: shown[c] for c in order if c in shown}
    return df.select(*[value.alias(name) for name, value in shown.items()], *map(col, carry))
