"""Text cleaning, keys and small text derivations."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Texts that stand for "no value" in hand-kept sheets.
EMPTY_MARKS = ["", "nan", "NaN", "None", "<NA>"]


def col(name: str) -> Column:
    """A column by its literal name; names may hold spaces, dots and slashes."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean(c: Column) -> Column:
    """Non-breaking spaces to spaces, then trimmed."""
    return F.trim(F.regexp_replace(c.cast("string"), "\u00a0", " "))


def blank_to_null(c: Column, marks: list[str] = EMPTY_MARKS) -> Column:
    """Trimmed text, or null where only an empty mark is left."""
    text = F.trim(c.cast("string"))
    return F.when(~text.isin(marks), text)


def upper_header(name: str) -> str:
    return name.strip().upper()


def account_key(c: Column) -> Column:
    """Account id without trailing '.0', leading apostrophes and padding; blank is null."""
    text = F.regexp_replace(clean(c), r"\.0$", "")
    return F.nullif(F.trim(F.regexp_replace(text, "^'+", "")), F.lit(""))


def account_id(c: Column) -> Column:
    """Account id without padding and leading apostrophes, the one spelling filters compare; blank is null."""
    return F.nullif(F.trim(F.regexp_replace(F.trim(c.cast("string")), "^'+", "")), F.lit(""))


def account_text(c: Column) -> Column:
    """Account id as stored in configs: one leading apostrophe."""
    text = clean(c)
    return F.when(text == "", None).when(text.startswith("'"), text).otherwise(F.concat(F.lit("'"), text))


def waybill_key(c: Column) -> Column:
    """Trimmed, leading apostrophes and all spaces removed, upper case; blank is null."""
    text = F.regexp_replace(F.trim(c.cast("string")), "^'+", "")
    return F.nullif(F.upper(F.regexp_replace(text, r"\s+", "")), F.lit(""))


def list_key(c: Column) -> Column:
    """Join key of customer lists: no spaces, upper case, one apostrophe in front; blank is null."""
    text = F.upper(F.regexp_replace(F.trim(c.cast("string")), r"\s+", ""))
    text = F.nullif(text, F.lit(""))
    return F.when(text.startswith("'"), text).otherwise(F.concat(F.lit("'"), text))


def pickup_key(c: Column) -> Column:
    """Pickup reference number without apostrophes and asterisks; blank is null."""
    return F.nullif(F.regexp_replace(F.trim(c.cast("string")), r"['*]", ""), F.lit(""))


def code_key(c: Column) -> Column:
    """Trimmed code; the spelled-out null marks never match anything."""
    text = F.trim(c.cast("string"))
    return F.when(~F.upper(text).isin("", "NONE", "NAN", "NAT"), text)


def zip_text(c: Column) -> Column:
    """Postal code as text without a numeric tail; zero and blank marks are null."""
    text = F.regexp_replace(F.trim(c.cast("string")), r"\.0+$", "")
    return F.when(~text.isin("", "NAN", "nan", "None", "NONE", "0", "0.0"), text)


def pattern_of_example(example: str) -> str:
    r"""Regex for keys shaped like an example: digit runs become \d+, the rest is literal."""
    pieces = re.findall(r"\d+|\D+", example)
    return "(?i)" + "".join(r"\d+" if p.isdigit() else re.escape(p) for p in pieces)


def first_match(columns: list[Column], patterns: list[str]) -> Column:
    """Upper-cased first regex hit, column by column and within a column pattern by pattern."""
    hits = [
        F.nullif(F.upper(F.regexp_extract(F.trim(c.cast("string")), p, 0)), F.lit(""))
        for c in columns
        for p in patterns
    ]
    return F.coalesce(*hits)


def is_blank_key(c: Column) -> Column:
    text = F.trim(F.regexp_replace(F.trim(c.cast("string")), "^'+|'+$", ""))
    return c.isNull() | text.isin("", "NAN", "NONE")


def strip_scheme(c: Column) -> Column:
    """URL text without http:// or https://; null becomes an empty text."""
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), "^https?://", "")


def joined_list(c: Column) -> Column:
    """A list cell flattened to one comma-separated text."""
    return F.array_join(c.cast("array<string>"), ", ")


def file_label(c: Column) -> Column:
    """Value usable in an output name: slashes become dashes, leading apostrophes go."""
    return F.regexp_replace(F.regexp_replace(c.cast("string"), r"[/\\]", "-"), "^'+", "")
