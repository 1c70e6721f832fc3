"""Differences between timestamps and parsing of date text."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

HOUR = 3_600_000_000
DAY = 24 * HOUR

# Indonesian month names by month number.
MONTHS = [
    "JANUARI", "FEBRUARI", "MARET", "APRIL", "MEI", "JUNI",
    "JULI", "AGUSTUS", "SEPTEMBER", "OKTOBER", "NOVEMBER", "DESEMBER",
]

# Explicit date formats in order of trial. The second item says
# whether the year has two digits.
DATE_FORMATS = [
    ("M/d/yy H:m", True), ("M/d/yyyy H:m", False), ("d-MMM-yyyy H:m", False), ("d-MMM-yy H:m", True),
    ("d/M/yyyy H:m", False), ("d/M/yy H:m", True), ("yyyy-M-d H:m:s", False), ("yyyy-M-d H:m", False),
    ("yyyy-M-d", False), ("d MMM yyyy", False), ("d MMMM yyyy", False), ("d/M/yyyy", False),
    ("M/d/yyyy", False), ("d-M-yyyy", False), ("d-M-yy", True), ("yyyy/M/d", False),
    ("d.M.yyyy", False), ("d.M.yy", True),
]

DAY_FIRST_FORMATS = [
    ("d/M/yyyy H:m:s", False), ("d/M/yyyy H:m", False), ("d/M/yyyy", False), ("d/M/yy H:m", True), ("d/M/yy", True),
    ("d-M-yyyy H:m:s", False), ("d-M-yyyy H:m", False), ("d-M-yyyy", False), ("d-M-yy H:m", True), ("d-M-yy", True),
]


def micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def whole_days(start: Column, end: Column) -> Column:
    """Elapsed days rounded down, so one hour backwards is -1."""
    return F.floor((micros(end) - micros(start)) / DAY)


def hours_up(start: Column, end: Column) -> Column:
    """Elapsed hours rounded up."""
    return F.ceil((micros(end) - micros(start)) / HOUR)


def month_name(c: Column) -> Column:
    return F.coalesce(F.get(F.array(*[F.lit(m) for m in MONTHS]), F.month(c) - 1), F.lit(""))


def month_label(c: Column) -> Column:
    """yyyy-MM and the month name, e.g. ``1998-03 MARET``; null stays null."""
    return F.when(c.isNotNull(), F.concat_ws(" ", F.date_format(c, "yyyy-MM"), month_name(c)))


def serial_day(c: Column) -> Column:
    """Spreadsheet serial number to timestamp; fractions are the time of day."""
    value = c.try_cast("double")
    # Serial 0 is 1899-12-30, which lies 25569 days before the epoch.
    moment = F.timestamp_micros(F.round((value - 25569) * DAY).cast("long"))
    return F.when((value >= 2) & (value < 2_958_466), moment)


# What each pattern letter run may look like in a text.
_PIECES = {
    "yyyy": r"\d{4}", "yy": r"\d{2}", "MMMM": "[A-Za-z]+", "MMM": "[A-Za-z]{3}", "M": "(0?[1-9]|1[0-2])",
    "d": r"(0?[1-9]|[12]\d|3[01])", "H": r"([01]?\d|2[0-3])", "m": r"[0-5]?\d", "s": r"[0-5]?\d",
}


def _shape(pattern: str) -> str:
    """Regex of the texts a date pattern can read."""
    runs = re.findall(r"([A-Za-z])(\1*)|([^A-Za-z])", pattern)
    return "^" + "".join(_PIECES[letter + more] if letter else re.escape(mark) for letter, more, mark in runs) + "$"


def with_formats(text: Column, formats: list[tuple[str, bool]]) -> Column:
    """First format that fits; two-digit years from 69 on belong to the last century.

    A pattern is tried only on texts of its shape: a failed parse costs an
    exception per row, the shape test does not.
    """
    tries = []
    for pattern, short_year in formats:
        parsed = F.try_to_timestamp(text, F.lit(pattern))
        if short_year:
            parsed = F.when(F.year(parsed) >= 2069, F.timestamp_add("YEAR", F.lit(-100), parsed)).otherwise(parsed)
        tries.append(F.when(text.rlike(_shape(pattern)), parsed))
    return F.coalesce(*tries)


def parse_text(c: Column) -> Column:
    """Serial numbers, then the explicit formats, then compact yyyyMMdd and ISO text."""
    text = F.trim(c.cast("string"))
    serial = F.when(text.rlike(r"^\d{5}(\.\d+)?$"), serial_day(text))
    compact = F.when(text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")))
    iso = F.when(text.rlike(r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d"), text.try_cast("timestamp"))
    return F.coalesce(serial, with_formats(text, DATE_FORMATS), compact, iso)


def parse_numbers(c: Column, rule: str | None) -> Column | None:
    """Column-wide numeric rule chosen from a profile: epoch_ms, epoch_s or serial."""
    value = c.try_cast("double")
    if rule == "epoch_ms":
        return F.timestamp_micros(F.round(value * 1000).try_cast("long"))
    if rule == "epoch_s":
        return F.timestamp_micros(F.round(value * 1_000_000).try_cast("long"))
    if rule == "serial":
        return serial_day(c)
    return None


def parse_mixed(c: Column) -> Column:
    """Text starting like d/m/y is read day first, everything else by the general rules."""
    text = F.trim(c.cast("string"))
    day_first = F.when(text.rlike(r"^\d{1,2}[/-]\d{1,2}[/-]\d{2,4}"), with_formats(text, DAY_FIRST_FORMATS))
    return F.coalesce(day_first, parse_text(c))
