"""Two-valued row filters built from nested config lists and dicts.

Every leaf yields true or false, never null, so that ``not`` is a plain
complement. A missing column lets every row pass.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shipreport.functions.text import account_id, col


def _text(c: Column) -> Column:
    return c.cast("string")


def _number(c: Column) -> Column:
    return c.try_cast("double")


def _or(c: Column, default: bool) -> Column:
    return F.coalesce(c, F.lit(default))


def _sought(values) -> list:
    return list(values) if isinstance(values, (list, tuple, set, frozenset)) else [values]


def _regex(c: Column, pattern: str) -> Column:
    return _or(_text(c).rlike("(?i)" + str(pattern)), False)


LEAVES: dict[str, Callable[[Column, object], Column]] = {
    "starts_with": lambda c, v: _or(F.upper(_text(c)).startswith(str(v).upper()), False),
    "ends_with": lambda c, v: _or(F.upper(_text(c)).endswith(str(v).upper()), False),
    "contains": _regex,
    "regex": _regex,
    "equals": lambda c, v: _or(c == F.lit(v), False),
    "iequals": lambda c, v: _or(F.upper(_text(c)) == str(v).upper(), False),
    "not_equals": lambda c, v: _or(c != F.lit(v), True),
    "gt": lambda c, v: _or(_number(c) > float(v), False),
    "lt": lambda c, v: _or(_number(c) < float(v), False),
    "gte": lambda c, v: _or(_number(c) >= float(v), False),
    "lte": lambda c, v: _or(_number(c) <= float(v), False),
    "in": lambda c, v: _or(c.isin(_sought(v)), False),
    "not_in": lambda c, v: _or(~c.isin(_sought(v)), True),
}

# The older config dialect compares prefixes and suffixes with their case.
CASED_LEAVES: dict[str, Callable[[Column, object], Column]] = {
    **LEAVES,
    "starts_with": lambda c, v: _or(_text(c).startswith(str(v)), False),
    "ends_with": lambda c, v: _or(_text(c).endswith(str(v)), False),
}


def _actual(df: DataFrame, name: str) -> str | None:
    wanted = name.strip().upper()
    return next((c for c in df.columns if c.strip().upper() == wanted), None)


def leaf(df: DataFrame, rule, *, cased: bool = False, literal: bool = False) -> Column:
    """One ``[column, operator, value]`` rule; ``literal`` switches ``contains`` off regex."""
    name, operator, value = rule
    if operator not in LEAVES:
        raise ValueError(f"unknown filter operator: {operator}")
    actual = _actual(df, name)
    if actual is None:
        return F.lit(True)
    if literal and operator == "contains":
        value = re.escape(str(value))
    return (CASED_LEAVES if cased else LEAVES)[operator](col(actual), value)


def tree(df: DataFrame, node, **options) -> Column:
    """A leaf, or a dict with exactly one of and / or / not."""
    if isinstance(node, (list, tuple)) and len(node) == 3 and isinstance(node[0], str):
        return leaf(df, node, **options)
    if not isinstance(node, dict) or len(node) != 1:
        raise ValueError(f"expected [column, operator, value] or one of and/or/not: {node!r}")
    ((word, body),) = node.items()
    word = word.lower()
    if word == "not":
        return ~tree(df, body, **options)
    if word not in ("and", "or"):
        raise ValueError(f"unknown logical word: {word}")
    parts = [tree(df, child, **options) for child in body]
    if not parts:
        raise ValueError(f"{word} needs at least one condition")
    joined = parts[0]
    for part in parts[1:]:
        joined = joined & part if word == "and" else joined | part
    return joined


def all_of(df: DataFrame, rules, **options) -> Column:
    """The flat list form: every rule must hold."""
    return tree(df, {"and": list(rules)}, **options) if rules else F.lit(True)


def bound(df: DataFrame, name: str, moment: date | datetime | str) -> Column:
    """A literal of the column's own type, so the comparison reaches the file scan."""
    kind = df.schema[name].dataType
    text = moment if isinstance(moment, str) else moment.isoformat(sep=" ") if isinstance(
        moment, datetime) else moment.isoformat()
    if isinstance(kind, T.StringType):
        return F.lit(text)
    return F.lit(text).cast(kind)


def date_window(df: DataFrame, name: str, start, end) -> Column:
    """Half-open window start <= column < end."""
    return (col(name) >= bound(df, name, start)) & (col(name) < bound(df, name, end))


def account_in(c: Column, accounts) -> Column:
    """Membership that ignores padding and the apostrophe on either side."""
    wanted = sorted({str(a).strip().lstrip("'").strip() for a in accounts} - {""})
    return _or(account_id(c).isin(wanted), False)


def stored_account_in(c: Column, accounts) -> Column:
    """Membership on untouched stored ids in both spellings; this form is pushed to the scan."""
    plain = sorted({str(a).strip().lstrip("'").strip() for a in accounts} - {""})
    return _or(c.isin(plain + ["'" + a for a in plain]), False)


def status_in(c: Column, statuses, *, cased: bool = False) -> Column:
    if cased:
        return _or(c.isin(_sought(statuses)), False)
    return _or(F.upper(c).isin(sorted({str(s).upper() for s in _sought(statuses)})), False)


def group_in(c: Column, groups) -> Column:
    """A group name or a list of group names."""
    return _or(c.isin(_sought(groups)), False)
