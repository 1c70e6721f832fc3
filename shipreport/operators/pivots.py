"""Summary tables: row and column fields, measures, shares, totals.

The fact rows are aggregated once into mergeable parts (counts, sums, extremes).
Shares and totals are computed from those parts, never from the facts again.
"""

from __future__ import annotations

from dataclasses import dataclass, field as _field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from shipreport.functions.text import col

BLANK = "(blank)"


@dataclass(frozen=True)
class Measure:
    field: str
    func: str = "sum"
    name: str | None = None
    percent_of: str | None = None  # row, column or total

    @property
    def label(self) -> str:
        return self.name or f"{self.func.title()} of {self.field}"

    @property
    def kind(self) -> str:
        func = self.func.lower()
        return {"average": "avg"}.get(func, func if func in ("count", "avg", "max", "min") else "sum")


@dataclass(frozen=True)
class Pivot:
    name: str
    rows: list[str]
    columns: list[str] = _field(default_factory=list)
    values: list[Measure] = _field(default_factory=list)
    filters: list[tuple[str, object]] = _field(default_factory=list)
    hide_blank: bool = False
    sort: tuple[str, str] | None = None  # measure label, asc or desc

    @classmethod
    def from_config(cls, spec: dict) -> "Pivot":
        values = [
            Measure(
                v["field"], v.get("func", "sum"), v.get("name") or v.get("caption"),
                (v.get("percentage_of") or "row").lower() if v.get("as_percentage") else None,
            )
            for v in spec.get("values", [])
        ]
        filters = [(f["field"], f["value"]) for f in spec.get("filters", []) if isinstance(f, dict)]
        sort = spec.get("sort")
        return cls(
            spec["name"], list(spec.get("rows", [])), list(spec.get("columns", [])), values, filters,
            bool(spec.get("hide_blank")), (sort["by"], sort.get("order", "desc")) if sort else None,
        )


def _is_date_field(name: str) -> bool:
    upper = name.upper()
    return "TGL" in upper or ("DATE" in upper and "UPDATE" not in upper)


def _is_blank(c: Column) -> Column:
    text = F.lower(F.trim(c.cast("string")))
    return c.isNull() | text.isin("", BLANK)


def _filtered(df: DataFrame, pivot: Pivot) -> tuple[DataFrame, list[str], list[str]]:
    """Source rows of the pivot and its known row and column fields; unknown ones are left out."""
    rows = [c for c in pivot.rows if c in df.columns]
    columns = [c for c in pivot.columns if c in df.columns]
    for name, value in pivot.filters:
        if name in df.columns:
            df = df.where(col(name) == F.lit(value))
    if pivot.hide_blank:
        for name in rows + columns:
            df = df.where(~_is_blank(col(name)))
    return df, rows, columns


class _Parts:
    """Mergeable aggregates behind the measures of one pivot."""

    def __init__(self, measures: list[Measure]):
        self.names: dict[tuple[str, str], str] = {}
        for m in measures:
            for func in ("sum", "count") if m.kind == "avg" else (m.kind,):
                self.names.setdefault((func, m.field), f"_part{len(self.names)}")

    def first(self) -> list[Column]:
        functions = {"count": F.count, "sum": F.sum, "max": F.max, "min": F.min}
        return [functions[func](col(name)).alias(part) for (func, name), part in self.names.items()]

    def merged(self) -> list[Column]:
        functions = {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}
        return [functions[func](part).alias(part) for (func, _), part in self.names.items()]

    def value(self, m: Measure) -> Column:
        if m.kind == "avg":
            return F.try_divide(F.col(self.names["sum", m.field]), F.col(self.names["count", m.field]))
        return F.col(self.names[m.kind, m.field])


def in_one_month(df: DataFrame) -> Column | None:
    """Whether all entries of a sheet lie in one month: asked once for the pivots of a stored sheet."""
    if "TGL_ENTRY" not in df.columns:
        return None
    month = F.trunc(col("TGL_ENTRY"), "month")
    return df.agg((F.min(month) == F.max(month)).alias("one")).scalar()


def _base(df: DataFrame, pivot: Pivot, one_month: Column | None = None) -> tuple[DataFrame, list[str], list[str], _Parts]:
    """Aggregated parts per member combination; date fields become days, or months over several months.

    With one_month the facts are aggregated by the shown members at once. Without it dates
    are first aggregated by day, and whether all entries lie in one month is then read from
    those rows, so the facts are not computed a second time.
    """
    source, rows, columns = _filtered(df, pivot)
    parts = _Parts([m for m in pivot.values if m.field in df.columns])
    dates = [c for c in rows + columns if _is_date_field(c)]
    if not dates:
        return source.groupBy(*map(col, rows + columns)).agg(*parts.first()), rows, columns, parts

    if one_month is not None:
        members = [
            F.when(one_month, F.to_date(col(c))).otherwise(F.trunc(col(c), "month")).alias(c) if c in dates else col(c)
            for c in rows + columns
        ]
        return source.groupBy(*members).agg(*parts.first()), rows, columns, parts

    keys = [F.to_date(col(c)).alias(c) if c in dates else col(c) for c in rows + columns]
    if "TGL_ENTRY" not in df.columns:
        base, one_month = source.groupBy(*keys).agg(*parts.first()), F.lit(False)
    else:
        month = F.trunc(col("TGL_ENTRY"), "month")
        span = [F.min(month).alias("_from"), F.max(month).alias("_to")]
        base = source.groupBy(*keys).agg(*parts.first(), *span)
        # Page filters must not narrow the question, which is asked of the whole sheet.
        asked = df.agg(*span) if pivot.filters or pivot.hide_blank else base.agg(
            F.min("_from").alias("_from"), F.max("_to").alias("_to"))
        one_month = asked.select((F.col("_from") == F.col("_to")).alias("one")).scalar()
    members = [
        F.when(one_month, col(c)).otherwise(F.trunc(col(c), "month")).alias(c) if c in dates else col(c)
        for c in rows + columns
    ]
    return base.groupBy(*members).agg(*parts.merged()), rows, columns, parts


def _join_same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join on keys where a blank member equals a blank member."""
    named = right.select(*[col(k).alias(f"_t{i}") for i, k in enumerate(keys)],
                         *[col(c) for c in right.columns if c not in keys])
    same = None
    for i, k in enumerate(keys):
        part = col(k).eqNullSafe(F.col(f"_t{i}"))
        same = part if same is None else same & part
    return left.join(named, same).drop(*[f"_t{i}" for i in range(len(keys))])


def pivot_long(df: DataFrame, pivot: Pivot, one_month: Column | None = None) -> DataFrame:
    """One row per row-and-column member combination with every measure.

    one_month: the answer of `in_one_month` for df, where several pivots of one sheet share it.
    """
    base, rows, columns, parts = _base(df, pivot, one_month)
    measures = [m for m in pivot.values if m.field in df.columns]
    out = base
    shown: dict[str, Column] = {m.label: parts.value(m) for m in measures if not m.percent_of}
    for kind in ("row", "column", "total"):
        shares = [m for m in measures if m.percent_of == kind or (m.percent_of and kind == "row" and m.percent_of not in (
            "column", "total"))]
        if not shares:
            continue
        keys = rows if kind == "row" else columns if kind == "column" else []
        totals = {f"_{kind}{i}": parts.value(m) for i, m in enumerate(shares)}
        if kind == "row" and not columns:
            wholes = totals  # every row is its own total
        elif keys:
            side = base.groupBy(*map(col, keys)).agg(*parts.merged()).select(
                *map(col, keys), *[v.alias(n) for n, v in totals.items()])
            out = _join_same(out, side, keys)
            wholes = {n: F.col(n) for n in totals}
        else:
            grand = base.agg(*parts.merged())
            wholes = {n: grand.select(v.alias(n)).scalar() for n, v in totals.items()}
        for m, whole in zip(shares, wholes.values()):
            shown[m.label] = F.try_divide(parts.value(m), whole)
    labels = [m.label for m in measures]
    out = out.select(*map(col, rows + columns), *[shown[n].alias(n) for n in labels])
    if pivot.sort and pivot.sort[0] in labels:
        by = col(pivot.sort[0])
        ordered = by.asc() if pivot.sort[1].lower() == "asc" else by.desc()
        out = out.orderBy(ordered, *[col(c).asc_nulls_last() for c in rows + columns])
    return out


def member_table(long: DataFrame, columns: list[str]) -> DataFrame:
    """(columns.., _member): each member's label; members that give one text are told apart by a number."""
    members = long.select(*map(col, columns)).distinct().withColumn("_text", _label(columns))
    same = Window.partitionBy("_text").orderBy(*[col(c).asc_nulls_first() for c in columns])
    number = F.row_number().over(same)
    label = F.when(number == 1, F.col("_text")).otherwise(F.concat("_text", F.lit(" ("), number.cast("string"), F.lit(")")))
    return members.withColumn("_member", label).drop("_text")


def pivot_members(long: DataFrame, columns: list[str], limit: int | None = None) -> list[str]:
    """The distinct column labels, one for each column of the wide table; with a limit, an error beyond it."""
    found = member_table(long, columns).select("_member")
    found = (found if limit is None else found.limit(limit + 1)).collect()
    if limit is not None and len(found) > limit:
        raise ValueError(f"more than {limit} members across the columns; use the long form")
    return sorted(r[0] for r in found)


def _label(columns: list[str]) -> Column:
    return F.concat_ws(" | ", *[F.coalesce(col(c).cast("string"), F.lit(BLANK)) for c in columns])


def pivot_wide(df: DataFrame, pivot: Pivot, members: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """The same table with column members side by side.

    Widening works on the aggregated rows. A caller may set a limit to the
    number of members; the long form needs none.
    """
    long = pivot_long(df, pivot)
    rows = [c for c in pivot.rows if c in df.columns]
    columns = [c for c in pivot.columns if c in df.columns]
    if not columns:
        return long
    labels = [c for c in long.columns if c not in rows + columns]
    members = members if members is not None else pivot_members(long, columns, limit)
    names = member_table(long, columns).withColumnsRenamed({c: f"_m{i}" for i, c in enumerate(columns)})
    same = [col(c).eqNullSafe(F.col(f"_m{i}")) for i, c in enumerate(columns)]
    named = long.join(names, reduce(lambda a, b: a & b, same)).select(*map(col, rows), "_member", *map(col, labels))
    return named.groupBy(*map(col, rows)).pivot("_member", members).agg(
        *[F.first(col(m), ignorenulls=True).alias(m) for m in labels])


def pivot_totals(df: DataFrame, pivot: Pivot) -> DataFrame:
    """The long form with subtotals and grand totals.

    ``row_level`` and ``column_level`` say how many fields a line still
    distinguishes; 0 in both is the grand total.
    """
    base, rows, columns, parts = _base(df, pivot)
    plain = [m for m in pivot.values if m.field in df.columns and not m.percent_of]
    sets = [rows[:i] + c for i in range(len(rows) + 1) for c in ([columns, []] if columns else [[]])]
    grouped = base.groupingSets([[col(c) for c in s] for s in sets], *map(col, rows + columns))

    def level(names: list[str]) -> Column:
        kept = F.lit(len(names))
        for c in names:
            kept = kept - F.grouping(col(c)).cast("int")
        return kept

    out = grouped.agg(*parts.merged(), level(rows).alias("row_level"), level(columns).alias("column_level"))
    return out.select(*map(col, rows + columns), "row_level", "column_level", *[
        parts.value(m).alias(m.label) for m in plain])
