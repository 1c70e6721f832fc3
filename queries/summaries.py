"""Pivot tables, presets, date profiles and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.master import PROJECTS, projects, shipments, view_sql
from queries.registry import query, table
from shipreport.functions.text import col
from shipreport.operators import lookups
from shipreport.operators.pivots import Measure, Pivot, in_one_month, pivot_long, pivot_totals, pivot_wide
from shipreport.operators.profile import column_rules, normalise_dates, parse_report, profile_dates
from shipreport.plans.presets import PRESETS
from shipreport.session import stored

_COUNT = Measure("AWB", "count", "JUMLAH")
_MEMBERS = ["Success", "Undel", "On Process", "Return Shipper", "Un Receiving", "RU Shipper/Origin", "(blank)"]


@query("pivot_rows", f"""WITH s AS ({view_sql("AWB", "REGIONAL", "STATUS_POD", "AMOUNT")})
SELECT REGIONAL, STATUS_POD, count(AWB) AS "JUMLAH", sum(AMOUNT) AS "TOTAL" FROM s GROUP BY 1, 2""")
def pivot_rows(spark, sf):
    df = shipments(spark, sf, "AWB", "REGIONAL", "STATUS_POD", "AMOUNT")
    return pivot_long(df, Pivot("p", ["REGIONAL", "STATUS_POD", "NOT_THERE"], [],
                                [_COUNT, Measure("AMOUNT", "sum", "TOTAL"), Measure("GONE", "count")]))


@query("pivot_cols", f"""WITH s AS ({view_sql("AWB", "3 LC DEST", "STATUS_POD")})
SELECT "3 LC DEST", {", ".join(
    f"nullif(count(AWB) FILTER (WHERE coalesce(STATUS_POD, '(blank)') = '{m}'), 0) AS \"{m}\"" for m in _MEMBERS)}
FROM s GROUP BY 1""")
def pivot_cols(spark, sf):
    df = shipments(spark, sf, "AWB", "3 LC DEST", "STATUS_POD")
    return pivot_wide(df, Pivot("p", ["3 LC DEST"], ["STATUS_POD"], [_COUNT]), members=_MEMBERS)


@query("pivot_cols_found", """SELECT l_linenumber,
  count(l_orderkey) FILTER (WHERE l_returnflag = 'A') AS "A_n", sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS "A_qty",
  count(l_orderkey) FILTER (WHERE l_returnflag = 'N') AS "N_n", sum(l_quantity) FILTER (WHERE l_returnflag = 'N') AS "N_qty",
  count(l_orderkey) FILTER (WHERE l_returnflag = 'R') AS "R_n", sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS "R_qty"
FROM lineitem GROUP BY 1""")
def pivot_cols_found(spark, sf):
    measures = [Measure("l_orderkey", "count", "n"), Measure("l_quantity", "sum", "qty")]
    return pivot_wide(table(spark, sf, "lineitem"), Pivot("p", ["l_linenumber"], ["l_returnflag"], measures))


@query("pivot_measures", f"""WITH s AS ({view_sql("AWB", "ZONA", "WEIGHT", "AMOUNT")})
SELECT ZONA, count(AWB) AS n, sum(AMOUNT) AS total, round(avg(WEIGHT), 6) AS mean, max(WEIGHT) AS hi, min(WEIGHT) AS lo
FROM s GROUP BY 1""")
def pivot_measures(spark, sf):
    df = shipments(spark, sf, "AWB", "ZONA", "WEIGHT", "AMOUNT")
    values = [Measure("AWB", "count", "n"), Measure("AMOUNT", "other", "total"), Measure("WEIGHT", "average", "mean"),
              Measure("WEIGHT", "max", "hi"), Measure("WEIGHT", "min", "lo")]
    return pivot_long(df, Pivot("p", ["ZONA"], [], values)).withColumn("mean", F.round("mean", 6))


def _share_sql(over: str) -> str:
    return f"""WITH s AS ({view_sql("AWB", "REGIONAL", "STATUS_POD")}),
g AS (SELECT REGIONAL, STATUS_POD, count(AWB) AS n FROM s GROUP BY 1, 2)
SELECT REGIONAL, STATUS_POD, n AS "JUMLAH", round(n / sum(n) OVER ({over}), 9) AS share FROM g"""


def _share(spark, sf, of):
    df = shipments(spark, sf, "AWB", "REGIONAL", "STATUS_POD")
    spec = Pivot("p", ["REGIONAL"], ["STATUS_POD"], [_COUNT, Measure("AWB", "count", "share", of)])
    return pivot_long(df, spec).withColumn("share", F.round("share", 9))


@query("pivot_pct_row", _share_sql("PARTITION BY REGIONAL"))
def pivot_pct_row(spark, sf):
    return _share(spark, sf, "row")


@query("pivot_pct_col", _share_sql("PARTITION BY STATUS_POD"))
def pivot_pct_col(spark, sf):
    return _share(spark, sf, "column")


@query("pivot_pct_total", _share_sql(""))
def pivot_pct_total(spark, sf):
    return _share(spark, sf, "total")


@query("pivot_month", f"""WITH s AS ({view_sql("AWB", "TGL_ENTRY", "STATUS_POD")})
SELECT CAST(date_trunc('month', TGL_ENTRY) AS DATE) AS TGL_ENTRY, STATUS_POD, count(AWB) AS "JUMLAH"
FROM s GROUP BY 1, 2""")
def pivot_month(spark, sf):
    df = shipments(spark, sf, "AWB", "TGL_ENTRY", "STATUS_POD")
    return pivot_long(df, Pivot("p", ["TGL_ENTRY"], ["STATUS_POD"], [_COUNT]))


@query("pivot_day", """SELECT CAST(ts AS DATE) AS "TGL_ENTRY", event_type, count(event_id) AS "JUMLAH" FROM events GROUP BY 1, 2""")
def pivot_day(spark, sf):
    # All events lie in one month, so the date field keeps its days.
    df = table(spark, sf, "events").withColumnRenamed("ts", "TGL_ENTRY")
    return pivot_long(df, Pivot("p", ["TGL_ENTRY"], ["event_type"], [Measure("event_id", "count", "JUMLAH")]))


@query("pivot_filtered", f"""WITH s AS ({view_sql("AWB", "REASON RETURN", "STATUS_POD")})
SELECT "REASON RETURN", count(AWB) AS "JUMLAH" FROM s WHERE STATUS_POD = 'Undel' GROUP BY 1""")
def pivot_filtered(spark, sf):
    df = shipments(spark, sf, "AWB", "REASON RETURN", "STATUS_POD")
    return pivot_long(df, PRESETS["pivot_reason_return"][0])


@query("pivot_hide_blank", f"""WITH s AS ({view_sql("AWB", "CODING", "ZONA")})
SELECT CODING, ZONA, count(AWB) AS "JUMLAH" FROM s WHERE trim(CODING) <> '' AND ZONA IS NOT NULL GROUP BY 1, 2""")
def pivot_hide_blank(spark, sf):
    df = shipments(spark, sf, "AWB", "CODING", "ZONA")
    return pivot_long(df, Pivot("p", ["CODING"], ["ZONA"], [_COUNT], hide_blank=True))


@query("pivot_sorted", f"""WITH s AS ({view_sql("AWB", "TGL_ENTRY", "STATUS_POD")}),
g AS (SELECT STATUS_POD, CAST(date_trunc('month', TGL_ENTRY) AS DATE) AS TGL_ENTRY, count(AWB) AS n FROM s GROUP BY 1, 2)
SELECT STATUS_POD, TGL_ENTRY, n AS "JUMLAH", round(n / sum(n) OVER (PARTITION BY TGL_ENTRY), 9) AS "% of Row Total"
FROM g ORDER BY 4 DESC, 1, 2""")
def pivot_sorted(spark, sf):
    df = shipments(spark, sf, "AWB", "TGL_ENTRY", "STATUS_POD")
    out = pivot_long(df, PRESETS["pivot_status_by_tgl_entry"][0])
    return out.withColumn("% of Row Total", F.round(col("% of Row Total"), 9))


@query("pivot_rollup", f"""WITH s AS ({view_sql("AWB", "REGIONAL", "3 LC DEST", "STATUS_POD", "AMOUNT")})
SELECT REGIONAL, "3 LC DEST", STATUS_POD,
  2 - grouping(REGIONAL) - grouping("3 LC DEST") AS row_level, 1 - grouping(STATUS_POD) AS column_level,
  count(AWB) AS "JUMLAH", sum(AMOUNT) AS total, max(AMOUNT) AS hi
FROM s GROUP BY GROUPING SETS ((REGIONAL, "3 LC DEST", STATUS_POD), (REGIONAL, STATUS_POD), (STATUS_POD),
  (REGIONAL, "3 LC DEST"), (REGIONAL), ())""")
def pivot_rollup(spark, sf):
    df = shipments(spark, sf, "AWB", "REGIONAL", "3 LC DEST", "STATUS_POD", "AMOUNT")
    values = [_COUNT, Measure("AMOUNT", "sum", "total"), Measure("AMOUNT", "max", "hi")]
    return pivot_totals(df, Pivot("p", ["REGIONAL", "3 LC DEST"], ["STATUS_POD"], values))


# ---- every preset over one master, in one common shape ----------------------

_PRESET_COLUMNS = [
    "AWB", "AMOUNT", "STATUS_POD", "3 LC DEST", "CARRER", "ID_ACCOUNT", "TGL_ENTRY", "ORIGIN", "REASON RETURN",
    "SERVICE", "ZONA", "REGIONAL", "CARRER_POD",
]
# Columns the presets take from derivations (which have queries of their own), here from master columns.
_DERIVED = {
    "AJ Car Status": "CASE WHEN STATUS_POD = 'Success' THEN 'Delivered' ELSE 'Open' END", "KETERANGAN AJ CAR": "'ket ' || STATUS_POD",
    "CODING_UNDEL": "SERVICE", "REASON UNDEL": "ZONA", "DEPT PZC": "'PZC ' || ID_ACCOUNT", "ORIGIN 2": "substr(ORIGIN, 1, 3)",
    "CYCLE NAME": "'CY ' || SERVICE", "STATUS": "STATUS_POD", "REFF NUM": "AWB", "KET AWB": "CASE WHEN AWB IS NULL THEN 'none' ELSE 'found' END",
    "CUSTOMER": "'HO'", "CUST_NAME": "'name ' || ID_ACCOUNT", "CAREER_1ST": "CARRER_POD", "WILAYAH": "REGIONAL",
    "PERIODE": "'bulan ' || CAST(month(TGL_ENTRY) AS STRING)", "WEEK_OF_YEAR": "CAST(weekofyear(TGL_ENTRY) AS INT)",
}
_PRESETS_HERE = [(name, p) for name, pivots in PRESETS.items() for p in pivots]


def _member_sql(f: str) -> str:
    return f"CAST(date_trunc('month', \"{f}\") AS DATE)" if "TGL" in f else f'"{f}"'


def _preset_sql() -> str:
    arms = []
    for name, p in _PRESETS_HERE:
        rows = ", ".join(f"coalesce(CAST({_member_sql(f)} AS STRING), '(blank)')" for f in p.rows)
        columns = ", ".join(f"coalesce(CAST({_member_sql(f)} AS STRING), '(blank)')" for f in p.columns) or "''"
        where = " AND ".join(f"\"{f}\" = '{v}'" for f, v in p.filters)
        if p.hide_blank:
            where = " AND ".join(f"trim(\"{f}\") <> ''" for f in p.rows)
        inner = f"""SELECT concat_ws(' | ', {rows}) AS r, concat_ws(' | ', {columns}) AS c, count(AWB) AS n,
          sum(AMOUNT) AS amount FROM s {'WHERE ' + where if where else ''} GROUP BY 1, 2"""
        for m in p.values:
            over = {"row": "PARTITION BY r", "column": "PARTITION BY c", None: None}[m.percent_of]
            value = "amount" if m.field == "AMOUNT" else "n" if over is None else f"n / sum(n) OVER ({over})"
            arms.append(f"""SELECT '{name}' AS preset, '{p.name}' AS pivot, '{m.label}' AS measure, r AS row_member,
              c AS column_member, round(CAST({value} AS DOUBLE), 6) AS value FROM ({inner})""")
    derived = ", ".join(f'{e} AS "{c}"' for c, e in _DERIVED.items())
    return f"WITH s AS (SELECT *, {derived} FROM ({view_sql(*_PRESET_COLUMNS)}))\n" + "\nUNION ALL ".join(arms)


@query("pivot_presets", _preset_sql())
def pivot_presets(spark, sf):
    # As in a report run, the pivots read the stored report, each its own columns.
    df = stored(shipments(spark, sf, *_PRESET_COLUMNS).withColumns({c: F.expr(e) for c, e in _DERIVED.items()}), "presets")
    whole, one_month = None, in_one_month(df)
    for name, p in _PRESETS_HERE:
        long = pivot_long(df, p, one_month)

        def member(fields):
            return F.concat_ws(" | ", *[F.coalesce(col(f).cast("string"), F.lit("(blank)")) for f in fields])

        lines = long.select(
            F.lit(name).alias("preset"), F.lit(p.name).alias("pivot"), member(p.rows).alias("row_member"),
            member(p.columns).alias("column_member"),
            F.inline(F.array(*[
                F.struct(F.lit(m.label).alias("measure"), F.round(col(m.label).cast("double"), 6).alias("value"))
                for m in p.values])))
        whole = lines if whole is None else whole.unionByName(lines)
    return whole


# ---- account groups --------------------------------------------------------


@query("ids_per_group", f"""WITH p AS ({PROJECTS}), q AS (
SELECT upper(trim(BIG_GROUPING_CUST)) AS group_name, trim(CUST_ID) AS id, row_idx FROM p WHERE BIG_GROUPING_CUST IS NOT NULL)
SELECT group_name, CASE WHEN starts_with(id, chr(39)) THEN id ELSE concat(chr(39), id) END AS account_id,
  min(row_idx) AS first_idx FROM q GROUP BY 1, 2""")
def ids_per_group(spark, sf):
    return lookups.group_accounts(projects(spark, sf))


_NAMES = ["CUSTOMER#00000001", "customer#0000000.5", "NATION"]


@query("ids_by_name_theta", f"""WITH p AS ({PROJECTS}), names AS (SELECT unnest({_NAMES}) AS group_name)
SELECT group_name, CASE WHEN starts_with(trim(CUST_ID), chr(39)) THEN trim(CUST_ID) ELSE concat(chr(39), trim(CUST_ID)) END
  AS account_id, min(row_idx) AS first_idx
FROM p, names WHERE regexp_matches(upper(CUST_NAME), upper(group_name)) GROUP BY 1, 2""")
def ids_by_name_theta(spark, sf):
    return lookups.accounts_by_name(projects(spark, sf), _NAMES)


@query("ids_by_name_index", f"""WITH p AS ({PROJECTS}), names AS (SELECT unnest({_NAMES}) AS group_name UNION SELECT n_name FROM nation)
SELECT group_name, CASE WHEN starts_with(trim(CUST_ID), chr(39)) THEN trim(CUST_ID) ELSE concat(chr(39), trim(CUST_ID)) END
  AS account_id, min(row_idx) AS first_idx
FROM p, names WHERE regexp_matches(upper(CUST_NAME), upper(group_name)) GROUP BY 1, 2""")
def ids_by_name_index(spark, sf):
    """Accounts by name through the gram index of customer names; the patterns are a table."""
    names = spark.createDataFrame([(n,) for n in _NAMES], "group_name string").unionByName(table(spark, sf, "nation").select(F.col("n_name").alias("group_name")))
    return lookups.accounts_by_pattern(projects(spark, sf), names)


# ---- date columns ----------------------------------------------------------

_RAW = {
    "c_serial": "CASE WHEN event_id % 19 = 0 THEN NULL ELSE CAST(45292 + event_id % 700 AS STRING) || '.5' END",
    "c_ms": "CAST(1704067200000 + event_id * 1000 AS STRING)",
    "c_s": "CAST(1704067200 + event_id * 60 AS STRING)",
    "c_tgl": "CASE event_id % 12 WHEN 0 THEN '15/02/2024 10:30' WHEN 1 THEN '2/15/2024 10:30' WHEN 2 THEN '15-Feb-2024 10:30'"
             " WHEN 3 THEN '2024-02-15' WHEN 4 THEN '15 February 2024' WHEN 5 THEN '3/4/99 1:05' WHEN 6 THEN 'bukan tanggal'"
             " WHEN 7 THEN '45337.25' WHEN 8 THEN NULL WHEN 9 THEN '15.02.2024' WHEN 10 THEN '2024-02-15 23:59:58'"
             " ELSE '15-02-24' END",
}
_SQL_FORMATS = (
    "['%m/%d/%y %H:%M', '%m/%d/%Y %H:%M', '%d-%b-%Y %H:%M', '%d-%b-%y %H:%M', '%d/%m/%Y %H:%M', '%d/%m/%y %H:%M', "
    "'%Y-%m-%d %H:%M:%S', '%Y-%m-%d %H:%M', '%Y-%m-%d', '%d %b %Y', '%d %B %Y', '%d/%m/%Y', '%m/%d/%Y', '%d-%m-%Y', "
    "'%d-%m-%y', '%Y/%m/%d', '%d.%m.%Y', '%d.%m.%y']")
_RAW_SQL = "raw AS (SELECT event_id, " + ", ".join(f"{e} AS {n}" for n, e in _RAW.items()) + " FROM events)"
_SERIAL = "TIMESTAMP '1899-12-30' + to_microseconds(CAST(round(TRY_CAST({c} AS DOUBLE) * 86400000000) AS BIGINT))"
_PARSED = {
    "c_serial": _SERIAL.format(c="c_serial"),
    "c_ms": "make_timestamp(TRY_CAST(c_ms AS BIGINT) * 1000)",
    "c_s": "make_timestamp(TRY_CAST(c_s AS BIGINT) * 1000000)",
    "c_tgl": "coalesce(CASE WHEN regexp_matches(c_tgl, '^\\d{5}(\\.\\d+)?$') THEN " + _SERIAL.format(c="c_tgl")
             + " END, CASE WHEN regexp_matches(c_tgl, '^\\d{1,2}-\\d{1,2}-\\d{2}$') THEN try_strptime(c_tgl, '%d-%m-%y')"
             # this engine's %Y would read a two-digit year as the year 15
             + f" ELSE try_strptime(c_tgl, {_SQL_FORMATS}) END)",
}


def _raw(spark, sf):
    return table(spark, sf, "events").select("event_id", *[F.expr(e).alias(n) for n, e in _RAW.items()])


@query("parse_dates", f"WITH {_RAW_SQL} SELECT event_id, " + ", ".join(
    f"{e} AS {n}" for n, e in _PARSED.items()) + " FROM raw")
def parse_dates(spark, sf):
    return normalise_dates(_raw(spark, sf), list(_RAW))


@query("date_profile", f"""WITH {_RAW_SQL}, p AS (SELECT {", ".join(
    f"count({n}) AS {n}_f, count({e}) AS {n}_p" for n, e in _PARSED.items())} FROM raw)
{" UNION ALL ".join(
    f"SELECT '{n}' AS column_name, '{r}' AS rule, {n}_f AS filled, {n}_p AS parsed, "
    f"round({n}_p / greatest({n}_f, 1) * 100, 2) AS parsed_pct FROM p"
    for n, r in {"c_serial": "serial", "c_ms": "epoch_ms", "c_s": "epoch_s", "c_tgl": "text"}.items())}""")
def date_profile(spark, sf):
    df = _raw(spark, sf)
    return parse_report(df, list(_RAW), column_rules(df, list(_RAW)))


@query("date_rules", f"""WITH {_RAW_SQL} {" UNION ALL ".join(
    f"SELECT '{n}' AS column_name, count({n}) AS filled, count(CASE WHEN regexp_matches({n}, '^[0-9]+([.][0-9]+)?$') THEN 1 END)"
    f" AS numeric, max(CASE WHEN regexp_matches({n}, '^[0-9]+([.][0-9]+)?$') THEN CAST({n} AS DOUBLE) END) AS largest,"
    f" count(CASE WHEN regexp_matches({n}, '^[0-9]+([.][0-9]+)?$') AND CAST({n} AS DOUBLE) BETWEEN 29500 AND 50000 THEN 1 END)"
    f" AS serial_like, '{r}' AS rule FROM raw"
    for n, r in {"c_serial": "serial", "c_ms": "epoch_ms", "c_s": "epoch_s", "c_tgl": "text"}.items())}""")
def date_rules(spark, sf):
    return profile_dates(_raw(spark, sf), list(_RAW))


_MIXED = ("CASE event_id % 5 WHEN 0 THEN '3/4/2024 10:05' WHEN 1 THEN '25-12-24' WHEN 2 THEN '2024-04-03 01:02:03'"
          " WHEN 3 THEN NULL ELSE '15 February 2024' END")


@query("parse_dates_mixed", f"""WITH r AS (SELECT event_id, {_MIXED} AS t FROM events)
SELECT event_id, CASE WHEN t LIKE '%/%' THEN try_strptime(t, '%d/%m/%Y %H:%M') WHEN t LIKE '__-__-__' THEN try_strptime(t, '%d-%m-%y')
  ELSE try_strptime(t, ['%Y-%m-%d %H:%M:%S', '%d %B %Y']) END AS parsed FROM r""")
def parse_dates_mixed(spark, sf):
    from shipreport.functions.moments import parse_mixed

    return table(spark, sf, "events").select("event_id", parse_mixed(F.expr(_MIXED)).alias("parsed"))
