"""Lists and pickup files, split outputs, run state, and whole reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.derived import _CAL, _aging_sql, _flag_sql, _STATUS_COLUMNS, CALENDAR, STATUS_STEPS
from queries.enrichment import _LIST_SQL, _NAMED, _PATCHED, listing, patch_table
from queries.master import (
    AS_OF, PROJECTS, UNDEL_CODES, ZONES, joined, made, pick, projects, shipments, sources, undel_codes, view_sql, zones)
from queries.registry import query, table
from shipreport.functions.text import col
from shipreport.operators import runstate
from shipreport.operators.lookups import group_accounts
from shipreport.operators.pivots import Measure, Pivot, pivot_long
from shipreport.plans.registry import Context
from shipreport.plans.report import ReportConfig, build_report, build_reports_together, combine, expand_combined, write_report
from shipreport.plans.workbook import workbook
from shipreport.schema import typed
from shipreport.session import fresh_path
from shipreport.sinks import outputs
from shipreport.sources import references

_MONTHS_SQL = ("['JANUARI', 'FEBRUARI', 'MARET', 'APRIL', 'MEI', 'JUNI', 'JULI', 'AGUSTUS', 'SEPTEMBER', 'OKTOBER', "
               "'NOVEMBER', 'DESEMBER']")


def _label_sql(c: str) -> str:
    return f"strftime({c}, '%Y-%m') || ' ' || {_MONTHS_SQL}[month({c})]"


# ---- lists and files -------------------------------------------------------


@query("ref_window", """SELECT CAST(o_orderkey AS STRING) AS "AWB", o_orderdate AS "TGL PICKUP", o_orderpriority AS "LAYANAN",
  strftime(o_orderdate, '%y%m') AS _source_period FROM orders WHERE o_orderdate >= TIMESTAMP '1998-05-15'""")
def ref_window(spark, sf):
    path = fresh_path(spark, "list")
    table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("awb"), F.date_format("o_orderdate", "dd-MMM-yyyy HH:mm").alias(" Tgl Pickup "),
        F.col("o_orderpriority").alias("Layanan")).write.csv(path, header=True)
    return references.read_list_file(spark, path, "TGL PICKUP", 3, AS_OF).drop("_source_file")


@query("ref_period_union", """SELECT CAST(o_orderkey AS STRING) AS "AWB",
  CASE WHEN month(o_orderdate) = 6 THEN o_orderstatus END AS "STATUS", CASE WHEN month(o_orderdate) = 7 THEN o_orderpriority END
  AS "LAYANAN", strftime(o_orderdate, '%y%m') AS _source_period FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-06-01' AND o_orderdate < TIMESTAMP '1998-08-01'""")
def ref_period_union(spark, sf):
    root = fresh_path(spark, "lists")
    orders = table(spark, sf, "orders").withColumn("period", F.date_format("o_orderdate", "yyMM"))
    # every month has a folder; June and July files have a column of their own
    awb = F.col("o_orderkey").alias("awb")
    for months, extra in ((~F.month("o_orderdate").isin(6, 7), []), (F.month("o_orderdate") == 6, [F.col("o_orderstatus").alias("Status")]),
                          (F.month("o_orderdate") == 7, [F.col("o_orderpriority").alias("layanan")])):
        orders.where(months).select("period", awb, *extra).write.mode("append").partitionBy("period").csv(f"{root}/parts", header=True)
    return references.read_list_folders(spark, f"{root}/parts", 2, AS_OF, folder="period={}").drop("_source_file")


_FOLDERS = [("DATA BS CREDIT CARD CY 1-5 JULI 1998", "a_SD_OUTPUT"), ("Data BS UOB Cashplus CY 10 JUNI 1998", "b"),
            ("DATA KARTU LAIN CY 3 MEI 1998", "c")]
_LINE = ("concat(' ', CAST(o_orderkey AS STRING), ' ; nama é ', CAST(o_custkey AS STRING), ';;x; ', "
         "{day}, ' ')")


@query("semi_delimited", """WITH o AS (SELECT *, o_orderkey % 3 AS f FROM orders)
SELECT CAST(o_orderkey AS STRING) AS "REFF NUM", 'nama é ' || CAST(o_custkey AS STRING) AS "CUSTOMER NAME",
  CAST(o_orderdate AS DATE) AS "PICK UP DATE",
  CASE f WHEN 0 THEN 'CY 1-5 JULI 1998' ELSE 'CY 10 JUNI 1998' END AS "CYCLE NAME",
  CASE f WHEN 0 THEN 'JNE_BSCC CY 1-5 JULI_SD.txt' ELSE 'JNE_BSCP CY 10 JUNI.txt' END AS "NAMA FILE PICK UP",
  CASE f WHEN 0 THEN 'BS CY 1-5 STAMP' ELSE 'CP CY 10 NON STAMP' END AS "CYCLE & JENIS",
  CASE f WHEN 0 THEN 'BS STAMP' ELSE 'BSCP NON STAMP' END AS "JENIS BILLING",
  CASE f WHEN 0 THEN 'JULI' ELSE 'JUNI' END AS "PERIODE UOB" FROM o WHERE f < 2""")
def semi_delimited(spark, sf):
    root = fresh_path(spark, "pickups")
    line = F.expr(_LINE.format(day="date_format(o_orderdate, 'MM/dd/yyyy')"))
    orders = table(spark, sf, "orders")
    for i, (folder, name) in enumerate(_FOLDERS):
        lines = orders.where(F.col("o_orderkey") % 3 == i).select(
            F.explode(F.array(line, F.lit("kurang;isi"))).alias("REF;NAMA;TGL"))
        lines.write.csv(f"{root}/{folder}/{name}.txt", header=True, sep="\u0001", encoding="ISO-8859-1",
                        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return references.read_pickups(spark, root, 2, AS_OF)


@query("path_attrs", """WITH u AS (SELECT page_id, 'DATA BS Credit Card CY ' || CAST(page_id % 28 + 1 AS STRING) || '-30 MEI 2024' AS folder,
  CASE WHEN contains(url, 'https') THEN 'x_sd_output.txt' ELSE 'y.txt' END AS file_name FROM pages)
SELECT page_id, 'CY ' || CAST(page_id % 28 + 1 AS STRING) || '-30 MEI 2024' AS "CYCLE NAME",
  'JNE_BSCC CY ' || CAST(page_id % 28 + 1 AS STRING) || '-30 MEI' || CASE WHEN contains(file_name, 'sd') THEN '_SD.txt' ELSE '.txt' END
    AS "NAMA FILE PICK UP",
  'BS CY ' || CAST(page_id % 28 + 1 AS STRING) || '-30 ' || CASE WHEN contains(file_name, 'sd') THEN 'STAMP' ELSE 'NON STAMP' END
    AS "CYCLE & JENIS", CASE WHEN contains(file_name, 'sd') THEN 'BS STAMP' ELSE 'BS NON STAMP' END AS "JENIS BILLING" FROM u""")
def path_attrs(spark, sf):
    pages = table(spark, sf, "pages")
    folder = F.concat(F.lit("DATA BS Credit Card CY "), (F.col("page_id") % 28 + 1).cast("string"), F.lit("-30 MEI 2024"))
    name = F.when(F.col("url").contains("https"), "x_sd_output.txt").otherwise("y.txt")
    return pages.select("page_id", *[c.alias(n) for n, c in references.folder_attributes(folder, name).items()])


_RAW_TYPES = {
    "AWB": "CAST(l_orderkey AS STRING)",
    "QTY": pick("l_linenumber", ["12", "7.0", "x", "", None]),
    "WEIGHT": pick("l_partkey", ["1.25", "abc", " 2 ", None]),
    "TGL_ENTRY": pick("l_suppkey", ["36000.5", "1998-07-15 08:30:00", "bukan", None, "35990"]),
    "ETD": pick("l_partkey", ["3", "-1", "2,5"]),
}


@query("typed_cast", f"""WITH r AS (SELECT l_partkey, l_linenumber, l_suppkey, {", ".join(f"{e} AS {n}" for n, e in _RAW_TYPES.items())} FROM lineitem)
SELECT AWB, CAST(TRY_CAST(QTY AS DOUBLE) AS BIGINT) AS QTY, TRY_CAST(WEIGHT AS DOUBLE) AS WEIGHT,
  CASE WHEN regexp_matches(TGL_ENTRY, '^[0-9.]+$') THEN TIMESTAMP '1899-12-30' +
    to_microseconds(CAST(round(TRY_CAST(TGL_ENTRY AS DOUBLE) * 86400000000) AS BIGINT)) ELSE TRY_CAST(TGL_ENTRY AS TIMESTAMP) END
    AS TGL_ENTRY, CAST(TRY_CAST(ETD AS DOUBLE) AS BIGINT) AS ETD FROM r""")
def typed_cast(spark, sf):
    return typed(table(spark, sf, "lineitem").select(*[F.expr(e).alias(n) for n, e in _RAW_TYPES.items()]))


# ---- split outputs ---------------------------------------------------------


def _written(spark, df, labels, kind="split"):
    path = fresh_path(spark, kind)
    outputs.write_split(df, path, labels)
    return path


@query("split_manifest", f"""WITH s AS ({view_sql("AWB", "NATION_ACCOUNT", "REGIONAL", "AMOUNT")})
SELECT 'account' AS split, ltrim(NATION_ACCOUNT, chr(39)) AS output_label, count(*) AS n_rows FROM s GROUP BY 2
UNION ALL SELECT 'value', replace(REGIONAL, '/', '-'), count(*) FROM s GROUP BY 2""")
def split_manifest(spark, sf):
    df = shipments(spark, sf, "AWB", "NATION_ACCOUNT", "REGIONAL", "AMOUNT").withColumnRenamed("NATION_ACCOUNT", "ID_ACCOUNT")
    found = None
    for split, label in (("account", outputs.split_labels("TGL_ENTRY", by_id=True)),
                         ("value", outputs.split_labels("TGL_ENTRY", by_column="REGIONAL"))):
        path = _written(spark, df, label)
        lines = outputs.manifest(spark, path, ["output_label"]).withColumn("split", F.lit(split))
        found = lines if found is None else found.unionByName(lines)
    return found


@query("split_by_month", f"""WITH s AS ({view_sql("AWB", "TGL_ENTRY")})
SELECT {_label_sql("TGL_ENTRY")} AS period_label, count(*) AS n_rows FROM s GROUP BY 1""")
def split_by_month(spark, sf):
    df = shipments(spark, sf, "AWB", "TGL_ENTRY")
    path = _written(spark, df, outputs.split_labels("TGL_ENTRY", monthly=True))
    return outputs.manifest(spark, path, ["period_label"])


@query("split_by_year", f"""WITH s AS ({view_sql("AWB", "TGL_ENTRY", "REGIONAL")})
SELECT strftime(TGL_ENTRY, '%Y') AS year_label, REGIONAL AS output_label, count(*) AS n_rows FROM s GROUP BY 1, 2""")
def split_by_year(spark, sf):
    df = shipments(spark, sf, "AWB", "TGL_ENTRY", "REGIONAL")
    labels = outputs.split_labels("TGL_ENTRY", period="year", by_column="REGIONAL")
    return outputs.manifest(spark, _written(spark, df, labels), list(labels))


@query("split_by_values", f"""WITH s AS ({view_sql("ROW_KEY", "CODING")})
SELECT ROW_KEY, CODING, CASE WHEN CODING IS NULL OR trim(CODING) = '' THEN 'Kosong' WHEN trim(CODING) = 'D01' THEN 'Terkirim'
  ELSE 'Masalah' END AS sheet FROM s WHERE CODING IS NULL OR trim(CODING) IN ('', 'D01', 'U12')
UNION ALL SELECT ROW_KEY, CODING, 'Lagi' FROM s WHERE trim(CODING) = 'U12'""")
def split_by_values(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "CODING")
    return outputs.tag_listed_values(df, " coding", {"D01": "Terkirim", None: "Kosong", "U12": "Masalah", " U12 ": "Lagi"})


@query("clean_output", """SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CAST(CAST(round(CAST(x AS DOUBLE) * 100) AS BIGINT) AS STRING)), ', ')
    AS "LIST", CAST(NULL AS STRING) AS "BLANK", regexp_replace(url, '^https?://', '') AS "URL_FOTO", CAST(label AS DOUBLE) AS "QTY"
FROM embeddings LEFT JOIN pages ON vec_id = page_id""".replace("CAST(NULL AS STRING) AS \"BLANK\"", "CASE WHEN label % 2 = 0 THEN CAST(label AS STRING) END AS \"BLANK\"").replace("regexp_replace(url", "regexp_replace(coalesce(url, '')"))
def clean_output(spark, sf):
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("vec_id"), F.col("url").alias("URL_FOTO"))
    df = table(spark, sf, "embeddings").join(pages, "vec_id", "left").select(
        "vec_id",
        F.transform("embedding", lambda x: F.round(x.cast("double") * 100).cast("bigint")).alias("LIST"),
        F.when(F.col("label") % 2 == 0, F.col("label").cast("string")).otherwise(" NaN ").alias("BLANK"),
        "URL_FOTO", F.col("label").cast("string").alias("QTY"))
    return outputs.clean_output(df)


@query("clean_urls", "SELECT page_id, regexp_replace(url, '^https?://', '') AS \"URL_TTD\" FROM pages")
def clean_urls(spark, sf):
    return outputs.clean_output(table(spark, sf, "pages").select("page_id", F.col("url").alias("URL_TTD")))


@query("dim_refresh", f"""WITH p AS ({PROJECTS})
SELECT trim(replace(CUST_ID, chr(160), ' ')) AS "CUST_ID", trim(replace(CUST_NAME, chr(160), ' ')) AS "CUST_NAME",
  BIG_GROUPING_CUST, nullif(CATEGORY, '') AS CATEGORY FROM p""".replace(
    'trim(replace(CUST_NAME, chr(160), \' \'))', 'nullif(trim(replace(CUST_NAME, chr(160), \' \')), \'\')'))
def dim_refresh(spark, sf):
    sheet = projects(spark, sf).withColumnRenamed("CUST_ID", "CUST_ID_2").withColumn("OTHER", F.lit(1))
    path = fresh_path(spark, "projects")
    outputs.refresh_projects(sheet, path)
    back = references.read_table(spark, path, ["CUST_ID", "CUST_NAME", "BIG_GROUPING_CUST", "CATEGORY"])
    return back.select(*[F.nullif(col(c), F.lit("")).alias(c) for c in back.columns])


# ---- run state -------------------------------------------------------------


def _report_name(c: str) -> str:
    return (f"CASE WHEN {c} % 10 = 0 THEN 'report JULI ' || CAST({c} AS STRING) WHEN {c} % 10 = 1 THEN '1998 report ' || CAST({c} AS STRING)"
            f" ELSE 'report ' || CAST({c} AS STRING) END")


_EVENT_STATUS = ("CASE WHEN user_id % 5 = 4 THEN 'Success' WHEN event_type = 'error' THEN 'Undel' WHEN event_type = 'view' THEN 'Return Shipper'"
                 " ELSE 'Success' END")


def _snapshot(spark, sf, day: int | None = None):
    """Status counts per report: of all events, or of two days between which some reports have grown, come or gone."""
    events = table(spark, sf, "events").select(
        F.expr(_report_name("user_id")).alias("report"), F.expr(_EVENT_STATUS).alias("STATUS_POD"), "user_id", "ts")
    if day == 1:
        events = events.where("user_id % 4 <> 0 OR ts < TIMESTAMP '2024-01-20 00:00:00'").where("user_id % 7 <> 3")
    elif day == 2:
        events = events.where("user_id % 7 <> 5")
    return runstate.status_counts(events, F.col("report"))


_SNAPSHOTS = f"""e AS (SELECT {_report_name("user_id")} AS report, {_EVENT_STATUS} AS status, user_id, ts FROM events),
now1 AS (SELECT report, status, count(*) AS n FROM e WHERE user_id % 7 <> 5 GROUP BY 1, 2),
then1 AS (SELECT report, status, count(*) AS n FROM e WHERE (user_id % 4 <> 0 OR ts < TIMESTAMP '2024-01-20') AND user_id % 7 <> 3
  GROUP BY 1, 2),
reports AS (SELECT DISTINCT report FROM e),
changes AS (SELECT report, CASE WHEN contains(lower(report), 'juli') OR contains(report, '1998') THEN 'current period'
    WHEN report NOT IN (SELECT report FROM now1) THEN 'new'
    WHEN EXISTS (SELECT 1 FROM ((SELECT * FROM now1 EXCEPT SELECT * FROM then1) UNION ALL (SELECT * FROM then1 EXCEPT SELECT * FROM now1)) x
      WHERE x.report = reports.report) THEN 'changed'
    WHEN EXISTS (SELECT 1 FROM now1 WHERE now1.report = reports.report AND status NOT IN ('Success', 'Return Shipper')) THEN 'still open'
    ELSE 'unchanged' END AS reason FROM reports)"""


def _changes(spark, sf):
    reports = table(spark, sf, "events").select(F.expr(_report_name("user_id")).alias("report")).distinct()
    return runstate.report_changes(reports, _snapshot(spark, sf, 2), _snapshot(spark, sf, 1), AS_OF)


@query("status_snapshot", f"WITH {_SNAPSHOTS} SELECT report, status, count(*) AS n, DATE '{AS_OF.isoformat()}' AS as_of FROM e GROUP BY 1, 2")
def status_snapshot(spark, sf):
    path = fresh_path(spark, "snapshot")
    events = table(spark, sf, "events").select(
        F.expr(_report_name("user_id")).alias("name"), F.expr(_EVENT_STATUS).alias("STATUS_POD"))
    for _ in range(2):  # a second run of the day replaces the first
        outputs.append_snapshot(events, path, F.col("name"), AS_OF)
    return spark.read.parquet(path).select("status", "n", F.col("as_of").cast("date").alias("as_of"), "report")


@query("ledger_marked", """SELECT CAST(c_custkey AS STRING) AS key,
  CASE WHEN c_custkey % 5 = 0 THEN '1998-07-15' ELSE '1998-07-' || lpad(CAST(c_custkey % 14 + 1 AS STRING), 2, '0') END AS processed
FROM customer""")
def ledger_marked(spark, sf):
    key = F.col("c_custkey").cast("string").alias("key")
    customers = table(spark, sf, "customer")
    old = customers.select(key, F.concat(F.lit("1998-07-"), F.lpad((F.col("c_custkey") % 14 + 1).cast("string"), 2, "0")).alias("processed"))
    done = customers.where("c_custkey % 5 = 0").select(key)
    return runstate.marked_processed(runstate.marked_processed(old, done, AS_OF), done.unionAll(done), AS_OF)


@query("report_changed", f"WITH {_SNAPSHOTS} SELECT report, reason, reason <> 'unchanged' AS send FROM changes")
def report_changed(spark, sf):
    return _changes(spark, sf)


@query("next_baseline", f"""WITH {_SNAPSHOTS}
SELECT * FROM now1 WHERE report IN (SELECT report FROM changes WHERE reason = 'changed')
UNION ALL SELECT * FROM then1 WHERE report NOT IN (SELECT report FROM changes WHERE reason = 'changed')""")
def next_baseline(spark, sf):
    return runstate.next_baseline(_snapshot(spark, sf, 2), _snapshot(spark, sf, 1), _changes(spark, sf))


@query("closed_subset", f"""WITH {_SNAPSHOTS}
SELECT report, bool_and(status IN ('Success', 'Return Shipper')) AS closed_only FROM e WHERE status IS NOT NULL GROUP BY 1""")
def closed_subset(spark, sf):
    return runstate.closed_only(_snapshot(spark, sf))


_LEDGER = {
    "key": "'query_' || CAST(o_orderkey AS STRING)",
    "processed": "CASE WHEN o_orderkey % 9 = 0 THEN 'kemarin' WHEN o_orderkey % 9 = 1 THEN NULL WHEN o_orderkey % 9 = 2 THEN '1998-02-31'"
                 f" WHEN o_orderkey % 9 < 6 THEN '{AS_OF.isoformat()}' WHEN o_orderkey % 9 = 6 THEN '1998-07-01' WHEN o_orderkey % 9 = 7"
                 " THEN '1998-06-30' ELSE '1998-07-10' END",
}
_LEDGER_SQL = "l AS (SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in _LEDGER.items()) + " FROM orders)"


def _ledger(spark, sf):
    return table(spark, sf, "orders").select(*[F.expr(e).alias(n) for n, e in _LEDGER.items()])


@query("ledger_anti", f"""WITH {_LEDGER_SQL} SELECT DISTINCT 'query_' || CAST(l_orderkey AS STRING) AS key FROM lineitem
WHERE 'query_' || CAST(l_orderkey AS STRING) NOT IN (SELECT key FROM l WHERE processed = '{AS_OF.isoformat()}')""")
def ledger_anti(spark, sf):
    work = table(spark, sf, "lineitem").select(F.concat(F.lit("query_"), F.col("l_orderkey").cast("string")).alias("key")).distinct()
    return runstate.not_yet_processed(work, _ledger(spark, sf), AS_OF)


@query("ledger_retention", f"""WITH {_LEDGER_SQL} SELECT key, processed FROM l
WHERE TRY_CAST(processed AS DATE) >= DATE '{AS_OF.isoformat()}' - 14""")
def ledger_retention(spark, sf):
    return runstate.retained(_ledger(spark, sf), AS_OF)


@query("contact_outputs", f"""WITH {_SNAPSHOTS}
SELECT DISTINCT unnest(['contact ' || CAST(user_id % 10 AS STRING), 'team ' || event_type]) AS contact, e2.report
FROM (SELECT {_report_name("user_id")} AS report, user_id, event_type FROM events) e2
WHERE report IN (SELECT report FROM changes WHERE reason <> 'unchanged')""")
def contact_outputs(spark, sf):
    sent = table(spark, sf, "events").select(
        F.expr(_report_name("user_id")).alias("report"),
        F.array(F.concat(F.lit("contact "), (F.col("user_id") % 10).cast("string")), F.concat(F.lit("team "), "event_type"))
        .alias("contacts"))
    return runstate.outputs_per_contact(sent, _changes(spark, sf))


# ---- the fixed workbook ----------------------------------------------------

_BOOK = ["AWB", "ID_ACCOUNT", "TGL_ENTRY", "CONSIGNEE_NAME", "NOREF", "ORIGIN", "DEST", "SERVICE", "QTY", "WEIGHT", "AMOUNT",
         "CODING", "TGL_RECEIVED", "ETD", "COD_FLAG", "BILNOTE_FLAG", "BILNOTE_AMOUNT", "SHIPPER_NAME", "STATUS_POD",
         "DATE_1ST_ATTEMPT", "RESULT_1ST_ATTEMPT", "RESULT_2ND_ATTEMPT", "RESULT_LAST_ATTEMPT"]
_BOOK_ROWS = f"""s0 AS ({view_sql(*_BOOK)}),
s AS (SELECT *, CASE WHEN STATUS_POD = 'RU Shipper/Origin' THEN 'RU Origin' ELSE STATUS_POD END AS st FROM s0)"""


@query("monthly_workbook", f"""WITH {_BOOK_ROWS}, g AS (SELECT chr(39) || CAST(c_custkey AS STRING) AS k, c_mktsegment AS grp FROM customer),
z AS ({ZONES}), u AS (SELECT "Coding Undel" AS k, min("Remark_English") AS remark FROM ({UNDEL_CODES}) GROUP BY 1),
r AS (SELECT *, CASE WHEN st IN ('Return Shipper', 'RU Origin', 'Undel', 'Hold WH Destination')
  THEN coalesce(RESULT_LAST_ATTEMPT, RESULT_2ND_ATTEMPT, RESULT_1ST_ATTEMPT) END AS reason FROM s)
SELECT AWB, ID_ACCOUNT, TGL_ENTRY, CONSIGNEE_NAME, NOREF, ORIGIN, r.DEST, SERVICE, QTY, WEIGHT, AMOUNT, CODING, TGL_RECEIVED, ETD,
  COD_FLAG, BILNOTE_FLAG, BILNOTE_AMOUNT, SHIPPER_NAME, grp AS "GROUPING_SHIPPER", CAST(month(TGL_ENTRY) AS STRING) AS "PERIODE",
  'WEEK ' || CAST((dayofyear(TGL_ENTRY) + dayofweek(date_trunc('year', TGL_ENTRY)) - 1) // 7 + 1 AS STRING) AS "PERIODE WEEK",
  z."3 LC" AS "DEST2", z."NAMA KAB/KOTA 2" AS "DEST 3",
  CASE WHEN z."3 LC" IN ('KOE', 'AMI') THEN 'Regional Jatim KOE AMI' ELSE z.REGION END AS "REGIONAL", z.ZONA AS "ZONA",
  CASE COD_FLAG WHEN 'Y' THEN 'COD' WHEN 'N' THEN 'NON COD' ELSE coalesce(COD_FLAG, 'NON COD') END AS "PAYMENT METHODE",
  st AS "STATUS_POD_2", CASE WHEN STATUS_POD = 'Success' THEN coalesce(DATE_1ST_ATTEMPT, TGL_RECEIVED) END AS "1ST ATTEMPT",
  CAST(NULL AS STRING) AS "AGING 1st ATTEMPT", CAST(NULL AS STRING) AS "CAREER 1st ATTEMPT", CAST(NULL AS STRING) AS "AGING POD",
  CAST(NULL AS STRING) AS "CARRER POD", reason AS "CODING RETURN", u.remark AS "REASON RETURN",
  CASE WHEN SERVICE IS NULL THEN 'INVALID' WHEN SERVICE LIKE 'CTCYES%' OR SERVICE LIKE 'YES%' THEN 'YES'
    WHEN SERVICE LIKE 'CTC%' OR SERVICE LIKE 'REG%' THEN 'REG' WHEN SERVICE LIKE 'TRC%' OR SERVICE LIKE 'JTR%' THEN 'JTR' END AS "KET",
  CAST(month(TGL_ENTRY) AS STRING) || '.' || monthname(TGL_ENTRY) || ' ' || CAST(year(TGL_ENTRY) AS STRING) AS "PERIODE LABEL",
  CASE WHEN TGL_ENTRY <= TIMESTAMP '2020-05-31' THEN 'MEI' ELSE 'CEK MANUAL' END AS "PERIODE BY REQUEST",
  CASE WHEN st = 'Success' THEN 'Success' WHEN st IN ('Return Shipper', 'RU Origin', 'AWB Cancel') THEN 'Return' ELSE 'On Follow Up' END
    AS "STATUS_POD3"
FROM r LEFT JOIN g ON ID_ACCOUNT = g.k LEFT JOIN z ON r.DEST = z.DEST LEFT JOIN u ON reason = u.k""")
def monthly_workbook(spark, sf):
    keys = ["AWB", "ID_ACCOUNT", "DEST"]
    rest = [c for c in _BOOK if c not in keys]
    df, late = joined(spark, sf, *_BOOK).select(*[e.alias(c) for c, e in made(*keys).items()], *sources(*rest)), made(*rest)
    late["Status_Update"] = F.when(late["STATUS_POD"] == "RU Shipper/Origin", "RU Origin").otherwise(late["STATUS_POD"])
    shippers = table(spark, sf, "customer").select(
        F.concat(F.lit("'"), F.col("c_custkey").cast("string")).alias("CUST_ID_2"),
        F.col("c_mktsegment").alias("CUST_NAME_GROUPING"))
    return workbook(df, shippers, zones(spark, sf), undel_codes(spark, sf), extras=True, late=late)


# ---- whole reports ---------------------------------------------------------

_REPORT_COLUMNS = ["AWB", "ROW_KEY", "TGL_TARIK_REPORT", "TGL_ENTRY", "TGL_RECEIVED", "ID_ACCOUNT", "STATUS_POD",
                   "STATUS_POD_UPDATE", "CODING", "REGIONAL", "AMOUNT", "WEIGHT", "GOODS_DESCR", "ETD", "1ST_ATTEMPT_DATE",
                   "CARRER_POD", "GROUPING_SHIPPER"]
REPORT = {
    "group_name": "MACHINERY", "period": "previous_months", "jumlah_bulan": 6,
    "selected_cols": ["AWB", "ID_ACCOUNT", "CUST_NAME", "TGL_ENTRY", "STATUS_POD", "IS_CLOSE", "GROUPING_STATUS", "GOODS_DESCR",
                      "WEIGHT", "AGING_POD", "CARRER_POD", "ETA", "EXTRA", "TIDAK_ADA", "REGIONAL"],
    "exclude_cols": ["TIDAK_ADA"], "split_by_col_val": "REGIONAL",
    "filters": {"and": [{"not": ["STATUS_POD", "equals", ""]}, {"or": [["WEIGHT", "lte", 4], ["STATUS_POD", "iequals", "undel"]]}]},
    "edit_file": {"replace_values": True},
}


def _group(spark, sf):
    """All accounts whose group name starts with the report's."""
    return group_accounts(projects(spark, sf)).where(col("group_name").startswith(REPORT["group_name"]))


def _report(spark, sf, criteria, accounts=None):
    ctx = Context(AS_OF, {"project_reference": projects(spark, sf)}, CALENDAR)
    return build_report(
        shipments(spark, sf, *_REPORT_COLUMNS), ReportConfig.from_dict(criteria), ctx, accounts=accounts,
        patch=patch_table(spark, sf), tie_break=[col("ROW_KEY").desc()])


_REPORT_SQL = f"""s AS ({view_sql(*_REPORT_COLUMNS)}), {_CAL}, {_PATCHED}, {_NAMED},
win AS (SELECT * FROM s WHERE TGL_ENTRY >= TIMESTAMP '1998-01-01' AND TGL_ENTRY < TIMESTAMP '1998-07-01'
  AND ltrim(ID_ACCOUNT, chr(39)) IN (SELECT trim(ltrim(regexp_replace(trim(CUST_ID), '\\.0$', ''), chr(39))) FROM ({PROJECTS})
    WHERE starts_with(BIG_GROUPING_CUST, 'MACHINERY'))),
dd AS (SELECT * FROM win QUALIFY row_number() OVER (PARTITION BY AWB ORDER BY TGL_TARIK_REPORT DESC NULLS LAST, ROW_KEY DESC) = 1),
v AS (SELECT dd.* EXCLUDE (STATUS_POD, STATUS_POD_UPDATE, AMOUNT), coalesce(st, STATUS_POD_UPDATE) AS upd,
  coalesce(CAST(am AS BIGINT), AMOUNT) AS AMOUNT, st, ex FROM dd LEFT JOIN p ON AWB = k),
x AS (SELECT *, CASE WHEN trim(CODING) = 'C01' THEN 'Claim Missing' WHEN trim(CODING) = 'C02' THEN 'Claim Damage'
  ELSE coalesce(upd, '') END AS pod FROM v),
kk AS (SELECT x.*, coalesce(lower(pod) = 'success', false) AS ok, {_aging_sql("TGL_RECEIVED", "c")} AS a2,
    CASE WHEN ETD + 1 >= 1 THEN a.le + ETD + 1 ELSE a.lt + 1 + ETD + 1 END AS rank,
    coalesce(nm.name, GROUPING_SHIPPER) AS name2, CASE WHEN WEIGHT IS NOT NULL THEN greatest(1.0::DOUBLE,
      CASE WHEN WEIGHT % 1 > 0.3 THEN ceil(WEIGHT) ELSE floor(WEIGHT) END) END AS w2
  FROM x LEFT JOIN cal a ON a.d = CAST(TGL_ENTRY AS DATE) LEFT JOIN cal c ON c.d = CAST(TGL_RECEIVED AS DATE)
  LEFT JOIN nm ON ltrim(ID_ACCOUNT, chr(39)) = nm.k),
y AS (SELECT kk.*, coalesce(st, pod) AS fin, e.d + (TGL_ENTRY - date_trunc('day', TGL_ENTRY)) AS eta
  FROM kk LEFT JOIN cal e ON e.le = rank AND e.wk = 1),
rep AS (SELECT AWB, ID_ACCOUNT, name2 AS CUST_NAME, TGL_ENTRY, fin AS STATUS_POD,
    CASE WHEN lower(trim(pod)) IN ('success', 'return shipper') THEN 'x' ELSE '' END AS IS_CLOSE,
    CASE WHEN pod = 'Success' THEN 'Success' WHEN pod IN ('Return Shipper', 'RU Origin') THEN 'Process Return'
      WHEN pod IN ('Missing', 'AWB Cancel', 'Hold WH Destination', 'Undel') THEN 'Undel' ELSE 'On Process' END AS GROUPING_STATUS,
    GOODS_DESCR, '' AS INSURANCE_ID, w2 AS WEIGHT, CASE WHEN ok THEN a2 END AS AGING_POD,
    {_flag_sql("CARRER_POD", "a2")} AS CARRER_POD, eta AS "ETA", ex AS "EXTRA", REGIONAL, REGIONAL AS output_label,
    {_label_sql("TGL_ENTRY")} AS period_label
  FROM y WHERE fin <> '' AND (coalesce(w2 <= 4, false) OR upper(fin) = 'UNDEL'))"""


@query("report_end_to_end", f"WITH {_REPORT_SQL} SELECT * FROM rep")
def report_end_to_end(spark, sf):
    return _report(spark, sf, REPORT, _group(spark, sf))


@query("report_written", f"WITH {_REPORT_SQL} SELECT output_label, period_label, count(*) AS n_rows FROM rep GROUP BY 1, 2")
def report_written(spark, sf):
    path = fresh_path(spark, "report")
    write_report(_report(spark, sf, REPORT, _group(spark, sf)), ReportConfig.from_dict(REPORT), path)
    return outputs.manifest(spark, path, ["output_label", "period_label"])


@query("report_summary", f"""WITH {_REPORT_SQL}, g AS (SELECT STATUS_POD, CAST(date_trunc('month', TGL_ENTRY) AS DATE) AS TGL_ENTRY,
  count(AWB) AS n FROM rep GROUP BY 1, 2)
SELECT STATUS_POD, TGL_ENTRY, n AS "JUMLAH", round(n / sum(n) OVER (PARTITION BY STATUS_POD), 9) AS share FROM g""")
def report_summary(spark, sf):
    spec = Pivot("p", ["STATUS_POD"], ["TGL_ENTRY"], [Measure("AWB", "count", "JUMLAH"), Measure("AWB", "count", "share", "row")])
    return pivot_long(_report(spark, sf, REPORT, _group(spark, sf)), spec).withColumn("share", F.round("share", 9))


_COMBINED = {
    "groups_name": "GABUNGAN", "period": "year", "selected_cols": ["AWB", "TGL_ENTRY", "REGIONAL"],
    "reports": [{"group_name": "SATU", "filters": ["REGIONAL", "contains", "jawa"]},
                {"group_name": "DUA", "period": "last_n_months", "jumlah_bulan": 2, "selected_cols": ["AWB", "STATUS_POD", "CODING"]}],
}


@query("combined_report", f"""WITH s AS ({view_sql(*_REPORT_COLUMNS)}), y AS (SELECT * FROM s WHERE year(TGL_ENTRY) = 1998
  QUALIFY row_number() OVER (PARTITION BY AWB ORDER BY TGL_TARIK_REPORT DESC NULLS LAST, ROW_KEY DESC) = 1),
m AS (SELECT * FROM s WHERE TGL_ENTRY >= TIMESTAMP '1998-06-01' AND TGL_ENTRY < TIMESTAMP '1998-07-16'
  QUALIFY row_number() OVER (PARTITION BY AWB ORDER BY TGL_TARIK_REPORT DESC NULLS LAST, ROW_KEY DESC) = 1)
SELECT 'SATU' AS report, AWB, TGL_ENTRY, REGIONAL, '' AS INSURANCE_ID, '1998' AS year_label, CAST(NULL AS STRING) AS STATUS_POD,
  CAST(NULL AS STRING) AS CODING FROM y WHERE contains(lower(REGIONAL), 'jawa')
UNION ALL SELECT 'DUA', AWB, NULL, NULL, '', NULL, CASE WHEN trim(CODING) = 'C01' THEN 'Claim Missing'
  WHEN trim(CODING) = 'C02' THEN 'Claim Damage' ELSE coalesce(STATUS_POD_UPDATE, '') END, CODING FROM m""")
def combined_report(spark, sf):
    """All children of a combined report from one scan of the master and one newest-row window."""
    ctx = Context(AS_OF, {"project_reference": projects(spark, sf)}, CALENDAR)
    configs = [ReportConfig.from_dict(c) for c in expand_combined([_COMBINED])]
    patch = patch_table(spark, sf)
    return combine(build_reports_together(shipments(spark, sf, *_REPORT_COLUMNS), configs, ctx, patches={c.name: patch for c in configs},
                                          tie_break=[col("ROW_KEY").desc()]))


_MONTHLY = [*_STATUS_COLUMNS, "AWB", "TGL_TARIK_REPORT", "BIG_GROUPING_CUST", "AMOUNT", "SERVICE"]


@query("monthly_report", f"""WITH s0 AS ({view_sql(*_MONTHLY)}),
s AS (SELECT * FROM (SELECT * FROM s0 QUALIFY row_number() OVER
    (PARTITION BY AWB ORDER BY TGL_TARIK_REPORT DESC NULLS LAST, ROW_KEY DESC) = 1)
  WHERE BIG_GROUPING_CUST IN ('MACHINERY', 'FURNITURE') AND TGL_ENTRY >= TIMESTAMP '1998-05-01 09:30:00'
    AND TGL_ENTRY < TIMESTAMP '1998-08-01 09:30:00'), {STATUS_STEPS},
l AS (SELECT *, nullif(regexp_replace(trim("No Resi"), '\\s+', '', 'g'), '') AS k0 FROM ({_LIST_SQL})),
kl AS (SELECT *, CASE WHEN starts_with(k0, chr(39)) THEN k0 ELSE chr(39) || k0 END AS key FROM l),
m AS (SELECT * FROM z WHERE coalesce(SERVICE LIKE 'REG%', false))
SELECT kl."TGL PICKUP", kl.AMOUNT, chr(39) || m.AWB AS AWB, kl.CODING, m.final_status AS STATUS_POD,
  CASE WHEN m.AWB IS NULL THEN NULL WHEN lower(trim(final_status)) IN ('success', 'return shipper') THEN 'x' ELSE '' END AS IS_CLOSE,
  CASE WHEN m.AWB IS NOT NULL THEN '' END AS INSURANCE_ID
FROM kl LEFT JOIN m ON key = chr(39) || m.AWB""")
def monthly_report(spark, sf):
    from datetime import datetime

    from shipreport.plans.monthly import build_monthly_report, newest_rows

    config = ReportConfig.from_dict({
        "group_name": ["MACHINERY", "FURNITURE"], "jumlah_bulan": 3, "selected_cols": ["AWB", "CODING", "STATUS_POD", "IS_CLOSE"],
        "filter_cols": [["SERVICE", "starts_with", "REG"]],
        "cust_ref": {"key_col": ["No Resi", "AWB"], "selected_ref_cols": ["TGL PICKUP", "AMOUNT"]}})
    base = newest_rows(shipments(spark, sf, *_MONTHLY), [col("ROW_KEY").desc()])
    return build_monthly_report(base, config, Context(AS_OF), datetime(1998, 7, 15, 9, 30), listing=listing(spark, sf))


@query("split_by_column", f"""WITH s AS ({view_sql("TGL_ENTRY", "ZONA")})
SELECT 'date' AS split, {_label_sql("TGL_ENTRY")} AS sheet, count(*) AS n_rows FROM s WHERE TGL_ENTRY IS NOT NULL GROUP BY 2
UNION ALL SELECT 'value', ZONA, count(*) FROM s WHERE ZONA IS NOT NULL GROUP BY 2""")
def split_by_column(spark, sf):
    df = shipments(spark, sf, "TGL_ENTRY", "ZONA")
    sheets = [df.select(F.lit(split).alias("split"), outputs.by_column(c).alias("sheet")).where("sheet is not null")
              for split, c in (("date", "TGL_ENTRY"), ("value", "ZONA"))]
    return sheets[0].unionByName(sheets[1]).groupBy("split", "sheet").agg(F.count(F.lit(1)).alias("n_rows"))


_DAILY = [
    {"group_name": "DAFTAR", "id_account": [f"'{n}" for n in range(1, 61)], "period": "year", "contact": ["a"],
     "selected_cols": ["AWB", "TGL_ENTRY", "STATUS_POD", "NO"]},
    {"group_name": "MACHINERY 3", "period": "previous_months", "jumlah_bulan": 6, "selected_cols": ["AWB", "TGL_ENTRY", "REGIONAL"], "split_by_col_val": "REGIONAL"},
    {"group_name": "SUDAH", "id_account": ["'1"], "selected_cols": ["AWB"]},
    {"groups_name": "GABUNGAN", "id_account": [f" {n} " for n in range(1, 200)], "selected_cols": ["AWB", "STATUS_POD"],
     "reports": [{"group_name": "SATU", "period": "year"}, {"group_name": "DUA", "period": "last_n_months", "jumlah_bulan": 2}]},
]


def _daily_sql(name: str, accounts: str, start: str, end: str) -> str:
    return (f"SELECT '{name}' AS report, count(DISTINCT coalesce(AWB, '-')) AS n_rows, '{AS_OF.isoformat()}' AS processed FROM s "
            f"WHERE TGL_ENTRY >= TIMESTAMP '{start}' AND TGL_ENTRY < TIMESTAMP '{end}' AND nullif(trim(ltrim(trim(ID_ACCOUNT), chr(39))), '') IN ({accounts})")


_UP_TO = "SELECT CAST(i AS STRING) FROM range(1, {}) t(i)"


@query("daily_run", " UNION ALL ".join([
    f"WITH s AS ({view_sql('AWB', 'ROW_KEY', 'TGL_ENTRY', 'ID_ACCOUNT')}) " + _daily_sql("DAFTAR", _UP_TO.format(61), "1998-01-01", "1999-01-01"),
    _daily_sql("MACHINERY 3", "SELECT trim(ltrim(regexp_replace(trim(CUST_ID), '\\.0$', ''), chr(39))) FROM (" + PROJECTS + ") WHERE upper(trim(BIG_GROUPING_CUST)) = 'MACHINERY 3'",
               "1998-01-01", "1998-07-01"),
    _daily_sql("SATU", _UP_TO.format(200), "1998-01-01", "1999-01-01"), _daily_sql("DUA", _UP_TO.format(200), "1998-06-01", "1998-07-16")]))
def daily_run(spark, sf):
    from shipreport.plans.daily import RunInputs
    from shipreport.plans.daily import daily_run as run
    from shipreport.sources.shipments import write_shipments

    root = fresh_path(spark, "master")
    stored = [*_REPORT_COLUMNS, "CATEGORY"]
    write_shipments(joined(spark, sf, *stored), root, columns=made(*stored))
    ledger = spark.createDataFrame([("SUDAH", AS_OF.isoformat()), ("LAMA", "1998-07-10")], "key string, processed string")
    done = run(spark, _DAILY, root, fresh_path(spark, "outputs"), fresh_path(spark, "snapshots"),
               Context(AS_OF, {"project_reference": projects(spark, sf)}, CALENDAR), RunInputs(ledger))
    return done.manifest.join(done.ledger, "key").select("report", "n_rows", "processed")
