"""Scans, filters, one row per key, projection and order."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from queries.master import AS_OF, PROJECTS, projects, shipments, view_sql, zones, ZONES
from queries.registry import query, table
from shipreport.functions import predicates
from shipreport.functions.text import account_key, clean, code_key, col, list_key, pickup_key, waybill_key, zip_text
from shipreport.operators import dedup, projection
from shipreport.operators.numbering import number_rows
from shipreport.plans.periods import period_window
from shipreport.plans.report import closed_first, sorted_output
from shipreport.functions.status import close_mark
from shipreport.session import fresh_path
from shipreport.sources import shipments as source

# ---- one row per key -------------------------------------------------------


def _ties():
    return [col("ROW_KEY").desc()]


@query("latest_per_key", f"""
WITH s AS ({view_sql("AWB", "TGL_TARIK_REPORT", "ROW_KEY", "STATUS_POD", "AMOUNT")})
SELECT AWB, TGL_TARIK_REPORT, ROW_KEY, STATUS_POD, AMOUNT FROM s
QUALIFY row_number() OVER (PARTITION BY AWB ORDER BY TGL_TARIK_REPORT DESC NULLS LAST, ROW_KEY DESC) = 1""")
def latest_per_key(spark, sf):
    df = shipments(spark, sf, "AWB", "TGL_TARIK_REPORT", "ROW_KEY", "STATUS_POD", "AMOUNT")
    return dedup.latest_per_key(df, tie_break=_ties())


@query("latest_bucketed", f"""
WITH s AS ({view_sql("AWB", "TGL_TARIK_REPORT", "ROW_KEY", "STATUS_POD", "AMOUNT")})
SELECT AWB, TGL_TARIK_REPORT, ROW_KEY, STATUS_POD, AMOUNT FROM s
QUALIFY row_number() OVER (PARTITION BY AWB ORDER BY TGL_TARIK_REPORT DESC NULLS LAST, ROW_KEY DESC) = 1""")
def latest_bucketed(spark, sf):
    """The newest row of every waybill over the master stored bucketed by AWB: no shuffle before the window."""
    import uuid

    name = f"shipreport_master_{uuid.uuid4().hex}"
    source.write_bucketed_shipments(shipments(spark, sf, "AWB", "TGL_TARIK_REPORT", "ROW_KEY", "STATUS_POD", "AMOUNT", "TGL_ENTRY", "ID_ACCOUNT", "CATEGORY"), name)
    df = spark.table(name).select("AWB", "TGL_TARIK_REPORT", "ROW_KEY", "STATUS_POD", "AMOUNT")
    return dedup.latest_per_key(df, tie_break=_ties())


@query("latest_per_key_nulls_win", f"""
WITH s AS ({view_sql("AWB", "TGL_TARIK_REPORT", "ROW_KEY")})
SELECT AWB, TGL_TARIK_REPORT, ROW_KEY FROM s
QUALIFY row_number() OVER (PARTITION BY AWB ORDER BY TGL_TARIK_REPORT DESC NULLS FIRST, ROW_KEY DESC) = 1""")
def latest_per_key_nulls_win(spark, sf):
    df = shipments(spark, sf, "AWB", "TGL_TARIK_REPORT", "ROW_KEY")
    return dedup.latest_per_key(df, tie_break=_ties(), nulls_win=True)


@query("first_per_key", f"""
WITH p AS ({PROJECTS})
SELECT BIG_GROUPING_CUST, row_idx, CUST_ID FROM p
QUALIFY row_number() OVER (PARTITION BY BIG_GROUPING_CUST ORDER BY row_idx) = 1""")
def first_per_key(spark, sf):
    return dedup.first_per_key(
        projects(spark, sf).select("BIG_GROUPING_CUST", "row_idx", "CUST_ID"), ["BIG_GROUPING_CUST"], ["row_idx"])


@query("first_non_null", f"""
WITH s AS ({view_sql("AWB", "ROW_KEY", "CODING", "RESULT_1ST_ATTEMPT", "CONNOTE_RETURN_RT")})
SELECT AWB,
       arg_min(CODING, ROW_KEY) FILTER (WHERE CODING IS NOT NULL) AS CODING,
       arg_min(RESULT_1ST_ATTEMPT, ROW_KEY) FILTER (WHERE RESULT_1ST_ATTEMPT IS NOT NULL) AS RESULT_1ST_ATTEMPT,
       arg_min(CONNOTE_RETURN_RT, ROW_KEY) FILTER (WHERE CONNOTE_RETURN_RT IS NOT NULL) AS CONNOTE_RETURN_RT
FROM s GROUP BY AWB""")
def first_non_null(spark, sf):
    names = ["CODING", "RESULT_1ST_ATTEMPT", "CONNOTE_RETURN_RT"]
    return dedup.first_non_null(shipments(spark, sf, "AWB", "ROW_KEY", *names), "AWB", "ROW_KEY", names)


@query("dim_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def dim_distinct(spark, sf):
    return dedup.distinct_pairs(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


# ---- filters ---------------------------------------------------------------

_LEAVES = [
    (["DEST", "starts_with", "cgk1"], "coalesce(upper(DEST) LIKE 'CGK1%', false)"),
    (["DEST", "ends_with", "00"], "coalesce(upper(DEST) LIKE '%00', false)"),
    (["RECEIVED/REASON", "contains", "RED|ring"], "coalesce(regexp_matches(\"RECEIVED/REASON\", '(?i)RED|ring'), false)"),
    (["RECEIVED/REASON", "regex", "^s.*g$"], "coalesce(regexp_matches(\"RECEIVED/REASON\", '(?i)^s.*g$'), false)"),
    (["STATUS_POD", "equals", "Undel"], "coalesce(STATUS_POD = 'Undel', false)"),
    (["STATUS_POD", "iequals", "undel"], "coalesce(upper(STATUS_POD) = 'UNDEL', false)"),
    (["STATUS_POD", "not_equals", "Undel"], "coalesce(STATUS_POD <> 'Undel', true)"),
    (["WEIGHT", "gt", 2.5], "coalesce(WEIGHT > 2.5, false)"),
    (["WEIGHT", "lt", "2.5"], "coalesce(WEIGHT < 2.5, false)"),
    (["SLA", "gte", -2], "coalesce(SLA >= -2, false)"),
    (["SLA", "lte", -2], "coalesce(SLA <= -2, false)"),
    (["CODING", "gt", 1], "false"),
    (["CODING", "in", ["D01", "U01"]], "coalesce(CODING IN ('D01', 'U01'), false)"),
    (["CODING", "not_in", ["D01", "U01"]], "coalesce(CODING NOT IN ('D01', 'U01'), true)"),
    (["NO_SUCH_COLUMN", "equals", "x"], "true"),
]
_LEAF_COLUMNS = ["ROW_KEY", "DEST", "RECEIVED/REASON", "STATUS_POD", "WEIGHT", "SLA", "CODING"]


@query("filter_leaves", f"""WITH s AS ({view_sql(*_LEAF_COLUMNS)})
SELECT ROW_KEY, {", ".join(f"{e} AS leaf_{i}" for i, (_, e) in enumerate(_LEAVES))} FROM s""")
def filter_leaves(spark, sf):
    df = shipments(spark, sf, *_LEAF_COLUMNS)
    return df.select("ROW_KEY", *[predicates.leaf(df, rule).alias(f"leaf_{i}") for i, (rule, _) in enumerate(_LEAVES)])


@query("filter_nulls", f"""WITH s AS ({view_sql(*_LEAF_COLUMNS)})
SELECT ROW_KEY, {", ".join(f"NOT ({e}) AS not_{i}" for i, (_, e) in enumerate(_LEAVES))} FROM s""")
def filter_nulls(spark, sf):
    df = shipments(spark, sf, *_LEAF_COLUMNS)
    return df.select(
        "ROW_KEY", *[predicates.tree(df, {"not": rule}).alias(f"not_{i}") for i, (rule, _) in enumerate(_LEAVES)])


@query("filter_tree", f"""WITH s AS ({view_sql("ROW_KEY", "DEST", "STATUS_POD", "WEIGHT", "CODING")})
SELECT ROW_KEY, STATUS_POD, CODING FROM s
WHERE (coalesce(STATUS_POD IN ('Undel', 'On Process'), false) OR NOT coalesce(WEIGHT > 2, false))
  AND NOT (coalesce(upper(DEST) LIKE 'CGK%', false) AND coalesce(CODING NOT IN ('D01'), true))""")
def filter_tree(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "DEST", "STATUS_POD", "WEIGHT", "CODING")
    rule = {"and": [
        {"or": [["STATUS_POD", "in", ["Undel", "On Process"]], {"not": ["WEIGHT", "gt", 2]}]},
        {"not": {"and": [["DEST", "starts_with", "cgk"], ["CODING", "not_in", ["D01"]]]}},
    ]}
    return df.where(predicates.tree(df, rule)).select("ROW_KEY", "STATUS_POD", "CODING")


@query("filter_list_cased", f"""WITH s AS ({view_sql("ROW_KEY", "DEST", "SERVICE")})
SELECT ROW_KEY FROM s WHERE coalesce(SERVICE LIKE 'REG%', false) AND coalesce(DEST LIKE '%7', false)""")
def filter_list_cased(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "DEST", "SERVICE")
    rules = [["SERVICE", "starts_with", "REG"], ["DEST", "ends_with", "7"], ["GONE", "equals", 1]]
    return df.where(predicates.all_of(df, rules, cased=True)).select("ROW_KEY")


_ACCOUNTS = ["'12", "13", " 14 ", "'999", "1001"]


@query("account_membership", f"""WITH s AS ({view_sql("ROW_KEY", "ID_ACCOUNT")})
SELECT ROW_KEY, ID_ACCOUNT FROM s WHERE ltrim(ID_ACCOUNT, chr(39)) IN ('12', '13', '14', '999', '1001')""")
def account_membership(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "ID_ACCOUNT")
    return df.where(predicates.account_in(col("ID_ACCOUNT"), _ACCOUNTS))


@query("status_membership", f"""WITH s AS ({view_sql("ROW_KEY", "STATUS_POD")})
SELECT ROW_KEY, STATUS_POD FROM s WHERE upper(STATUS_POD) IN ('SUCCESS', 'RETURN SHIPPER')""")
def status_membership(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "STATUS_POD")
    return df.where(predicates.status_in(col("STATUS_POD"), ["success", "Return Shipper"]))


@query("group_membership", f"""WITH s AS ({view_sql("ROW_KEY", "BIG_GROUPING_CUST")})
SELECT ROW_KEY, BIG_GROUPING_CUST FROM s WHERE BIG_GROUPING_CUST IN ('MACHINERY', 'FURNITURE')""")
def group_membership(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "BIG_GROUPING_CUST")
    return df.where(predicates.group_in(col("BIG_GROUPING_CUST"), ["MACHINERY", "FURNITURE"]))


@query("date_window", """SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-05-01' AND o_orderdate < TIMESTAMP '1998-07-16'""")
def date_window(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return df.where(predicates.date_window(df, "o_orderdate", *period_window("last_n_months", 3, AS_OF)))


@query("scan_filtered", """SELECT o_orderkey AS AWB, stored AS ID_ACCOUNT, o_orderdate AS TGL_ENTRY, o_orderstatus AS STATUS_POD, given
FROM (SELECT *, CASE o_orderkey % 4 WHEN 0 THEN chr(39) || o_custkey WHEN 1 THEN ' ' || chr(39) || o_custkey || ' '
    WHEN 2 THEN o_custkey || '  ' ELSE o_custkey || '.0' END AS stored FROM orders), (VALUES ('list'), ('table')) t(given)
WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' AND o_orderstatus IN ('F', 'P', 'O')
  AND o_custkey BETWEEN 1 AND 60 AND o_orderkey % 4 < 3""")
def scan_filtered(spark, sf):
    key, quote = F.col("o_custkey").cast("string"), F.lit("'")
    spelled = F.when(F.col("o_orderkey") % 4 == 0, F.concat(quote, key)).when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit(" '"), key, F.lit(" "))).when(
        F.col("o_orderkey") % 4 == 2, F.concat(key, F.lit("  "))).otherwise(F.concat(key, F.lit(".0")))
    df = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("AWB"), spelled.alias("ID_ACCOUNT"),
        F.col("o_orderdate").alias("TGL_ENTRY"), F.col("o_orderstatus").alias("STATUS_POD"), "o_orderpriority")
    wanted = [f"' {n} " if n % 2 else str(n) for n in range(1, 61)]
    forms = {"list": wanted, "table": spark.createDataFrame([(w,) for w in wanted], "account_id string")}
    found = [source.select_shipments(
        df, columns=["awb", "id_account", "tgl_entry", "status_pod"], window=("TGL_ENTRY", *period_window("year", None, AS_OF)),
        accounts=accounts, statuses=["f", "p", "o"]).withColumn("given", F.lit(name)) for name, accounts in forms.items()]
    return found[0].unionAll(found[1])


# ---- sources ---------------------------------------------------------------


def _stored_master(spark, sf):
    """The master written by month and category, as an upstream extract would be."""
    root = fresh_path(spark, "master")
    source.write_shipments(
        shipments(spark, sf, "AWB", "ROW_KEY", "TGL_ENTRY", "CATEGORY", "AMOUNT"), root)
    return root


@query("scan_period", f"""WITH s AS ({view_sql("AWB", "ROW_KEY", "TGL_ENTRY", "CATEGORY", "AMOUNT")})
SELECT AWB, ROW_KEY, TGL_ENTRY, CATEGORY, AMOUNT, strftime(TGL_ENTRY, '%Y') AS tahun, strftime(TGL_ENTRY, '%m') AS bulan,
  CATEGORY AS p_category
FROM s WHERE TGL_ENTRY >= TIMESTAMP '1998-04-01' AND TGL_ENTRY < TIMESTAMP '1998-07-01' AND CATEGORY = 'BANK'""")
def scan_period(spark, sf):
    start, end = period_window("previous_months", 3, AS_OF)
    df = source.scan_period(spark, _stored_master(spark, sf), start, end, category="BANK")
    return df.where(predicates.date_window(df, "TGL_ENTRY", start, end))


@query("scan_file_filter", f"""WITH s AS ({view_sql("ROW_KEY", "TGL_ENTRY", "CATEGORY")})
SELECT ROW_KEY FROM s WHERE CATEGORY = 'RETAIL' AND strftime(TGL_ENTRY, '%m') = '03' AND TGL_ENTRY IS NOT NULL""")
def scan_file_filter(spark, sf):
    df = spark.read.parquet(_stored_master(spark, sf))
    df = source.file_filter(df, ".PARQUET", ["p_category=retail"])
    return source.file_filter(df, path_contains="/Bulan=03/").select("ROW_KEY")


@query("project_ci", """SELECT l_orderkey, l_returnflag, l_shipdate FROM lineitem""")
def project_ci(spark, sf):
    return projection.present_columns(
        table(spark, sf, "lineitem"), [" L_ORDERKEY ", "L_ReturnFlag", "missing", "l_shipdate", "L_SHIPDATE"])


@query("union_by_name", """
SELECT CAST(o_orderkey AS STRING) AS AWB, o_orderstatus AS STATUS_POD, CAST(NULL AS STRING) AS SERVICE FROM orders
  WHERE month(o_orderdate) <= 6
UNION ALL SELECT CAST(o_orderkey AS STRING), o_orderstatus, o_orderpriority FROM orders WHERE month(o_orderdate) > 6""")
def union_by_name(spark, sf):
    orders, path = table(spark, sf, "orders"), fresh_path(spark, "month")
    first_half, awb, status = F.month("o_orderdate") <= 6, F.col("o_orderkey").alias(" awb "), F.col("o_orderstatus").alias("Status_Pod")
    service, unknown = F.col("o_orderpriority").alias("service"), F.lit("x").alias("unknown")
    # two headers in one folder, the columns in another order
    orders.where(first_half).select(awb, status).write.csv(path, header=True)
    orders.where(~first_half).select(service, status, unknown, awb).write.mode("append").csv(path, header=True)
    return source.read_month_csv(spark, [path], keep=["AWB", "STATUS_POD", "SERVICE"])


# ---- projection and order --------------------------------------------------


@query("report_select", f"""WITH s AS ({view_sql("AWB", "ROW_KEY", "STATUS_POD", "AMOUNT", "GOODS_DESCR")})
SELECT AMOUNT AS "Nilai", '' AS "Asuransi", AWB AS "No Resi", GOODS_DESCR AS "Barang", '' AS "Kosong" FROM s""")
def report_select(spark, sf):
    df = shipments(spark, sf, "AWB", "ROW_KEY", "STATUS_POD", "AMOUNT", "GOODS_DESCR")
    return projection.select_report(
        df, ["AWB", "GOODS_DESCR", "STATUS_POD", "awb", "AMOUNT", "NOT_THERE"], exclude=["STATUS_POD"],
        rename=["No Resi", "Barang", "Asuransi", "Status", "Nilai", "Kosong"],
        order=["Nilai", "Asuransi", "No Resi", "Status", "Barang", "Kosong"])


@query("row_numbers", """SELECT row_number() OVER (PARTITION BY role ORDER BY conv_id, turn, text) AS "NO",
  role, conv_id, turn FROM conversations""")
def row_numbers(spark, sf):
    df = table(spark, sf, "conversations").select("role", "conv_id", "turn", "text")
    numbered = number_rows(df, [F.col("conv_id").asc(), F.col("turn").asc(), F.col("text").asc()], per=["role"])
    return numbered.drop("text")


@query("row_numbers_unsplit", f"""WITH s AS ({view_sql("TGL_ENTRY", "ROW_KEY")})
SELECT row_number() OVER (ORDER BY TGL_ENTRY NULLS LAST, ROW_KEY) AS "NO", TGL_ENTRY, ROW_KEY FROM s""")
def row_numbers_unsplit(spark, sf):
    df = shipments(spark, sf, "TGL_ENTRY", "ROW_KEY")
    return number_rows(df, [col("TGL_ENTRY").asc_nulls_last(), col("ROW_KEY").asc()])


@query("sorted_output", f"""WITH s AS ({view_sql("ROW_KEY", "TGL_ENTRY")})
SELECT ROW_KEY, TGL_ENTRY FROM s ORDER BY TGL_ENTRY NULLS LAST""")
def sorted_rows(spark, sf):
    return sorted_output(shipments(spark, sf, "ROW_KEY", "TGL_ENTRY"))


@query("close_first", f"""WITH s AS ({view_sql("ROW_KEY", "STATUS_POD")})
SELECT ROW_KEY, STATUS_POD,
  CASE WHEN lower(trim(STATUS_POD)) IN ('success', 'return shipper') THEN 'x' ELSE '' END AS IS_CLOSE
FROM s ORDER BY 3 DESC, 2""")
def close_first(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "STATUS_POD")
    return closed_first(df.withColumn("IS_CLOSE", close_mark(col("STATUS_POD"))))


@query("const_cols", f"""WITH s AS ({view_sql("ROW_KEY")})
SELECT ROW_KEY, 'JNE' AS PIC, 0 AS DIM, 0 AS "DIM - Copy", 'JNE DKI JAKARTA' AS "NAMA ORIGIN", 'HO' AS CUSTOMER,
  DATE '{AS_OF.isoformat()}' AS UPDATE_TIME FROM s""")
def const_cols(spark, sf):
    from shipreport.plans.registry import Context, derive_columns

    df = shipments(spark, sf, "ROW_KEY")
    return derive_columns(df, ["PIC", "DIM", "NAMA ORIGIN", "UPDATE_TIME"], Context(AS_OF))


# ---- text and keys ---------------------------------------------------------


@query("clean_text", f"""WITH p AS ({PROJECTS}), z AS ({ZONES})
SELECT 'name' AS kind, trim(replace(CUST_NAME, chr(160), ' ')) AS cleaned, row_idx FROM p
UNION ALL SELECT 'zip', CASE WHEN regexp_replace(trim("KODE POS"), '\\.0+$', '') NOT IN ('', '0')
  THEN regexp_replace(trim("KODE POS"), '\\.0+$', '') END, CAST(regexp_replace(DEST, '^[A-Z]+', '') AS BIGINT) FROM z""")
def clean_text(spark, sf):
    names = projects(spark, sf).select(
        F.lit("name").alias("kind"), clean(col("CUST_NAME")).alias("cleaned"), "row_idx")
    codes = zones(spark, sf).select(
        F.lit("zip"), zip_text(col("KODE POS")), F.regexp_replace("DEST", "^[A-Z]+", "").cast("long"))
    return names.union(codes)


@query("key_normalise", f"""WITH s AS ({view_sql("ROW_KEY", "ID_ACCOUNT", "REFNO_UOB", "CODING", "NOREF")})
SELECT ROW_KEY, ltrim(ID_ACCOUNT, chr(39)) AS account,
  nullif(upper(regexp_replace(trim(NOREF), '\\s+', '', 'g')), '') AS waybill,
  CASE WHEN trim(NOREF) <> '' THEN concat(chr(39), upper(regexp_replace(trim(NOREF), '\\s+', '', 'g'))) END AS listed,
  nullif(replace(replace(trim(REFNO_UOB), chr(39), ''), '*', ''), '') AS pickup,
  CASE WHEN upper(trim(CODING)) NOT IN ('', 'NONE', 'NAN', 'NAT') THEN trim(CODING) END AS code FROM s""")
def key_normalise(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "ID_ACCOUNT", "REFNO_UOB", "CODING", "NOREF")
    return df.select(
        "ROW_KEY", account_key(col("ID_ACCOUNT")).alias("account"), waybill_key(col("NOREF")).alias("waybill"),
        list_key(col("NOREF")).alias("listed"), pickup_key(col("REFNO_UOB")).alias("pickup"),
        code_key(col("CODING")).alias("code"))
