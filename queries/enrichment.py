"""Lookups, list joins, corrections and account assignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.master import (
    AREA, AS_OF, PROJECTS, STATUS_CODES, STATUS_MAP, UNDEL_CODES, ZONES, area_table, pick, projects, shipments,
    status_codes, status_map, undel_codes, view_sql, zones,
)
from queries.registry import query, table
from shipreport.functions.text import col
from shipreport.operators import listjoin, lookups, overrides
from shipreport.operators.asof import fill_forward

_ORIGIN_FIELDS = """z."3 LC" AS "3_LC_ORIGIN", z."NAMA KAB/KOTA" AS "ORIGIN_CITY", z."NAMA KAB/KOTA 2" AS "ORIGIN_CITY_2",
  z."REGION" AS "REGION", z."PROVINSI" AS "PROVINSI_ORIGIN", z."KODE POS" AS "KODE_POS_ORI\""""


@query("origin_lookup", f"""WITH s AS ({view_sql("ROW_KEY", "ORIGIN")}), z AS ({ZONES})
SELECT ROW_KEY, ORIGIN, {_ORIGIN_FIELDS} FROM s LEFT JOIN z ON ORIGIN = z.DEST""")
def origin_lookup(spark, sf):
    return lookups.origin_lookup(shipments(spark, sf, "ROW_KEY", "ORIGIN"), zones(spark, sf))


# Zip of every code: its own, else that of the next higher code of its prefix.
_FILLED = f"""z AS ({ZONES}),
c AS (SELECT z.*, CASE WHEN regexp_replace(trim("KODE POS"), '\\.0+$', '') NOT IN ('', '0')
      THEN regexp_replace(trim("KODE POS"), '\\.0+$', '') END AS own,
    regexp_extract(DEST, '^([A-Z]+)\\s*(\\d+)$', 1) AS prefix,
    CAST(regexp_extract(DEST, '^([A-Z]+)\\s*(\\d+)$', 2) AS BIGINT) AS num FROM z),
f AS (SELECT c.*, first_value(own IGNORE NULLS) OVER (PARTITION BY prefix ORDER BY num
      RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS zip FROM c)"""


@query("dest_lookup", f"""WITH s AS ({view_sql("ROW_KEY", "DEST")}), {_FILLED}
SELECT ROW_KEY, s.DEST, f.KECAMATAN, f."NAMA KAB/KOTA", f."PROVINSI", f.zip AS "KODE POS"
FROM s LEFT JOIN f ON s.DEST = f.DEST""")
def dest_lookup(spark, sf):
    return lookups.dest_lookup(shipments(spark, sf, "ROW_KEY", "DEST"), zones(spark, sf))


@query("asof_forward", f"WITH {_FILLED} SELECT DEST, zip FROM f")
def asof_forward(spark, sf):
    from shipreport.functions.text import zip_text

    codes = zones(spark, sf).select("DEST", zip_text(col("KODE POS")).alias("zip"))
    return fill_forward(codes, "DEST", "zip")


@query("asof_brand_size", """WITH a AS (SELECT upper(replace(p_type, ' ', '')) AS prefix, p_size AS num,
    max(CASE WHEN p_partkey % 3 = 0 THEN p_brand END) AS own FROM part GROUP BY 1, 2)
SELECT concat(prefix, CAST(num AS STRING)) AS code,
  first_value(own IGNORE NULLS) OVER (PARTITION BY prefix ORDER BY num
    RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS brand FROM a""")
def asof_brand_size(spark, sf):
    prefix, size = F.upper(F.regexp_replace("p_type", " ", "")), F.col("p_size").cast("string")
    codes = table(spark, sf, "part").groupBy(F.concat(prefix, size).alias("code")).agg(
        F.max(F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand"))).alias("brand"))
    return fill_forward(codes, "code", "brand")


@query("area_group", f"""WITH s AS ({view_sql("ROW_KEY", "DEST")}), z AS ({ZONES})
SELECT ROW_KEY, s.DEST, CASE z.REGION WHEN 'Regional Jakarta' THEN 'Jabodetabekcil'
  WHEN 'Regional Bodetabekcil' THEN 'Jabodetabekcil' WHEN 'Regional Jawa Barat' THEN 'Pulau Jawa'
  WHEN 'Regional Jateng Diy' THEN 'Pulau Jawa' ELSE 'Luar Pulau Jawa' END AS "WILAYAH"
FROM s LEFT JOIN z ON s.DEST = z.DEST""")
def area_group(spark, sf):
    return lookups.area_group(shipments(spark, sf, "ROW_KEY", "DEST"), zones(spark, sf))


_UNDEL_ONCE = f"""u AS (SELECT trim("Coding Undel") AS k, min("Remark_Bahasa") AS remark FROM ({UNDEL_CODES})
  WHERE trim("Coding Undel") <> '' GROUP BY 1)"""


@query("code_lookup", f"""WITH s AS ({view_sql("ROW_KEY", "CODING_UNDEL", "CODING")}), {_UNDEL_ONCE},
c AS (SELECT CODE, arg_min(STATUS, row_idx) AS st FROM ({STATUS_CODES}) GROUP BY 1)
SELECT ROW_KEY, CODING_UNDEL, CODING, u.remark AS "REASON UNDEL", d.st AS "CODING_DELIVERY", a.st AS "CODING_REMARKS"
FROM s LEFT JOIN u ON trim(CODING_UNDEL) = u.k
LEFT JOIN c d ON CODING = d.CODE AND starts_with(CODING, 'D') LEFT JOIN c a ON CODING = a.CODE""")
def code_lookup(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "CODING_UNDEL", "CODING")
    df = lookups.undelivered_reason(df, undel_codes(spark, sf))
    df = lookups.delivery_remark(df, status_codes(spark, sf), order=["row_idx"])
    return lookups.code_remark(df, status_codes(spark, sf), order=["row_idx"])


_ATTEMPTS = ["RESULT_1ST_ATTEMPT", "RESULT_2ND_ATTEMPT", "RESULT_LAST_ATTEMPT"]


@query("attempt_reason", f"""WITH s AS ({view_sql("ROW_KEY", *_ATTEMPTS)}),
u AS (SELECT DISTINCT "Coding Undel" AS k, "Remark_Bahasa" AS remark FROM ({UNDEL_CODES}))
SELECT ROW_KEY, RESULT_1ST_ATTEMPT, RESULT_2ND_ATTEMPT, RESULT_LAST_ATTEMPT,
  CASE WHEN RESULT_1ST_ATTEMPT LIKE 'U%' THEN a.remark END AS REASON_1ST_ATTEMPT,
  CASE WHEN RESULT_2ND_ATTEMPT LIKE 'U%' THEN b.remark END AS REASON_2ND_ATTEMPT,
  CASE WHEN RESULT_LAST_ATTEMPT LIKE 'U%' THEN c.remark END AS REASON_LAST_ATTEMPT
FROM s LEFT JOIN u a ON RESULT_1ST_ATTEMPT = a.k LEFT JOIN u b ON RESULT_2ND_ATTEMPT = b.k
LEFT JOIN u c ON RESULT_LAST_ATTEMPT = c.k""")
def attempt_reason(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", *_ATTEMPTS)
    for result in _ATTEMPTS:
        df = lookups.attempt_reason(df, undel_codes(spark, sf), result)
    return df


@query("status_map", f"""WITH s AS ({view_sql("ROW_KEY", "STATUS_POD")}), m AS ({STATUS_MAP})
SELECT ROW_KEY, STATUS_POD, g AS "Remark Return", a AS "AJ Car Status", k AS "KETERANGAN AJ CAR" FROM s LEFT JOIN (
  SELECT "Status" AS st, "Grouping BIG Status" AS g, "AJ Car Status" AS a, "KETERANGAN AJ CAR" AS k FROM m
  QUALIFY row_number() OVER (PARTITION BY "Status" ORDER BY row_idx) = 1) ON STATUS_POD = st""")
def client_status(spark, sf):
    return lookups.client_status(
        shipments(spark, sf, "ROW_KEY", "STATUS_POD"), status_map(spark, sf), order=["row_idx"])


@query("area_sla", f"""WITH s AS ({view_sql("ROW_KEY", "REGIONAL", "AGING", "CARRER")}), a AS ({AREA})
SELECT ROW_KEY, REGIONAL, AGING, "AREA MANDIRI", b."SLA" AS "SLA OOB",
  CASE WHEN b."SLA" - AGING < 0 THEN 'Over SLA' ELSE 'On Time SLA' END AS CARRER
FROM s LEFT JOIN (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY REGION ORDER BY row_idx) = 1) b
  ON REGIONAL = b.REGION""")
def area_sla(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "REGIONAL", "AGING", "CARRER")
    return lookups.area_promise(df, area_table(spark, sf), order=["row_idx"])


_NAMED = f"""nm AS (SELECT trim(ltrim(regexp_replace(trim(CUST_ID), '\\.0$', ''), chr(39))) AS k,
  arg_min(trim(replace(CUST_NAME, chr(160), ' ')), row_idx) AS name FROM ({PROJECTS})
  WHERE trim(replace(CUST_NAME, chr(160), ' ')) <> '' GROUP BY 1)"""


@query("account_name", f"""WITH s AS ({view_sql("ROW_KEY", "ID_ACCOUNT", "GROUPING_SHIPPER")}), {_NAMED}
SELECT ROW_KEY, ID_ACCOUNT, GROUPING_SHIPPER, coalesce(nm.name, GROUPING_SHIPPER) AS CUST_NAME,
  concat_ws(' ', ID_ACCOUNT, coalesce(nm.name, GROUPING_SHIPPER)) AS "DEPT PZC"
FROM s LEFT JOIN nm ON ltrim(ID_ACCOUNT, chr(39)) = nm.k""")
def account_name(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "ID_ACCOUNT", "GROUPING_SHIPPER")
    return lookups.account_label(df, projects(spark, sf), order=["row_idx"])


# Report groups: one per nation and market segment, some under a name no account carries.
_GROUP_NAME = ("CASE WHEN c_custkey % 7 = 0 THEN concat('other ', CAST(c_nationkey AS STRING)) "
               "ELSE concat(' ', lower(c_mktsegment), ' ', CAST(c_nationkey AS STRING), chr(160)) END")
_INDUSTRY = "concat(c_mktsegment, ' ', CAST(c_nationkey AS STRING))"


@query("category_lookup", f"""WITH g AS (SELECT {_GROUP_NAME} AS group_name,
    CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS STRING) END AS account_id FROM customer),
p AS (SELECT *, upper(trim(BIG_GROUPING_CUST)) AS bn,
    trim(ltrim(regexp_replace(trim(CUST_ID), '\\.0$', ''), chr(39))) AS k FROM ({PROJECTS})),
bn AS (SELECT bn, nullif(arg_min(CATEGORY, row_idx), '') AS cat FROM p WHERE bn IS NOT NULL GROUP BY 1),
bi AS (SELECT k, nullif(arg_min(CATEGORY, row_idx), '') AS cat FROM p GROUP BY 1),
i AS (SELECT {_INDUSTRY} AS b, arg_min(concat('IND ', c_mktsegment), c_custkey) AS ind FROM customer GROUP BY 1)
SELECT group_name, account_id, coalesce(bn.cat, bi.cat, 'UNKNOWN') AS category, coalesce(i.ind, 'UNKNOWN') AS industry
FROM g LEFT JOIN bn ON upper(trim(replace(group_name, chr(160), ' '))) = bn.bn LEFT JOIN bi ON account_id = bi.k
LEFT JOIN i ON upper(trim(replace(group_name, chr(160), ' '))) = i.b""")
def category_lookup(spark, sf):
    customers = table(spark, sf, "customer")
    groups = customers.select(
        F.expr(_GROUP_NAME).alias("group_name"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey").cast("string")).alias("account_id"))
    industries = customers.select(
        F.col("c_custkey").alias("row_idx"), F.expr(_INDUSTRY).alias("BIG_GROUPING_CUST"),
        F.concat(F.lit("IND "), "c_mktsegment").alias("CUST_INDUSTRY_NEW"))
    return lookups.category_of_groups(groups, projects(spark, sf), industries)


@query("accounts_of_reports", f"""WITH p AS (SELECT upper(trim(BIG_GROUPING_CUST)) AS g, trim(CUST_ID) AS id, upper(CUST_NAME) AS nm
  FROM ({PROJECTS})),
q AS (SELECT g, nm, CASE WHEN starts_with(id, chr(39)) THEN id ELSE concat(chr(39), id) END AS id FROM p),
c AS (SELECT DISTINCT upper(c_mktsegment) || ' ' || CAST(c_nationkey AS STRING) AS group_name,
  CASE WHEN c_nationkey < 5 THEN concat(chr(39), CAST(c_custkey AS STRING)) END AS account_id FROM customer
  UNION ALL SELECT 'CUSTOMER#00000002', NULL),
o AS (SELECT DISTINCT group_name FROM c WHERE account_id IS NULL)
SELECT DISTINCT group_name, account_id, 'explicit' AS source FROM c WHERE account_id IS NOT NULL
UNION ALL SELECT DISTINCT group_name, id, 'group' FROM o JOIN q ON g = group_name
UNION ALL SELECT DISTINCT group_name, id, 'name' FROM o JOIN q ON regexp_matches(nm, group_name)
  WHERE group_name NOT IN (SELECT g FROM q WHERE g IS NOT NULL)""")
def accounts_of_reports(spark, sf):
    customers = table(spark, sf, "customer")
    configs = customers.select(
        F.concat_ws(" ", F.upper("c_mktsegment"), F.col("c_nationkey").cast("string")).alias("group_name"),
        F.when(F.col("c_nationkey") < 5, F.concat(F.lit("'"), F.col("c_custkey").cast("string"))).alias("account_id"),
    ).distinct()
    brand = customers.select(F.lit("CUSTOMER#00000002").alias("group_name"),
                             F.lit(None).cast("string").alias("account_id")).distinct()
    accounts = projects(spark, sf)
    wanted, groups = configs.unionByName(brand), lookups.group_accounts(accounts)
    # names of configs without accounts or a group of their name, looked up in the name index
    unmatched = lookups.without_group(wanted.where("account_id is null").select("group_name").distinct(), groups)
    return lookups.explicit_accounts(wanted, groups, lookups.accounts_by_pattern(accounts, unmatched))


# ---- customer lists --------------------------------------------------------

# A customer's own list: one line per order, some without a usable key, some keys repeated.
_LIST = {
    "No Resi": "CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN ' '"
               " WHEN o_orderkey % 10 = 2 THEN concat(' ', CAST(o_orderkey AS STRING), ' ')"
               " WHEN o_orderkey % 10 = 3 THEN CAST(o_orderkey % 100 AS STRING)"
               " ELSE concat(chr(39), CAST(o_orderkey AS STRING)) END",
    "TGL PICKUP": "o_orderdate",
    "AMOUNT": "CAST(round(o_totalprice) AS BIGINT)",
    "CODING": "'from list'",
    "X_M": "'gone'",
}
_LIST_SQL = "SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in _LIST.items()) + " FROM orders"
_LATEST_SQL = """d AS (SELECT * FROM s QUALIFY row_number() OVER
  (PARTITION BY AWB ORDER BY TGL_TARIK_REPORT DESC NULLS LAST, ROW_KEY DESC) = 1)"""


def listing(spark, sf):
    return table(spark, sf, "orders").select(*[F.expr(e).alias(n) for n, e in _LIST.items()])


def latest(spark, sf, *columns):
    from shipreport.operators.dedup import latest_per_key

    df = shipments(spark, sf, "AWB", "TGL_TARIK_REPORT", "ROW_KEY", *columns)
    return latest_per_key(df, tie_break=[col("ROW_KEY").desc()])


@query("reflist_left", f"""WITH s AS ({view_sql("AWB", "TGL_TARIK_REPORT", "ROW_KEY", "AMOUNT", "CODING")}), {_LATEST_SQL},
l AS (SELECT *, nullif(regexp_replace(trim("No Resi"), '\\s+', '', 'g'), '') AS k0 FROM ({_LIST_SQL})),
k AS (SELECT *, CASE WHEN starts_with(k0, chr(39)) THEN k0 ELSE chr(39) || k0 END AS key FROM l)
SELECT key AS "No Resi", "TGL PICKUP", k.AMOUNT, chr(39) || d.AWB AS AWB, d.TGL_TARIK_REPORT, d.ROW_KEY, d.CODING
FROM k LEFT JOIN d ON key = chr(39) || d.AWB""")
def reflist_left(spark, sf):
    master = latest(spark, sf, "AMOUNT", "CODING")
    # the key pair is given the wrong way round on purpose
    return listjoin.join_customer_list(listing(spark, sf), master, ("AWB", "No Resi"), requested=["AMOUNT"])


_KEY_EXAMPLES = ["GEN.25/03/26-06"]
_GEN = "'(?i)gen\\.\\d+/\\d+/\\d+-\\d+'"


@query("key_backfill", f"""WITH s AS ({view_sql("ROW_KEY", "NOREF", "GOODS_DESCR", "NOTICE")})
SELECT ROW_KEY, GOODS_DESCR, NOTICE, CASE WHEN NOREF IS NULL OR trim(NOREF) = '' THEN
  coalesce(nullif(upper(regexp_extract(GOODS_DESCR, {_GEN})), ''), nullif(upper(regexp_extract(NOTICE, {_GEN})), ''), NOREF)
  ELSE NOREF END AS NOREF FROM s""")
def key_backfill(spark, sf):
    return listjoin.back_fill_key(shipments(spark, sf, "ROW_KEY", "NOREF", "GOODS_DESCR", "NOTICE"), "NOREF", _KEY_EXAMPLES)


_PICKUP_INPUTS = ["AWB", "REFNO_UOB", "STATUS_POD", "RECEIVED/REASON", "CODING", "REASON RETURN", "TGL_RECEIVED"]

def _relation_case(part: int) -> str:
    from shipreport.functions.derive import DELIVERY_CODES

    arms = " ".join(f"WHEN '{k}' THEN '{v[part]}'" for k, v in DELIVERY_CODES.items())
    return f"CASE code {arms} END"


_PICKUPS = {
    "REFF NUM": "concat(' ', CAST(o_orderkey % 9000 AS STRING))",
    "CUSTOMER NAME": "concat('nama ', CAST(o_custkey AS STRING))",
    "PICK UP DATE": "CAST(o_orderdate AS DATE)",
    "line_no": "o_orderkey",
}


@query("pickup_right", f"""WITH s AS ({view_sql("ROW_KEY", *_PICKUP_INPUTS)}),
p AS (SELECT {", ".join(f'{e} AS "{n}"' for n, e in _PICKUPS.items())} FROM orders),
q AS (SELECT trim("REFF NUM") AS ref, arg_min("CUSTOMER NAME", line_no) AS cn, arg_min("PICK UP DATE", line_no) AS pd,
  min(line_no) AS line_no FROM p GROUP BY 1),
m AS (SELECT *, nullif(replace(replace(trim(REFNO_UOB), chr(39), ''), '*', ''), '') AS mk FROM s),
j AS (SELECT q.*, m.*, CASE WHEN trim(CODING) = '' OR CODING IS NULL THEN 'OPC' ELSE CODING END AS code
  FROM q LEFT JOIN m ON q.ref = m.mk),
r AS (SELECT *, {_relation_case(0)} AS rel, {_relation_case(1)} AS flag FROM j)
SELECT ref AS "REFF NUM", cn AS "CUSTOMER NAME", pd AS "PICK UP DATE", line_no, ROW_KEY, AWB, mk AS "REFNO_UOB", STATUS_POD,
  "RECEIVED/REASON", code AS "CODING", "REASON RETURN", TGL_RECEIVED, flag AS "STATUS UOB",
  CASE WHEN lower(STATUS_POD) = 'success' THEN "RECEIVED/REASON" END AS "RECIPIENT",
  CASE WHEN flag = 'S' THEN rel END AS "RECIPIENT RELATION", CASE WHEN flag = 'R' THEN rel END AS "REASON 2",
  CASE WHEN flag = 'S' THEN AWB WHEN flag = 'R' THEN concat_ws(' ', AWB, "REASON RETURN") END AS "REMARK_UOB",
  '26' AS "COURIER ID", pd AS "UPLOAD DATE", TGL_RECEIVED AS "CLOSING DATE",
  CASE WHEN trim(AWB) <> '' THEN 'ADA AWB' ELSE 'TIDAK ADA AWB' END AS "KET AWB",
  CASE WHEN TGL_RECEIVED IS NOT NULL THEN 'SUDAH CLOSING' ELSE 'BELUM CLOSING' END AS "STATUS CLOSING"
FROM r""")
def pickup_right(spark, sf):
    pickups = table(spark, sf, "orders").select(*[F.expr(e).alias(n) for n, e in _PICKUPS.items()])
    return listjoin.join_pickups(shipments(spark, sf, "ROW_KEY", *_PICKUP_INPUTS), pickups, order=["line_no"])


@query("code_map", f"""WITH s AS ({view_sql("ROW_KEY", "CODING")}),
c AS (SELECT ROW_KEY, CASE WHEN trim(CODING) = '' OR CODING IS NULL THEN 'OPC' ELSE CODING END AS code FROM s)
SELECT ROW_KEY, code, {_relation_case(0)} AS relation, {_relation_case(1)} AS flag FROM c""")
def code_map(spark, sf):
    from shipreport.functions.derive import delivery_parts

    df = shipments(spark, sf, "ROW_KEY", "CODING")
    return df.select("ROW_KEY", *[c.alias(n) for n, c in delivery_parts(col("CODING")).items()])


@query("returns_inner", f"""WITH s AS ({view_sql("ROW_KEY", "CONNOTE_RETURN_RT")}),
r AS (SELECT concat('RT', CAST(s_suppkey AS STRING)) AS "AWB - COPY", s_name AS "SHIPPER_NAME",
  CASE WHEN s_nationkey % 2 = 0 THEN 'Success' ELSE 'Undel' END AS "STATUS_POD" FROM supplier)
SELECT r.*, CASE WHEN "STATUS_POD" = 'Success' THEN 'x' ELSE '' END AS "IS_CLOSE"
FROM r JOIN s ON CONNOTE_RETURN_RT = "AWB - COPY\"""")
def returns_inner(spark, sf):
    from shipreport.plans.registry import Context, derive_columns

    returns = table(spark, sf, "supplier").select(
        F.concat(F.lit("RT"), F.col("s_suppkey").cast("string")).alias("AWB - COPY"), F.col("s_name").alias("SHIPPER_NAME"),
        F.when(F.col("s_nationkey") % 2 == 0, "Success").otherwise("Undel").alias("STATUS_POD"))
    joined = listjoin.join_returns(shipments(spark, sf, "ROW_KEY", "CONNOTE_RETURN_RT"), returns)
    return derive_columns(joined, ["IS_CLOSE"], Context(AS_OF))


# ---- manual corrections ----------------------------------------------------

_PATCH = {
    "row_idx": "o_orderkey * 10",
    "AWB": "CASE WHEN o_orderkey % 6 = 0 THEN concat(chr(39), ' ', CAST(o_orderkey AS STRING), ' ')"
           " WHEN o_orderkey % 6 = 1 THEN CAST(o_orderkey - 1 AS STRING) WHEN o_orderkey % 6 = 2 THEN 'nan'"
           " ELSE CAST(o_orderkey % 1000 AS STRING) END",
    "STATUS_POD": pick("o_orderkey", ["Success", "", "nan", " Undel ", None, "None", "<NA>"]),
    "AMOUNT": pick("o_custkey", ["100", None, "250"]),
    "EXTRA": pick("o_custkey", [None, "catatan"]),
}


def _cell(c: str) -> str:
    return f"CASE WHEN trim({c}) NOT IN ('', 'nan', 'NaN', 'None', '<NA>') THEN trim({c}) END"


_PATCHED = f"""r AS (SELECT {", ".join(f'{e} AS "{n}"' for n, e in _PATCH.items())} FROM orders),
n AS (SELECT row_idx, upper(regexp_replace(ltrim({_cell("AWB")}, chr(39)), '\\s+', '', 'g')) AS k,
  {_cell("STATUS_POD")} AS st, {_cell("AMOUNT")} AS am, {_cell("EXTRA")} AS ex FROM r),
p AS (SELECT k, arg_min(st, row_idx) FILTER (WHERE st IS NOT NULL) AS st, arg_min(am, row_idx) FILTER (WHERE am IS NOT NULL) AS am,
  arg_min(ex, row_idx) FILTER (WHERE ex IS NOT NULL) AS ex FROM n WHERE k <> '' GROUP BY 1)"""


def patch_table(spark, sf):
    return overrides.patches(table(spark, sf, "orders").select(*[F.expr(e).alias(n) for n, e in _PATCH.items()]))


@query("manual_override", f"""WITH s AS ({view_sql("ROW_KEY", "AWB", "STATUS_POD", "STATUS_POD_UPDATE", "AMOUNT")}), {_PATCHED}
SELECT ROW_KEY, AWB, coalesce(st, STATUS_POD) AS STATUS_POD, coalesce(st, STATUS_POD_UPDATE) AS STATUS_POD_UPDATE,
  coalesce(CAST(am AS BIGINT), AMOUNT) AS AMOUNT, ex AS EXTRA FROM s LEFT JOIN p ON AWB = k""")
def manual_override(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "AWB", "STATUS_POD", "STATUS_POD_UPDATE", "AMOUNT")
    return overrides.apply_patches(df, patch_table(spark, sf))


@query("override_counts", f"""WITH s AS ({view_sql("AWB")}), {_PATCHED},
j AS (SELECT p.* FROM s JOIN p ON AWB = k)
SELECT 'STATUS_POD' AS column_name, count(st) AS cells FROM j UNION ALL SELECT 'AMOUNT', count(am) FROM j
UNION ALL SELECT 'EXTRA', count(ex) FROM j""")
def override_counts(spark, sf):
    return overrides.patched_counts(shipments(spark, sf, "AWB"), patch_table(spark, sf))


# ---- receivers -------------------------------------------------------------

WORDS = ["ring", "blue bolt", "satpam", "gear box", "red widgets"]

# Longest common subsequence by rows of a table, and the token-set score over it, in SQL.
_LCS = """list_last(list_reduce(list_transform(string_split(da, ''), lambda c: [ord(c)]), lambda r, x:
  list_reduce(list_transform(range(1, length(db) + 1), lambda j: [CAST(j AS INTEGER)]), lambda acc, j:
    acc || [CASE WHEN ord(db[j[1]]) = x[1] THEN r[j[1]] + 1 ELSE greatest(r[j[1] + 1], acc[len(acc)]) END], [0]),
  list_resize([0], length(db) + 1, 0)))"""
_RECEIVER_SQL = f"""WITH s AS ({view_sql("ROW_KEY", "RECEIVED/REASON", "CONSIGNEE_NAME")}),
x AS (SELECT *, trim(coalesce("RECEIVED/REASON", '')) AS txt FROM s),
n AS (SELECT DISTINCT lower(txt) AS name FROM x WHERE length(txt) BETWEEN 1 AND 15),
t AS (SELECT name, word, list_distinct(string_split(name, ' ')) AS ta, list_distinct(string_split(word, ' ')) AS tb
  FROM n, (SELECT unnest({WORDS}) AS word)),
d AS (SELECT name, word, array_to_string(list_sort(list_filter(ta, lambda y: list_contains(tb, y))), ' ') AS sect,
  array_to_string(list_sort(list_filter(ta, lambda y: NOT list_contains(tb, y))), ' ') AS da,
  array_to_string(list_sort(list_filter(tb, lambda y: NOT list_contains(ta, y))), ' ') AS db FROM t),
l AS (SELECT *, CASE WHEN da = '' OR db = '' THEN 0 ELSE {_LCS} END AS lcs,
  CASE WHEN sect = '' THEN 0 ELSE 1 END AS j, length(sect) AS ls, length(da) AS la, length(db) AS lb FROM d),
f AS (SELECT name, CASE WHEN ls > 0 AND (la = 0 OR lb = 0) THEN 100.0 ELSE greatest(
    100 - 100.0 * (la + lb - 2 * lcs) / (2 * (ls + j) + la + lb),
    CASE WHEN ls > 0 THEN 100 - 100.0 * (j + la) / (2 * ls + j + la) ELSE 0 END,
    CASE WHEN ls > 0 THEN 100 - 100.0 * (j + lb) / (2 * ls + j + lb) ELSE 0 END) END AS score FROM l),
bad AS (SELECT DISTINCT name FROM f WHERE score >= 85)
SELECT ROW_KEY, CONSIGNEE_NAME, CASE WHEN bad.name IS NOT NULL
  THEN coalesce(nullif(trim(coalesce(CONSIGNEE_NAME, '')), ''), txt) ELSE txt END AS "RECEIVED/REASON"
FROM x LEFT JOIN bad ON lower(txt) = bad.name"""


@query("receiver_clean", _RECEIVER_SQL)
def receiver_clean(spark, sf):
    from shipreport.operators.receivers import clean_receivers

    df = shipments(spark, sf, "ROW_KEY", "RECEIVED/REASON", "CONSIGNEE_NAME")
    return clean_receivers(df, WORDS)
