"""Per-row derivations, working-day arithmetic, status and delay rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.master import AS_OF, HOLIDAYS, ZONES, holiday_values, shipments, view_sql, zones
from queries.registry import query
from shipreport.functions import derive, moments, status
from shipreport.functions.delay import DELAY_INPUTS, attribute_delay
from shipreport.functions.text import col
from shipreport.functions.workdays import WorkCalendar, arrival
from shipreport.operators import lookups

MONTHS_SQL = "[" + ", ".join(f"'{m}'" for m in moments.MONTHS) + "]"
CALENDAR = WorkCalendar(HOLIDAYS)


@query("address_join", f"""WITH s AS ({view_sql("ROW_KEY", "ADDR1", "ADDR2", "ADDR3")})
SELECT ROW_KEY, concat_ws(' ', CASE WHEN trim(ADDR1) <> '' THEN ADDR1 END, CASE WHEN trim(ADDR2) <> '' THEN ADDR2 END,
  CASE WHEN trim(ADDR3) <> '' THEN ADDR3 END) AS ADDRESS FROM s""")
def address_join(spark, sf):
    from shipreport.plans.registry import Context, derive_columns

    df = shipments(spark, sf, "ROW_KEY", "ADDR1", "ADDR2", "ADDR3")
    return derive_columns(df, ["ADDRESS"], Context(AS_OF)).select("ROW_KEY", "ADDRESS")


@query("latlong", f"""WITH s AS ({view_sql("ROW_KEY", "STATUS_LATITUDE", "STATUS_LONGITUDE")})
SELECT ROW_KEY, CASE WHEN lower(trim(STATUS_LATITUDE)) NOT IN ('', 'nan') AND lower(trim(STATUS_LONGITUDE)) NOT IN ('', 'nan')
  THEN trim(STATUS_LATITUDE) || ', ' || trim(STATUS_LONGITUDE) ELSE '' END AS STATUS_LATLONG FROM s""")
def latlong(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "STATUS_LATITUDE", "STATUS_LONGITUDE")
    return df.select("ROW_KEY", derive.coordinates(col("STATUS_LATITUDE"), col("STATUS_LONGITUDE")).alias("STATUS_LATLONG"))


@query("period_cols", f"""WITH s AS ({view_sql("ROW_KEY", "TGL_ENTRY")})
SELECT ROW_KEY, TGL_ENTRY, coalesce({MONTHS_SQL}[month(TGL_ENTRY)], '') AS PERIODE,
  date_diff('day', date_trunc('month', TGL_ENTRY), date_trunc('day', TGL_ENTRY)) // 7 + 1 AS WEEK,
  week(TGL_ENTRY) AS WEEK_OF_YEAR, day(TGL_ENTRY) AS DAY, strftime(TGL_ENTRY, '%H:%M') AS TIME_ENTRY FROM s""")
def period_cols(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "TGL_ENTRY")
    return df.withColumns(derive.period_columns(col("TGL_ENTRY")))


@query("received_cols", f"""WITH s AS ({view_sql("ROW_KEY", "TGL_RECEIVED")})
SELECT ROW_KEY, CAST(TGL_RECEIVED AS DATE) AS DATE_RECEIVED, strftime(TGL_RECEIVED, '%H:%M:%S') AS TIME_RECEIVED FROM s""")
def received_cols(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "TGL_RECEIVED")
    return df.select("ROW_KEY", *[c.alias(n) for n, c in derive.received_columns(col("TGL_RECEIVED")).items()])


@query("prefix_class", f"""WITH s AS ({view_sql("ROW_KEY", "ORIGIN", "DEST_FW", "SERVICE")})
SELECT ROW_KEY, CASE WHEN ORIGIN LIKE 'CGK%' THEN 'Non SBS' ELSE 'SBS' END AS "ORIGIN 2",
  substr(DEST_FW, 1, 3) AS "3 LC DEST FW", CASE WHEN SERVICE IS NULL THEN 'INVALID' WHEN SERVICE LIKE 'CTCYES%' THEN 'YES'
  WHEN SERVICE LIKE 'YES%' THEN 'YES' WHEN SERVICE LIKE 'CTC%' THEN 'REG' WHEN SERVICE LIKE 'REG%' THEN 'REG'
  WHEN SERVICE LIKE 'TRC%' THEN 'JTR' WHEN SERVICE LIKE 'JTR%' THEN 'JTR' END AS "KET" FROM s""")
def prefix_class(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "ORIGIN", "DEST_FW", "SERVICE")
    return df.select("ROW_KEY", derive.origin_class(col("ORIGIN")).alias("ORIGIN 2"),
                     derive.site_code(col("DEST_FW")).alias("3 LC DEST FW"), derive.service_family(col("SERVICE")).alias("KET"))


@query("status_class", f"""WITH s AS ({view_sql("ROW_KEY", "STATUS_POD")})
SELECT ROW_KEY, STATUS_POD, CASE WHEN STATUS_POD IN ('Success', 'Return Shipper') THEN 'CLOSE CABANG'
    ELSE 'ON FOLLOW UP CABANG' END AS REASON,
  CASE WHEN STATUS_POD = 'Return Shipper' THEN 'RETURN SICEPAT' END AS DESCR_RETURN,
  CASE WHEN STATUS_POD = 'Success' THEN 'Success' WHEN STATUS_POD IN ('Return Shipper', 'RU Origin') THEN 'Process Return'
    WHEN STATUS_POD IN ('Missing', 'AWB Cancel', 'Hold WH Destination', 'Undel') THEN 'Undel' ELSE 'On Process' END
    AS GROUPING_STATUS FROM s""")
def status_class(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "STATUS_POD")
    pod = col("STATUS_POD")
    return df.withColumns({"REASON": status.follow_up(pod), "DESCR_RETURN": status.return_note(pod),
                           "GROUPING_STATUS": status.status_group(pod)})


@query("case_dates", f"""WITH s AS ({view_sql("ROW_KEY", "CONNOTE_RETURN_RT", "TGL_RECEIVED", "DATE_CONNOTE_RETURN_RT",
                                             "DATE_1ST_ATTEMPT", "STATUS_POD")})
SELECT ROW_KEY, CASE WHEN CONNOTE_RETURN_RT IS NULL THEN TGL_RECEIVED WHEN contains(CONNOTE_RETURN_RT, 'RT')
    THEN DATE_CONNOTE_RETURN_RT END AS DATE_RECEIVE_REQUEST,
  CASE WHEN DATE_1ST_ATTEMPT IS NULL AND STATUS_POD = 'Success' THEN TGL_RECEIVED ELSE DATE_1ST_ATTEMPT END
    AS DATE_1ST_ATTEMPT FROM s""")
def case_dates(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "CONNOTE_RETURN_RT", "TGL_RECEIVED", "DATE_CONNOTE_RETURN_RT",
                   "DATE_1ST_ATTEMPT", "STATUS_POD")
    return df.select(
        "ROW_KEY",
        derive.request_date(col("CONNOTE_RETURN_RT"), col("TGL_RECEIVED"), col("DATE_CONNOTE_RETURN_RT")).alias(
            "DATE_RECEIVE_REQUEST"),
        derive.first_attempt(col("DATE_1ST_ATTEMPT"), col("STATUS_POD"), col("TGL_RECEIVED")).alias("DATE_1ST_ATTEMPT"))


@query("weight_round", f"""WITH s AS ({view_sql("ROW_KEY", "WEIGHT")})
SELECT ROW_KEY, CASE WHEN WEIGHT IS NOT NULL THEN greatest(1.0::DOUBLE,
  CASE WHEN WEIGHT % 1 > 0.3 THEN ceil(WEIGHT) ELSE floor(WEIGHT) END) END AS WEIGHT FROM s""")
def weight_round(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "WEIGHT")
    return df.withColumn("WEIGHT", derive.billed_weight(col("WEIGHT")))


@query("mask_pii", f"""WITH s AS ({view_sql("ROW_KEY")}) SELECT ROW_KEY, '*****' AS CONTACT, '*****' AS NOTELP FROM s""")
def mask_pii(spark, sf):
    from shipreport.plans.registry import Context, derive_columns

    return derive_columns(shipments(spark, sf, "ROW_KEY", "CONTACT", "NOTELP"), ["CONTACT"], Context(AS_OF))


@query("regex_fix", f"""WITH s AS ({view_sql("ROW_KEY", "REGIONAL")})
SELECT ROW_KEY, replace(REGIONAL, 'Sumatara', 'Sumatera') AS REGIONAL,
  replace(upper(REGIONAL), 'SUMATARA', 'Sumatera') AS "DEST REGIONAL" FROM s""")
def regex_fix(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "REGIONAL")
    return derive.fix_regional_spelling(df.withColumn("DEST REGIONAL", F.upper("REGIONAL")))


@query("sla_bucket", f"""WITH s AS ({view_sql("ROW_KEY", "SLA")})
SELECT ROW_KEY, SLA, CASE WHEN SLA IS NULL THEN '' WHEN SLA > 0 THEN 'OVER SLA' WHEN SLA = 0 THEN 'TODAY'
  WHEN SLA >= -3 THEN concat('H', CAST(SLA AS STRING)) ELSE '>H-4' END AS GROUPING_SLA FROM s""")
def sla_bucket(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "SLA")
    return df.withColumn("GROUPING_SLA", derive.sla_bucket(col("SLA")))


@query("regex_extract", f"""WITH s AS ({view_sql("ROW_KEY", "INTRUCTION")})
SELECT ROW_KEY, INTRUCTION, nullif(regexp_extract(INTRUCTION, 'SPK/[A-Z0-9-]+/[0-9]+/[A-Z]+/[0-9]+'), '') AS SPK FROM s""")
def regex_extract(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "INTRUCTION")
    return df.withColumn("SPK", derive.work_order(col("INTRUCTION")))


def _likes(column: str, words: list[str]) -> str:
    return " OR ".join(f"contains(lower({column}), '{w}')" for w in words)


@query("keyword_class", f"""WITH s AS ({view_sql("ROW_KEY", "GOODS_DESCR", "PROVINSI")})
SELECT ROW_KEY, CASE WHEN contains(upper(GOODS_DESCR), 'ULTAH') OR contains(upper(GOODS_DESCR), 'ULANG TAHUN')
    OR contains(upper(GOODS_DESCR), 'UCAPAN') THEN 'ATENSI ULANG TAHUN' ELSE 'REGULER' END AS BNI_KATEGORI,
  CASE WHEN PROVINSI IS NULL THEN NULL WHEN {_likes("PROVINSI", derive.WEST)} THEN 'Indonesia Bagian Barat'
    WHEN {_likes("PROVINSI", derive.CENTRAL)} THEN 'Indonesia Bagian Tengah' ELSE 'Indonesia Bagian Timur' END
    AS "Indonesia Bagian" FROM s""")
def keyword_class(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "GOODS_DESCR", "PROVINSI")
    return df.select("ROW_KEY", derive.goods_category(col("GOODS_DESCR")).alias("BNI_KATEGORI"),
                     derive.island_third(col("PROVINSI")).alias("Indonesia Bagian"))


@query("keyword_class_documents", """SELECT doc_id, CASE WHEN regexp_matches(upper(text), 'ULANG TAHUN|ULTAH|UCAPAN')
  THEN 'ATENSI ULANG TAHUN' ELSE 'REGULER' END AS category FROM documents""")
def keyword_class_documents(spark, sf):
    from queries.registry import table

    return table(spark, sf, "documents").select("doc_id", derive.goods_category(col("text")).alias("category"))


@query("price_per_kg", f"""WITH s AS ({view_sql("ROW_KEY", "AMOUNT", "WEIGHT", "ETD")})
SELECT ROW_KEY, CASE WHEN WEIGHT <> 0 THEN floor(AMOUNT / WEIGHT / 1000) * 1000.0::DOUBLE END AS "Harga Per KG",
  CASE WHEN ETD <> 0 THEN floor(CAST(AMOUNT AS DOUBLE) / ETD / 1000) * 1000.0::DOUBLE END AS per_day FROM s""")
def price_per_kg(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "AMOUNT", "WEIGHT", "ETD")
    return df.select("ROW_KEY", derive.price_per_kg(col("AMOUNT"), col("WEIGHT")).alias("Harga Per KG"),
                     derive.price_per_kg(col("AMOUNT"), col("ETD")).alias("per_day"))


@query("time_deltas", f"""WITH s AS ({view_sql("ROW_KEY", "TGL_ENTRY", "1ST_RUNSHEET_DATE", "INBOUND_MANIFEST_DATE")})
SELECT ROW_KEY, CAST(floor((epoch_us("1ST_RUNSHEET_DATE") - epoch_us("INBOUND_MANIFEST_DATE")) / 86400000000.0) AS BIGINT) AS days,
  CAST(ceil((epoch_us("INBOUND_MANIFEST_DATE") - epoch_us(TGL_ENTRY)) / 3600000000.0) AS BIGINT) AS hours FROM s""")
def time_deltas(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "TGL_ENTRY", "1ST_RUNSHEET_DATE", "INBOUND_MANIFEST_DATE")
    return df.select(
        "ROW_KEY", moments.whole_days(col("INBOUND_MANIFEST_DATE"), col("1ST_RUNSHEET_DATE")).alias("days"),
        moments.hours_up(col("TGL_ENTRY"), col("INBOUND_MANIFEST_DATE")).alias("hours"))


# ---- working days ----------------------------------------------------------

# A day-by-day calendar with running counts: the arithmetic is checked against plain counting.
_CAL = f"""h(d) AS (VALUES {holiday_values()}),
days AS (SELECT CAST(g AS DATE) AS d FROM generate_series(DATE '1990-01-01', DATE '2006-12-31', INTERVAL 1 DAY) t(g)),
w AS (SELECT d, CASE WHEN isodow(d) < 6 AND d NOT IN (SELECT d FROM h) THEN 1 ELSE 0 END AS wk FROM days),
cal AS (SELECT d, wk, sum(wk) OVER (ORDER BY d) AS le, sum(wk) OVER (ORDER BY d) - wk AS lt FROM w)"""


def _aging_sql(end: str, b: str) -> str:
    return f"""CASE WHEN CAST({end} AS DATE) <= CAST(TGL_ENTRY AS DATE) THEN 0 ELSE CAST({b}.lt - a.lt + 1 AS BIGINT) END"""


@query("busdays_aging", f"""WITH s AS ({view_sql("ROW_KEY", "TGL_ENTRY", "TGL_RECEIVED")}), {_CAL}
SELECT ROW_KEY, TGL_ENTRY, TGL_RECEIVED, {_aging_sql("TGL_RECEIVED", "b")} AS aging
FROM s LEFT JOIN cal a ON a.d = CAST(TGL_ENTRY AS DATE) LEFT JOIN cal b ON b.d = CAST(TGL_RECEIVED AS DATE)""")
def busdays_aging(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "TGL_ENTRY", "TGL_RECEIVED")
    return df.withColumn("aging", CALENDAR.aging(col("TGL_ENTRY"), col("TGL_RECEIVED")))


@query("busdays_inclusive", f"""WITH s AS ({view_sql("ROW_KEY", "TGL_ENTRY", "TGL_RECEIVED")}), {_CAL}
SELECT ROW_KEY, CASE WHEN CAST(TGL_RECEIVED AS DATE) < CAST(TGL_ENTRY AS DATE) THEN 0
  ELSE CAST(b.le - a.lt AS BIGINT) END AS span
FROM s LEFT JOIN cal a ON a.d = CAST(TGL_ENTRY AS DATE) LEFT JOIN cal b ON b.d = CAST(TGL_RECEIVED AS DATE)""")
def busdays_inclusive(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "TGL_ENTRY", "TGL_RECEIVED")
    return df.select("ROW_KEY", CALENDAR.span(col("TGL_ENTRY"), col("TGL_RECEIVED")).alias("span"))


@query("eta_workdays", f"""WITH s AS ({view_sql("ROW_KEY", "TGL_ENTRY", "ETD")}), {_CAL},
k AS (SELECT ROW_KEY, TGL_ENTRY, ETD, CASE WHEN ETD + 1 >= 1 THEN a.le + ETD + 1 ELSE a.lt + 1 + ETD + 1 END AS rank
  FROM s LEFT JOIN cal a ON a.d = CAST(TGL_ENTRY AS DATE))
SELECT ROW_KEY, TGL_ENTRY, ETD, b.d + (TGL_ENTRY - date_trunc('day', TGL_ENTRY)) AS "ETA",
  TGL_ENTRY + to_days(CAST(ETD + 1 AS INTEGER)) AS eta_calendar
FROM k LEFT JOIN cal b ON b.le = rank AND b.wk = 1""")
def eta_workdays(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "TGL_ENTRY", "ETD")
    return df.withColumns({"ETA": arrival(col("TGL_ENTRY"), col("ETD"), CALENDAR),
                           "eta_calendar": arrival(col("TGL_ENTRY"), col("ETD"), None)})


def _flag_sql(kept: str, aging: str) -> str:
    return f"""CASE WHEN ok THEN coalesce({kept}, CASE WHEN {aging} <= ETD THEN 'Ontime SLA' WHEN {aging} > ETD THEN 'Over SLA' END) END"""


@query("aging_flags", f"""WITH s AS ({view_sql("ROW_KEY", "TGL_ENTRY", "1ST_ATTEMPT_DATE", "TGL_RECEIVED", "ETD", "STATUS_POD",
                                              "CARRER_POD")}), {_CAL},
k AS (SELECT s.*, coalesce(lower(STATUS_POD) = 'success', false) AS ok, {_aging_sql('"1ST_ATTEMPT_DATE"', "b")} AS a1,
  {_aging_sql("TGL_RECEIVED", "c")} AS a2 FROM s LEFT JOIN cal a ON a.d = CAST(TGL_ENTRY AS DATE)
  LEFT JOIN cal b ON b.d = CAST("1ST_ATTEMPT_DATE" AS DATE) LEFT JOIN cal c ON c.d = CAST(TGL_RECEIVED AS DATE))
SELECT ROW_KEY, TGL_ENTRY, TGL_RECEIVED, ETD, STATUS_POD, CASE WHEN ok THEN "1ST_ATTEMPT_DATE" END AS "1ST_ATTEMPT_DATE",
  CASE WHEN ok THEN a1 END AS "AGING_1ST", {_flag_sql("NULL", "a1")} AS "CAREER_1ST", CASE WHEN ok THEN a2 END AS "AGING_POD",
  {_flag_sql("CARRER_POD", "a2")} AS "CARRER_POD" FROM k""")
def aging_flags(spark, sf):
    df = shipments(spark, sf, "ROW_KEY", "TGL_ENTRY", "1ST_ATTEMPT_DATE", "TGL_RECEIVED", "ETD", "STATUS_POD", "CARRER_POD")
    return derive.aging_flags(df, CALENDAR)


_TEMPLATE = ["ROW_KEY", "AWB", "NOREF", "AMOUNT", "WEIGHT", "PROVINSI", "ETD", "TGL_RECEIVED", "TGL_ENTRY", "STATUS_POD"]


@query("lead_time_class", f"""WITH s AS ({view_sql(*_TEMPLATE)}), {_CAL},
k AS (SELECT s.*, coalesce(lower(trim(STATUS_POD)) = 'success', false) AS ok FROM s),
m AS (SELECT k.*, CASE WHEN ok THEN CAST(floor((epoch_us(TGL_RECEIVED) - epoch_us(TGL_ENTRY)) / 86400000000.0) AS BIGINT) END AS lt,
  CASE WHEN ok THEN CASE WHEN CAST(TGL_RECEIVED AS DATE) < CAST(TGL_ENTRY AS DATE) THEN 0 ELSE CAST(b.le - a.lt AS BIGINT) END END AS od
  FROM k LEFT JOIN cal a ON a.d = CAST(TGL_ENTRY AS DATE) LEFT JOIN cal b ON b.d = CAST(TGL_RECEIVED AS DATE))
SELECT ROW_KEY, coalesce(trim(NOREF), '') AS "No_YL", right(coalesce(AWB, ''), 7) AS "No DSV", '99%' AS "Target",
  CASE WHEN lt IS NOT NULL THEN strftime(TGL_RECEIVED, '%H:%M:%S') END AS "ATA", lt AS "LEAD TIME",
  CAST(ETD AS DOUBLE) AS "SLA_", CASE WHEN ok THEN 'OK' END AS "REMARK_YL", lt + 1 AS "Overday Before Holiday",
  od AS "Overday Success After Holiday", lt + 1 - od AS "Total Tgl Merah",
  CASE WHEN NOT ok THEN NULL WHEN TGL_RECEIVED IS NULL THEN 'On Process' WHEN lt > ETD THEN 'Fail' ELSE 'Achieve' END
    AS "Status Delivery",
  CASE WHEN lt <= 0 THEN 'SDS' WHEN lt = 1 THEN 'NDS' WHEN lt = 2 THEN 'H+2' WHEN lt > 2 THEN 'H++' END AS "MOD" FROM m""")
def lead_time_class(spark, sf):
    df = derive.delivery_template(shipments(spark, sf, *_TEMPLATE), CALENDAR, AS_OF)
    return df.select("ROW_KEY", *[col(c) for c in (
        "No_YL", "No DSV", "Target", "ATA", "LEAD TIME", "SLA_", "REMARK_YL", "Overday Before Holiday",
        "Overday Success After Holiday", "Total Tgl Merah", "Status Delivery", "MOD")])


# ---- status ----------------------------------------------------------------

_STATUS_COLUMNS = ["ROW_KEY", *status.FULL_STATUS_INPUTS, *status.FULL_STATUS_OPTIONAL]
_SETTLED_SQL = ", ".join(f"'{v}'" for v in status.SETTLED)
STATUS_STEPS = f"""
a AS (SELECT *, CASE WHEN trim(STATUS_POD_UPDATE) <> '' THEN STATUS_POD_UPDATE ELSE STATUS_POD END AS pod,
  trim(CODING) AS code FROM s),
b AS (SELECT *, CASE WHEN code IN ('D25', 'D26', 'D99') THEN 'Auto Closed Breach (D25,D26)' WHEN code IN ('D24', 'C02') THEN 'Claim Damage'
  WHEN code = 'C01' THEN 'Claim Missing' WHEN code = 'R26' THEN 'Return Shipper' WHEN code = 'CL1' THEN 'Auto Closed Origin (CL1)'
  WHEN code IN ('CL2', 'CL3', 'CL4') THEN 'Auto Closed Destination (CL2,CL4)' WHEN code IN ('R24', 'R25') THEN 'Rejection Return'
  WHEN code = 'CR4' THEN 'Destroyed' WHEN pod IS NULL THEN 'Unknown' WHEN pod = 'RU Shipper/Origin' THEN 'RU Origin'
  ELSE pod END AS s0 FROM a),
c AS (SELECT *, CASE WHEN s0 IN ({_SETTLED_SQL}) THEN s0 WHEN trim(AWB_CANCEL) = 'Y' THEN 'AWB Cancel'
  WHEN TGL_ENTRY IS NULL THEN 'Invalid AWB' WHEN code = 'CR8' THEN 'RU Origin' WHEN code = 'U14' THEN 'Missing'
  WHEN code = 'U11' THEN 'Damage' WHEN s0 = 'Un Receiving' THEN 'Un Receiving' ELSE 'Next' END AS s1 FROM b),
d AS (SELECT *, CASE WHEN s1 <> 'Next' THEN s1 WHEN CONNOTE_RETURN_RT IS NOT NULL THEN 'RU Origin'
  WHEN CONNOTE_RETURN_RF IS NOT NULL THEN 'RU Origin' WHEN contains(CODING, 'U0') THEN 'Undel' WHEN contains(CODING, 'CR3') THEN 'Undel'
  WHEN CODING IN ('CR2', 'U21', 'U22', 'U23', 'U10') THEN 'Undel'
  WHEN RESULT_1ST_ATTEMPT IS NOT NULL AND NOT contains(RESULT_1ST_ATTEMPT, 'U12') THEN 'Undel'
  WHEN pod IS NOT NULL OR INBOUND_MANIFEST IS NOT NULL OR MANIFEST_TRANSIT_AGEN IS NOT NULL OR HVI_NO IS NOT NULL
    OR RUNSHEET_NO IS NOT NULL THEN 'On Process'
  WHEN left(DEST, 3) = left(HVO_NO, 3) THEN 'On Process'
  WHEN OUTBOUND_MANIFEST IS NOT NULL OR HVO_NO IS NOT NULL THEN 'On Forward Destination'
  WHEN RECEIVING IS NOT NULL THEN 'Un Manifest' ELSE 'Un Receiving' END AS s2 FROM c),
e AS (SELECT *, CASE WHEN contains(CONFIRM_SHIPMENT_UNDEL, 'WH1') THEN 'Hold WH Destination' ELSE s2 END AS s3 FROM d),
f AS (SELECT *, CASE WHEN s3 = 'On Process' AND contains(ORIGIN, 'CGK') AND contains(DEST, 'CGK') THEN
  CASE WHEN HVI_NO IS NOT NULL THEN 'On Process' WHEN HVO_NO IS NOT NULL THEN 'On Forward Destination'
    WHEN RECEIVING IS NOT NULL THEN 'Un Manifest' ELSE 'Un Receiving' END ELSE s3 END AS s4 FROM e),
g AS (SELECT *, CASE WHEN NO_CNOTE_FW IS NULL THEN s4 ELSE CASE DESC_STATUS_FW WHEN 'RU Shipper/Origin' THEN 'RU Origin'
    WHEN 'Cancel' THEN 'Undel' WHEN 'Damage Case' THEN 'Damage' WHEN 'Success' THEN 'Success' WHEN 'Return Shipper' THEN 'Return Shipper'
    WHEN 'Undel' THEN 'Undel' WHEN 'Destroyed' THEN 'Destroyed' WHEN 'Missing' THEN 'Missing'
    WHEN 'Rejection Return' THEN 'Rejection Return' ELSE s4 END END AS s5,
  CASE WHEN NO_CNOTE_FW IS NULL THEN DEST ELSE DEST_FW END AS dest2,
  CASE WHEN NO_CNOTE_FW IS NULL THEN CODING ELSE CODING_STATUS_FW END AS coding2 FROM f),
h1 AS (SELECT *, CASE WHEN coding2 = 'DB1' THEN 'Success' ELSE s5 END AS s6 FROM g),
h2 AS (SELECT *, CASE WHEN CONNOTE_RETURN_RT IS NOT NULL AND s6 IN ('On Process', 'Undel', 'Hold WH Destination',
  'Auto Closed Destination (CL2,CL4)', 'Auto Closed Breach (D25,D26)') THEN 'RU Origin' ELSE s6 END AS s7 FROM h1),
h3 AS (SELECT *, CASE WHEN s7 <> 'On Process' THEN s7
  WHEN left(RUNSHEET_NO, 3) = left(dest2, 3) THEN CASE WHEN CAST(DATE_RUNSHEET AS DATE) = DATE '{AS_OF.isoformat()}'
    THEN 'On Delivery' ELSE 'Open POD' END
  WHEN left(RUNSHEET_NO, 3) = left(ORIGIN, 3) THEN 'On Forward Destination' ELSE 'Problem Missroute' END AS s8 FROM h2),
h4 AS (SELECT *, CASE WHEN IREG_CODE LIKE 'X%' AND s8 IN ('Un Receiving', 'Un Manifest', 'On Forward Destination')
  THEN 'Problem X-Ray' ELSE s8 END AS s9 FROM h3),
z AS (SELECT *, CASE WHEN s9 IN ('Auto Closed Breach (D25,D26)', 'Auto Closed Destination (CL2,CL4)') THEN 'Claim Breach (Over SLA)'
  WHEN s9 IN ('Open POD', 'Problem Missroute') THEN 'On Process' WHEN s9 = 'Auto Closed Origin (CL1)' THEN 'Un Receiving'
  ELSE s9 END AS final_status FROM h4)"""


@query("status_full", f"""WITH s AS ({view_sql(*_STATUS_COLUMNS)}), {STATUS_STEPS}
SELECT ROW_KEY, dest2 AS DEST, coding2 AS CODING, final_status AS STATUS_POD FROM z""")
def status_full(spark, sf):
    df = status.resolve_full_status(shipments(spark, sf, *_STATUS_COLUMNS), AS_OF)
    return df.select("ROW_KEY", "DEST", "CODING", "STATUS_POD")


@query("status_short", f"""WITH s AS ({view_sql("ROW_KEY", "STATUS_POD", "STATUS_POD_UPDATE", "CODING")})
SELECT ROW_KEY, CODING, CASE WHEN trim(CODING) = 'C01' THEN 'Claim Missing' WHEN trim(CODING) = 'C02' THEN 'Claim Damage'
  ELSE coalesce(STATUS_POD_UPDATE, '') END AS STATUS_POD FROM s""")
def status_short(spark, sf):
    return status.short_status(shipments(spark, sf, "ROW_KEY", "STATUS_POD", "STATUS_POD_UPDATE", "CODING"))


# ---- delay -----------------------------------------------------------------

_DELAY_COLUMNS = ["ROW_KEY", "ORIGIN", *[c for c in DELAY_INPUTS if c != "3_LC_ORIGIN"]]


def _days(start: str, end: str) -> str:
    return f"floor((epoch_us({end}) - epoch_us({start})) / 86400000000.0)"


def _delay_sql(morning: str, same_day: str) -> str:
    return f"""
d0 AS (SELECT s.*, zo."3 LC" AS o3, coalesce(zo."3 LC" = "3 LC DEST", false) AS same FROM s LEFT JOIN zo ON ORIGIN = zo.DEST),
d1 AS (SELECT *, coalesce(OUTBOUND_MANIFEST_DATE, CASE WHEN same THEN "1ST_HVO_DATE" END, HBG_DATE) AS om,
  coalesce(INBOUND_MANIFEST_DATE, CASE WHEN same THEN HVI_DATE END) AS im FROM d0),
d2 AS (SELECT *, coalesce(im, "1ST_RUNSHEET_DATE") AS im2 FROM d1),
d3 AS (SELECT *, CASE WHEN ceil((epoch_us(om) - epoch_us(TGL_ENTRY)) / 3600000000.0) > 5 THEN 'FM - Late'
    WHEN om IS NOT NULL AND TGL_ENTRY IS NOT NULL THEN 'FM - Ontime' END AS fm,
  {_days("om", "im2")} AS mmd, hour(im) AS hr, {_days("im2", '"1ST_RUNSHEET_DATE"')} AS rd,
  {_days("im2", "MANIFEST_TRANSIT_SUBAGEN_DATE")} AS md,
  {_days("MANIFEST_TRANSIT_SUBAGEN_DATE", "MANIFEST_INBOUND_SUBAGEN_DATE")} AS td, hour(MANIFEST_INBOUND_SUBAGEN_DATE) AS th,
  {_days("MANIFEST_INBOUND_SUBAGEN_DATE", '"1ST_RUNSHEET_DATE"')} AS cd FROM d2),
d4 AS (SELECT *, CASE WHEN mmd > ETD THEN 'MM - Late ETD Max' WHEN mmd > 1 THEN 'MM - Late > 1 Hari'
    WHEN mmd IS NOT NULL THEN 'MM - Ontime' END AS mm,
  CASE WHEN hr IS NULL THEN NULL WHEN ZONA IN ('A', 'B') THEN
    CASE WHEN hr < 17 THEN CASE WHEN rd = 0 THEN 'LM - Ontime Zona AB' ELSE 'LM - Late Zona AB' END
      WHEN rd < 0 THEN 'LM - IM Backdate' WHEN rd IN (0, 1) THEN 'LM - Ontime Zona AB' ELSE 'LM - Late Zona AB' END
  WHEN ZONA IN ('C', 'D') THEN CASE WHEN md < 0 THEN 'LM - IM Backdate'
      WHEN (hr >= 12 AND md IN (0, 1)) OR {morning} THEN 'handed' ELSE 'LM - Late FW to Sub Agen' END END AS fw,
  CASE WHEN th IS NULL THEN NULL WHEN cd < 0 THEN 'LM - MTI Backdate' WHEN {same_day} THEN
      CASE WHEN cd = 0 THEN 'LM - Ontime Runsheet Zona C D' ELSE 'LM - Late Runsheet Zona C D' END
    WHEN cd IN (0, 1) THEN 'LM - Ontime Runsheet Zona C D' ELSE 'LM - Late Runsheet Zona C D' END AS cr FROM d3),
d5 AS (SELECT *, CASE WHEN fw = 'handed' THEN CASE WHEN td < 0 THEN 'LM - MTI Backdate' WHEN td >= 2 THEN 'LM - Late Inbound Sub Agen'
    WHEN td IS NOT NULL THEN 'taken' ELSE 'handed' END ELSE fw END AS fw2 FROM d4),
d6 AS (SELECT *, CASE WHEN fw2 = 'handed' AND cr IS NULL THEN 'LM - UnMTI' WHEN fw2 IS NULL OR fw2 = 'taken' THEN cr
    WHEN fw2 = 'handed' THEN 'Ontime Cabang Utama FW Sub Agen' ELSE fw2 END AS lm FROM d5),
d7 AS (SELECT *, concat_ws(', ',
  CASE WHEN fm = 'FM - Late' OR RECEIVING_DATE IS NULL OR om IS NULL OR contains(STATUS_POD, 'Cancel') THEN 'FM - LATE' END,
  CASE WHEN contains(mm, 'Late') OR im2 IS NULL OR contains(HOLD_REASON, 'Cukai') OR contains(HOLD_REASON, 'Bea') THEN 'MM - LATE' END,
  CASE WHEN contains(lm, 'Late') OR MANIFEST_TRANSIT_SUBAGEN_DATE IS NULL OR MANIFEST_INBOUND_SUBAGEN_DATE IS NULL
    OR "1ST_RUNSHEET_DATE" IS NULL OR {_days('"1ST_RUNSHEET_DATE"', "TGL_RECEIVED")} > 1 OR DATE_LAST_ATTEMPT IS NOT NULL
    OR contains(NO_CNOTE_FW, 'FW') THEN 'LM - LATE' END) AS legs FROM d6),
d8 AS (SELECT *, CASE WHEN CARRER = 'Over SLA' AND legs = '' THEN 'LM - LATE' WHEN CARRER IN ('Over SLA', 'Over SLA (became)') THEN legs
  ELSE '' END AS grp FROM d7)"""


_DELAY_AS_IS = _delay_sql("false", "th = 17")


def _delay_rows(spark, sf, **options):
    df = shipments(spark, sf, *_DELAY_COLUMNS)
    df = lookups.attach(df, zones(spark, sf), col("ORIGIN"), col("DEST"), {"3_LC_ORIGIN": "3 LC"})
    return attribute_delay(df, keep_steps=True, **options).select(
        "ROW_KEY", "REMARK_FM", "REMARK_MM", "REMARK_LM", "GROUPING_LATE")


_DELAY_OUT = "SELECT ROW_KEY, fm AS REMARK_FM, mm AS REMARK_MM, lm AS REMARK_LM, grp AS GROUPING_LATE FROM d8"


@query("delay_attribution", f"""WITH s AS ({view_sql(*_DELAY_COLUMNS)}), zo AS ({ZONES}), {_DELAY_AS_IS} {_DELAY_OUT}""")
def delay_attribution(spark, sf):
    return _delay_rows(spark, sf)


@query("delay_attribution_fixed", f"""WITH s AS ({view_sql(*_DELAY_COLUMNS)}), zo AS ({ZONES}),
{_delay_sql("(hr < 12 AND md = 0)", "th < 17")} {_DELAY_OUT}""")
def delay_attribution_fixed(spark, sf):
    return _delay_rows(spark, sf, fixed_rules=True)
