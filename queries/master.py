"""The given tables seen as a shipment master and its reference tables.

Every column is one SQL expression both engines understand, so the view and its
SQL twin cannot drift apart. Only the joins the requested columns need are made.
Nulls are put in by rule because the given tables have none.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from queries.registry import table

AS_OF = date(1998, 7, 15)

# Holidays of the test calendar.
HOLIDAYS = [
    date(y, m, d) for y in range(1995, 2003) for m, d in ((1, 1), (3, 28), (5, 1), (6, 1), (8, 17), (12, 25), (12, 26))
]


def pick(number: str, values: list[str | None]) -> str:
    """CASE over number modulo the count of values."""
    arms = " ".join(
        f"WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'") for i, v in enumerate(values))
    return f"CASE ({number}) % {len(values)} {arms} END"


def _late(hours: str, hole: int, number: str) -> str:
    """Order date plus some hours, missing where the number divides by ``hole``."""
    return f"CASE WHEN ({number}) % {hole} = 0 THEN NULL ELSE o_orderdate + INTERVAL '1' HOUR * ({hours}) END"


_N = "l_orderkey * 3 + l_partkey * 7 + l_linenumber"  # spreads values over lines
CODES = [
    "D01", "D25", "D26", "D99", "D24", "C01", "C02", "R26", "CL1", "CL2", "CL3", "CL4", "R24", "R25", "CR4", "CR8",
    "U14", "U11", "U01", "U05", "CR3", "CR2", "U21", "U10", "DB1", "D10", None, None, " U12 ", "X9", "CR1", None, "",
]
SITES = ["CGK", "BDO", "SUB", "KOE", "AMI"]
REGIONS = [
    "Regional Jakarta", "Regional Bodetabekcil", "Regional Jawa Barat", "Regional Jateng Diy", "Regional Sumatara",
    "Regional Kalimantan",
]
PROVINCES = ["DKI Jakarta", "Jawa Barat", "Sulawesi Utara", "Papua", "Kalimantan Timur", "Maluku", "Bali", None]

# name -> (tables beyond lineitem, expression)
COLUMNS: dict[str, tuple[str, str]] = {
    "AWB": ("", "CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE CAST(l_orderkey AS STRING) END"),
    "ROW_KEY": ("", "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING),"
                    " CAST(l_suppkey AS STRING), CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING))"),
    "TGL_TARIK_REPORT": ("", "CASE WHEN l_linenumber = 7 AND l_suppkey % 5 = 0 THEN NULL ELSE l_shipdate END"),
    "TGL_ENTRY": ("o", _late("l_orderkey % 20", 53, "l_orderkey")),
    "TGL_RECEIVED": ("", "CASE WHEN l_linestatus = 'O' AND l_linenumber % 3 = 0 THEN NULL"
                         " ELSE l_shipdate + INTERVAL '1' HOUR * (l_partkey % 24) END"),
    "ID_ACCOUNT": ("o", "concat(CASE WHEN o_custkey % 2 = 0 THEN chr(39) ELSE '' END, CAST(o_custkey AS STRING))"),
    "NATION_ACCOUNT": ("oc", "concat(CASE WHEN c_nationkey % 2 = 0 THEN chr(39) ELSE '' END,"
                             " CAST(80000000 + c_nationkey AS STRING))"),
    "BIG_GROUPING_CUST": ("oc", "c_mktsegment"),
    "GROUPING_SHIPPER": ("oc", "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('GRP ', c_mktsegment) END"),
    "CATEGORY": ("o", pick("o_custkey", ["RETAIL", "BANK", "ECOM"])),
    "SHIPPER_NAME": ("oc", "c_name"),
    "CONSIGNEE_NAME": ("", pick("l_suppkey", ["Budi", "Siti Aminah", "", None, "Agus"])),
    "RECEIVED/REASON": ("p", "CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE p_name END"),
    "STATUS_POD": ("o", "CASE WHEN l_partkey % 41 = 0 THEN NULL WHEN l_suppkey % 17 = 0 THEN 'Un Receiving'"
                        " WHEN l_suppkey % 19 = 0 THEN 'RU Shipper/Origin'"
                        " WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'Return Shipper'"
                        " WHEN o_orderstatus = 'F' THEN 'Success' WHEN o_orderstatus = 'O' THEN 'Undel'"
                        " ELSE 'On Process' END"),
    "STATUS_POD_UPDATE": ("", "CASE WHEN l_partkey % 13 = 0 THEN 'Success' WHEN l_partkey % 13 = 1 THEN ''"
                              " WHEN l_partkey % 13 < 4 THEN 'Undel' ELSE NULL END"),
    "CODING": ("", pick(_N, CODES)),
    "CODING_UNDEL": ("", pick(_N, ["U01", " U02", "", "NONE", None, "U07", "D05"])),
    "RESULT_1ST_ATTEMPT": ("", pick("l_suppkey + l_linenumber", [None, "U12", "U01", None, None, "D05", None, "U03"])),
    "RESULT_2ND_ATTEMPT": ("", pick("l_suppkey * 3 + l_linenumber", [None, "U02", None, "U07", "D01"])),
    "RESULT_LAST_ATTEMPT": ("", pick("l_suppkey * 5 + l_linenumber", [None, None, "U03", "U05", "D02", None])),
    "AWB_CANCEL": ("", pick("l_orderkey + l_linenumber", ["Y", "N", None, None, "N", None, "N", "N", None, "N", "N"])),
    "CONNOTE_RETURN_RT": ("", "CASE WHEN (l_orderkey + l_partkey) % 8 = 0 THEN concat('RT', CAST(l_suppkey AS STRING))"
                              " WHEN (l_orderkey + l_partkey) % 8 = 1 THEN concat('XX', CAST(l_suppkey AS STRING))"
                              " ELSE NULL END"),
    "DATE_CONNOTE_RETURN_RT": ("o", _late("60", 4, "l_orderkey + l_linenumber")),
    "CONNOTE_RETURN_RF": ("", pick("l_partkey * 3 + l_linenumber", ["RF1", None, None, None, None, None, None, None, None])),
    "INBOUND_MANIFEST": ("", pick("l_partkey + l_linenumber", ["IM1", None, None])),
    "MANIFEST_TRANSIT_AGEN": ("", pick("l_partkey * 5 + l_linenumber", ["MT1", None, None, None, None])),
    "HVI_NO": ("", pick("l_partkey * 3 + l_suppkey", ["CGK/HVI", None, None, None])),
    "HVO_NO": ("", pick("l_partkey * 5 + l_suppkey", ["CGK/HVO", None, "BDO/HVO", None, None, "SUB/HVO", None])),
    "RUNSHEET_NO": ("", pick("l_partkey * 2 + l_suppkey", ["CGK/R1", "BDO/R1", None, "SUB/R1", None, "KOE/R1", None, "AMI/R1"])),
    "DATE_RUNSHEET": ("", f"CASE WHEN l_partkey % 3 = 0 THEN CAST('{AS_OF.isoformat()} 09:30:00' AS TIMESTAMP)"
                          " ELSE CAST(l_shipdate AS TIMESTAMP) END"),
    "OUTBOUND_MANIFEST": ("", pick("l_suppkey * 3 + l_linenumber", ["OM1", None, None, None])),
    "RECEIVING": ("", pick("l_suppkey * 5 + l_partkey", ["RC1", None, "RC2"])),
    "CONFIRM_SHIPMENT_UNDEL": ("", pick(_N, ["A WH1", None, None, None, "B", None, None, None, None, None, None, None, None])),
    "IREG_CODE": ("", pick(_N, ["X1", None, "Y1", None, None])),
    "NO_CNOTE_FW": ("", pick("l_partkey * 11 + l_linenumber", ["FW9", None, None, "AB9", None, None, None])),
    "DEST_FW": ("", pick("l_suppkey", ["CGK10", "SUB20", None, "AMI30"])),
    "CODING_STATUS_FW": ("", pick("l_suppkey * 3 + l_linenumber", ["DB1", "U01", None, "D01"])),
    "DESC_STATUS_FW": ("", pick("l_partkey + l_suppkey", [
        "Success", "Return Shipper", "RU Shipper/Origin", "Cancel", "Undel", "Destroyed", "Damage Case", "Missing",
        "Rejection Return", "On Process", "Other", None])),
    "ORIGIN": ("", f"concat({pick('l_suppkey', SITES)}, CAST(l_suppkey AS STRING))"),
    "DEST": ("", f"concat({pick('l_partkey', SITES)}, CAST(l_partkey AS STRING))"),
    "3 LC DEST": ("", pick("l_partkey", SITES)),
    "REGIONAL": ("", pick("l_partkey", REGIONS)),
    "PROVINSI": ("", pick("l_partkey", PROVINCES)),
    "ZONA": ("", pick("l_suppkey + l_linenumber", ["A", "B", "C", "D", None])),
    "SERVICE": ("o", "CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'CTCYES23'"
                     " WHEN o_orderpriority = '2-HIGH' THEN 'YES23' WHEN o_orderpriority = '3-MEDIUM' THEN 'REG23'"
                     " WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'JTR<130' ELSE 'OKE23' END"),
    "WEIGHT": ("", "CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE l_quantity / 10.0 END"),
    "QTY": ("", "CAST(l_quantity AS BIGINT)"),
    "AMOUNT": ("", "CAST(round(l_extendedprice) AS BIGINT)"),
    "ETD": ("", "CASE WHEN l_suppkey % 23 = 0 THEN NULL ELSE l_linenumber % 5 - 1 END"),
    "SLA": ("", "CASE WHEN l_suppkey % 23 = 1 THEN NULL ELSE l_linenumber - 6 END"),
    "AGING": ("", "l_linenumber"),
    "CARRER": ("", pick("l_partkey + l_linenumber", ["Over SLA", "Ontime SLA", "Over SLA (became)", "Over SLA", None])),
    "CARRER_POD": ("", pick("l_partkey", ["Over SLA", "Ontime SLA", None])),
    "1ST_ATTEMPT_DATE": ("o", _late("l_suppkey % 90", 6, "l_partkey")),
    "DATE_1ST_ATTEMPT": ("o", _late("l_suppkey % 90", 4, "l_partkey")),
    "DATE_LAST_ATTEMPT": ("o", _late("l_suppkey", 2, "l_partkey + l_linenumber")),
    "RECEIVING_DATE": ("o", _late("1", 7, "l_partkey + l_suppkey")),
    "OUTBOUND_MANIFEST_DATE": ("o", _late("(l_partkey + l_linenumber) % 14 + 10", 5, "l_partkey")),
    "1ST_HVO_DATE": ("o", _late("(l_partkey * 3) % 20 + 5", 4, "l_suppkey")),
    "HBG_DATE": ("o", _late("(l_suppkey * 3) % 30", 6, "l_orderkey")),
    "INBOUND_MANIFEST_DATE": ("o", _late(f"({_N}) % 61 + 8", 4, "l_partkey + l_linenumber")),
    "HVI_DATE": ("o", _late("(l_suppkey * 5 + l_orderkey) % 50 + 6", 3, "l_suppkey")),
    "1ST_RUNSHEET_DATE": ("o", _late("(l_partkey * 11 + l_orderkey) % 83 + 12", 9, "l_orderkey + l_linenumber")),
    "MANIFEST_TRANSIT_SUBAGEN_DATE": ("o", _late("(l_suppkey * 7 + l_orderkey) % 67 + 15", 5, "l_orderkey + l_suppkey")),
    "MANIFEST_INBOUND_SUBAGEN_DATE": ("o", _late("(l_suppkey * 11 + l_partkey) % 97 + 20", 6, "l_orderkey + l_partkey")),
    "HOLD_REASON": ("", pick(_N, ["Bea Masuk", None, "Lain", None, "Cukai", None, None, None, None, None, None])),
    "GOODS_DESCR": ("p", "concat(p_name, CASE WHEN l_partkey % 6 = 0 THEN ' kado ultah' WHEN l_partkey % 6 = 1 THEN"
                         " concat(' GEN.', CAST(l_suppkey AS STRING), '/03/26-', CAST(l_linenumber AS STRING)) ELSE '' END)"),
    "INTRUCTION": ("", "CASE WHEN l_partkey % 4 = 0 THEN concat('kirim SPK/A-', CAST(l_partkey AS STRING), '/12/IV/1998 segera')"
                       " WHEN l_partkey % 4 = 1 THEN 'tanpa nomor' ELSE NULL END"),
    "NOTICE": ("", "CASE WHEN l_suppkey % 3 = 0 THEN concat('ref gen.', CAST(l_partkey AS STRING), '/01/02-3') ELSE NULL END"),
    "NOREF": ("", "CASE WHEN l_linenumber % 3 = 0 THEN '' WHEN l_linenumber % 3 = 1 THEN NULL"
                  " ELSE concat(' no ', CAST(l_orderkey AS STRING)) END"),
    "REFNO_UOB": ("", "CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE concat(chr(39), CAST(l_orderkey AS STRING), '*') END"),
    "REASON RETURN": ("", pick("l_suppkey", ["rumah kosong", "alamat salah", None])),
    "ADDR1": ("", "concat('Jl. ', CAST(l_partkey AS STRING))"),
    "ADDR2": ("", pick("l_suppkey", [" ", "RT 01", None])),
    "ADDR3": ("", pick("l_linenumber", ["", "Blok B", None, "Lt 2"])),
    "CONTACT": ("", "concat('C', CAST(l_orderkey AS STRING))"),
    "NOTELP": ("", "concat('08', CAST(l_partkey AS STRING))"),
    "STATUS_LATITUDE": ("", pick("l_partkey", ["-6.2", " ", None, "nan", "-7.1"])),
    "STATUS_LONGITUDE": ("", pick("l_suppkey", ["106.8", "", "110.4", None])),
    "URL_FOTO": ("", pick("l_partkey", ["http://a.example/1", "https://b.example/2", "c.example/3", None])),
    "COD_FLAG": ("", pick("l_partkey", ["Y", "N", None, "P"])),
    "BILNOTE_FLAG": ("", pick("l_partkey", ["Y", "N"])),
    "BILNOTE_AMOUNT": ("", "l_partkey % 1000"),
}

JOINS = {
    "o": "JOIN orders ON l_orderkey = o_orderkey",
    "c": "JOIN customer ON o_custkey = c_custkey",
    "p": "JOIN part ON l_partkey = p_partkey",
}


def _tables(columns: list[str]) -> str:
    used = set("".join(COLUMNS[c][0] for c in columns))
    return "".join(t for t in "ocp" if t in used)


def view_sql(*columns: str) -> str:
    """SELECT giving the master with these columns."""
    shown = ", ".join(f'{COLUMNS[c][1]} AS "{c}"' for c in columns)
    joins = " ".join(JOINS[t] for t in _tables(list(columns)))
    return f"SELECT {shown} FROM lineitem {joins}"


def joined(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The tables these columns are made of. Customers join the orders first: the wide lines are dealt out once for both."""
    used, df = _tables(list(columns)), table(spark, sf_dir, "lineitem")
    if "o" in used:
        orders = table(spark, sf_dir, "orders")
        if "c" in used:
            orders = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if "p" in used:
        df = df.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return df


def made(*columns: str) -> dict[str, Column]:
    """These columns as expressions over the joined tables."""
    return {c: F.expr(COLUMNS[c][1]) for c in columns}


def sources(*columns: str) -> list[str]:
    """The table columns that these columns are made of."""
    return sorted(set(re.findall(r"\b[locp]_[a-z]+\b", " ".join(COLUMNS[c][1] for c in columns))))


def shipments(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The master with these columns."""
    return joined(spark, sf_dir, *columns).select(*[e.alias(c) for c, e in made(*columns).items()])


def reference(source: str, columns: dict[str, str]) -> tuple:
    """A reference table as columns over one given table: (reader, SELECT)."""
    text = f"SELECT {', '.join(f'{e} AS \"{n}\"' for n, e in columns.items())} FROM {source}"

    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, source).select(*[F.expr(e).alias(n) for n, e in columns.items()])

    return read, text


zones, ZONES = reference("part", {
    "DEST": f"concat({pick('p_partkey', SITES)}, CAST(p_partkey AS STRING))",
    "3 LC": pick("p_partkey", SITES),
    "KECAMATAN": "p_name",
    "NAMA KAB/KOTA": "p_brand",
    "NAMA KAB/KOTA 2": "upper(p_brand)",
    "REGION": pick("p_partkey", REGIONS),
    "PROVINSI": pick("p_partkey", PROVINCES),
    "KODE POS": "CASE WHEN p_size % 3 = 0 THEN concat(CAST(10000 + p_partkey AS STRING), '.0')"
                " WHEN p_size % 3 = 1 THEN '0' WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 7 < 5 THEN ''"
                " ELSE CAST(20000 + p_partkey AS STRING) END",
    "ZONA": pick("p_partkey", ["A", "B", "C", "D"]),
})

# Undelivered and status codes: one row per supplier-made code.
undel_codes, UNDEL_CODES = reference("supplier", {
    "Coding Undel": "CASE WHEN s_suppkey % 10 = 9 THEN ' ' ELSE concat('U0', CAST(s_suppkey % 10 AS STRING)) END",
    "Remark_Bahasa": "concat('alasan ', CAST(s_suppkey % 10 AS STRING))",
    "Remark_English": "concat('reason ', CAST(s_suppkey % 10 AS STRING))",
})
status_codes, STATUS_CODES = reference("supplier", {
    "row_idx": "s_suppkey",
    "CODE": f"concat({pick('s_suppkey', ['D0', 'U0', 'CL', 'R2'])}, CAST(s_suppkey % 10 AS STRING))",
    "STATUS": "concat('uraian ', s_name)",
})
projects, PROJECTS = reference("customer", {
    "row_idx": "c_custkey",
    "CUST_ID": "concat(CASE WHEN c_custkey % 3 = 0 THEN chr(39) ELSE ' ' END, CAST(c_custkey AS STRING),"
               " CASE WHEN c_custkey % 5 = 0 THEN '.0' ELSE '' END)",
    "CUST_NAME": "CASE WHEN c_custkey % 11 = 0 THEN ' ' ELSE concat(' ', c_name, chr(160)) END",
    "BIG_GROUPING_CUST": "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE concat(c_mktsegment, ' ', CAST(c_nationkey AS STRING)) END",
    "CATEGORY": pick("c_nationkey", ["RETAIL", "BANK", "ECOM", ""]),
})

status_map, STATUS_MAP = reference("nation", {
    "row_idx": "n_nationkey",
    "Status": pick("n_nationkey", ["Success", "Undel", "On Process", "Return Shipper", "Hold WH Destination", "RU Origin"]),
    "Grouping BIG Status": pick("n_nationkey", ["Delivered", "Problem", "Process", "Return", "Problem", "Return"]),
    "AJ Car Status": pick("n_nationkey", ["Done", "Open", "Open", "Back", None, "Back"]),
    "KETERANGAN AJ CAR": "concat('ket ', CAST(n_nationkey AS STRING))",
})
area_table, AREA = reference("nation", {
    "row_idx": "n_nationkey",
    "REGION": pick("n_nationkey", REGIONS[:5]),
    "AREA MANDIRI": "concat('AREA ', CAST(n_nationkey AS STRING))",
    "SLA": "CASE WHEN n_nationkey = 3 THEN NULL ELSE n_nationkey + 2 END",
})


def holiday_values() -> str:
    return ", ".join(f"(DATE '{h.isoformat()}')" for h in HOLIDAYS)
