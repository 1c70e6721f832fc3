"""Columns of the shipment master the library reads, with their types."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from shipreport.functions.moments import serial_day
from shipreport.functions.text import col

# Master column names by type; every other column is text.
TIMESTAMPS = [
    "TGL_ENTRY", "RECEIVING_DATE", "OUTBOUND_MANIFEST_DATE", "INBOUND_MANIFEST_DATE", "DATE_RUNSHEET",
    "TGL_RECEIVED", "DATE_1ST_ATTEMPT", "DATE_2ND_ATTEMPT", "DATE_LAST_ATTEMPT", "DATE_CONNOTE_RETURN_RT",
    "TGL_TARIK_REPORT", "HBG_DATE", "1ST_HVO_DATE", "HVI_DATE", "MANIFEST_TRANSIT_SUBAGEN_DATE",
    "MANIFEST_INBOUND_SUBAGEN_DATE", "1ST_RUNSHEET_DATE", "PICKUP_DATE", "1ST_ATTEMPT_DATE",
]
LONGS = ["QTY", "GOODS_VALUE", "AMOUNT", "AGING", "ETD", "SLA", "BILNOTE_AMOUNT", "AGING_1ST", "AGING_POD"]
DOUBLES = ["WEIGHT"]
# The same columns in the order the master lists them.
MASTER_COLUMNS = [
    "AWB", "ID_ACCOUNT", "SHIPPER_NAME", "TGL_ENTRY", "CONSIGNEE_NAME", "ADDR1", "ADDR2", "ADDR3", "CONTACT", "NOTELP",
    "NOREF", "ORIGIN", "DEST", "SERVICE", "QTY", "WEIGHT", "GOODS_DESCR", "INSURANCE_ID", "GOODS_VALUE", "AMOUNT",
    "INTRUCTION", "NOTICE", "HOLD_REASON", "RECEIVING", "RECEIVING_DATE", "OUTBOUND_MANIFEST", "OUTBOUND_MANIFEST_DATE",
    "INBOUND_MANIFEST", "INBOUND_MANIFEST_DATE", "MANIFEST_TRANSIT_AGEN", "HVO_NO", "HVI_NO", "HVI_DATE", "RUNSHEET_NO",
    "DATE_RUNSHEET", "CODING", "STATUS_POD", "TGL_RECEIVED", "STATUS_LATITUDE", "STATUS_LONGITUDE", "AGING", "ETD", "SLA",
    "CARRER", "RECEIVED/REASON", "AWB_CANCEL", "COD_FLAG", "BILNOTE_FLAG", "BILNOTE_AMOUNT", "REFNO_UOB",
    "DATE_1ST_ATTEMPT", "RESULT_1ST_ATTEMPT", "DATE_2ND_ATTEMPT", "RESULT_2ND_ATTEMPT", "DATE_LAST_ATTEMPT",
    "RESULT_LAST_ATTEMPT", "CONNOTE_RETURN_RT", "DATE_CONNOTE_RETURN_RT", "CONNOTE_RETURN_RF", "CONFIRM_SHIPMENT_UNDEL",
    "IREG_CODE", "URL_TTD", "URL_FOTO", "NO_CNOTE_FW", "DEST_FW", "CODING_STATUS_FW", "DESC_STATUS_FW", "HBG_DATE",
    "1ST_HVO_DATE", "MANIFEST_TRANSIT_SUBAGEN_DATE", "MANIFEST_INBOUND_SUBAGEN_DATE", "PICKUP_DATE", "PICKUP_STATUS",
    "1ST_RUNSHEET_DATE", "URL_CHAT", "TGL_TARIK_REPORT", "STATUS_POD_UPDATE", "1ST_ATTEMPT_DATE", "AGING_1ST",
    "CAREER_1ST", "AGING_POD", "CARRER_POD", "CODING_UNDEL", "REASON RETURN", "3 LC DEST", "NAMA KAB/KOTA 2", "REGIONAL",
    "ZONA", "GROUPING_SHIPPER", "CATEGORY", "BIG_GROUPING_CUST", "PROVINSI",
]

URL_COLUMNS = ["URL_TTD", "URL_FOTO", "URL_CHAT"]
NUMERIC_OUTPUT = ["QTY", "WEIGHT", "AMOUNT", "BILNOTE_AMOUNT"]

_TYPES = {
    **{c: T.TimestampType() for c in TIMESTAMPS},
    **{c: T.LongType() for c in LONGS},
    **{c: T.DoubleType() for c in DOUBLES},
}


def kind(name: str) -> T.DataType:
    return _TYPES.get(name, T.StringType())


def master_schema(columns: list[str] | None = None) -> T.StructType:
    return T.StructType([T.StructField(c, kind(c)) for c in columns or MASTER_COLUMNS])


def typed(df: DataFrame, kinds: dict[str, str] | None = None) -> DataFrame:
    """Cast every column to its master type; unreadable cells become null.

    Numbers in a timestamp column are spreadsheet serials.
    """
    out = []
    for field in df.schema:
        name, target = field.name, (kinds or {}).get(field.name) or kind(field.name).simpleString()
        value = col(name)
        if target == "timestamp":
            if not isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
                text = value.cast("string")
                value = F.coalesce(F.when(text.rlike(r"^\d+(\.\d+)?$"), serial_day(text)), text.try_cast("timestamp"))
            else:
                value = value.cast("timestamp")
        elif target in ("bigint", "long") and isinstance(field.dataType, T.StringType):
            value = value.try_cast("double").try_cast("bigint")
        else:
            value = value.try_cast(target)
        out.append(value.alias(name))
    return df.select(*out)
