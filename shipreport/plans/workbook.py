"""The fixed monthly workbook: typed master, three lookups, derived columns, final layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shipreport.functions.derive import calendar_week, service_family
from shipreport.functions.text import col
from shipreport.operators.lookups import attach, one_row_per_key
from shipreport.session import fresh_path, in_slices, stored

# Date bands of the workbook, upper bound and label.
BANDS = [
    ("2020-05-31", "MEI"), ("2020-06-30", "JUNI"), ("2020-07-31", "JULI"),
    ("2020-08-14", "01-14 AGUSTUS"), ("2020-08-31", "15-31 AGUSTUS"),
]
RETURN_LIKE = ["Return Shipper", "RU Origin", "Undel", "Hold WH Destination"]

# Column order of the finished sheet.
LAYOUT = [
    "AWB", "ID_ACCOUNT", "TGL_ENTRY", "CONSIGNEE_NAME", "NOREF", "ORIGIN", "DEST", "SERVICE", "QTY", "WEIGHT",
    "AMOUNT", "CODING", "TGL_RECEIVED", "ETD", "COD_FLAG", "BILNOTE_FLAG", "BILNOTE_AMOUNT", "GROUPING_SHIPPER",
    "PERIODE", "PERIODE WEEK", "DEST2", "DEST 3", "REGIONAL", "ZONA", "PAYMENT METHODE", "STATUS_POD_2",
    "1ST ATTEMPT", "AGING 1st ATTEMPT", "CAREER 1st ATTEMPT", "AGING POD", "CARRER POD", "CODING RETURN",
    "REASON RETURN", "KET", "SHIPPER_NAME",
]


def with_references(df: DataFrame, shippers: DataFrame, zones: DataFrame) -> DataFrame:
    """The lines with shipper group and destination, stored slice by slice.

    Two lookups deal out the wide lines; in one plan the shuffle files of both, and of all that the
    lines come from, would lie on disk until the sheet is written.
    """
    group = {"GROUPING_SHIPPER": "CUST_NAME_GROUPING"}
    place = {"DEST2": "3 LC", "DEST 3": "NAMA KAB/KOTA 2", "REGION": "REGION", "ZONA": "ZONA"}
    shippers = stored(one_row_per_key(shippers, col("CUST_ID_2"), group, None), "shippers")
    zones = stored(one_row_per_key(zones, col("DEST"), place, None), "zones")

    def looked_up(rows: DataFrame) -> DataFrame:
        rows = attach(rows, shippers, col("ID_ACCOUNT"), col("_k"), {c: c for c in group}, unique=True)
        return attach(rows, zones, col("DEST"), col("_k"), {c: c for c in place}, unique=True)

    path = fresh_path(df.sparkSession, "workbook")
    in_slices(df, col("AWB") if "AWB" in df.columns else None, lambda rows, first, last: looked_up(rows).write.mode("append").parquet(path))
    return df.sparkSession.read.schema(looked_up(df).schema).parquet(path)


def workbook(
    df: DataFrame, shippers: DataFrame, zones: DataFrame, codes: DataFrame, *, extras: bool = False, late: dict[str, Column] | None = None,
) -> DataFrame:
    """Expects typed columns and the status under Status_Update.

    ``extras`` keeps the intermediate period texts and the three-way status group. ``late`` gives columns
    that no lookup needs as expressions over ``df``; they are made after the lines were dealt out.
    """
    status, entry = col("Status_Update"), col("TGL_ENTRY")
    reason = F.when(status.isin(RETURN_LIKE), F.coalesce(
        col("RESULT_LAST_ATTEMPT"), col("RESULT_2ND_ATTEMPT"), col("RESULT_1ST_ATTEMPT")))
    attempt = F.when(col("STATUS_POD") == "Success", F.coalesce(col("DATE_1ST_ATTEMPT"), col("TGL_RECEIVED")))
    derived = {"CODING RETURN": reason, "1ST ATTEMPT": attempt}
    if late:
        df = with_references(df, shippers, zones).withColumns(late).withColumns(derived)
    else:
        # what several columns of the lines give is derived first, so the lookups move fewer columns
        shown = {c.upper() for c in (*LAYOUT, "Status_Update")}
        df = df.withColumns(derived)
        df = with_references(df.select(*[col(c) for c in df.columns if c.upper() in shown]), shippers, zones)
    # one row a code, stored: the lines are not dealt out for a table whose size is not known
    codes = stored(one_row_per_key(codes, col("Coding Undel"), {"Remark_English": "Remark_English"}, None), "codes")
    df = attach(df, codes, col("CODING RETURN"), col("_k"), {"REASON RETURN": "Remark_English"}, unique=True)
    band = F.coalesce(*[F.when(entry <= F.lit(end).cast("timestamp"), label) for end, label in BANDS],
                      F.lit("CEK MANUAL"))
    nothing = F.lit(None).cast("string")
    df = df.withColumns({
        "PERIODE": F.month(entry).cast("string"),
        "PERIODE LABEL": F.date_format(entry, "M.MMMM yyyy"),
        "PERIODE WEEK": F.concat(F.lit("WEEK "), calendar_week(entry).cast("string")),
        "PERIODE BY REQUEST": band,
        "STATUS_POD_2": status,
        "STATUS_POD3": F.when(status == "Success", "Success")
        .when(status.isin("Return Shipper", "RU Origin", "AWB Cancel"), "Return").otherwise("On Follow Up"),
        "REGIONAL": F.when(col("DEST2").isin("KOE", "AMI"), "Regional Jatim KOE AMI").otherwise(col("REGION")),
        "PAYMENT METHODE": F.when(col("COD_FLAG") == "Y", "COD")
        .when((col("COD_FLAG") == "N") | col("COD_FLAG").isNull(), "NON COD").otherwise(col("COD_FLAG")),
        "KET": service_family(col("SERVICE")),
        **{c: nothing for c in ("AGING 1st ATTEMPT", "CAREER 1st ATTEMPT", "AGING POD", "CARRER POD")},
    })
    layout = [c for c in LAYOUT if c in df.columns]
    if extras:
        layout += ["PERIODE LABEL", "PERIODE BY REQUEST", "STATUS_POD3"]
    return df.select(*map(col, layout))
