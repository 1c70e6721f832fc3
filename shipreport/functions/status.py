"""Delivery status rules."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from shipreport.functions.text import col

# Status labels by code.
CODED_STATUS = {
    "D25": "Auto Closed Breach (D25,D26)",
    "D26": "Auto Closed Breach (D25,D26)",
    "D99": "Auto Closed Breach (D25,D26)",
    "D24": "Claim Damage",
    "C01": "Claim Missing",
    "C02": "Claim Damage",
    "R26": "Return Shipper",
    "CL1": "Auto Closed Origin (CL1)",
    "CL2": "Auto Closed Destination (CL2,CL4)",
    "CL3": "Auto Closed Destination (CL2,CL4)",
    "CL4": "Auto Closed Destination (CL2,CL4)",
    "R24": "Rejection Return",
    "R25": "Rejection Return",
    "CR4": "Destroyed",
}

# Labels that end the search at once.
SETTLED = [
    "Success", "Return Shipper", "RU Origin", "Auto Closed Breach (D25,D26)", "Claim Damage", "Claim Missing",
    "Auto Closed Origin (CL1)", "Auto Closed Destination (CL2,CL4)", "Rejection Return", "Destroyed",
]

# Status of the forwarding waybill and the label it gives the forwarded one.
FORWARDED_STATUS = {
    "Success": "Success",
    "Return Shipper": "Return Shipper",
    "RU Shipper/Origin": "RU Origin",
    "Cancel": "Undel",
    "Undel": "Undel",
    "Destroyed": "Destroyed",
    "Damage Case": "Damage",
    "Missing": "Missing",
    "Rejection Return": "Rejection Return",
}

RETURNABLE = [
    "On Process", "Undel", "Hold WH Destination", "Auto Closed Destination (CL2,CL4)", "Auto Closed Breach (D25,D26)",
]

FINAL_LABEL = {
    "Auto Closed Breach (D25,D26)": "Claim Breach (Over SLA)",
    "Auto Closed Destination (CL2,CL4)": "Claim Breach (Over SLA)",
    "Open POD": "On Process",
    "Problem Missroute": "On Process",
    "Auto Closed Origin (CL1)": "Un Receiving",
    "RU Shipper/Origin": "RU Origin",
}

FULL_STATUS_INPUTS = [
    "CODING", "AWB_CANCEL", "TGL_ENTRY", "CONNOTE_RETURN_RT", "CONNOTE_RETURN_RF", "RESULT_1ST_ATTEMPT",
    "STATUS_POD", "INBOUND_MANIFEST", "MANIFEST_TRANSIT_AGEN", "HVI_NO", "RUNSHEET_NO", "OUTBOUND_MANIFEST",
    "RECEIVING", "HVO_NO", "ORIGIN", "DEST", "CONFIRM_SHIPMENT_UNDEL", "DATE_RUNSHEET",
]
FULL_STATUS_OPTIONAL = ["STATUS_POD_UPDATE", "NO_CNOTE_FW", "DEST_FW", "CODING_STATUS_FW", "DESC_STATUS_FW", "IREG_CODE"]


def _mapped(c: Column, table: dict[str, str]) -> Column:
    """A small constant table as a map literal; unknown keys give null."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), c)


def _has(c: Column, needle: str) -> Column:
    return F.coalesce(c.contains(needle), F.lit(False))


def _site(c: Column) -> Column:
    return F.substring(c, 1, 3)


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def resolve_full_status(df: DataFrame, as_of: date) -> DataFrame:
    """Replace STATUS_POD by the fully resolved status.

    Forwarded shipments also take over the destination and code of the
    forwarding waybill. The steps are kept as separate projections, so shared
    intermediate values are computed once and still run in one code stage.
    """
    missing = [c for c in FULL_STATUS_INPUTS if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns for the status rules: {missing}")
    keep = [c for c in df.columns if c != "STATUS_POD_UPDATE"]
    absent = [c for c in FULL_STATUS_OPTIONAL if c not in df.columns]
    df = df.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else df

    update, raw_code = F.trim(col("STATUS_POD_UPDATE")), col("CODING")
    df = df.withColumns({
        "_given": F.when(update != "", col("STATUS_POD_UPDATE")).otherwise(col("STATUS_POD")),
        "_code": F.trim(raw_code),
    })
    given = F.coalesce(col("_given"), F.lit("Unknown"))
    df = df.withColumn(
        "_coded",
        F.coalesce(
            _mapped(col("_code"), CODED_STATUS),
            F.when(given == "RU Shipper/Origin", "RU Origin").otherwise(given),
        ),
    )

    seen_inside = F.coalesce(
        col("_given"), col("INBOUND_MANIFEST"), col("MANIFEST_TRANSIT_AGEN"), col("HVI_NO"), col("RUNSHEET_NO")
    ).isNotNull()
    first_result = col("RESULT_1ST_ATTEMPT")
    df = df.withColumn(
        "_found",
        F.when(col("_coded").isin(SETTLED), col("_coded"))
        .when(F.trim(col("AWB_CANCEL")) == "Y", "AWB Cancel")
        .when(col("TGL_ENTRY").isNull(), "Invalid AWB")
        .when(col("_code") == "CR8", "RU Origin")
        .when(col("_code") == "U14", "Missing")
        .when(col("_code") == "U11", "Damage")
        .when(col("_coded") == "Un Receiving", "Un Receiving")
        .when(col("CONNOTE_RETURN_RT").isNotNull() | col("CONNOTE_RETURN_RF").isNotNull(), "RU Origin")
        .when(_has(raw_code, "U0") | _has(raw_code, "CR3"), "Undel")
        .when(raw_code.isin("CR2", "U21", "U22", "U23", "U10"), "Undel")
        .when(first_result.isNotNull() & ~_has(first_result, "U12"), "Undel")
        .when(seen_inside, "On Process")
        .when(_site(col("DEST")) == _site(col("HVO_NO")), "On Process")
        .when(col("OUTBOUND_MANIFEST").isNotNull() | col("HVO_NO").isNotNull(), "On Forward Destination")
        .when(col("RECEIVING").isNotNull(), "Un Manifest")
        .otherwise("Un Receiving"),
    )

    within_hub = _has(col("ORIGIN"), "CGK") & _has(col("DEST"), "CGK") & (col("_found") == "On Process")
    df = df.withColumn(
        "_placed",
        F.when(_has(col("CONFIRM_SHIPMENT_UNDEL"), "WH1"), "Hold WH Destination")
        .when(~within_hub, col("_found"))
        .when(col("HVI_NO").isNotNull(), "On Process")
        .when(col("HVO_NO").isNotNull(), "On Forward Destination")
        .when(col("RECEIVING").isNotNull(), "Un Manifest")
        .otherwise("Un Receiving"),
    )

    forwarded = col("NO_CNOTE_FW").isNotNull()
    df = df.withColumns({
        "_placed": F.when(forwarded, F.coalesce(_mapped(col("DESC_STATUS_FW"), FORWARDED_STATUS), col("_placed")))
        .otherwise(col("_placed")),
        "DEST": F.when(forwarded, col("DEST_FW")).otherwise(col("DEST")),
        "CODING": F.when(forwarded, col("CODING_STATUS_FW")).otherwise(col("CODING")),
    })
    df = df.withColumn(
        "_placed",
        F.when(
            col("CONNOTE_RETURN_RT").isNotNull()
            & F.when(col("CODING") == "DB1", False).otherwise(col("_placed").isin(RETURNABLE)),
            "RU Origin",
        )
        .when(col("CODING") == "DB1", "Success")
        .otherwise(col("_placed")),
    )

    courier_site = _site(col("RUNSHEET_NO"))
    at_dest = _holds(courier_site == _site(col("DEST")))
    at_origin = _holds(courier_site == _site(col("ORIGIN")))
    out_today = _holds(col("DATE_RUNSHEET").cast("date") == F.lit(as_of))
    df = df.withColumn(
        "_placed",
        F.when(col("_placed") != "On Process", col("_placed"))
        .when(at_dest & out_today, "On Delivery")
        .when(at_dest, "Open POD")
        .when(at_origin, "On Forward Destination")
        .otherwise("Problem Missroute"),
    )
    held_by_scan = col("_placed").isin("Un Receiving", "Un Manifest", "On Forward Destination")
    df = df.withColumn(
        "_placed",
        F.when(held_by_scan & _holds(col("IREG_CODE").startswith("X")), "Problem X-Ray").otherwise(col("_placed")),
    )
    final = F.coalesce(_mapped(col("_placed"), FINAL_LABEL), col("_placed"))
    return df.select(*[final.alias(c) if c == "STATUS_POD" else col(c) for c in keep])


def short_status(df: DataFrame) -> DataFrame:
    """Claims by code, else the updated status (empty text where there is none)."""
    if "STATUS_POD" not in df.columns:
        raise ValueError("missing column for the short status: STATUS_POD")
    current = "STATUS_POD_UPDATE" if "STATUS_POD_UPDATE" in df.columns else "STATUS_POD"
    code = F.trim(col("CODING")) if "CODING" in df.columns else F.lit(None).cast("string")
    status = (
        F.when(code == "C01", "Claim Missing")
        .when(code == "C02", "Claim Damage")
        .otherwise(F.coalesce(col(current), F.lit("")))
    )
    return df.withColumn("STATUS_POD", status).drop("STATUS_POD_UPDATE")


def is_success(c: Column) -> Column:
    return _holds(F.lower(c) == "success")


def close_mark(status: Column) -> Column:
    return F.when(F.lower(F.trim(status)).isin("success", "return shipper"), "x").otherwise("")


def follow_up(status: Column) -> Column:
    return F.when(status.isin("Success", "Return Shipper"), "CLOSE CABANG").otherwise("ON FOLLOW UP CABANG")


def return_note(status: Column) -> Column:
    return F.when(F.trim(status) == "Return Shipper", "RETURN SICEPAT")


def status_group(status: Column) -> Column:
    text = F.trim(status)
    return (
        F.when(text == "Success", "Success")
        .when(text.isin("Return Shipper", "RU Origin"), "Process Return")
        .when(text.isin("Missing", "AWB Cancel", "Hold WH Destination", "Undel"), "Undel")
        .otherwise("On Process")
    )
