"""Which leg of the journey made a late shipment late."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shipreport.functions.moments import hours_up, whole_days
from shipreport.functions.text import col

# Labels that name a leg.
FIRST_LATE, MIDDLE_LATE, LAST_LATE = "FM - LATE", "MM - LATE", "LM - LATE"
HANDED_OVER = "Ontime Cabang Utama FW Sub Agen"
TAKEN_IN = "Ontime Inbound Sub Agen"
LATE_CARRIER = ["Over SLA", "Over SLA (became)"]

DELAY_INPUTS = [
    "3_LC_ORIGIN", "3 LC DEST", "OUTBOUND_MANIFEST_DATE", "1ST_HVO_DATE", "HBG_DATE", "TGL_ENTRY",
    "INBOUND_MANIFEST_DATE", "HVI_DATE", "1ST_RUNSHEET_DATE", "ETD", "ZONA", "MANIFEST_TRANSIT_SUBAGEN_DATE",
    "MANIFEST_INBOUND_SUBAGEN_DATE", "RECEIVING_DATE", "TGL_RECEIVED", "DATE_LAST_ATTEMPT", "STATUS_POD",
    "NO_CNOTE_FW", "HOLD_REASON", "CARRER", "CARRER_POD",
]


def _names(c: Column, *needles: str) -> Column:
    """True where the text holds any of the needles, false for null."""
    found = F.lit(False)
    for needle in needles:
        found = found | F.coalesce(c.contains(needle), F.lit(False))
    return found


def _yes(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def attribute_delay(df: DataFrame, *, fixed_rules: bool = False, keep_steps: bool = False) -> DataFrame:
    """Add GROUPING_LATE: the late legs of a shipment that missed its promise, else blank.

    Expects the three-letter origin code in 3_LC_ORIGIN. ``fixed_rules`` replaces
    two thresholds the established report applies literally (the morning rule of
    zones C and D never fires; the hand-in rule tests hour = 17, not hour < 17).
    """
    missing = [c for c in DELAY_INPUTS if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns for delay attribution: {missing}")
    keep = df.columns

    same_city = _yes(col("3_LC_ORIGIN") == col("3 LC DEST"))
    df = df.withColumns({
        "_left": F.coalesce(
            col("OUTBOUND_MANIFEST_DATE"), F.when(same_city, col("1ST_HVO_DATE")), col("HBG_DATE")),
        "_hub_in": F.coalesce(col("INBOUND_MANIFEST_DATE"), F.when(same_city, col("HVI_DATE"))),
    })
    df = df.withColumn("_in", F.coalesce(col("_hub_in"), col("1ST_RUNSHEET_DATE")))

    out, handed, taken = col("1ST_RUNSHEET_DATE"), col("MANIFEST_TRANSIT_SUBAGEN_DATE"), col("MANIFEST_INBOUND_SUBAGEN_DATE")
    df = df.withColumns({
        "_first_hours": hours_up(col("TGL_ENTRY"), col("_left")),
        "_middle_days": whole_days(col("_left"), col("_in")),
        "_hour_in": F.hour(col("_hub_in")),
        "_out_days": whole_days(col("_in"), out),
        "_handed_days": whole_days(col("_in"), handed),
        "_taken_days": whole_days(handed, taken),
        "_taken_hour": F.hour(taken),
        "_courier_days": whole_days(taken, out),
    })

    near, far = _yes(col("ZONA").isin("A", "B")), _yes(col("ZONA").isin("C", "D"))
    days = col("_out_days")
    near_early = _yes(col("_hour_in") < 17)
    near_step = (
        F.when(near_early & _yes(days == 0), "LM - Ontime Zona AB")
        .when(near_early, "LM - Late Zona AB")
        .when(_yes(days < 0), "LM - IM Backdate")
        .when(_yes(days.isin(0, 1)), "LM - Ontime Zona AB")
        .otherwise("LM - Late Zona AB")
    )
    handed_days, morning = col("_handed_days"), _yes(col("_hour_in") < 12)
    in_time = ~morning & _yes(handed_days.isin(0, 1))
    if fixed_rules:
        in_time = in_time | (morning & _yes(handed_days == 0))
    far_step = (
        F.when(_yes(handed_days < 0), "LM - IM Backdate")
        .when(in_time, HANDED_OVER)
        .otherwise("LM - Late FW to Sub Agen")
    )
    known = col("_hour_in").isNotNull()
    df = df.withColumn("_forward", F.when(known & near, near_step).when(known & far, far_step))

    taken_days = col("_taken_days")
    taken_step = (
        F.when(taken_days < 0, "LM - MTI Backdate")
        .when(taken_days >= 2, "LM - Late Inbound Sub Agen")
        .when(taken_days.isNotNull(), TAKEN_IN)
    )
    df = df.withColumn(
        "_forward",
        F.when(col("_forward") == HANDED_OVER, F.coalesce(taken_step, F.lit(HANDED_OVER))).otherwise(col("_forward")),
    )

    courier_days = col("_courier_days")
    same_day_only = col("_taken_hour") < 17 if fixed_rules else col("_taken_hour") == 17
    allowed = F.when(same_day_only, courier_days == 0).otherwise(courier_days.isin(0, 1))
    courier_step = F.when(
        col("_taken_hour").isNotNull(),
        F.when(_yes(courier_days < 0), "LM - MTI Backdate")
        .when(_yes(allowed), "LM - Ontime Runsheet Zona C D")
        .otherwise("LM - Late Runsheet Zona C D"),
    )
    df = df.withColumn("_courier", courier_step)
    df = df.withColumns({
        "_last": F.when((col("_forward") == HANDED_OVER) & col("_courier").isNull(), "LM - UnMTI")
        .when(col("_forward").isNull() | (col("_forward") == TAKEN_IN), col("_courier"))
        .otherwise(col("_forward")),
        "_first": F.when(col("_first_hours") > 5, "FM - Late").when(col("_first_hours").isNotNull(), "FM - Ontime"),
        "_middle": F.when(col("_middle_days") > col("ETD"), "MM - Late ETD Max")
        .when(col("_middle_days") > 1, "MM - Late > 1 Hari")
        .when(col("_middle_days").isNotNull(), "MM - Ontime"),
    })

    carrier_note = col("CARRER_POD").cast("string")
    first_late = (
        _yes(col("_first") == "FM - Late")
        | col("RECEIVING_DATE").isNull()
        | col("_left").isNull()
        | _names(col("STATUS_POD"), "Cancel")
        | _names(carrier_note, "FM")
    )
    middle_late = (
        _names(col("_middle"), "Late")
        | col("_in").isNull()
        | _names(col("HOLD_REASON"), "Cukai", "Bea")
        | _names(carrier_note, "MM")
    )
    last_late = (
        _names(col("_last"), "Late")
        | handed.isNull()
        | taken.isNull()
        | out.isNull()
        | _yes(whole_days(out, col("TGL_RECEIVED")) > 1)
        | col("DATE_LAST_ATTEMPT").isNotNull()
        | _names(col("NO_CNOTE_FW"), "FW")
        | _names(carrier_note, "LM")
    )
    legs = F.concat_ws(
        ", ", F.when(first_late, FIRST_LATE), F.when(middle_late, MIDDLE_LATE), F.when(last_late, LAST_LATE)
    )
    df = df.withColumn("_legs", legs)
    carrier = col("CARRER")
    grouping = (
        F.when(_yes(carrier.isin(LATE_CARRIER)), F.when((carrier == "Over SLA") & (col("_legs") == ""), LAST_LATE)
               .otherwise(col("_legs")))
        .otherwise("")
    )
    steps = {"REMARK_FM": "_first", "REMARK_MM": "_middle", "REMARK_LM": "_last"} if keep_steps else {}
    return df.select(
        *[col(c) for c in keep if c != "GROUPING_LATE"],
        *[col(source).alias(name) for name, source in steps.items()],
        grouping.alias("GROUPING_LATE"),
    )
