"""Small per-row derivations of report columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shipreport.functions.moments import month_name, whole_days
from shipreport.functions.status import is_success
from shipreport.functions.text import col
from shipreport.functions.workdays import WorkCalendar


def address(lines: list[Column]) -> Column:
    """Non-blank address lines joined by one space."""
    texts = F.array(*[F.coalesce(c.cast("string"), F.lit("")) for c in lines])
    return F.array_join(F.filter(texts, lambda t: F.trim(t) != ""), " ")


def coordinates(lat: Column, lon: Column) -> Column:
    def known(c: Column) -> Column:
        text = F.trim(c.cast("string"))
        return F.when(~F.lower(text).isin("", "nan"), text)

    return F.coalesce(F.concat(known(lat), F.lit(", "), known(lon)), F.lit(""))


def period_columns(entry: Column) -> dict[str, Column]:
    return {
        "PERIODE": month_name(entry),
        "WEEK": F.floor((F.dayofmonth(entry) - 1) / 7).cast("int") + 1,
        "WEEK_OF_YEAR": F.weekofyear(entry),
        "DAY": F.dayofmonth(entry),
        "TIME_ENTRY": F.date_format(entry, "HH:mm"),
    }


def received_columns(received: Column) -> dict[str, Column]:
    return {"DATE_RECEIVED": F.to_date(received), "TIME_RECEIVED": F.date_format(received, "HH:mm:ss")}


def origin_class(origin: Column) -> Column:
    return F.when(origin.startswith("CGK"), "Non SBS").otherwise("SBS")


def site_code(place: Column) -> Column:
    return F.substring(place, 1, 3)


def request_date(return_number: Column, received: Column, returned: Column) -> Column:
    """Received date without a return number, the return date for RT numbers, else null."""
    return F.when(return_number.isNull(), received).when(return_number.contains("RT"), returned)


def first_attempt(attempt: Column, status: Column, received: Column) -> Column:
    return F.when(attempt.isNull() & (F.trim(status) == "Success"), received).otherwise(attempt)


def billed_weight(weight: Column) -> Column:
    """Rounded up past 0.3 of a unit, else down, at least 1; bad or missing weights stay null."""
    w = weight.try_cast("double")
    rounded = F.when(w % 1 > 0.3, F.ceil(w)).otherwise(F.floor(w))
    return F.when(w.isNotNull(), F.greatest(F.lit(1.0), rounded.cast("double")))


def fix_regional_spelling(df: DataFrame) -> DataFrame:
    names = [c for c in df.columns if "REGIONAL" in c.upper()]
    if not names:
        return df
    return df.withColumns({c: F.regexp_replace(col(c).cast("string"), "(?i)sumatara", "Sumatera") for c in names})


def sla_bucket(sla: Column) -> Column:
    days = sla.try_cast("double").try_cast("long")
    return (
        F.when(days == 0, "TODAY").when(days == -1, "H-1").when(days == -2, "H-2").when(days == -3, "H-3")
        .when(days <= -4, ">H-4").when(days >= 1, "OVER SLA").otherwise("")
    )


# Fixed value: work-order number inside an instruction text.
WORK_ORDER = r"(SPK/[A-Z0-9\-]+/\d+/[A-Z]+/\d+)"


def work_order(instruction: Column) -> Column:
    return F.nullif(F.regexp_extract(instruction, WORK_ORDER, 1), F.lit(""))


def goods_category(goods: Column) -> Column:
    greeting = F.coalesce(F.upper(goods.cast("string")).rlike("ULANG TAHUN|ULTAH|UCAPAN"), F.lit(False))
    return F.when(greeting, "ATENSI ULANG TAHUN").otherwise("REGULER")


# Keywords that place a province, tried in this order.
WEST = [
    "sumatera", "aceh", "riau", "kepulauan riau", "kepri", "bengkulu", "lampung", "jambi", "banten", "jakarta",
    "jawa barat", "jawa", "yogyakarta", "yogya", "bali",
]
CENTRAL = ["sulawesi", "kalimantan", "borneo"]


def island_third(province: Column) -> Column:
    text = F.lower(province)
    return (
        F.when(text.isNull() | text.isin("nan", "none"), None)
        .when(text.rlike("|".join(WEST)), "Indonesia Bagian Barat")
        .when(text.rlike("|".join(CENTRAL)), "Indonesia Bagian Tengah")
        .otherwise("Indonesia Bagian Timur")
    )


def price_per_kg(amount: Column, weight: Column) -> Column:
    """Price per unit of weight, down to whole thousands; no weight gives null."""
    return F.floor(F.try_divide(amount.try_cast("double"), weight.try_cast("double")) / 1000) * 1000.0


# Relation code and S/R flag by delivery code.
DELIVERY_CODES = {
    "CR1": ("Retur Origin", "R"), "D01": ("01", "S"), "D02": ("07", "S"), "D03": ("08", "S"), "D04": ("06", "S"),
    "D05": ("08", "S"), "D06": ("02", "S"), "D07": ("05", "S"), "D08": ("08", "S"), "D09": ("03", "S"),
    "D10": ("10", "S"), "D11": ("08", "S"), "D12": ("08", "S"), "DB1": ("08", "S"), "DB2": ("08", "S"),
    "R10": ("06", "R"), "U01": ("03", "R"), "U02": ("04", "R"), "U03": ("02", "R"), "U04": ("06", "R"),
    "U05": ("07", "R"), "U06": ("08", "R"), "U07": ("07", "R"), "U08": ("08", "R"), "U09": ("07", "R"),
    "U10": ("10", "R"), "U11": ("06", "R"), "U12": ("06", "R"), "U13": ("08", "R"), "U14": ("07", "R"),
    "U21": ("08", "R"), "U22": ("07", "R"), "U23": ("07", "R"), "U24": ("06", "R"), "U25": ("07", "R"),
    "OPC": ("On Process", "On Process"),
}


def _code_part(code: Column, part: int) -> Column:
    pairs = [F.lit(x) for key, parts in DELIVERY_CODES.items() for x in (key, parts[part])]
    return F.try_element_at(F.create_map(*pairs), code)


def delivery_code(code: Column) -> Column:
    """The code itself, or OPC where it is blank."""
    return F.when(code.isNull() | (F.trim(code) == ""), "OPC").otherwise(code)


def delivery_parts(code: Column) -> dict[str, Column]:
    """The code, its relation or reason number, and its S/R flag."""
    filled = delivery_code(code)
    return {"code": filled, "relation": _code_part(filled, 0), "flag": _code_part(filled, 1)}


def pickup_columns(df: DataFrame) -> DataFrame:
    """Recipient, relation, reason, remark and closing flags of a pickup report."""
    df = df.withColumn("CODING", delivery_code(col("CODING")))
    df = df.withColumns({"_relation": _code_part(col("CODING"), 0), "STATUS UOB": _code_part(col("CODING"), 1)})
    flag, awb = col("STATUS UOB"), col("AWB")
    has_awb = F.coalesce(F.trim(awb) != "", F.lit(False))
    return df.withColumns({
        "RECIPIENT": F.when(is_success(col("STATUS_POD")), col("RECEIVED/REASON")),
        "RECIPIENT RELATION": F.when(flag == "S", col("_relation")),
        "REASON 2": F.when(flag == "R", col("_relation")),
        "REMARK_UOB": F.when(flag == "S", awb).when(flag == "R", F.concat_ws(" ", awb, col("REASON RETURN"))),
        "COURIER ID": F.lit("26"),
        "UPLOAD DATE": col("PICK UP DATE"),
        "KET AWB": F.when(has_awb, "ADA AWB").otherwise("TIDAK ADA AWB"),
        "CLOSING DATE": col("TGL_RECEIVED"),
        "STATUS CLOSING": F.when(col("TGL_RECEIVED").isNotNull(), "SUDAH CLOSING").otherwise("BELUM CLOSING"),
    }).drop("_relation")


def delivery_template(df: DataFrame, calendar: WorkCalendar, as_of) -> DataFrame:
    """The block of lead-time columns of the distributor template."""
    df = df.withColumn("_ok", is_success(F.trim(col("STATUS_POD"))))
    dated = col("_ok") & col("TGL_RECEIVED").isNotNull() & col("TGL_ENTRY").isNotNull()
    awb_text = F.coalesce(col("AWB"), F.lit(""))
    lead = F.when(dated, whole_days(col("TGL_ENTRY"), col("TGL_RECEIVED")))
    orders = F.coalesce(col("OTMS Order"), F.lit("0")) if "OTMS Order" in df.columns else F.lit("0")
    given = {"Target": "99%", "Origin_WH": "PDU REG", "Vendor": "JNE", "Buyer PO": ""}
    df = df.withColumns({
        **{name: F.lit(text) for name, text in given.items() if name not in df.columns},
        "OTMS Order": orders,
        "City Code": orders,
        "No_YL": F.coalesce(F.trim(col("NOREF")), F.lit("")),
        "No DSV": F.right(awb_text, F.lit(7)),
        "AWB 2": F.trim(awb_text),
        "Indonesia Bagian": island_third(col("PROVINSI")),
        "Harga Per KG": price_per_kg(col("AMOUNT"), col("WEIGHT")),
        "ATA": F.when(dated, F.date_format(col("TGL_RECEIVED"), "HH:mm:ss")),
        "LEAD TIME": lead,
        "SLA_": col("ETD").try_cast("double"),
        "REMARK_YL": F.when(col("_ok"), "OK"),
        "TODAY DATE": F.lit(as_of),
        "Overday Success After Holiday": F.when(dated, calendar.span(col("TGL_ENTRY"), col("TGL_RECEIVED"))),
    })
    days = col("LEAD TIME")
    return df.withColumns({
        "Overday Before Holiday": days + 1,
        "Total Tgl Merah": days + 1 - col("Overday Success After Holiday"),
        "Status Delivery": F.when(~col("_ok"), None)
        .when(col("TGL_RECEIVED").isNull(), "On Process")
        .when(days > col("SLA_"), "Fail")
        .otherwise("Achieve"),
        "MOD": F.when(days <= 0, "SDS").when(days == 1, "NDS").when(days == 2, "H+2").when(days > 2, "H++"),
    }).drop("_ok")


# Both spellings of the aging columns; the last one is made where a table has neither.
AGING_NAMES = {
    "attempt": ["1ST ATTEMPT", "1ST_ATTEMPT_DATE"],
    "attempt_aging": ["AGING 1st ATTEMPT", "AGING_1ST"],
    "attempt_flag": ["CAREER 1st ATTEMPT", "CAREER_1ST"],
    "aging": ["AGING POD", "AGING_POD"],
    "flag": ["CARRER POD", "CARRER_POD"],
}


def first_present(df: DataFrame, names: list[str]) -> str:
    """The first of the names the table has, else the last one."""
    return next((n for n in names if n in df.columns), names[-1])


def aging_flags(df: DataFrame, calendar: WorkCalendar) -> DataFrame:
    """Working-day aging and on-time flags of the first attempt and the delivery.

    Only successful rows carry them; values already present there are kept.
    """
    n = {role: first_present(df, names) for role, names in AGING_NAMES.items()}
    kinds = {"attempt": "timestamp", "attempt_aging": "long", "aging": "long"}
    ok = is_success(col("STATUS_POD"))
    df = df.withColumns({
        name: F.when(ok, col(name)) if name in df.columns else F.lit(None).cast(kinds.get(role, "string"))
        for role, name in n.items()
    })

    def aged(name: str, end: str):
        days = F.when(ok, calendar.aging(col("TGL_ENTRY"), col(end)))
        return F.coalesce(col(name).try_cast("long"), days)

    df = df.withColumns({n["attempt_aging"]: aged(n["attempt_aging"], n["attempt"]),
                         n["aging"]: aged(n["aging"], "TGL_RECEIVED")})

    def flag(kept: str, aging: str) -> Column:
        on_time = F.when(ok & (col(aging) <= col("ETD")), "Ontime SLA").when(ok & (col(aging) > col("ETD")), "Over SLA")
        return F.coalesce(col(kept), on_time)

    return df.withColumns({n["attempt_flag"]: flag(n["attempt_flag"], n["attempt_aging"]),
                           n["flag"]: flag(n["flag"], n["aging"])})


# Service family by prefix, tried in this order.
SERVICE_FAMILY = [("CTCYES", "YES"), ("YES", "YES"), ("CTC", "REG"), ("REG", "REG"), ("TRC", "JTR"), ("JTR", "JTR")]


def service_family(service: Column) -> Column:
    picked = F.when(service.isNull(), "INVALID")
    for prefix, family in SERVICE_FAMILY:
        picked = picked.when(service.startswith(prefix), family)
    return picked


def calendar_week(entry: Column) -> Column:
    """Week of the year where week 1 holds January 1 and weeks begin on Sunday."""
    january = F.trunc(entry, "year")
    return F.floor((F.dayofyear(entry) + F.dayofweek(january) - 2) / 7).cast("int") + 1


