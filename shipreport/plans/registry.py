"""Which derivation fills which report column, and in what order they run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, functions as F

from shipreport.functions import derive, status
from shipreport.functions.delay import DELAY_INPUTS, attribute_delay
from shipreport.functions.text import col
from shipreport.functions.workdays import WorkCalendar, arrival
from shipreport.operators import listjoin, lookups


@dataclass
class Context:
    """What derivations need besides the rows: reference tables, the calendar and the report date.

    ``full_status`` fills STATUS_POD by the full status rules instead of the short ones.
    """

    as_of: date
    refs: dict[str, DataFrame] = field(default_factory=dict)
    calendar: WorkCalendar = field(default_factory=WorkCalendar)
    full_status: bool = False

    def ref(self, name: str) -> DataFrame:
        if name not in self.refs:
            raise ValueError(f"reference table not given: {name}")
        table = self.refs[name]
        # "first row wins" follows the file: a table that brings no row order gets the order it is read in
        return table if "row_idx" in table.columns else table.withColumn("row_idx", F.monotonically_increasing_id())


@dataclass(frozen=True)
class Derivation:
    """``outputs`` call for it, ``changes`` are columns it also rewrites, ``optional`` ones it reads where there are any."""

    name: str
    outputs: tuple[str, ...]
    inputs: tuple[str, ...]
    run: Callable[[DataFrame, Context], DataFrame]
    changes: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()

    @property
    def written(self) -> set[str]:
        return {*self.outputs, *self.changes}


REGISTRY: dict[str, Derivation] = {}


def register(
    name: str, outputs: list[str], inputs: list[str], run: Callable[[DataFrame, Context], DataFrame],
    changes: list[str] = (), optional: list[str] = (),
) -> None:
    """Add a derivation; applications may add their own."""
    REGISTRY[name] = Derivation(name, tuple(outputs), tuple(inputs), run, tuple(changes), tuple(optional))


def _columns(make: Callable[[DataFrame, Context], dict]) -> Callable[[DataFrame, Context], DataFrame]:
    return lambda df, ctx: df.withColumns(make(df, ctx))


def _delay(df: DataFrame, ctx: Context) -> DataFrame:
    added = [] if "3_LC_ORIGIN" in df.columns else ["3_LC_ORIGIN"]
    if added:
        df = lookups.attach(df, ctx.ref("zone"), col("ORIGIN"), col("DEST"), {"3_LC_ORIGIN": "3 LC"})
    return attribute_delay(df)


def _address(df: DataFrame, ctx: Context) -> DataFrame:
    lines = [col(c) if c in df.columns else F.lit("") for c in ("ADDR1", "ADDR2", "ADDR3")]
    if "ADDRESS" not in df.columns:
        return df.withColumn("ADDRESS", derive.address(lines))
    # An address column that is empty throughout is filled, any other is left alone.
    empty = (df.agg(F.count(col("ADDRESS")).alias("n")).scalar() == 0)
    return df.withColumn("ADDRESS", F.when(empty, derive.address(lines)).otherwise(col("ADDRESS")))


def _client_status(df: DataFrame, ctx: Context) -> DataFrame:
    return lookups.client_status(status.resolve_full_status(df, ctx.as_of), ctx.ref("status_map"))


def _status(df: DataFrame, ctx: Context) -> DataFrame:
    return status.resolve_full_status(df, ctx.as_of) if ctx.full_status else status.short_status(df)


# Columns of the short status.
_STATUS = ["STATUS_POD"]
_STATUS_OPTIONAL = ["CODING", "STATUS_POD_UPDATE", *status.FULL_STATUS_INPUTS, *status.FULL_STATUS_OPTIONAL]

register("origin", ["ORIGIN_CITY", "ORIGIN_CITY_2", "3_LC_ORIGIN", "PROVINSI_ORIGIN", "REGION", "KODE_POS_ORI"],
         ["ORIGIN"], lambda df, ctx: lookups.origin_lookup(df, ctx.ref("zone")))
register("destination", ["KECAMATAN", "NAMA KAB/KOTA", "PROVINSI", "KODE POS"], ["DEST"],
         lambda df, ctx: lookups.dest_lookup(df, ctx.ref("zone")))
register("period", ["DAY", "PERIODE", "WEEK", "WEEK_OF_YEAR", "TIME_ENTRY"], ["TGL_ENTRY"],
         _columns(lambda df, ctx: derive.period_columns(col("TGL_ENTRY"))))
register("received", ["DATE_RECEIVED", "TIME_RECEIVED"], ["TGL_RECEIVED"],
         _columns(lambda df, ctx: derive.received_columns(col("TGL_RECEIVED"))))
register("client_status", ["AJ Car Status", "KETERANGAN AJ CAR", "Remark Return"],
         status.FULL_STATUS_INPUTS, _client_status, changes=["STATUS_POD", "DEST", "CODING"], optional=status.FULL_STATUS_OPTIONAL)
register("short_status", ["STATUS_POD"], _STATUS, _status, optional=_STATUS_OPTIONAL)
register("aging", ["AGING_1ST", "CAREER_1ST", "AGING_POD", "CARRER_POD"],
         ["TGL_ENTRY", "1ST_ATTEMPT_DATE", "TGL_RECEIVED", "ETD", "STATUS_POD"],
         lambda df, ctx: derive.aging_flags(df, ctx.calendar), optional=[n for names in derive.AGING_NAMES.values() for n in names])
register("pickups", ["CYCLE NAME", "REFF NUM", "PICK UP DATE", "CUSTOMER NAME", "RECIPIENT RELATION", "STATUS UOB",
                     "REASON 2"],
         ["REFNO_UOB", "STATUS_POD", "RECEIVED/REASON", "CODING", "AWB", "REASON RETURN", "TGL_RECEIVED"],
         lambda df, ctx: listjoin.join_pickups(df, ctx.ref("pickups")))
register("dimensions", ["DIM", "DIM - Copy"], [],
         _columns(lambda df, ctx: {"DIM": F.lit(0), "DIM - Copy": F.lit(0)}))
register("template", ["OTMS Order", "Target", "Origin_WH", "Vendor", "No_YL", "No DSV", "Buyer PO", "Indonesia Bagian",
                      "City Code", "Harga Per KG", "ATA", "LEAD TIME", "SLA_", "REMARK_YL", "AWB 2"],
         ["AWB", "NOREF", "AMOUNT", "WEIGHT", "PROVINSI", "ETD", "TGL_RECEIVED", "TGL_ENTRY", "STATUS_POD"],
         lambda df, ctx: derive.delivery_template(df, ctx.calendar, ctx.as_of))
register("customer_literals", ["NAMA ORIGIN", "CUSTOMER"], [],
         _columns(lambda df, ctx: {"NAMA ORIGIN": F.lit("JNE DKI JAKARTA"), "CUSTOMER": F.lit("HO")}))
register("contacts", ["CONTACT", "NOTELP"], [],
         _columns(lambda df, ctx: {c: F.lit("*****") for c in ("CONTACT", "NOTELP")}))
register("area", ["AREA MANDIRI", "SLA OOB"], ["REGIONAL", "AGING"],
         lambda df, ctx: lookups.area_promise(df, ctx.ref("area_sla")), changes=["CARRER"])
register("address", ["ADDRESS"], [], _address, optional=["ADDR1", "ADDR2", "ADDR3"])
register("customer_name", ["CUST_NAME"], ["ID_ACCOUNT"],
         lambda df, ctx: lookups.account_name(df, ctx.ref("project_reference")))
register("coordinates", ["STATUS_LATLONG"], ["STATUS_LATITUDE", "STATUS_LONGITUDE"], _columns(
    lambda df, ctx: {"STATUS_LATLONG": derive.coordinates(col("STATUS_LATITUDE"), col("STATUS_LONGITUDE"))}))
register("arrival", ["ETA"], ["ETD", "TGL_ENTRY"],
         _columns(lambda df, ctx: {"ETA": arrival(col("TGL_ENTRY"), col("ETD"), ctx.calendar)}))
register("delivery_remark", ["CODING_DELIVERY"], ["CODING"],
         lambda df, ctx: lookups.delivery_remark(df, ctx.ref("status_code")))
register("delay", ["GROUPING_LATE"], ["ORIGIN", *[c for c in DELAY_INPUTS if c != "3_LC_ORIGIN"]], _delay, optional=["3_LC_ORIGIN"])
register("sla_bucket", ["GROUPING_SLA"], ["SLA"],
         _columns(lambda df, ctx: {"GROUPING_SLA": derive.sla_bucket(col("SLA"))}))
register("pic", ["PIC"], [], _columns(lambda df, ctx: {"PIC": F.lit("JNE")}))
register("origin_class", ["ORIGIN 2"], ["ORIGIN"],
         _columns(lambda df, ctx: {"ORIGIN 2": derive.origin_class(col("ORIGIN"))}))
register("account_label", ["DEPT PZC"], ["ID_ACCOUNT"],
         lambda df, ctx: lookups.account_label(df, ctx.ref("project_reference")))
register("closed", ["IS_CLOSE"], ["STATUS_POD"],
         _columns(lambda df, ctx: {"IS_CLOSE": status.close_mark(col("STATUS_POD"))}))
register("follow_up", ["REASON"], ["STATUS_POD"],
         _columns(lambda df, ctx: {"REASON": status.follow_up(col("STATUS_POD"))}))
register("reason_1st", ["REASON_1ST_ATTEMPT"], ["RESULT_1ST_ATTEMPT"],
         lambda df, ctx: lookups.attempt_reason(df, ctx.ref("undel_code"), "RESULT_1ST_ATTEMPT"))
register("reason_2nd", ["REASON_2ND_ATTEMPT"], ["RESULT_2ND_ATTEMPT"],
         lambda df, ctx: lookups.attempt_reason(df, ctx.ref("undel_code"), "RESULT_2ND_ATTEMPT"))
register("reason_last", ["REASON_LAST_ATTEMPT"], ["RESULT_LAST_ATTEMPT"],
         lambda df, ctx: lookups.attempt_reason(df, ctx.ref("undel_code"), "RESULT_LAST_ATTEMPT"))
register("request_date", ["DATE_RECEIVE_REQUEST"], ["CONNOTE_RETURN_RT", "TGL_RECEIVED", "DATE_CONNOTE_RETURN_RT"],
         _columns(lambda df, ctx: {"DATE_RECEIVE_REQUEST": derive.request_date(
             col("CONNOTE_RETURN_RT"), col("TGL_RECEIVED"), col("DATE_CONNOTE_RETURN_RT"))}))
register("return_note", ["DESCR_RETURN"], ["STATUS_POD"],
         _columns(lambda df, ctx: {"DESCR_RETURN": status.return_note(col("STATUS_POD"))}))
register("update_time", ["UPDATE_TIME"], [], _columns(lambda df, ctx: {"UPDATE_TIME": F.lit(ctx.as_of)}))
register("status_group", ["GROUPING_STATUS"], ["STATUS_POD"],
         _columns(lambda df, ctx: {"GROUPING_STATUS": status.status_group(col("STATUS_POD"))}))
register("work_order", ["SPK"], ["INTRUCTION"],
         _columns(lambda df, ctx: {"SPK": derive.work_order(col("INTRUCTION"))}))
register("area_group", ["WILAYAH"], ["DEST"], lambda df, ctx: lookups.area_group(df, ctx.ref("zone")))
register("first_attempt", ["DATE_1ST_ATTEMPT"], ["DATE_1ST_ATTEMPT", "STATUS_POD", "TGL_RECEIVED"],
         _columns(lambda df, ctx: {"DATE_1ST_ATTEMPT": derive.first_attempt(
             col("DATE_1ST_ATTEMPT"), col("STATUS_POD"), col("TGL_RECEIVED"))}))
register("forward_site", ["3 LC DEST FW"], ["DEST_FW"],
         _columns(lambda df, ctx: {"3 LC DEST FW": derive.site_code(col("DEST_FW"))}))
register("billed_weight", ["WEIGHT"], ["WEIGHT"],
         _columns(lambda df, ctx: {"WEIGHT": derive.billed_weight(col("WEIGHT"))}))
register("undelivered_reason", ["REASON UNDEL"], ["CODING_UNDEL"],
         lambda df, ctx: lookups.undelivered_reason(df, ctx.ref("undel_code")))
register("goods_category", ["BNI_KATEGORI"], ["GOODS_DESCR"],
         _columns(lambda df, ctx: {"BNI_KATEGORI": derive.goods_category(col("GOODS_DESCR"))}))
register("code_remark", ["CODING_REMARKS"], ["CODING"],
         lambda df, ctx: lookups.code_remark(df, ctx.ref("status_code")))


def needed_for(columns: list[str]) -> list[Derivation]:
    """Derivations that fill any of the columns, each after those it takes input from.

    Two derivations of the same column, or two that feed each other, run in the
    order they were registered.
    """
    wanted = [d for d in REGISTRY.values() if set(d.outputs) & set(columns)]
    place = {d.name: i for i, d in enumerate(REGISTRY.values())}
    sorter: TopologicalSorter[str] = TopologicalSorter()
    for later in wanted:
        before = []
        for earlier in wanted:
            if earlier is later:
                continue
            mutual = earlier.written & set(later.inputs) and later.written & set(earlier.inputs)
            if earlier.written & later.written or mutual:
                if place[earlier.name] < place[later.name]:
                    before.append(earlier.name)
            elif earlier.written & set(later.inputs):
                before.append(earlier.name)
        sorter.add(later.name, *before)
    return [REGISTRY[name] for name in sorter.static_order()]


def columns_read(columns: list[str]) -> set[str]:
    """All columns that filling ``columns`` may read or write."""
    return set(columns).union(*[{*d.inputs, *d.optional, *d.written} for d in needed_for(columns)])


def derive_columns(df: DataFrame, columns: list[str], ctx: Context) -> DataFrame:
    """Run what the selected columns need; a missing input is an error, not a silent gap."""
    for d in needed_for(columns):
        absent = [c for c in d.inputs if c not in df.columns]
        if absent:
            raise ValueError(f"{d.name} needs the columns {absent}")
        df = d.run(df, ctx)
    return df
