"""Column expressions on small hand-made rows."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pandas.tseries.offsets import CustomBusinessDay
from pyspark.sql import functions as F

from shipreport.functions import derive, moments, predicates
from shipreport.functions.delay import DELAY_INPUTS, attribute_delay
from shipreport.functions.status import FULL_STATUS_INPUTS, FULL_STATUS_OPTIONAL, resolve_full_status, short_status
from shipreport.functions.text import col, pattern_of_example
from shipreport.functions.workdays import WorkCalendar, arrival
from shipreport.operators.receivers import token_set_score

DAY = dt.date(1998, 7, 15)
MOMENTS = {"TGL_ENTRY", "DATE_RUNSHEET"}


def frame(spark, names, rows, moments_in=()):
    schema = ", ".join(f"`{n}` {'timestamp' if n in moments_in else 'string'}" for n in names)
    return spark.createDataFrame([[r.get(n) for n in names] for r in rows], schema)


# ---- working days ----------------------------------------------------------

HOLIDAYS = [dt.date(2024, 1, 1), dt.date(2024, 2, 8), dt.date(2024, 2, 10), dt.date(2024, 3, 11), dt.date(2024, 3, 12),
            dt.date(2025, 12, 25), dt.date(1998, 5, 1)]


def test_working_days_agree_with_numpy_and_pandas(spark):
    rng = random.Random(5)
    pairs = [(dt.datetime(2023, 11, 1) + dt.timedelta(hours=rng.randrange(24 * 900)),
              dt.datetime(2023, 11, 1) + dt.timedelta(hours=rng.randrange(24 * 900)), rng.randrange(-6, 30)) for _ in range(800)]
    pairs += [(dt.datetime(1850, 3, 2, 5), dt.datetime(2150, 1, 9), 3), (dt.datetime(2024, 2, 10, 8), dt.datetime(2024, 2, 10), -1)]
    calendar = WorkCalendar(HOLIDAYS)
    df = spark.createDataFrame(pairs, "a timestamp, b timestamp, n long")
    rows = df.select("a", "b", "n", calendar.aging(col("a"), col("b")).alias("aging"), calendar.span(col("a"), col("b")).alias("span"),
                     arrival(col("a"), col("n"), calendar).alias("eta")).collect()
    offset = CustomBusinessDay(holidays=HOLIDAYS)
    for r in rows:
        a, b = np.datetime64(r.a.date()), np.datetime64(r.b.date())
        aging = 0 if b <= a else np.busday_count(a, b, holidays=HOLIDAYS) + 1
        span = 0 if b < a else np.busday_count(a, b + np.timedelta64(1, "D"), holidays=HOLIDAYS)
        assert (r.aging, r.span) == (aging, span), r
        assert pd.Timestamp(r.eta) == pd.Timestamp(r.a) + offset * (r.n + 1), r


def test_working_days_of_nulls(spark):
    df = spark.createDataFrame([(None, dt.datetime(2024, 1, 5))], "a timestamp, b timestamp")
    calendar = WorkCalendar(HOLIDAYS)
    row = df.select(calendar.aging(col("a"), col("b")), calendar.span(col("b"), col("a")),
                    arrival(col("a"), F.lit(2), calendar)).first()
    assert tuple(row) == (None, None, None)


def test_calendar_from_table(spark):
    table = spark.createDataFrame([("2024-01-01",), (None,), ("2024-01-01",)], "date string")
    assert WorkCalendar.from_table(table)._days == WorkCalendar([dt.date(2024, 1, 1)])._days


# ---- filters ---------------------------------------------------------------


def test_not_is_the_complement(spark):
    df = spark.createDataFrame([("Abc", "5"), (None, None), ("", "x"), ("abd", "-1")], "a string, n string")
    leaves = [["a", "starts_with", "AB"], ["a", "ends_with", "C"], ["a", "contains", "b."], ["a", "regex", "^$"],
              ["a", "equals", "Abc"], ["a", "iequals", "ABC"], ["a", "not_equals", "Abc"], ["n", "gt", 1], ["n", "lt", 1],
              ["n", "gte", 5], ["n", "lte", -1], ["a", "in", ["Abc"]], ["a", "not_in", ["Abc"]], ["zz", "equals", 1]]
    for rule in leaves:
        for r in df.select(predicates.tree(df, rule).alias("y"), predicates.tree(df, {"not": rule}).alias("n")).collect():
            assert r.y is not None and r.y != r.n, rule


def test_filter_details(spark):
    df = spark.createDataFrame([("a.c",), ("abc",), (None,)], "a string")

    def hits(rule, **options):
        return [r.a for r in df.where(predicates.tree(df, rule, **options)).collect()]

    assert hits(["a", "contains", "a.c"]) == ["a.c", "abc"]
    assert hits(["a", "contains", "a.c"], literal=True) == ["a.c"]
    assert hits(["a", "not_equals", "abc"]) == ["a.c", None]
    assert hits(["A", "starts_with", "AB"], cased=True) == []
    for bad in (["a", "like", 1], {"and": [], "or": []}, {"xor": [["a", "in", []]]}, "a", {"and": []}):
        with pytest.raises(ValueError):
            predicates.tree(df, bad)


# ---- status ----------------------------------------------------------------

# One row per rule: what differs from an empty dated row, and the status it must get.
STATUS_CASES = [
    ({"CODING": "D25"}, "Claim Breach (Over SLA)"), ({"CODING": " D24 "}, "Claim Damage"), ({"CODING": "C01"}, "Claim Missing"),
    ({"CODING": "R26"}, "Return Shipper"), ({"CODING": "CL1"}, "Un Receiving"), ({"CODING": "CL3"}, "Claim Breach (Over SLA)"),
    ({"CODING": "R25"}, "Rejection Return"), ({"CODING": "CR4"}, "Destroyed"),
    ({"STATUS_POD": "RU Shipper/Origin"}, "RU Origin"), ({"STATUS_POD": "Undel", "STATUS_POD_UPDATE": "Success"}, "Success"),
    ({"STATUS_POD": "Success", "STATUS_POD_UPDATE": " "}, "Success"), ({"AWB_CANCEL": "Y"}, "AWB Cancel"),
    ({"TGL_ENTRY": None}, "Invalid AWB"), ({"CODING": "CR8"}, "RU Origin"), ({"CODING": "U14"}, "Missing"),
    ({"CODING": "U11"}, "Damage"), ({"STATUS_POD": "Un Receiving"}, "Un Receiving"), ({"CONNOTE_RETURN_RT": "RT1"}, "RU Origin"),
    ({"CONNOTE_RETURN_RF": "RF1"}, "RU Origin"), ({"CODING": "xU01"}, "Undel"), ({"CODING": "CR3"}, "Undel"),
    ({"CODING": "U22"}, "Undel"), ({"RESULT_1ST_ATTEMPT": "D01"}, "Undel"), ({"RESULT_1ST_ATTEMPT": "U12"}, "Un Receiving"),
    ({"INBOUND_MANIFEST": "x"}, "On Process"), ({"DEST": "BDO1", "HVO_NO": "BDO/1"}, "On Process"),
    ({"OUTBOUND_MANIFEST": "x"}, "On Forward Destination"), ({"RECEIVING": "x"}, "Un Manifest"), ({}, "Un Receiving"),
    ({"STATUS_POD": "Success", "CONFIRM_SHIPMENT_UNDEL": "A WH1"}, "Hold WH Destination"),
    ({"ORIGIN": "CGK1", "DEST": "CGK2", "INBOUND_MANIFEST": "x"}, "Un Receiving"),
    ({"ORIGIN": "CGK1", "DEST": "CGK2", "INBOUND_MANIFEST": "x", "RECEIVING": "x"}, "Un Manifest"),
    ({"ORIGIN": "CGK1", "DEST": "CGK2", "INBOUND_MANIFEST": "x", "HVO_NO": "x"}, "On Forward Destination"),
    ({"ORIGIN": "CGK1", "DEST": "CGK2", "HVI_NO": "x"}, "On Process"),
    ({"NO_CNOTE_FW": "F", "DESC_STATUS_FW": "Cancel"}, "Undel"), ({"NO_CNOTE_FW": "F", "DESC_STATUS_FW": "On Process"}, "Un Receiving"),
    ({"CODING": "DB1"}, "Success"), ({"CODING": "CL2", "CONNOTE_RETURN_RT": "RT"}, "RU Origin"),
    ({"INBOUND_MANIFEST": "x", "DEST": "BDO1", "RUNSHEET_NO": "BDO9", "DATE_RUNSHEET": dt.datetime(1998, 7, 15, 9)}, "On Delivery"),
    ({"INBOUND_MANIFEST": "x", "DEST": "BDO1", "RUNSHEET_NO": "BDO9", "DATE_RUNSHEET": dt.datetime(1998, 7, 14)}, "On Process"),
    ({"INBOUND_MANIFEST": "x", "ORIGIN": "SUB1", "DEST": "BDO1", "RUNSHEET_NO": "SUB9"}, "On Forward Destination"),
    ({"RECEIVING": "x", "IREG_CODE": "X1"}, "Problem X-Ray"), ({"INBOUND_MANIFEST": "x", "IREG_CODE": "X1"}, "On Process"),
]


def test_every_status_rule(spark):
    names = FULL_STATUS_INPUTS + FULL_STATUS_OPTIONAL + ["id"]
    rows = [{"TGL_ENTRY": dt.datetime(1998, 7, 1), **case, "id": str(i)} for i, (case, _) in enumerate(STATUS_CASES)]
    got = {int(r.id): r.STATUS_POD for r in resolve_full_status(frame(spark, names, rows, MOMENTS), DAY).collect()}
    assert got == {i: want for i, (_, want) in enumerate(STATUS_CASES)}


def test_status_without_optional_columns_and_forwarded_fields(spark):
    df = frame(spark, FULL_STATUS_INPUTS, [{"STATUS_POD": "Success"}], MOMENTS)
    assert resolve_full_status(df, DAY).columns == df.columns
    df = frame(spark, FULL_STATUS_INPUTS + FULL_STATUS_OPTIONAL, [{"NO_CNOTE_FW": "1", "DEST_FW": "SUB", "CODING_STATUS_FW": "DB1"}], MOMENTS)
    row = resolve_full_status(df, DAY).first()
    assert (row.STATUS_POD, row.DEST, row.CODING) == ("Success", "SUB", "DB1")
    with pytest.raises(ValueError):
        resolve_full_status(df.drop("HVI_NO"), DAY)


def test_short_status(spark):
    df = frame(spark, ["CODING", "STATUS_POD"], [{"CODING": " C02", "STATUS_POD": "a"}, {"CODING": "x"}])
    assert [r.STATUS_POD for r in short_status(df).collect()] == ["Claim Damage", ""]


# ---- delay -----------------------------------------------------------------

_DATES = [c for c in DELAY_INPUTS if "DATE" in c or c.startswith("TGL")]
_START = dt.datetime(2024, 3, 4, 8)
_GOOD = {
    "3_LC_ORIGIN": "CGK", "3 LC DEST": "BDO", "TGL_ENTRY": 0, "OUTBOUND_MANIFEST_DATE": 3, "INBOUND_MANIFEST_DATE": 5,
    "1ST_RUNSHEET_DATE": 8, "MANIFEST_TRANSIT_SUBAGEN_DATE": 6, "MANIFEST_INBOUND_SUBAGEN_DATE": 7, "RECEIVING_DATE": 1,
    "TGL_RECEIVED": 9, "ZONA": "A", "STATUS_POD": "Success", "CARRER": "Over SLA (became)", "ETD": "2",
}
DELAY_CASES = [
    ({}, ""), ({"OUTBOUND_MANIFEST_DATE": 6}, "FM - LATE"), ({"RECEIVING_DATE": None}, "FM - LATE"),
    ({"STATUS_POD": "AWB Cancel"}, "FM - LATE"), ({"INBOUND_MANIFEST_DATE": 80, "1ST_RUNSHEET_DATE": 81}, "MM - LATE"),
    ({"HOLD_REASON": "Bea"}, "MM - LATE"), ({"1ST_RUNSHEET_DATE": 30}, "LM - LATE"), ({"DATE_LAST_ATTEMPT": 3}, "LM - LATE"),
    ({"NO_CNOTE_FW": "FW1"}, "LM - LATE"), ({"TGL_RECEIVED": 90}, "LM - LATE"), ({"CARRER": "Ontime SLA", "RECEIVING_DATE": None}, ""),
    ({"CARRER": "Over SLA"}, "LM - LATE"), ({"OUTBOUND_MANIFEST_DATE": 6, "MANIFEST_TRANSIT_SUBAGEN_DATE": None}, "FM - LATE, LM - LATE"),
    ({"ZONA": "C"}, ""), ({"ZONA": "C", "INBOUND_MANIFEST_DATE": 3}, "LM - LATE"),
    ({"ZONA": "C", "MANIFEST_INBOUND_SUBAGEN_DATE": 57, "1ST_RUNSHEET_DATE": 58, "TGL_RECEIVED": 58}, "LM - LATE"),
    ({"3 LC DEST": "CGK", "OUTBOUND_MANIFEST_DATE": None, "1ST_HVO_DATE": 2}, ""), ({"OUTBOUND_MANIFEST_DATE": None}, "FM - LATE"),
]


def test_delay_legs(spark):
    names = DELAY_INPUTS + ["id"]
    rows = []
    for i, (case, _) in enumerate(DELAY_CASES):
        row = {**_GOOD, **case, "id": str(i)}
        rows.append({k: _START + dt.timedelta(hours=v) if k in _DATES and v is not None else v for k, v in row.items()})
    df = frame(spark, names, rows, _DATES).withColumn("ETD", col("ETD").cast("long"))
    got = {int(r.id): r.GROUPING_LATE for r in attribute_delay(df).collect()}
    assert got == {i: want for i, (_, want) in enumerate(DELAY_CASES)}


# ---- the rest --------------------------------------------------------------


def test_date_texts(spark):
    texts = {"3/4/99 1:05": dt.datetime(1999, 3, 4, 1, 5), "25/12/2024 10:30": dt.datetime(2024, 12, 25, 10, 30),
             "25-Dec-2024 10:30": dt.datetime(2024, 12, 25, 10, 30), "45658.5": dt.datetime(2025, 1, 1, 12),
             "20240115": dt.datetime(2024, 1, 15), "2024-01-15T08:00:01": dt.datetime(2024, 1, 15, 8, 0, 1),
             "31.01.68": dt.datetime(2068, 1, 31), "31/02/2024": None, "x": None, "1 March 2024": dt.datetime(2024, 3, 1)}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.d for r in df.select("t", moments.parse_text(col("t")).alias("d")).collect()}
    assert got == texts
    mixed = spark.createDataFrame([("3/4/2024 10:00",), ("2024-04-03",)], "t string").select(moments.parse_mixed(col("t")))
    assert [r[0] for r in mixed.collect()] == [dt.datetime(2024, 4, 3, 10), dt.datetime(2024, 4, 3)]


def test_billed_weight(spark):
    df = spark.createDataFrame([("1.3",), ("2.3",), ("0.1",), ("1.31",), (None,), ("x",)], "w string")
    assert [r[0] for r in df.select(derive.billed_weight(col("w"))).collect()] == [2.0, 2.0, 1.0, 2.0, None, None]


def test_calendar_week(spark):
    days = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 6), dt.datetime(2024, 1, 7), dt.datetime(2022, 1, 1), dt.datetime(2022, 1, 2)]
    df = spark.createDataFrame([(d,) for d in days], "d timestamp")
    assert [r[0] for r in df.select(derive.calendar_week(col("d"))).collect()] == [1, 1, 2, 1, 2]


def test_token_sets():
    assert token_set_score("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert token_set_score("satpam", "satpm") == pytest.approx(100 - 100 / 11)
    assert token_set_score("a b", "c d") < 85
    assert token_set_score("", "x") == 0


def test_key_examples():
    import re

    pattern = pattern_of_example("GEN.25/03/26-06")
    assert re.search(pattern, "x gen.1/22/3-4 y").group(0) == "gen.1/22/3-4"
    assert not re.search(pattern, "GENx25/03/26-06")
