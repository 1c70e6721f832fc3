"""The finding on the pivot presets: the facts are aggregated by the shown members, not by day first."""

import datetime

import pytest
from pyspark.sql import functions as F

import queries.summaries as summaries
from shipreport.operators.pivots import Measure, Pivot, in_one_month, pivot_long


def sheet(spark, days):
    """A row for each account and day, some without an entry day; times of day differ."""
    day = F.expr(f"timestamp'2024-01-03 00:00:00' + make_interval(0, 0, 0, cast(id % {days} as int), cast(id % 24 as int))")
    return spark.range(900).select(
        F.col("id").cast("string").alias("AWB"), (F.col("id") % 3).cast("string").alias("ID_ACCOUNT"),
        F.when(F.col("id") % 50 != 0, day).alias("TGL_ENTRY"), F.when(F.col("id") % 7 != 0, F.lit("Undel")).alias("STATUS_POD"))


@pytest.mark.parametrize("days", [20, 300])
def test_the_month_question_is_asked_once(spark, days):
    df = sheet(spark, days)
    for filters in ([], [("STATUS_POD", "Undel")]):
        p = Pivot("p", ["ID_ACCOUNT", "STATUS_POD"], ["TGL_ENTRY"], [Measure("AWB", "count", "n"), Measure("AWB", "count", "share", "row")], filters)
        want, got = pivot_long(df, p).collect(), pivot_long(df, p, in_one_month(df)).collect()
        assert sorted(want, key=repr) == sorted(got, key=repr)
        months = {r["TGL_ENTRY"] for r in got}
        assert len(months) == (days + 1 if days == 20 else 11)
    assert any(d.day != 1 for d in months if isinstance(d, datetime.date)) == (days == 20)
    assert in_one_month(df.drop("TGL_ENTRY")) is None


def test_presets_share_the_question(spark, sf_dir, monkeypatch):
    asked = []
    monkeypatch.setattr(summaries, "pivot_long", lambda df, p, one_month=None: asked.append(one_month) or pivot_long(df, p, one_month))
    plan = summaries.pivot_presets(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert len(asked) == len(summaries._PRESETS_HERE) and asked[0] is not None and len({id(x) for x in asked}) == 1
    # by account, status and day nearly every row is a group of its own
    assert "trunc(_groupingexpression" not in plan.lower() and "_from" not in plan
