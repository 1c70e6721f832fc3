"""What changed between runs, and what was already processed."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from shipreport.functions.moments import MONTHS
from shipreport.functions.text import col

# Statuses after which a shipment no longer changes.
CLOSED = ["Success", "Return Shipper"]


def status_counts(df: DataFrame, report: Column | str, status: str = "STATUS_POD") -> DataFrame:
    """Rows per report and status; rows without a status are not counted."""
    name = F.lit(report) if isinstance(report, str) else report
    return (
        df.where(col(status).isNotNull())
        .groupBy(name.alias("report"), col(status).alias("status"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _current_period(report: Column, as_of: date) -> Column:
    text = F.lower(report)
    return text.contains(MONTHS[as_of.month - 1].lower()) | text.contains(str(as_of.year))


def report_changes(reports: DataFrame, today: DataFrame, last: DataFrame, as_of: date) -> DataFrame:
    """One row per report with the reason it is sent, or ``unchanged``.

    ``reports`` has the report names; ``today`` and ``last`` are status counts.
    """
    now = today.select("report", "status", F.col("n").alias("n_now"))
    then = last.select("report", "status", F.col("n").alias("n_then"))
    both = now.join(then, ["report", "status"], "full")
    facts = both.groupBy("report").agg(
        F.count("n_now").alias("statuses_now"),
        F.max(F.coalesce(F.col("n_now"), F.lit(0)) != F.coalesce(F.col("n_then"), F.lit(0))).alias("differs"),
        F.max(F.col("n_now").isNotNull() & ~F.col("status").isin(CLOSED)).alias("is_open"),
    )
    joined = reports.select("report").join(facts, "report", "left")
    reason = (
        F.when(_current_period(F.col("report"), as_of), "current period")
        .when(F.coalesce(F.col("statuses_now"), F.lit(0)) == 0, "new")
        .when(F.col("differs"), "changed")
        .when(F.col("is_open"), "still open")
        .otherwise("unchanged")
    )
    return joined.select("report", reason.alias("reason"), (reason != "unchanged").alias("send"))


def next_baseline(today: DataFrame, last: DataFrame, changes: DataFrame) -> DataFrame:
    """Counts to compare with next time: today's for reports that changed, the old ones otherwise."""
    moved = changes.where("reason = 'changed'").select("report")
    return today.join(moved, "report", "left_semi").unionByName(last.join(moved, "report", "left_anti"))


def closed_only(counts: DataFrame) -> DataFrame:
    """Per report whether every status it holds is a closed one."""
    return counts.groupBy("report").agg(F.min(F.col("status").isin(CLOSED)).alias("closed_only"))


def not_yet_processed(work: DataFrame, ledger: DataFrame, as_of: date) -> DataFrame:
    """Work items whose key the ledger does not date today."""
    done = ledger.where(col("processed") == as_of.isoformat()).select("key").distinct()
    return work.join(done, "key", "left_anti")


def marked_processed(ledger: DataFrame, keys: DataFrame, as_of: date) -> DataFrame:
    """The ledger with the keys dated today; a key keeps one row, however often it is marked."""
    today = keys.select("key").distinct().withColumn("processed", F.lit(as_of.isoformat()))
    return ledger.select("key", "processed").join(today, "key", "left_anti").unionByName(today)


def retained(ledger: DataFrame, as_of: date, days: int = 14) -> DataFrame:
    """Ledger rows with a readable date of the last days."""
    readable = col("processed").rlike(r"^\d{4}-\d{1,2}-\d{1,2}$")
    when = F.when(readable, col("processed").try_cast("date"))
    return ledger.where(when >= F.date_sub(F.lit(as_of), days))


def outputs_per_contact(outputs: DataFrame, changes: DataFrame) -> DataFrame:
    """Distinct (contact, report) pairs to send.

    ``outputs`` has report and contacts (an array); pairs stay rows, so a contact
    with very many reports is no single large value.
    """
    send = changes.where("send").select("report")
    return outputs.select(F.explode("contacts").alias("contact"), "report").distinct().join(
        send, "report", "left_semi").select("contact", "report")
