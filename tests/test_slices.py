"""Findings on disk: wide rows are dealt out slice by slice, and shuffle files go with their slice."""

import time
from collections import Counter

from pyspark.sql import functions as F

from queries.outputs import _BOOK
from shipreport import session
from shipreport.plans.workbook import workbook
from shipreport.sources.shipments import write_shipments


def files(spark) -> int:
    """Shuffle files on disk; they are deleted in the background, a moment after a query ends."""
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(found.apply(i).getName().startswith("shuffle") for i in range(found.size()))


def left_over(spark, before: int) -> int:
    for _ in range(50):
        if files(spark) <= before:
            break
        time.sleep(0.1)
    return files(spark) - before


def lines(spark):
    """Some without a waybill, some twice, one waybill on a fifth of them."""
    rows = spark.range(600).select(
        F.expr("case when id % 10 = 0 then null when id % 5 = 1 then 'A' else concat('W', id % 250) end").alias("AWB"),
        F.concat(F.lit(" "), (F.col("id") % 7).cast("string")).alias("ID_ACCOUNT"),
        F.expr("timestamp_seconds(900000000 + id % 90 * 86400)").alias("TGL_ENTRY"), F.expr("if(id % 2 = 0, 'RETAIL', 'BANK')").alias("CATEGORY"))
    return rows.repartition(5, "TGL_ENTRY")


def test_slices_hold_every_row_once(spark, monkeypatch):
    expected = Counter(map(tuple, lines(spark).collect()))
    for most, calls in ((1, session.SLICES), (100_000, 2)):
        monkeypatch.setattr(session, "SLICE_ROWS", most)
        found, seen = Counter(), []
        session.in_slices(lines(spark), F.col("AWB"), lambda rows, *ends: seen.append(ends) or found.update(map(tuple, rows.collect())))
        assert found == expected and len(seen) == calls
        assert seen == [(True, False), *[(False, False)] * (calls - 2), (False, True)]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    empty, seen = lines(spark).where("AWB = 'none'"), []
    session.in_slices(empty, F.col("AWB"), lambda rows, *ends: seen.append((rows.count(), *ends)))
    assert seen == [(0, True, False), (0, False, True)]
    session.in_slices(lines(spark), None, lambda rows, *ends: seen.append((rows.count(), *ends)))
    assert seen[2:] == [(600, True, True)]


def test_master_is_stored_slice_by_slice(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "SLICE_ROWS", 1)
    root, before = tmp_path / "m", files(spark)
    for _ in range(2):  # a second time replaces the first
        write_shipments(lines(spark), str(root))
    assert left_over(spark, before) <= 0
    jobs = {f.name.split("-", 2)[2].split(".")[0] for f in root.rglob("*.parquet")}
    assert len(jobs) > 3 and (root / "_SUCCESS").exists()
    stored = spark.read.parquet(str(root)).select("AWB", "ID_ACCOUNT", "TGL_ENTRY", "CATEGORY", "p_category")
    same = lines(spark).withColumn("ID_ACCOUNT", F.concat(F.lit("'"), F.trim("ID_ACCOUNT"))).withColumn("p_category", F.col("CATEGORY"))
    assert Counter(map(tuple, stored.collect())) == Counter(map(tuple, same.collect()))


def test_master_columns_are_made_after_the_deal(spark, tmp_path):
    raw = lines(spark).withColumnRenamed("ID_ACCOUNT", "number").withColumn("unused", F.lit(1))
    columns = {c: F.col(c) for c in ("AWB", "TGL_ENTRY", "CATEGORY")} | {"ID_ACCOUNT": F.concat(F.lit(" "), F.trim("number")), "TEXT": F.concat("AWB", F.lit("-"), "number")}
    for name, (df, made) in {"late": (raw, columns), "early": (raw.select(*[c.alias(n) for n, c in columns.items()]), None)}.items():
        write_shipments(df, str(tmp_path / name), columns=made)
    late, early = (spark.read.parquet(str(tmp_path / name)) for name in ("late", "early"))
    assert late.columns == early.columns == [*columns, "tahun", "bulan", "p_category"]
    assert Counter(map(tuple, late.collect())) == Counter(map(tuple, early.collect()))


def test_workbook_lines_are_dealt_out_slice_by_slice(spark, monkeypatch):
    monkeypatch.setattr(session, "SLICE_ROWS", 1)
    times, number = {"TGL_ENTRY", "TGL_RECEIVED", "DATE_1ST_ATTEMPT"}, F.col("id").cast("string")
    of = {c: F.timestamp_seconds("id") if c in times else number for c in _BOOK}
    of |= {"AWB": F.when(F.col("id") % 10 > 0, (F.col("id") % 400).cast("string")), "DEST": F.when(F.col("id") % 7 > 0, number),
           "STATUS_POD": F.lit("Success"), "Status_Update": F.lit("Undel"), "RESULT_LAST_ATTEMPT": (F.col("id") % 20).cast("string")}
    keys, many, n = ("AWB", "ID_ACCOUNT", "DEST"), spark.range(0, 100_000, 2), 1000
    shippers = many.select(number.alias("CUST_ID_2"), F.concat(F.lit("g"), number).alias("CUST_NAME_GROUPING"))
    zones = many.select(*[number.alias(c) for c in ("DEST", "3 LC", "NAMA KAB/KOTA 2", "REGION", "ZONA")])
    codes = many.select((F.col("id") % 10).cast("string").alias("Coding Undel"), F.lit("r").alias("Remark_English"))
    expected = Counter((str(i % 400) if i % 10 else None, str(i), f"g{i}" if i % 2 == 0 else None, str(i) if i % 2 == 0 and i % 7 else None,
                        "r" if i % 20 in (0, 2, 4, 6, 8) else None) for i in range(n))
    before, threshold = files(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        early = workbook(spark.range(n).select(*[e.alias(c) for c, e in of.items()]), shippers, zones, codes, extras=True)
        late = workbook(spark.range(n).select("id", *[of[c].alias(c) for c in keys]), shippers, zones, codes, extras=True,
                        late={c: e for c, e in of.items() if c not in keys})
        assert left_over(spark, before) <= 0
        assert "SortMergeJoin" not in late._jdf.queryExecution().sparkPlan().toString()
        assert early.dtypes == late.dtypes and Counter(map(tuple, early.collect())) == Counter(map(tuple, late.collect()))
        assert Counter(map(tuple, early.select("AWB", "NOREF", "GROUPING_SHIPPER", "ZONA", "REASON RETURN").collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
