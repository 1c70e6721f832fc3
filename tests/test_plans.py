"""Whole-report rules: what is read, whose row wins, and what a second run does."""

from datetime import date, datetime

from pyspark.sql import functions as F

from shipreport.operators import pivots, runstate
from shipreport.plans.monthly import newest_rows
from shipreport.plans.registry import Context
from shipreport.plans.report import ReportConfig, build_report, write_report
from shipreport.sinks.outputs import append_snapshot
from shipreport.sources.shipments import month_extract_paths, read_month_csv, write_shipments

DAY = date(1998, 7, 15)


def master(spark, extra=0):
    rows = [(f"A{i}", " '12 " if i % 2 else "12", datetime(1998, 7, 1 + i), datetime(1998, 7, 10), "Undel", "Regional Jawa Barat") for i in range(6)]
    df = spark.createDataFrame(rows, "AWB string, ID_ACCOUNT string, TGL_ENTRY timestamp, TGL_TARIK_REPORT timestamp, STATUS_POD string, REGIONAL string")
    return df.withColumns({f"C{i}": F.lit(str(i)) for i in range(extra)}) if extra else df


def config(**more):
    return ReportConfig.from_dict({"group_name": "G", "id_account": ["'12"], "period": "year", "selected_cols": ["AWB", "STATUS_POD", "REGIONAL"], **more})


def test_report_reads_what_it_needs(spark, tmp_path):
    master(spark, 60).write.parquet(str(tmp_path / "m"))
    rows = build_report(spark.read.parquet(str(tmp_path / "m")), config(filters=["C7", "equals", "7"]), Context(DAY))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: struct<", 1)[1].split(">", 1)[0]
    read = {c.split(":")[0] for c in schema.split(",")}
    assert "C7" in read and not read & {f"C{i}" for i in range(60) if i != 7}
    assert rows.count() == 6 and {"AWB", "STATUS_POD", "REGIONAL"} <= read


def test_padded_accounts_stay(spark):
    listed = build_report(master(spark), config(), Context(DAY)).count()
    table = spark.createDataFrame([("12",)], "account_id string")
    assert listed == build_report(master(spark), config(id_account=[]), Context(DAY), accounts=table).count() == 6


def test_account_ids_are_stored_in_one_spelling(spark, tmp_path):
    write_shipments(master(spark).withColumn("CATEGORY", F.lit("RETAIL")), str(tmp_path / "m"))
    assert {r[0] for r in spark.read.parquet(str(tmp_path / "m")).select("ID_ACCOUNT").collect()} == {"'12"}


def test_first_row_of_a_reference_wins(spark):
    projects = spark.createDataFrame([("12", "ZETA", "G", "RETAIL"), ("12", "ALFA", "G", "RETAIL")], "CUST_ID string, CUST_NAME string, BIG_GROUPING_CUST string, CATEGORY string").coalesce(1)
    rows = build_report(master(spark), config(selected_cols=["AWB", "CUST_NAME"]), Context(DAY, {"project_reference": projects}))
    assert {r.CUST_NAME for r in rows.collect()} == {"ZETA"}


def test_status_without_codes(spark):
    assert {r.STATUS_POD for r in build_report(master(spark), config(), Context(DAY)).collect()} == {"Undel"}


def test_snapshot_of_a_second_run(spark, tmp_path):
    path = str(tmp_path / "s")
    for day, rows in ((DAY, 6), (date(1998, 7, 16), 3), (DAY, 4)):
        append_snapshot(master(spark).limit(rows), path, "r", day)
    found = {(str(r.as_of), r.n) for r in spark.read.parquet(path).collect()}
    assert found == {("1998-07-15", 4), ("1998-07-16", 3)}


def test_snapshot_of_many_reports_is_one_folder_a_day(spark, tmp_path):
    path = str(tmp_path / "s")
    first = spark.range(1200).selectExpr("if(id % 300 = 7, null, concat('r', id % 300)) as name", "if(id % 2 = 0, 'Success', 'Undel') as STATUS_POD")
    append_snapshot(first, path, F.col("name"), DAY)
    append_snapshot(first.where("name is null or name in ('r1', 'r2')").limit(5), path, F.col("name"), DAY)
    rows = {(r.report, r.status): r.n for r in spark.read.parquet(path).collect()}
    assert len([x for x in (tmp_path / "s").rglob("*") if x.is_dir()]) == 1
    assert len({r for r, _ in rows}) == 300 and sum(rows.values()) == 297 * 4 + 5 and rows["r8", "Success"] == 4


def test_closed_first_spreads_one_status(spark):
    from shipreport.plans.report import closed_first

    df = spark.range(0, 40_000, 1, 8).selectExpr("cast(id as string) as AWB", "if(id % 10 = 0, 'Success', 'Undel') as STATUS_POD", "if(id % 10 = 0, 'x', '') as IS_CLOSE")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = closed_first(df)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        rows = out.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 10_000 and [r.IS_CLOSE for r in rows] == ["x"] * 4_000 + [""] * 36_000


def test_marked_keys(spark):
    old = spark.createDataFrame([("a", "1998-07-01"), ("b", "1998-07-15")], "key string, processed string")
    keys = spark.createDataFrame([("a",), ("c",), ("c",)], "key string")
    assert sorted(map(tuple, runstate.marked_processed(old, keys, DAY).collect())) == [("a", "1998-07-15"), ("b", "1998-07-15"), ("c", "1998-07-15")]


def test_wide_pivot_of_many_members(spark):
    df = spark.range(1500).select(F.lit("r").alias("r"), F.concat(F.lit("m"), "id").alias("c"), F.col("id").alias("n"))
    wide = pivots.pivot_wide(df, pivots.Pivot("p", ["r"], ["c"], [pivots.Measure("n", "sum", "n")]))
    assert len(wide.columns) == 1501 and wide.first()["m1499"] == 1499


def test_members_that_read_alike_stay_apart(spark):
    df = spark.createDataFrame([("r", None, 1), ("r", "(blank)", 2), ("r", "x", 3)], "r string, c string, n long")
    row = pivots.pivot_wide(df, pivots.Pivot("p", ["r"], ["c"], [pivots.Measure("n", "sum", "n")])).first().asDict()
    assert row == {"r": "r", "(blank)": 1, "(blank) (2)": 2, "x": 3}


def test_monthly_files_with_other_headers(spark, tmp_path):
    folder = tmp_path / "1998" / "07. JULI 1998" / "CATEGORY" / "RETAIL"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("AWB,STATUS,TGL_ENTRY\n1,x,30-Jun-1998 07:00\n")
    (folder / "b.csv").write_text("STATUS,AWB,TGL_ENTRY,TGL_TARIK_REPORT\ny,1,05-Jul-1998 08:00,06-Jul-1998 09:30\n")
    paths = month_extract_paths(str(tmp_path), "JULI", "RETAIL", DAY)
    rows = read_month_csv(spark, paths)
    assert sorted((r.AWB, r.STATUS) for r in rows.collect()) == [("1", "x"), ("1", "y")]
    newest = newest_rows(rows).collect()
    assert [(r.STATUS, r.TGL_ENTRY) for r in newest] == [("y", datetime(1998, 7, 5, 8))]


def test_written_files_are_in_order(spark, tmp_path):
    rows = build_report(master(spark).orderBy(F.rand(1)), config(selected_cols=["AWB", "TGL_ENTRY", "STATUS_POD", "IS_CLOSE"]), Context(DAY))
    write_report(rows, config(), str(tmp_path / "o"))
    for part in (tmp_path / "o").rglob("*.parquet"):
        dates = [r.TGL_ENTRY for r in spark.read.parquet(str(part)).collect()]
        assert dates == sorted(dates)


def test_combined_children_from_one_scan(spark, tmp_path):
    from shipreport.plans.report import build_reports_together

    rows = [(f"A{i % 9}", ["12", " '13 ", "14"][i % 3], datetime(1998, 1 + i % 7, 1 + i % 20), datetime(1998, 7, 10 + i % 3),
             ["Undel", "Success", None][i % 3], ["Regional Jawa Barat", "Bali", None][i % 2]) for i in range(60)]
    rows += [rows[0], rows[1]]  # repeated rows tie on every column
    spark.createDataFrame(rows, "AWB string, ID_ACCOUNT string, TGL_ENTRY timestamp, TGL_TARIK_REPORT timestamp, STATUS_POD string, REGIONAL string").write.parquet(str(tmp_path / "m"))
    source = spark.read.parquet(str(tmp_path / "m"))
    table = spark.createDataFrame([("13",), ("14",)], "account_id string")
    configs = [config(), config(group_name="H", id_account=[], period="last_n_months", jumlah_bulan=2),
               config(group_name="K", id_account=[], selected_statuses=["Undel"], filters=["REGIONAL", "contains", "jawa"]),
               config(group_name="L", id_account=["'14", "12"], selected_cols=["AWB", "TGL_ENTRY"])]
    accounts = {"H": table, "K": table}
    together = build_reports_together(source, configs, Context(DAY), accounts=accounts)
    for c in configs:
        alone = build_report(source, c, Context(DAY), accounts=accounts.get(c.name))
        assert sorted(map(tuple, together[c.name].collect())) == sorted(map(tuple, alone.collect())), c.name
    # the master was read by the one job that stored the tagged rows; no report reads it again
    for c in configs:
        assert str(tmp_path / "m") not in together[c.name]._jdf.queryExecution().executedPlan().toString()


def test_reports_of_one_name_stay_apart(spark):
    from shipreport.plans.daily import open_configs

    criteria = [{"group_name": "BIG", "period": "year"}, {"group_name": "BIG", "period": "last_n_months", "jumlah_bulan": 2},
                {"groups_name": "BOOK1", "reports": [{"group_name": "BIG"}]}, {"groups_name": "BOOK2", "reports": [{"group_name": "BIG"}]},
                {"group_name": "DONE"}]
    ledger = spark.createDataFrame([("DONE", DAY.isoformat()), ("BIG #2", "1998-07-01")], "key string, processed string")
    keyed = open_configs(spark, criteria, ledger, Context(DAY))
    assert [k for k, _ in keyed] == ["BIG", "BIG #2", "BOOK1/BIG", "BOOK2/BIG"]
    assert [c.period for _, c in keyed][:2] == ["year", "last_n_months"]


def test_newest_rows_over_the_bucketed_master_need_no_shuffle(spark):
    import uuid

    from shipreport.operators.dedup import latest_per_key
    from shipreport.sources.shipments import write_bucketed_shipments

    name = f"master_{uuid.uuid4().hex}"
    rows = master(spark).withColumn("CATEGORY", F.lit("RETAIL")).unionByName(master(spark).withColumn("CATEGORY", F.lit("BANK")))
    write_bucketed_shipments(rows, name, buckets=4)
    newest = latest_per_key(spark.table(name), "AWB", "TGL_TARIK_REPORT", tie_break=[F.col("CATEGORY")])
    assert "Exchange" not in newest._jdf.queryExecution().executedPlan().toString()
    assert newest.count() == 6
    wanted = spark.table(name).where(F.col("ID_ACCOUNT") == "'12")
    assert "PushedFilters: [IsNotNull(ID_ACCOUNT), EqualTo(ID_ACCOUNT,'12)]" in wanted._jdf.queryExecution().executedPlan().toString()
    assert wanted.count() == 12


def test_files_of_many_headers_in_one_scan(spark, tmp_path):
    from shipreport.operators.projection import normalise_headers
    from shipreport.sources.shipments import read_by_header

    heads = ["AWB,Status,amount", "awb, STATUS ,Extra", "awb,,awb"]
    for k in range(12):
        head = heads[k % 3]
        body = "\n".join(f"a{k}{i},s{i},{i if i % 2 else ''}" for i in range(5))
        (tmp_path / f"f{k:02d}.csv").write_text(f"{head}\n{body}\n\n")
    got = read_by_header(spark, [str(tmp_path / "*.csv")], source="_src")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 2 and "FileScan csv" not in plan  # first lines, then all rows: not one scan a header
    want = None
    for head in sorted(heads):
        files = [str(tmp_path / f"f{k:02d}.csv") for k in range(12) if heads[k % 3] == head]
        read = normalise_headers(spark.read.csv(files, header=True))
        want = read if want is None else want.unionByName(read, allowMissingColumns=True)
    assert got.columns[:-1] == want.columns
    assert sorted(map(tuple, got.drop("_src").collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
