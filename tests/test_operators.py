"""Operators on small rows, hot keys included, and what their plans must show."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shipreport.functions.text import col
from shipreport.operators import asof, dedup, listjoin, lookups, overrides, pivots
from shipreport.operators.numbering import number_rows
from shipreport.plans import periods, registry, report
from shipreport.plans.presets import PRESETS
from shipreport.sinks import outputs
from shipreport.sources import shipments as source

DAY = dt.date(1998, 7, 15)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_row_keeps_one_per_task_before_the_shuffle(spark, sf_dir):
    text = plan(entry.queries()["latest_per_key"](spark, sf_dir))
    partial, final = text.index("row_number(), 1, Partial"), text.index("row_number(), 1, Final")
    assert final < text.index("Exchange") < partial


def test_date_window_reaches_the_scan(spark, sf_dir):
    text = plan(entry.queries()["scan_filtered"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01" in text and "LessThan(o_orderdate,1999-01-01" in text


def test_period_scan_prunes_folders(spark, sf_dir):
    df = entry.queries()["scan_period"](spark, sf_dir)
    assert {(r.tahun, r.bulan, r.p_category) for r in df.collect()} <= {("1998", m, "BANK") for m in ("04", "05", "06")}
    assert "PartitionFilters: [" in plan(df) and "p_category" in plan(df).split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("name", ["ids_by_name_theta", "category_lookup", "report_end_to_end", "dest_lookup", "pivot_pct_total"])
def test_no_cross_joins(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text


def test_newest_row_with_a_hot_key(spark):
    rows = [(None if i % 3 == 0 else str(i % 50), None if i % 7 == 0 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), i)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "AWB string, TGL_TARIK_REPORT timestamp, i long").repartition(8)
    got = {r.AWB: r.i for r in dedup.latest_per_key(df).collect()}
    want = {}
    for awb, at, i in rows:
        if awb not in want or (at or dt.datetime.min, i) > want[awb]:
            want[awb] = (at or dt.datetime.min, i)
    assert got == {k: v[1] for k, v in want.items()}


def test_numbers_restart_per_output_and_survive_a_hot_output(spark):
    rng = random.Random(1)
    rows = [("big" if i % 3 else rng.choice(["a", "b", None]), rng.randrange(40), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "out string, k long, i long").repartition(8)
    got = number_rows(df, [col("k").asc(), col("i").asc()], per=["out"]).collect()
    for name in {"big", "a", "b", None}:
        want = sorted((k, i) for o, k, i in rows if o == name)
        assert [(r.k, r.i) for r in sorted((r for r in got if r.out == name), key=lambda r: r.NO)] == want
        assert sorted(r.NO for r in got if r.out == name) == list(range(1, len(want) + 1))


def test_forward_fill_against_brute_force(spark):
    rng = random.Random(2)
    codes = {(rng.choice(["CKR", "AB"]) + str(rng.randrange(40_000))): (str(i) if rng.random() < 0.05 else None) for i in range(1500)}
    codes["odd code"] = None
    df = spark.createDataFrame(list(codes.items()), "code string, zip string")
    got = {r.code: r.zip for r in asof.fill_forward(df, "code", "zip").collect()}
    split = lambda c: (c.rstrip("0123456789"), int(c.lstrip("ABCKR")))
    known = sorted((*split(c), z) for c, z in codes.items() if z)
    for c, z in codes.items():
        if c == "odd code":
            assert got[c] is None
            continue
        prefix, num = split(c)
        assert got[c] == (z or next((v for p, n, v in known if p == prefix and n >= num), None)), c


def test_zip_of_a_code_the_zone_table_lacks(spark):
    zones = spark.createDataFrame(
        [("CKR10001", "k1", "n", "p", None), ("CKR10020", "k2", "n", "p", "17530.0"), ("CKR10021", "k3", "n", "p", "0"),
         ("CKR10020", "zz", "n", "p", "9")], "DEST string, KECAMATAN string, `NAMA KAB/KOTA` string, PROVINSI string, `KODE POS` string")
    fact = spark.createDataFrame([(" ckr10000",), ("CKR10001",), ("CKR10021",), (None,), ("XX",)], "DEST string")
    got = {r.DEST: (r.KECAMATAN, r["KODE POS"]) for r in lookups.dest_lookup(fact, zones).collect()}
    assert got == {"CKR10000": (None, "17530"), "CKR10001": ("k1", "17530"), "CKR10021": ("k3", None), None: (None, None), "XX": (None, None)}


def test_ambiguous_reason_codes_are_an_error(spark):
    codes = spark.createDataFrame([("U01", "a"), ("U01", "b")], "`Coding Undel` string, Remark_Bahasa string")
    fact = spark.createDataFrame([("U01",)], "RESULT_1ST_ATTEMPT string")
    with pytest.raises(Exception, match="more than once"):
        lookups.attempt_reason(fact, codes, "RESULT_1ST_ATTEMPT").collect()
    with pytest.raises(ValueError):
        lookups.undelivered_reason(fact, codes.drop("Remark_Bahasa"))


def test_list_join_keeps_every_list_row(spark):
    listing = spark.createDataFrame([(None, 1), (" ", 2), ("'a 1", 3), ("A1", 4), ("zz", 5)] + [(None, i) for i in range(100, 400)],
                                    "KEY string, n long")
    master = spark.createDataFrame([("a1", "x"), (None, "never"), ("", "never")], "AWB string, v string")
    got = listjoin.join_customer_list(listing, master, ("KEY", "AWB")).collect()
    assert sorted(r.n for r in got) == sorted([1, 2, 3, 4, 5, *range(100, 400)])
    assert {r.n for r in got if r.v} == {3, 4} and {r.v for r in got} == {None, "x"}
    with pytest.raises(ValueError):
        listjoin.join_customer_list(listing, master, ("NOPE", "AWB"))


def test_patch_takes_the_first_filled_cell(spark):
    table = spark.createDataFrame([(1, "'A 1", "", "9"), (2, "a1", "Undel", "nan"), (3, "<NA>", "x", "1")],
                                  "row_idx long, AWB string, STATUS_POD string, AMOUNT string")
    df = spark.createDataFrame([("A1", "Success", "Success", 5), ("B", None, None, 6)],
                               "AWB string, STATUS_POD string, STATUS_POD_UPDATE string, AMOUNT long")
    got = {r.AWB: tuple(r)[1:] for r in overrides.apply_patches(df, overrides.patches(table)).collect()}
    assert got == {"A1": ("Undel", "Undel", 9), "B": (None, None, 6)}


def test_shares_sum_to_one_and_totals_match(spark):
    rows = [(random.Random(i).choice(["a", "b", None]), random.Random(i + 9).choice(["x", "y"]), str(i), i) for i in range(500)]
    df = spark.createDataFrame(rows, "r string, c string, AWB string, n long")
    for of, keys in (("row", ["r"]), ("column", ["c"]), ("total", [])):
        spec = pivots.Pivot("p", ["r"], ["c"], [pivots.Measure("AWB", "count", "share", of), pivots.Measure("n", "avg", "mean")])
        sums = pivots.pivot_long(df, spec).groupBy(*keys).agg(F.sum("share").alias("s")).collect()
        assert all(abs(r.s - 1) < 1e-9 for r in sums)
    totals = pivots.pivot_totals(df, pivots.Pivot("p", ["r"], ["c"], [pivots.Measure("AWB", "count", "n")]))
    assert [r.n for r in totals.where("row_level = 0 and column_level = 0").collect()] == [500]
    with pytest.raises(ValueError):
        pivots.pivot_wide(df, pivots.Pivot("p", ["r"], ["AWB"], [pivots.Measure("n", "sum", "n")]), limit=10)


def test_preset_config_round_trip():
    assert (len(PRESETS), sum(map(len, PRESETS.values()))) == (18, 42)
    spec = pivots.Pivot.from_config({
        "name": "p", "rows": ["a"], "columns": [], "filters": ["x", {"field": "s", "value": "Undel"}], "hide_blank": True,
        "values": [{"field": "AWB", "func": "count", "name": "n", "as_percentage": True}], "sort": {"row": "a", "by": "n"}})
    assert spec.values[0].percent_of == "row" and spec.filters == [("s", "Undel")] and spec.sort == ("n", "desc")


def test_periods():
    d = dt.date
    assert periods.period_window("year", None, DAY) == (d(1998, 1, 1), d(1999, 1, 1))
    assert periods.period_window("previous_months", None, DAY) == (d(1998, 5, 1), d(1998, 7, 1))
    assert periods.period_window("month_range", 8, DAY) == (d(1997, 12, 1), d(1998, 7, 16))
    assert periods.month_table_window(2, dt.datetime(1998, 7, 15, 9, 30)) == (dt.datetime(1998, 6, 1, 9, 30), dt.datetime(1998, 8, 1, 9, 30))
    assert [periods.splits_by_month("last_months", x) for x in (None, "off", True)] == [False, False, True]
    assert source.months_between(d(1997, 12, 1), d(1998, 2, 1)) == [(1997, 12), (1998, 1)]
    assert source.months_since("Desember", DAY) == 8 and source.months_since("may", DAY) == 3
    assert source.months_back(d(1998, 2, 1), 3) == [(1997, 12), (1998, 1), (1998, 2)]


def test_combined_configs_inherit():
    out = report.expand_combined([{"groups_name": "G", "period": "year", "reports": [{"group_name": "A"}, {"group_name": "B", "period": "x"}]},
                                  {"group_name": "C"}])
    assert [(c["group_name"], c.get("period"), c.get("move_to_sheet_of_file")) for c in out] == [
        ("A", "year", "G"), ("B", "x", "G"), ("C", None, None)]
    with pytest.raises(ValueError):
        report.expand_combined([{"reports": [{}]}])
    with pytest.raises(ValueError):
        report.ReportConfig.from_dict({})


def test_derivations_run_after_their_inputs():
    names = [d.name for d in registry.needed_for(["IS_CLOSE", "GROUPING_LATE", "CARRER_POD", "STATUS_POD", "AJ Car Status", "PROVINSI", "LEAD TIME"])]
    for earlier, later in (("client_status", "short_status"), ("short_status", "closed"), ("aging", "delay"), ("destination", "template")):
        assert names.index(earlier) < names.index(later)
    assert [d.name for d in registry.needed_for(["STATUS_POD"])] == ["short_status"]


def test_missing_inputs_and_references_are_errors(spark):
    df = spark.createDataFrame([("a",)], "AWB string")
    with pytest.raises(ValueError, match="needs the columns"):
        registry.derive_columns(df, ["WILAYAH"], registry.Context(DAY))
    with pytest.raises(ValueError, match="not given"):
        registry.derive_columns(df.withColumn("DEST", F.lit("x")), ["WILAYAH"], registry.Context(DAY))


def test_every_derivation_runs(spark, sf_dir):
    """All registered columns in one report, over references of the given tables."""
    from queries import derived, master

    columns = [c for c in master.COLUMNS if c not in ("NATION_ACCOUNT",)]
    df = master.shipments(spark, sf_dir, *columns)
    undel = master.undel_codes(spark, sf_dir).distinct()
    ctx = registry.Context(DAY, {
        "zone": master.zones(spark, sf_dir), "undel_code": undel, "status_code": master.status_codes(spark, sf_dir),
        "status_map": master.status_map(spark, sf_dir), "area_sla": master.area_table(spark, sf_dir),
        "project_reference": master.projects(spark, sf_dir)}, derived.CALENDAR)
    wanted = [c for d in registry.REGISTRY.values() if d.name != "pickups" for c in d.outputs]
    out = registry.derive_columns(df, wanted, ctx)
    assert set(wanted) <= set(out.columns)
    assert out.select(*[col(c) for c in dict.fromkeys(wanted)]).count() == df.count()


def test_numbered_report(spark):
    rows = [(str(i % 40), dt.datetime(1998, 6, 1) + dt.timedelta(days=i % 44), "'1" if i % 2 else "2", "Undel", "x") for i in range(400)]
    df = spark.createDataFrame(rows, "AWB string, TGL_ENTRY timestamp, ID_ACCOUNT string, STATUS_POD string, CODING string")
    df = df.withColumn("NO", F.lit(0))
    config = report.ReportConfig.from_dict({"group_name": "g", "id_account": ["1", "'2"], "split_by_id": True, "jumlah_bulan": 2,
                                            "period": "month_range", "selected_cols": ["NO", "AWB", "STATUS_POD", "KOSONG"]})
    out = report.build_report(df, config, registry.Context(DAY)).collect()
    assert out[0].__fields__ == ["NO", "AWB", "STATUS_POD", "INSURANCE_ID", "KOSONG", "output_label"]
    for label in ("1", "2"):
        assert sorted(r.NO for r in out if r.output_label == label) == list(range(1, 21))


def test_split_keeps_rows_without_a_label(spark, tmp_path):
    df = spark.createDataFrame([("a/b", 1), (None, 2), ("a/b", 3)], "v string, n long")
    outputs.write_split(df, str(tmp_path / "o"), outputs.split_labels("d", by_column="v"))
    got = {r.output_label: r.n_rows for r in outputs.manifest(spark, str(tmp_path / "o"), ["output_label"]).collect()}
    assert got == {"a-b": 2, None: 1}


def test_month_folder_layout(spark, tmp_path):
    for month in (5, 6):
        spark.createDataFrame([(month,)], "m int").write.parquet(source.month_folder(str(tmp_path), 1998, month, "RETAIL"))
    got = source.scan_month_folders(spark, str(tmp_path), dt.date(1998, 6, 1), dt.date(1998, 8, 1), "RETAIL")
    assert [r.m for r in got.collect()] == [6]


def test_table_encodings(spark, tmp_path):
    from shipreport.sources.references import read_table

    for name, encoding in (("utf", "utf-8"), ("latin", "latin-1")):
        (tmp_path / f"{name}.csv").write_text("CUST_ID , NAMA\n1,café  \n2,\n", encoding=encoding)
        rows = read_table(spark, str(tmp_path / f"{name}.csv"), ["CUST_ID", "NAMA"]).collect()
        assert [tuple(r) for r in rows] == [("1", "café"), ("2", None)]
    with pytest.raises(ValueError):
        read_table(spark, str(tmp_path / "utf.csv"), ["CATEGORY"])


def test_aging_uses_the_spelling_the_table_has(spark):
    from shipreport.functions.derive import aging_flags
    from shipreport.functions.workdays import WorkCalendar

    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("success", at, at + dt.timedelta(days=2), at + dt.timedelta(days=9), 3, None), ("Undel", at, at, at, 3, "kept?")],
        "STATUS_POD string, TGL_ENTRY timestamp, `1ST ATTEMPT` timestamp, TGL_RECEIVED timestamp, ETD long, `CARRER POD` string")
    good, other = aging_flags(df, WorkCalendar()).collect()
    assert (good["AGING_1ST"], good["CAREER_1ST"], good["AGING_POD"], good["CARRER POD"]) == (3, "Ontime SLA", 8, "Over SLA")
    assert (other["1ST ATTEMPT"], other["AGING_POD"], other["CARRER POD"]) == (None, None, None)


def test_list_columns_win_when_asked(spark):
    listing = spark.createDataFrame([("1", "list")], "AWB string, v string")
    master = spark.createDataFrame([("1", "master", 2)], "AWB string, v string, n long")
    for wins, want in ((False, "master"), (True, "list")):
        row = listjoin.join_customer_list(listing, master, ("AWB", "AWB"), list_wins=wins).first()
        assert (row.AWB, row.v, row.n) == ("'1", want, 2)


def test_checkpoint_folder_comes_from_the_session(spark):
    from shipreport.session import fresh_path

    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    path = fresh_path(spark, "x")
    assert folder is None or path.startswith(folder.rstrip("/"))
    assert path != fresh_path(spark, "x")


def test_accounts_by_pattern_equals_full_regex_and_has_no_product(spark):
    from shipreport.operators import lookups

    names = ["Acme Tools", "ACME tools jaya", "Bumi Raya", " ", None, "Toko A.B", "PT Sinar#12", "sinar#99"]
    projects = spark.createDataFrame([(i, f"'{100 + i}", n) for i, n in enumerate(names)] + [(50, None, "Acme"), (51, "'151", "Acme Tools")],
                                     "row_idx long, CUST_ID string, CUST_NAME string")
    patterns = ["acme", "^ACME TOOLS$", "A\\.B", "SINAR#\\d+", "(BUMI|TOKO)", "x{0,2}raya", ".*", "^$", "nothing", None]
    got = lookups.accounts_by_pattern(projects, spark.createDataFrame([(p,) for p in patterns], "group_name string"))
    want = lookups.accounts_by_name(projects, [p for p in patterns if p is not None])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_accounts_of_reports_broadcast_no_account_table_or_name_index(spark, tmp_path):
    from shipreport.operators import lookups

    # a small file of many accounts: by its size alone Spark would broadcast what is made of it
    spark.range(20_000).selectExpr("id as row_idx", "concat('', id) as CUST_ID", "concat('Customer#', lpad(cast(id as string), 9, '0')) as CUST_NAME",
                                   "concat('G ', id % 50) as BIG_GROUPING_CUST").write.parquet(str(tmp_path / "p"))
    projects = spark.read.parquet(str(tmp_path / "p"))
    wanted = spark.createDataFrame([("G 3", None), ("CUSTOMER#00000012", None), ("G 4", "'7")], "group_name string, account_id string")
    groups = lookups.group_accounts(projects)
    unmatched = lookups.without_group(wanted.where("account_id is null").select("group_name"), groups)
    got = lookups.explicit_accounts(wanted, groups, lookups.accounts_by_pattern(projects, unmatched))
    rows = sorted(map(tuple, got.collect()))
    assert [r for r in rows if r[2] == "explicit"] == [("G 4", "'7", "explicit")]
    assert {r[1] for r in rows if r[2] == "group"} == {f"'{i}" for i in range(3, 20_000, 50)}
    assert {r[1] for r in rows if r[2] == "name"} == {f"'{i}" for i in range(120, 130)}
    fresh = lookups.explicit_accounts(wanted, groups, lookups.accounts_by_pattern(projects, unmatched))
    lines = fresh._jdf.queryExecution().sparkPlan().toString().split("\n")
    assert not [line for line in lines if "BroadcastHashJoin" in line or "NestedLoop" in line]


def test_packed_tables_are_not_broadcast_by_their_file_size(spark, tmp_path):
    from queries.master import shipments

    many = spark.range(0, 2_000_000, 1, 4)
    many.selectExpr("id as c_custkey", "'BUILDING' as c_mktsegment").write.parquet(str(tmp_path / "customer.parquet"))
    many.selectExpr("id as o_orderkey", "id as o_custkey", "id % 9 as o_x").write.parquet(str(tmp_path / "orders.parquet"))
    many.selectExpr("id as l_orderkey", "cast(1 as int) as l_linenumber").write.parquet(str(tmp_path / "lineitem.parquet"))
    df = shipments(spark, str(tmp_path), "AWB", "BIG_GROUPING_CUST")
    lines = df._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in lines
    joins = df._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[1:]
    assert "o_custkey" in joins[1].split("\n")[0]  # customers meet the orders below the join of the lines
