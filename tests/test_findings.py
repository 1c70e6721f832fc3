"""The finding on the monthly workbook: the lines are not dealt out for the codes."""

from pyspark.sql import functions as F

from queries.outputs import _BOOK
from shipreport.plans.workbook import workbook


def test_workbook_codes_are_known_to_be_few(spark):
    times, numbers = {"TGL_ENTRY", "TGL_RECEIVED", "DATE_1ST_ATTEMPT"}, F.col("id").cast("string")
    df = spark.range(1000).select(*[(F.timestamp_seconds("id") if c in times else numbers).alias(c) for c in _BOOK], F.lit("Undel").alias("Status_Update"))
    many = spark.range(100_000)
    shippers = many.select(numbers.alias("CUST_ID_2"), numbers.alias("CUST_NAME_GROUPING"))
    zones = many.select(*[numbers.alias(c) for c in ("DEST", "3 LC", "NAMA KAB/KOTA 2", "REGION", "ZONA")])
    codes = many.select((F.col("id") % 10).cast("string").alias("Coding Undel"), F.concat(F.lit("r"), (F.col("id") % 10).cast("string")).alias("Remark_English"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        out = workbook(df, shippers, zones, codes)
        assert out._jdf.queryExecution().sparkPlan().toString().count("BroadcastHashJoin") == 1
        assert {r["AWB"]: r["REASON RETURN"] for r in out.where("AWB in ('3', '12')").collect()} == {"3": "r3", "12": None}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
