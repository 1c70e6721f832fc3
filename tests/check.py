"""Compare registered queries with their SQL twins: python tests/check.py [sf] [name ...]."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat() + "T00:00:00"
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return str(v)


def rows_of(records, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


def coarse(kind: str) -> str:
    kind = str(kind).lower()
    for word, group in (("list", "list"), ("[]", "list"), ("array", "list"), ("timestamp", "time"), ("date", "date"),
                        ("decimal", "float"), ("double", "float"), ("float", "float"), ("hugeint", "int"), ("int", "int"),
                        ("long", "int"), ("short", "int"), ("bool", "bool"), ("char", "text"), ("string", "text")):
        if word in kind:
            return group
    return kind


def compare(spark, con, name, make, sql, sf_dir):
    """Empty text when both sides agree, else what differs."""
    df = make(spark, sf_dir)
    got = rows_of([tuple(r) for r in df.collect()], df.columns)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = dict(zip(names, [coarse(d[1]) for d in result.description]))
    want = rows_of(result.fetchall(), names)
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(df.columns)} / {sorted(names)}"
    off = {f.name: (coarse(f.dataType.typeName()), kinds[f.name]) for f in df.schema
           if coarse(f.dataType.typeName()) != kinds[f.name]}
    note = f"types differ {off} " if off else ""
    if got != want:
        have, need = set(got), set(want)
        extra = [r for r in got if r not in need][:3]
        lost = [r for r in want if r not in have][:3]
        return f"{note}rows {len(got)} / {len(want)}; cols {sorted(names)}\n   spark only {extra}\n   sql only {lost}"
    return note


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0][0].isdigit() else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, bad, none = connect(sf_dir), 0, []
    oracle = entry.oracle_sql()
    for name, make in entry.queries().items():
        if args and not any(a in name for a in args):
            continue
        start = time.time()
        try:
            if name in oracle:
                said = compare(spark, con, name, make, oracle[name], sf_dir)
            else:
                said = ""
                none.append((name, make(spark, sf_dir).count()))
        except Exception as error:  # the check goes on with the next query
            said = f"{type(error).__name__}: {str(error)[:900]}"
        bad += bool(said)
        print(f"{'BAD ' if said else 'ok  '} {name} {time.time() - start:.1f}s {said}", flush=True)
    print(f"{bad} bad; without SQL: {none}")


if __name__ == "__main__":
    main()
