"""Runs registered queries in Spark and their SQL in DuckDB and compares the values.

Usage: python tests/compare.py [--sf 0.01] [--plain] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import datetime
import math
import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tallyworks.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat(" ")
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=lambda r: [(v is not None, str(type(v)), v if v is not None else 0) for v in r])


def database(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def compare(spark, con, folder, name, fn, sql):
    df = fn(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return len(rows) > 0, f"{len(rows)} rows, no SQL; {df.dtypes}"
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want = cur.fetchall()
    a, b = sorted_rows(df.columns, rows), sorted_rows(want_names, want)
    if a[0] != b[0]:
        return False, f"columns {a[0]} / {b[0]}"
    if len(a[1]) != len(b[1]):
        return False, f"rows {len(a[1])} / {len(b[1])}: {a[1][:2]} / {b[1][:2]}"
    for x, y in zip(a[1], b[1]):
        if x != y:
            return False, f"values\n   spark {x}\n   sql   {y}"
        for p, q in zip(x, y):
            if type(p) is not type(q) and p is not None and q is not None:
                return False, f"types {x} {y}"
    return True, f"{len(rows)} rows"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--plain", action="store_true", help="a session with Spark's own defaults, far from UTC")
    parser.add_argument("prefixes", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    quiet = {"spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    if args.plain:
        builder = SparkSession.builder.master("local[8]").config("spark.sql.session.timeZone", "America/New_York")
        for key, value in quiet.items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
    else:
        spark = build_session("compare", "local[8]", **quiet, **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    sqls, bad, total = entry.oracle_sql(), [], 0
    for name, fn in entry.queries().items():
        if args.prefixes and not any(name.startswith(p) for p in args.prefixes):
            continue
        total += 1
        start = time.time()
        try:
            ok, note = compare(spark, con, folder, name, fn, sqls.get(name))
        except Exception as error:  # noqa: BLE001
            text = str(error)
            ok, note = False, text[:600] if "JVM" in text or "[" in text[:3] else text[:600] + traceback.format_exc()[-500:]
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note[:700]}", flush=True)
        if not ok:
            bad.append(name)
    print(f"{total - len(bad)} of {total} good; failing: {bad}")
    return len(bad)


if __name__ == "__main__":
    sys.exit(main())
