"""Run registered queries on Spark and their SQL on DuckDB and compare every value.

    python tools/compare.py [--sf 0.01] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import pathlib
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0 if value else 0.0)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return "<null>" if value is None else str(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = sorted(tuple(canonical(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], body


def compare(spark, con, name, query, sql, sf_dir):
    """An error text, or None when both sides give the same table."""
    frame = query(spark, sf_dir)
    got_columns, got = table_of(frame.columns, [tuple(r) for r in frame.collect()])
    if sql is None:
        return None, len(got)
    result = con.execute(sql)
    wanted_columns, wanted = table_of([c[0] for c in result.description], result.fetchall())
    if got_columns != wanted_columns:
        return f"columns {got_columns} != {wanted_columns}", len(got)
    if len(got) != len(wanted):
        return f"rows {len(got)} != {len(wanted)}", len(got)
    different = [(a, b) for a, b in zip(got, wanted, strict=True) if a != b]
    if different:
        a, b = different[0]
        return f"{len(different)} of {len(got)} rows differ, first\n  spark {a}\n  sql   {b}", len(got)
    return None, len(got)


def main():
    from pyspark.sql import SparkSession

    from keelstone import catalog

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sqls = catalog.all_queries(), catalog.all_sql()
    bad = 0
    for name, query in queries.items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            error, rows = compare(spark, con, name, query, sqls.get(name), sf_dir)
        except Exception as exc:
            error, rows = f"{type(exc).__name__}: {str(exc)[:600]}", -1
        bad += error is not None
        mark = "ok " if error is None else "BAD"
        note = "" if name in sqls else " (no sql)"
        print(f"{mark} {name:28s} {rows:7d} rows {time.time() - start:6.2f}s{note}", flush=True)
        if error:
            print("    " + error, flush=True)
    print("failures:", bad)
    sys.exit(bad > 0)


if __name__ == "__main__":
    main()
