"""Run registered queries beside their SQL: ``python -m workload.check [folder] [name ...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from workload.queries import ORACLES, QUERIES
from workload.views import TABLES


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="workload-check-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(folder: str, names: list[str]) -> int:
    spark = session()
    base = duckdb.connect()
    for table in TABLES:
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    failures = 0
    for name in names or list(QUERIES):
        began = time.time()
        try:
            frame = QUERIES[name](spark, folder)
            got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
        except Exception as exc:
            failures += 1
            print(f"ERROR {name}: {str(exc)[:600]}", flush=True)
            continue
        took = time.time() - began
        if name not in ORACLES:
            print(f"rows  {name}: {sum(got.values())} rows, {took:.1f}s", flush=True)
            continue
        began = time.time()
        try:
            cursor = base.execute(ORACLES[name])
        except duckdb.Error as exc:
            failures += 1
            print(f"SQL   {name}: {str(exc)[:600]}", flush=True)
            continue
        columns = [d[0] for d in cursor.description]
        want = rows_of(columns, cursor.fetchall())
        same = got == want and sorted(columns) == sorted(frame.columns)
        failures += not same
        print(
            f"{'ok   ' if same else 'DIFF '} {name}: {sum(got.values())} rows, {took:.1f}s, sql {time.time() - began:.1f}s",
            flush=True,
        )
        if not same:
            print("   columns", sorted(frame.columns), sorted(columns))
            print("   extra", sum((got - want).values()), list((got - want).items())[:3])
            print("   lacking", sum((want - got).values()), list((want - got).items())[:3])
    return failures


if __name__ == "__main__":
    arguments = sys.argv[1:]
    place = arguments.pop(0) if arguments and os.path.isdir(arguments[0]) else "/root/testdata/sf0.01"
    raise SystemExit(main(place, arguments))
