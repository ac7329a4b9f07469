"""Run the registered queries against their SQL and compare whole results.

    python tools/check_queries.py [folder] [name prefix ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from snapstats.plans.driver_tables import BASE_TABLES  # noqa: E402
from snapstats.plans.registry import oracle_sql, queries  # noqa: E402
from snapstats.session import build_session  # noqa: E402

NAMES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, folder: str, name: str, build, sql: str | None) -> str:
    start = time.time()
    df = build(spark, folder)
    got = [tuple(r) for r in df.collect()]
    took = f"{time.time() - start:.1f}s"
    if sql is None:
        return f"rows-only {len(got)} {took}"
    con = duckdb.connect()
    for table in BASE_TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    described = con.execute(f"describe {sql}").fetchall()
    types = {d[0]: d[1] for d in described}
    want = con.execute(sql).fetchall()
    con.close()
    if sorted(types) != sorted(df.columns):
        return f"FAIL columns {sorted(df.columns)} / {sorted(types)}"
    notes = [f"{c}:{t}/{types[c]}" for c, t in df.dtypes if NAMES.get(t, t) != types[c]]
    a, b = rows_of(got, df.columns), rows_of(want, list(types))
    if a != b:
        left, right = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        return f"FAIL rows {len(a)}/{len(b)} spark-only {left} sql-only {right} columns {sorted(df.columns)}"
    return f"ok {len(a)} rows {took}" + (f" types differ: {notes}" if notes else "")


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = build_session("check", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    sqls, failed = oracle_sql(), 0
    for name, build in queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        try:
            result = compare(spark, folder, name, build, sqls.get(name))
        except Exception as error:
            result = f"FAIL {type(error).__name__}: {str(error)[:1500]}"
        failed += result.startswith("FAIL")
        print(f"{name:34s} {result}", flush=True)
    print(f"{failed} failed")
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
