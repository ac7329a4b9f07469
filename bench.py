"""Time the registered queries and print one JSON line.

Folder from BENCH_SF_DIR, threads from BENCH_CPUS. Each query runs once to warm up and then
BENCH_RUNS times (default 2), every row being produced and thrown away; the median counts.
The headline queries run by default; `all`, or names that queries start with, choose others.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from snapstats.plans.registry import queries  # noqa: E402
from snapstats.session import build_session  # noqa: E402


HEADLINE = (
    "r", "v01", "p02", "p03", "p12", "p15", "p18", "p19_dry_run", "m02", "m05", "m06", "m08", "m10", "m14_purge_rest",
    "s03", "s04", "s06_sync_report", "x02", "x07", "x08", "x10", "x11", "x12", "q01", "q03",
)


def seconds(spark, build, folder: str) -> float:
    start = time.perf_counter()
    build(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    prefixes = () if "all" in sys.argv[1:] else tuple(sys.argv[1:]) or HEADLINE
    times = {}
    for name, build in queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        seconds(spark, build, folder)
        times[name] = round(statistics.median(seconds(spark, build, folder) for _ in range(runs)), 4)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "runs": runs}))


if __name__ == "__main__":
    main()
