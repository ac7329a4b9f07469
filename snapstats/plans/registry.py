"""All registered queries: name to (Spark builder, checking SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from snapstats.plans import io_queries, maintenance_queries, planning_queries, report_queries, shaping_queries, store_queries
from snapstats.plans.driver_tables import DriverTables, with_views

GROUPS = [report_queries, planning_queries, maintenance_queries, shaping_queries, io_queries, store_queries]


def _entries() -> dict:
    return {name: entry for group in GROUPS for name, entry in group.QUERIES.items()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(build):
        return lambda spark, sf_dir: build(DriverTables(spark, sf_dir))
    return {name: runner(build) for name, (build, _) in _entries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for name, (_, sql) in _entries().items() if sql is not None}
