"""Carrying tables from one store to another, whole or by missing key."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapstats.functions.timeutil import AsOf, moment
from snapstats.operators.keyed import merge_by_key
from snapstats.schemas import PRIMARY_KEYS, SYNC_TABLES
from snapstats.session import shared_folder
from snapstats.sources.tables import append, publish

log = logging.getLogger(__name__)

RESULT_DDL = "table string, status string, source_count bigint, synced bigint, skipped bigint, error string"


def common_columns(source: DataFrame, destination: DataFrame) -> tuple[list[str], list[str]]:
    """Columns both sides have, in source order, and those the destination lacks."""
    have = set(destination.columns)
    return [c for c in source.columns if c in have], [c for c in source.columns if c not in have]


def count_rows(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("rows"))


def missing_rows(source: DataFrame, destination: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the destination lacks, in the common columns. Changed rows are not carried."""
    shared, _ = common_columns(source, destination)
    return source.select(*shared).join(destination.select(*keys), list(keys), "left_anti").select(*shared)


def full_merge(source: DataFrame, destination: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Destination with every common column taken from the source; columns it alone has are kept."""
    shared, missing = common_columns(source, destination)
    if missing:
        log.warning("columns missing in destination: %s", missing)
    return merge_by_key(destination, source.select(*shared), keys, [c for c in shared if c not in keys],
                        whole_table=True)


def sync_counts(table: str, source: DataFrame, destination: DataFrame, keys: Sequence[str],
                incremental: bool = False, dry_run: bool = False) -> DataFrame:
    """One row saying what a sync of this table moves: rows in the source, carried, left alone."""
    if dry_run:
        stored = count_rows(destination).scalar() if incremental else F.lit(0).cast("bigint")
        return source.agg(F.lit(table).alias("table"), F.lit("dry_run").alias("status"),
                          F.count(F.lit(1)).alias("source_count"), F.lit(0).cast("bigint").alias("synced"),
                          F.lit(0).cast("bigint").alias("skipped")).withColumn("dest_count", stored)
    known = source.select(*keys)
    if incremental:
        marks = destination.select(*keys).withColumn("_known", F.lit(True))
        known = known.join(marks, list(keys), "left").select(F.col("_known").isNotNull().alias("_known"))
    else:
        known = known.select(F.lit(False).alias("_known"))
    return known.agg(
        F.lit(table).alias("table"), F.lit("success").alias("status"), F.count(F.lit(1)).alias("source_count"),
        F.count_if(~F.col("_known")).alias("synced"), F.count_if("_known").alias("skipped"))


def sync_report(source: Mapping[str, DataFrame], destination: Mapping[str, DataFrame],
                tables: Iterable[str] | None = None, incremental: bool = False, dry_run: bool = False) -> DataFrame:
    """What a sync of these tables moves, one row per table, without moving it."""
    names = [t for t in (tables if tables is not None else SYNC_TABLES) if t in SYNC_TABLES and t in source]
    report = None
    for t in names:
        row = sync_counts(t, source[t], destination[t], PRIMARY_KEYS[t], incremental, dry_run)
        report = row if report is None else report.unionByName(row)
    return report


def shared_stage(spark: SparkSession) -> Callable[[str, DataFrame], DataFrame]:
    """Stores what a table is about to receive in a fresh folder that all executors share, and reads it back."""
    folder = f"{shared_folder(spark).rstrip('/')}/sync-{uuid.uuid4().hex}"

    def stage(table: str, rows: DataFrame) -> DataFrame:
        rows.write.parquet(f"{folder}/{table}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{table}")
    return stage


def store_sink(database: str | None, folder: str) -> Callable[[str, DataFrame, bool], None]:
    """Sink into the stored tables: missing rows are appended, a whole table becomes a new version in `folder`."""
    def write(table: str, rows: DataFrame, adds: bool) -> None:
        if adds:
            append(table, rows, database)
        else:
            publish(table, rows, f"{folder.rstrip('/')}/{table}-{uuid.uuid4().hex}", database)
    return write


def sync_table(table: str, source: DataFrame, destination: DataFrame, write: Callable[[str, DataFrame, bool], None],
               keys: Sequence[str] | None = None, incremental: bool = False, dry_run: bool = False,
               stage: Callable[[str, DataFrame], DataFrame] | None = None) -> dict:
    """Carry one table and report on it, once it has arrived. `write(table, rows, append)` is the sink.

    The comparison runs once: its rows are stored by `stage`, counted from the stored files and written from there, so
    the counts are those of the rows that moved, also when tasks had to be repeated.
    """
    keys = keys or PRIMARY_KEYS[table]
    if dry_run:
        return sync_counts(table, source, destination, keys, incremental, dry_run).first().asDict()
    rows = missing_rows(source, destination, keys) if incremental else full_merge(source, destination, keys)
    rows = (stage or shared_stage(source.sparkSession))(table, rows)
    source_count = source.count()
    synced = rows.count() if incremental else source_count
    write(table, rows, incremental)
    return {"table": table, "status": "success", "source_count": source_count, "synced": synced, "skipped": source_count - synced}


def sync_stores(spark: SparkSession, source: Mapping[str, DataFrame], destination: Mapping[str, DataFrame],
                write: Callable[[str, DataFrame, bool], None], tables: Iterable[str] | None = None,
                incremental: bool = False, dry_run: bool = False) -> DataFrame:
    """Carry every named table (default: all). Unknown names are ignored; a failing table does not stop the rest."""
    wanted = list(tables) if tables is not None else SYNC_TABLES
    unknown = [t for t in wanted if t not in SYNC_TABLES]
    if unknown:
        log.warning("unknown tables ignored: %s", unknown)
    results, stage = [], None if dry_run else shared_stage(spark)
    for table in (t for t in wanted if t in SYNC_TABLES):
        if table not in source:
            results.append((table, "skipped", None, 0, 0, "not found in source"))
            continue
        try:
            r = sync_table(table, source[table], destination[table], write, incremental=incremental, dry_run=dry_run, stage=stage)
            results.append((table, r["status"], r["source_count"], r["synced"], r["skipped"], None))
        except Exception as error:  # one table's failure is reported, not raised
            log.error("syncing %s failed: %s", table, error)
            results.append((table, "error", None, 0, 0, str(error)))
    return spark.createDataFrame(results, RESULT_DDL)


def sync_totals(results: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Totals over the table results; 'partial' when any table failed."""
    return results.agg(
        F.count(F.lit(1)).alias("tables"), F.sum("source_count").alias("source_count"),
        F.sum("synced").alias("synced"), F.sum("skipped").alias("skipped"),
        F.when(F.count_if(F.col("status") == "error") > 0, "partial").otherwise("success").alias("status"),
    ).withColumn("completed_at", moment(as_of))
