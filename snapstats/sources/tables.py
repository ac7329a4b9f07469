"""Stored tables: creating, reading, appending, and replacing the parts that a batch touches.

Tables are plain partitioned Parquet tables of the catalog. Two layout columns, hidden from readers unless they ask, say where a
row lies: the month of a snapshot and a hash bucket of a key. Both follow from the row, so a batch knows its partitions:
key checks read those only (`part_for`), and merges rewrite those only (`replace_parts`).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapstats.functions.timeutil import AsOf, since
from snapstats.schemas import (
    BLOOM_FILTERED, BUCKET_COLUMN, BUCKETED, MONTH_COLUMN, MONTH_PARTITIONED, PRIMARY_KEYS, TABLE_DDL, table_schema,
)

# Buckets of a key; a table keeps the number it was created with. At 100 TB take enough for buckets of some GB.
BUCKETS = 256
BUCKET_PROPERTY = "snapstats.buckets"
# A batch of up to so many distinct keys is looked up by the files' Bloom filters and statistics.
PUSHED_KEYS = 200


def layout_columns(table: str) -> list[str]:
    """Columns a table is partitioned by, outermost first."""
    return [MONTH_COLUMN] * (table in MONTH_PARTITIONED) + [BUCKET_COLUMN] * (table in BUCKETED)


def create_tables(spark: SparkSession, database: str | None = None, location: str | None = None, buckets: int = BUCKETS,
                  tables: Iterable[str] | None = None) -> list[str]:
    """Create every table (or those named) that does not exist yet; running it again changes nothing."""
    names, wanted = [], set(TABLE_DDL if tables is None else tables)
    kinds = {MONTH_COLUMN: "date", BUCKET_COLUMN: "int"}
    for table, ddl in ((t, d) for t, d in TABLE_DDL.items() if t in wanted):
        name, parts = qualified(table, database), layout_columns(table)
        columns = ", ".join([ddl, *(f"{c} {kinds[c]}" for c in parts)])
        # Overwriting replaces the partitions that are written, not the table.
        options = {"partitionOverwriteMode": "dynamic"}
        if table in BLOOM_FILTERED:
            options[f"parquet.bloom.filter.enabled#{BLOOM_FILTERED[table]}"] = "true"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS ({', '.join(f"'{k}' '{v}'" for k, v in options.items())})"
            + (f" PARTITIONED BY ({', '.join(parts)})" if parts else "")
            + (f" LOCATION '{location.rstrip('/')}/{table}'" if location else "")
            + (f" TBLPROPERTIES ('{BUCKET_PROPERTY}' = '{buckets}')" if table in BUCKETED else ""))
        names.append(name)
    return names


def qualified(table: str, database: str | None) -> str:
    return f"{database}.{table}" if database else table


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], table_schema(table))


def load_tables(spark: SparkSession, root: str, tables: Iterable[str] | None = None, layout: str = "{root}/{table}",
                ) -> dict[str, DataFrame]:
    """Parquet tables of a folder by name."""
    names = list(tables) if tables is not None else list(TABLE_DDL)
    return {t: spark.read.parquet(layout.format(root=root.rstrip("/"), table=t)) for t in names}


def load_catalog(spark: SparkSession, database: str | None = None, tables: Iterable[str] | None = None, layout: bool = False,
                 ) -> dict[str, DataFrame]:
    """Tables of the catalog by name, as they are now: a session keeps a table's file list, which other sessions may
    have added to. With `layout` the layout columns stay, by which time filters (see `since`) skip whole months.
    """
    loaded = {}
    for table in tables if tables is not None else TABLE_DDL:
        name = qualified(table, database)
        spark.catalog.refreshTable(name)
        loaded[table] = spark.table(name) if layout else spark.table(name).drop(*layout_columns(table))
    return loaded


def load_window(spark: SparkSession, table: str, as_of: AsOf, days: int, database: str | None = None) -> DataFrame:
    """The last `days` days of a snapshot table, read from their months only."""
    stored = load_catalog(spark, database, [table], layout=True)[table]
    return stored.filter(since(stored, MONTH_PARTITIONED[table], as_of, days)).drop(*layout_columns(table))


def property_of(spark: SparkSession, name: str, key: str) -> str | None:
    """Property of a catalog table."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return found.get(key)


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def laid_out(spark: SparkSession, table: str, rows: DataFrame, database: str | None = None) -> DataFrame:
    """`rows` with the table's layout columns."""
    if table in MONTH_PARTITIONED:
        rows = rows.withColumn(MONTH_COLUMN, F.trunc(MONTH_PARTITIONED[table], "month"))
    if table in BUCKETED:
        buckets = int(property_of(spark, qualified(table, database), BUCKET_PROPERTY))
        rows = rows.withColumn(BUCKET_COLUMN, bucket_of(F.col(BUCKETED[table]), buckets))
    return rows


def conform(table: str, rows: DataFrame) -> DataFrame:
    """Columns and types of the stored table; columns the rows lack are NULL."""
    return rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in table_schema(table).fields])


def parts_of(spark: SparkSession, table: str, rows: DataFrame, database: str | None = None) -> list[tuple]:
    """Partitions (values of the layout columns) that rows lie in, as far as their columns tell: at most one entry per
    month and bucket, so it fits the driver whatever the rows. The rows are read for it: store what is dear to compute."""
    known = [c for c in layout_columns(table) if (BUCKETED if c == BUCKET_COLUMN else MONTH_PARTITIONED)[table] in rows.columns]
    if MONTH_COLUMN not in known and table in MONTH_PARTITIONED:
        rows = rows.withColumn(MONTH_PARTITIONED[table], F.lit(None).cast("timestamp"))
    placed = laid_out(spark, table, rows, database)
    return sorted({tuple(r) for r in placed.select(*known).distinct().collect()}, key=repr)


def part_for(spark: SparkSession, table: str, batch: DataFrame, database: str | None = None, by: Sequence[str] | None = None,
             layout: bool = False) -> DataFrame:
    """What the stored table holds in the partitions of a batch: all that a check or a merge of its keys needs.

    Months count only where the time is part of the key (a known comment may come from any month). `by` names the
    key whose values are pushed to the files if the batch has few of them.
    """
    stored = load_catalog(spark, database, [table], layout=True)[table]
    columns = [c for c in batch.columns if c == BUCKETED.get(table) or c == MONTH_PARTITIONED.get(table) and c in PRIMARY_KEYS[table]]
    parts = parts_of(spark, table, batch.select(*columns), database)
    known = [c for c in layout_columns(table) if (BUCKETED if c == BUCKET_COLUMN else MONTH_PARTITIONED)[table] in columns]
    for k, column in enumerate(known):
        stored = stored.filter(F.col(column).isin(sorted({p[k] for p in parts})))
    if by is not None:
        keys = [r[0] for r in batch.select(*by).distinct().limit(PUSHED_KEYS + 1).collect()]
        if len(keys) <= PUSHED_KEYS:
            stored = stored.filter(F.col(by[0]).isin(keys))
    return stored if layout else stored.drop(*layout_columns(table))


def all_parts(parts: Sequence[tuple]) -> list[tuple]:
    """Every month of `parts` with every bucket of them: what a filter on either column can keep apart."""
    return sorted(product(*({p[k] for p in parts} for k in range(len(parts[0])))), key=repr) if parts else []


def rows_in(spark: SparkSession, table: str, parts: Sequence[tuple], database: str | None = None) -> DataFrame:
    """What the stored table holds in these partitions (see `all_parts`)."""
    columns = layout_columns(table)
    stored = load_catalog(spark, database, [table], layout=True)[table]
    return stored.filter(_any_of(columns, parts)).drop(*columns)


def in_parts(table: str, rows: DataFrame, parts: Sequence[tuple]) -> DataFrame:
    """Those of `rows`, which have the table's layout columns, that lie in these partitions (see `all_parts`)."""
    return rows.filter(_any_of(layout_columns(table), parts))


def replace_parts(table: str, rows: DataFrame, parts: Iterable[tuple], database: str | None = None) -> None:
    """Put `rows` in the place of all that the partitions `parts` hold; other partitions' files are not touched.

    `parts` are partitions the table has or gets; every row must lie in one of them. One that no row lies in is emptied. Spark writes
    beside the table and moves whole partitions in; should it die while moving, the same call repeated with the same
    rows mends it, so the rows must have been stored before.
    """
    spark, name, columns = rows.sparkSession, qualified(table, database), layout_columns(table)
    filled = set(parts_of(spark, table, rows, database))
    strays = filled - set(parts)
    if strays:
        raise ValueError(f"{table}: rows outside the parts to replace: {sorted(strays, key=repr)[:5]}")
    if filled:
        laid_out(spark, table, conform(table, rows), database).hint("rebalance", *columns).write.mode("overwrite").insertInto(name)
    stored = {tuple(r) for r in spark.table(name).select(*columns).where(_any_of(columns, parts)).distinct().collect()} if set(parts) - filled else set()
    for part in sorted((stored & set(parts)) - filled, key=repr):
        # A partition named in full is overwritten also by no rows.
        where = ", ".join(f"{c} = {_literal(v)}" for c, v in zip(columns, part))
        nothing = ", ".join(f"cast(null as {f.dataType.simpleString()})" for f in table_schema(table).fields)
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({where}) SELECT {nothing} WHERE false")
    spark.catalog.refreshTable(name)


def _literal(value) -> str:
    return "null" if value is None else str(value) if isinstance(value, int) else f"DATE '{value}'"


def _any_of(columns: Sequence[str], parts: Iterable[tuple]) -> Column:
    """A filter on the layout columns that keeps all of `parts`."""
    keep = F.lit(True)
    for k, column in enumerate(columns):
        values = {p[k] for p in parts}
        known = F.col(column).isin(sorted(values - {None}))
        keep = keep & (known | F.col(column).isNull() if None in values else known)
    return keep


def jdbc_options(url: str, table: str, partition_column: str | None = None, bounds: tuple | None = None,
                 partitions: int | None = None, fetch_size: int = 10_000, **extra: str) -> dict[str, str]:
    """Reader options for a database table, split over `partitions` ranges of `partition_column`."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if partition_column:
        if bounds is None or not partitions:
            raise ValueError("a partition column needs its bounds and the number of partitions")
        options.update(partitionColumn=partition_column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]),
                       numPartitions=str(partitions))
    return options


def load_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A database table (its driver must be on the classpath)."""
    return spark.read.format("jdbc").options(**options).load()


def append(table: str, rows: DataFrame, database: str | None = None) -> None:
    """Add rows to a table, laid out like it; a heavy partition is split over several files."""
    laid = laid_out(rows.sparkSession, table, conform(table, rows), database)
    if layout_columns(table):
        laid = laid.hint("rebalance", *layout_columns(table))
    laid.write.mode("append").insertInto(qualified(table, database))


def publish(table: str, rows: DataFrame, location: str, database: str | None = None) -> None:
    """Write a whole new version to a fresh folder, then point the table and its partitions at it: for loads of a whole table.

    The version being read is never touched: a job that fails half-way leaves its files as they were.
    """
    spark, name, columns = rows.sparkSession, qualified(table, database), layout_columns(table)
    laid = laid_out(spark, table, conform(table, rows), database)
    writer = laid.hint("rebalance", *columns) if columns else laid
    writer.write.mode("errorifexists").partitionBy(*columns).parquet(location)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    if columns:
        root = spark._jvm.org.apache.hadoop.fs.Path(location)
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        new = {tuple(r) for r in spark.read.parquet(location).select(*columns).distinct().collect()} if rows.head(1) else set()
        old = {tuple(r) for r in spark.table(name).select(*columns).distinct().collect()}
        for part in sorted(old | new, key=repr):
            # A partition without rows in the new version reads an empty folder.
            folder = spark._jvm.org.apache.hadoop.fs.Path(root, "/".join(f"{c}={v}" for c, v in zip(columns, part)))
            files.mkdirs(folder)
            spec = ", ".join(f"{c} = {_literal(v)}" for c, v in zip(columns, part))
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{folder}'")
            spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
