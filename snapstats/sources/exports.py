"""CSV output of tables and query results."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F, types as T

from snapstats.schemas import EXPORT_TABLES

NESTED = (T.ArrayType, T.MapType, T.StructType)


def flattened(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, which a CSV file can hold."""
    return df.select(*[
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, NESTED) else F.col(f.name) for f in df.schema.fields])


def export_csv(df: DataFrame, path: str) -> str:
    """One result to a folder of CSV files with headers, written by the executors."""
    flattened(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def export_tables(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """The tables that may leave, each to `<folder>/<table>.csv`; an empty one is named but not written."""
    exported = {}
    for name in EXPORT_TABLES:
        if name in tables:
            path = f"{folder.rstrip('/')}/{name}.csv"
            if not tables[name].isEmpty():
                export_csv(tables[name], path)
            exported[name] = path
    return exported
