"""Catalog helpers: list, register, describe and drop the nine tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from marketlens.sources.schemas import SCHEMAS, TABLE_COMMENTS, TABLE_ORDER


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables of the current (or given) database, ordered by name."""
    names = [(t.name,) for t in spark.catalog.listTables(database) if not t.isTemporary]
    return spark.createDataFrame(names, "table_name string").orderBy("table_name")


def register_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Expose DataFrames under their table names as temporary views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def describe(spark: SparkSession) -> DataFrame:
    """table_name, column_name, data_type, nullable, comment for the logical schema."""
    rows = []
    for table in TABLE_ORDER:
        for f in SCHEMAS[table].fields:
            rows.append((table, f.name, f.dataType.simpleString(), f.nullable, f.metadata.get("comment")))
        rows.append((table, None, None, None, TABLE_COMMENTS.get(table)))
    return spark.createDataFrame(
        rows, "table_name string, column_name string, data_type string, nullable boolean, comment string")


def drop_tables(spark: SparkSession, names: Sequence[str] = tuple(reversed(TABLE_ORDER)),
                database: str | None = None) -> None:
    """Drop tables if present, children before parents."""
    prefix = f"`{database}`." if database else ""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}`{name}`")
