"""Writes: append, overwrite, partition replace, copy, snapshot, publish and table creation."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOT = "snapshot_date"


def append(rows: DataFrame, path: str, *partition: str) -> None:
    rows.write.mode("append").partitionBy(*partition).parquet(path)


def overwrite(rows: DataFrame, path: str, *partition: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition).parquet(path)


def replace_partitions(rows: DataFrame, path: str, *partition: str) -> None:
    """Replaces the partitions that occur in rows and keeps the others, so a repeated run
    of one day leaves one copy of it."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def replace_partition(rows: DataFrame, path: str, partition: str, value: str) -> None:
    """Replaces one partition, by no rows too: a repeat that has none leaves none."""
    overwrite(rows.drop(partition), f"{path}/{partition}={value}")


def load(rows: DataFrame, path: str, mode: str = "truncate") -> None:
    """Truncating is the default; anything but append truncates."""
    (append if mode == "append" else overwrite)(rows, path)


def snapshot_day(run_date: Column) -> Column:
    """Snapshots are taken before the load and carry the day before it."""
    return F.date_sub(run_date, 1)


def snapshot_name(table: Column, run_date: Column) -> Column:
    return F.concat_ws("_", table, F.date_format(snapshot_day(run_date), "yyyyMMdd"))


def snapshot(rows: DataFrame, path: str, run_date: Column) -> None:
    """The table as it is now, as the partition of the day before; run again, it replaces itself."""
    replace_partitions(rows.withColumn(SNAPSHOT, snapshot_day(run_date)), path, SNAPSHOT)


def remove_folder(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def copy_table(spark: SparkSession, source: str, target: str) -> None:
    """Byte copy of one Parquet table, truncating the target. Spark has finished when it returns."""
    overwrite(spark.read.parquet(source), target)


def point_at(spark: SparkSession, table: str, location: str) -> None:
    """Makes a table read the Parquet files at a location, written before. Readers see
    either the files it pointed at so far or the new ones; no byte is copied."""
    schema = spark.read.parquet(location).schema
    if spark.catalog.tableExists(table) and _columns(spark.table(table).schema) == _columns(schema):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table)
    else:
        # External: dropping it removes the entry, not the files.
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path=location, source="parquet", schema=schema)


def show_as(spark: SparkSession, name: str, query: str) -> None:
    """Makes a name stand for a query, whatever columns it had before. The switch is one
    catalog call, so readers find the old rows or the new ones; only a table that still has
    the name goes first."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def publish(rows: DataFrame, table: str, root: str, version: str) -> None:
    """Writes a new version beside the old one and then points the table at it, so a run
    that dies midway leaves the old rows in place."""
    location = f"{root.rstrip('/')}/{table.split('.')[-1]}/version={version}"
    overwrite(rows, location)
    point_at(rows.sparkSession, table, location)


def copy_database(spark: SparkSession, source: str, target: str, root: str, version: str,
                  suffix: str = "") -> list[str]:
    """Publishes every table of one database in another under its name plus a suffix.
    Views are left out; the names copied are returned."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {target} LOCATION '{root}'")
    names = sorted(t.name for t in spark.catalog.listTables(source) if t.tableType != "VIEW" and not t.isTemporary)
    for name in names:
        publish(spark.table(f"{source}.{name}"), f"{target}.{name}{suffix}", root, version)
    return names


def archive_database(spark: SparkSession, source: str, target: str, root: str, run_date: date) -> list[str]:
    """Every table of a database as ``<name>_<day before>``, replaced when taken again."""
    day = (run_date - timedelta(days=1)).strftime("%Y%m%d")
    return copy_database(spark, source, target, root, uuid.uuid4().hex, f"_{day}")


def _columns(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def create_if_missing(spark: SparkSession, table: str, columns: str, location: str) -> bool:
    """Whether the table had to be created. ``columns`` is a DDL column list."""
    missing = not spark.catalog.tableExists(table)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet LOCATION '{location}'")
    return missing


def own_columns(names: Sequence[str], managed_prefix: str = "") -> list[str]:
    """Without the columns that the platform adds itself, known by their prefix."""
    return [n for n in names if not managed_prefix or not n.startswith(managed_prefix)]


def new_or_changed(spark: SparkSession, table: str, schema: T.StructType, managed_prefix: str = "") -> tuple[bool, bool]:
    """(new, changed): whether the table is missing, and whether its own columns' names or
    order differ; types do not count."""
    new = not spark.catalog.tableExists(table)
    return new, not new and own_columns(spark.table(table).columns, managed_prefix) != own_columns(schema.names, managed_prefix)


def recreate_if_changed(spark: SparkSession, table: str, schema: T.StructType, root: str,
                        version: str, managed_prefix: str = "") -> tuple[bool, bool]:
    """(new, changed). A table that changed is dropped with its rows and created anew."""
    new, changed = new_or_changed(spark, table, schema, managed_prefix)
    if new or changed:
        publish(spark.createDataFrame([], schema), table, root, version)
    return new, changed


def insert_by_name(rows: DataFrame, table: str) -> None:
    """Appends to a catalog table, columns matched by name."""
    spark = rows.sparkSession
    rows.select(*spark.table(table).columns).write.mode("append").insertInto(table)
