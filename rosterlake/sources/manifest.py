"""Which files a load takes, and into which table each goes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.functions.names import affixed, file_stem, file_type, without_prefix, without_tail
from rosterlake.schema import columns

# Fixed value: the fields of a manifest record.
MANIFEST = columns(
    "blob_name string, table_name string, file_name string, is_table_new string, "
    "has_table_schema_changed string, table_loaded_successfully string, table_rows_loaded bigint, "
    "dialect_field_delimiter string, dialect_quote_delimiter string, table_load_date string")


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Path, size and time of every file below root. Contents are not read: the column
    is pruned from the scan."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "length", "modificationTime")


def relative_to(path: Column, root: str) -> Column:
    """The part of a file URI behind the root folder."""
    return F.regexp_replace(F.substring_index(path, root.rstrip("/") + "/", -1), "^/+", "")


def in_folder(files: DataFrame, blob_path: str = "") -> DataFrame:
    """Files below a folder, named without it; folder markers are left out."""
    name = F.col("blob_name")
    kept = files.where(~name.endswith("/") & name.startswith(blob_path))
    return kept.withColumn("file_name", F.substring(name, F.lit(len(blob_path) + 1), F.length(name)))


def with_prefix(files: DataFrame, prefix: str) -> DataFrame:
    return files.where(F.col("file_name").startswith(prefix)) if prefix else files


def with_type(files: DataFrame, extension: str) -> DataFrame:
    return files.where(file_type("file_name") == extension) if extension else files


def named_files(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """Files on an explicit list (file_name, given_table); given_table is null where the
    list leaves the naming to the rules."""
    return files.join(wanted, "file_name")


def wanted_files(spark: SparkSession, only) -> DataFrame | None:
    """A list of files, or a mapping of files to tables. An empty one names no restriction;
    anything of another kind names no file."""
    if isinstance(only, Mapping):
        pairs = only.items()
    else:
        pairs = [(f, None) for f in only] if isinstance(only, (list, tuple)) else []
    if not only:
        return None
    return spark.createDataFrame([(f, t or None) for f, t in pairs], "file_name string, given_table string")


def build_manifest(files: DataFrame, load_ts: Column, blob_path: str = "", only: DataFrame | None = None,
                   file_prefix: str = "", file_type_filter: str = "", remove_prefix: bool = False,
                   remove_tail: str = "", add_prefix: str = "", add_suffix: str = "") -> DataFrame:
    """One manifest record per file to load.

    A file whose table the list names is taken as it is; the prefix and type filters and
    the naming rules apply to all others.
    """
    rows = in_folder(files, blob_path)
    rows = rows.withColumn("given_table", F.lit(None).cast("string")) if only is None else named_files(rows, only)
    given = rows.where(F.col("given_table").isNotNull()).withColumn("table_name", F.col("given_table"))
    free = with_type(with_prefix(rows.where(F.col("given_table").isNull()), file_prefix), file_type_filter)
    name = without_prefix(file_stem("file_name"), file_prefix if remove_prefix else "")
    if remove_tail:
        name = without_tail(name, remove_tail)
    free = free.withColumn("table_name", affixed(name, add_prefix, add_suffix))
    none = F.lit(None).cast("string")
    return given.unionByName(free).select(
        "blob_name", F.lower("table_name").alias("table_name"), "file_name",
        F.lit("n").alias("is_table_new"), F.lit("n").alias("has_table_schema_changed"),
        # Set once the load has run; a record that stays at n was not loaded.
        F.lit("n").alias("table_loaded_successfully"),
        F.lit(0).cast("bigint").alias("table_rows_loaded"),
        none.alias("dialect_field_delimiter"), none.alias("dialect_quote_delimiter"),
        F.date_format(load_ts, "yyyyMMdd_HHmmss").alias("table_load_date"),
    )


def with_load_results(manifest: DataFrame, loaded: DataFrame) -> DataFrame:
    """Row counts of the loaded tables (table_name, plus any column of the loaded rows) on
    their manifest records. Counting folds on the map side, so a table that holds most
    rows costs no more than the others."""
    counts = loaded.groupBy("table_name").agg(F.count(F.lit(1)).alias("_rows"))
    return manifest.join(counts, "table_name", "left").select(*[
        F.coalesce("_rows", c).alias(c) if c == "table_rows_loaded"
        else F.when(F.col("_rows").isNotNull(), F.lit("y")).otherwise(F.col(c)).alias(c)
        if c == "table_loaded_successfully" else F.col(c)
        for c in MANIFEST.names])


def with_file_facts(manifest: DataFrame, facts: DataFrame) -> DataFrame:
    """What was found out about files and their tables, on their manifest records: facts
    has blob_name and any of the manifest's other columns. A null fact changes nothing."""
    found = facts.select("blob_name", *[F.col(c).alias(f"_{c}") for c in facts.columns if c != "blob_name"])
    return manifest.join(found, "blob_name", "left").select(*[
        F.coalesce(f"_{c}", c).alias(c) if c != "blob_name" and c in facts.columns else F.col(c)
        for c in MANIFEST.names])


def not_yet_processed(files: DataFrame, processed: DataFrame) -> DataFrame:
    """Files the ledger of processed paths does not hold."""
    return files.join(processed.select("path"), "path", "left_anti")
