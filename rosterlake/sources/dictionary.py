"""Column dictionaries: from header lines or a file, compared with what a table has."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.functions.names import column_name
from rosterlake.schema import columns

# Type and mode of a column no dictionary describes, and the dictionary's fields.
DEFAULT_TYPE = "STRING"
DEFAULT_MODE = "NULLABLE"
DICTIONARY = columns(
    "table_name string, src_file_name string, src_col_name string, tgt_col_name string, "
    "tgt_col_type string, tgt_col_mode string, tgt_col_ord bigint")
EXTERNAL = columns(
    "table_name string, file_name string, column_name string, data_type string, "
    "nullable string, ordinal_position bigint")
# Names of the warehouse types a dictionary may use.
SPARK_TYPES = {"STRING": "string", "INT64": "bigint", "INTEGER": "bigint", "FLOAT64": "double",
               "FLOAT": "double", "BOOL": "boolean", "BOOLEAN": "boolean", "DATE": "date",
               "TIMESTAMP": "timestamp", "NUMERIC": "decimal(38,9)"}


def header_fields(header: Column, sep: str, quote: str) -> Column:
    """The fields of a header line; a quoted field may hold the separator."""
    s, q = re.escape(sep), re.escape(quote)
    line = F.concat(F.lit(sep), F.ltrim(header, F.lit("\ufeff")))
    raw = F.regexp_extract_all(line, F.lit(f"{s}({q}(?:[^{q}]|{q}{q})*{q}|[^{s}]*)"), 1)
    quoted = lambda f: f.startswith(quote) & f.endswith(quote) & (F.length(f) > 1)
    return F.transform(raw, lambda f: F.when(
        quoted(f), F.replace(f.substr(F.lit(2), F.length(f) - 2), F.lit(quote * 2), F.lit(quote))).otherwise(f))


def dictionary_from_headers(headers: DataFrame, sep: str = "|", quote: str = '"') -> DataFrame:
    """(table_name, file_name, header) -> one row per column, all strings and nullable."""
    fields = headers.select(
        "table_name", F.col("file_name").alias("src_file_name"),
        F.posexplode(header_fields(F.col("header"), sep, quote)).alias("_pos", "src_col_name"))
    return fields.select(
        "table_name", "src_file_name", "src_col_name",
        column_name("src_col_name").alias("tgt_col_name"),
        F.lit(DEFAULT_TYPE).alias("tgt_col_type"), F.lit(DEFAULT_MODE).alias("tgt_col_mode"),
        (F.col("_pos") + 1).cast("bigint").alias("tgt_col_ord"))


def read_external(spark: SparkSession, path: str) -> DataFrame:
    """A dictionary file, its columns found by their headings."""
    given = spark.read.option("header", True).option("escape", '"').csv(path)
    return given.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EXTERNAL])


def dictionary_from_external(manifest: DataFrame, external: DataFrame) -> DataFrame:
    """Dictionary rows whose table or file is on the manifest.

    The "or" is two equi-joins: by table, and by file where the table differs.
    """
    files = manifest.select("table_name", "file_name")
    d = external.select(F.col("table_name").alias("_t"), F.col("file_name").alias("_f"),
                        "column_name", "data_type", "nullable", "ordinal_position")
    by_table = files.join(d, F.col("table_name") == F.col("_t"))
    by_file = files.join(d, F.col("file_name") == F.col("_f")).where(
        ~F.col("table_name").eqNullSafe(F.col("_t")))
    return by_table.unionByName(by_file).select(
        "table_name", F.col("file_name").alias("src_file_name"),
        F.col("column_name").alias("src_col_name"), column_name("column_name").alias("tgt_col_name"),
        F.col("data_type").alias("tgt_col_type"), F.col("nullable").alias("tgt_col_mode"),
        F.col("ordinal_position").alias("tgt_col_ord"))


def name_collisions(dictionary: DataFrame) -> DataFrame:
    """Target names that two columns of one file would share."""
    return (dictionary.groupBy("table_name", "src_file_name", "tgt_col_name")
            .agg(F.count(F.lit(1)).alias("columns")).where(F.col("columns") > 1))


def listed_columns(spark: SparkSession, tables: Mapping[str, Sequence[str]]) -> DataFrame:
    """(ordinal_position, table_name, column_name) of columns listed per table."""
    rows = [(i, table, c) for table, names in tables.items() for i, c in enumerate(names, 1)]
    return spark.createDataFrame(rows, "ordinal_position bigint, table_name string, column_name string")


def existing_columns(spark: SparkSession, table: str, managed_prefix: str = "") -> DataFrame:
    """(ordinal_position, table_name, column_name) of a catalog table."""
    return unmanaged_columns(listed_columns(spark, {table.split(".")[-1]: spark.table(table).columns}), managed_prefix)


def unmanaged_columns(columns: DataFrame, managed_prefix: str = "") -> DataFrame:
    """Without the columns the platform adds itself; positions stay as they are."""
    if not managed_prefix:
        return columns
    return columns.where(~F.col("column_name").startswith(managed_prefix))


def as_columns(dictionary: DataFrame) -> DataFrame:
    return dictionary.select(F.col("tgt_col_ord").alias("ordinal_position"), "table_name",
                             F.col("tgt_col_name").alias("column_name"))


def column_differences(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Columns only one side has, by position, table and name; types do not count.

    One aggregation over both sides instead of two set differences: what occurs, once or
    several times, on one side only is a difference. Rows are dealt out by all three before
    they are grouped: a column occurs once or twice, so counts formed before the shuffle
    spare none of it, and a task that reads much would hold a group per row.
    """
    names = ["ordinal_position", "table_name", "column_name"]
    both = new.select(*names, F.lit(1).alias("_new"), F.lit(0).alias("_old")).unionByName(
        existing.select(*names, F.lit(0).alias("_new"), F.lit(1).alias("_old")))
    return (both.repartition(*names).groupBy(*names).agg(F.sum("_new").alias("_new"), F.sum("_old").alias("_old"))
            .where((F.col("_new") > 0) != (F.col("_old") > 0))
            .select(*names, F.when(F.col("_new") > 0, F.lit("new")).otherwise(F.lit("existing")).alias("side")))


def same_columns(new: DataFrame, existing: DataFrame) -> bool:
    return column_differences(new, existing).isEmpty()


def schema_json(dictionary: DataFrame) -> DataFrame:
    """Per table the JSON column list. A group is one table's columns."""
    entry = F.struct(
        "tgt_col_ord",
        F.struct(F.concat_ws("~", "src_file_name", "src_col_name").alias("description"),
                 F.col("tgt_col_name").alias("name"), F.col("tgt_col_type").alias("type"),
                 F.col("tgt_col_mode").alias("mode")).alias("column"))
    listed = dictionary.groupBy("table_name").agg(F.array_sort(F.collect_list(entry)).alias("_c"))
    return listed.select("table_name", F.to_json("_c.column").alias("schema_json"))


def struct_type(dictionary: DataFrame, table_name: str) -> T.StructType:
    """A table's schema, each field with its source column as metadata."""
    rows = (dictionary.where(F.col("table_name") == table_name)
            .select("tgt_col_ord", "tgt_col_name", "tgt_col_type", "tgt_col_mode", "src_file_name", "src_col_name")
            .distinct().orderBy("tgt_col_ord").collect())
    names = [r["tgt_col_name"] for r in rows]
    if len(set(names)) != len(names):
        raise ValueError(f"{table_name}: column names collide: {names}")
    fields = []
    for r in rows:
        ddl = SPARK_TYPES.get(r["tgt_col_type"].upper(), r["tgt_col_type"])
        kind = T.StructType.fromDDL(f"c {ddl}")["c"].dataType
        fields.append(T.StructField(r["tgt_col_name"], kind, r["tgt_col_mode"].upper() != "REQUIRED",
                                    {"description": f"{r['src_file_name']}~{r['src_col_name']}"}))
    return T.StructType(fields)
