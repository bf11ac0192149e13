"""A folder of delimited files -> one table per name, with a manifest of what was loaded."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rosterlake.sinks import tables
from rosterlake.sources import dictionary as dictionaries
from rosterlake.sources import manifest as manifests
from rosterlake.sources.delimited import (BAD, MAX_BAD_ROWS, STATUS, Dialect, accepted_rows, file_profiles, read_inferred,
                                          read_lines, rejected_rows, require_few_bad_rows)
from rosterlake.sources.quoted_lines import read_profiled

CSV, WHOLE_LINES = "csv", "ragged_right"
# What to do with a table whose columns differ from the files'.
RECREATE, STOP = "recreate", "stop"
# Fixed value: the column of a table of whole lines.
LINE = "value"


@dataclass(frozen=True)
class FileLoad:
    """What to load and how its tables are named."""

    blob_path: str = ""
    files: object = None
    file_prefix: str = ""
    file_type_filter: str = ""
    remove_prefix: bool = False
    remove_tail: str = ""
    add_prefix: str = ""
    add_suffix: str = ""
    mode: str = CSV
    write: str = "truncate"
    dialect: Dialect = Dialect(",", '"')
    # A dictionary file with names, types and modes instead of the header's names as text.
    dictionary: str | None = None
    # Whether the files begin with a header line. Files without one take their columns from
    # the dictionary, in its order.
    header: bool = True
    # A table with other columns than its files have is made anew, or stops the load before
    # anything is written to any table. Columns the platform adds, known by a prefix, do not count.
    on_change: str = RECREATE
    managed_prefix: str = ""
    save_manifest: str | None = None
    # Bad rows a file may have, and a folder that takes them with their file and reason;
    # without one they go to _rejects/<table>/version=<version> below the warehouse path.
    max_bad_rows: int = MAX_BAD_ROWS
    rejects: str | None = None


def load_folder(spark: SparkSession, root: str, database: str, warehouse: str, version: str,
                what: FileLoad = FileLoad()) -> DataFrame:
    """Loads the folder's files and returns the manifest.

    The files of one table are loaded together, matched by column name. The driver holds
    one record per file, as any Spark scan's does; rows stay on the executors. All tables
    are set against their files' columns before the first is written; a table that is
    loaded whole is switched to its new rows when these are written.
    """
    if what.mode == CSV and not what.header and not what.dictionary:
        raise ValueError("files without a header need a dictionary that names their columns")
    files = manifests.list_files(spark, root).select(
        "path", manifests.relative_to(F.col("path"), root).alias("blob_name"))
    wanted = None if what.files is None else manifests.wanted_files(spark, what.files)
    manifest = manifests.build_manifest(
        files.select("blob_name"), F.current_timestamp(), what.blob_path, wanted, what.file_prefix,
        what.file_type_filter, what.remove_prefix, what.remove_tail, what.add_prefix, what.add_suffix)
    items = manifest.join(files, "blob_name").collect()
    if not items:
        return manifest
    # From here on the records as they were built, load stamp included.
    manifest = spark.createDataFrame([Row(**{c: r[c] for c in manifests.MANIFEST.names}) for r in items], manifests.MANIFEST)

    listed = spark.createDataFrame([(r["path"], r["blob_name"], r["table_name"], r["file_name"]) for r in items],
                                   "path string, blob_name string, table_name string, file_name string")
    profiles = {r["_file"]: r for r in file_profiles(read_lines(spark, [r["path"] for r in items]), what.dialect).collect()}
    known = _dictionary(spark, listed, profiles, what)

    loads = {}
    for name in sorted({r["table_name"] for r in items}):
        mine = [r for r in items if r["table_name"] == name]
        rejects = what.rejects or f"{warehouse.rstrip('/')}/_rejects/{name}/version={version}"
        loads[name] = mine, _rows(spark, mine, profiles, known, replace(what, rejects=rejects))
    standing = [n for n in loads if spark.catalog.tableExists(f"{database}.{n}")]
    differing = _differences(spark, database, {n: loads[n][1] for n in standing}, what.managed_prefix)
    if differing and what.on_change == STOP:
        raise ValueError(f"tables have other columns than their files: {differing}")

    facts, counts = [], []
    for name, (mine, rows) in loads.items():
        table, location = f"{database}.{name}", f"{warehouse.rstrip('/')}/{name}"
        new, changed = name not in standing, name in differing
        if what.write == "append":
            if new or changed:
                tables.publish(spark.createDataFrame([], rows.schema), table, location, f"{version}-empty")
            tables.insert_by_name(rows, table)
        else:
            tables.publish(rows, table, location, version)
        counts.append(spark.table(table).select(F.lit(name).alias("table_name")))
        for r in mine:
            p = profiles.get(r["path"])
            facts.append((r["blob_name"], "y" if new else None, "y" if changed else None,
                          p and p["dialect_field_delimiter"], p and p["dialect_quote_delimiter"]))
    facts = spark.createDataFrame(facts, "blob_name string, is_table_new string, has_table_schema_changed string, "
                                         "dialect_field_delimiter string, dialect_quote_delimiter string")
    loaded = counts[0]
    for count in counts[1:]:
        loaded = loaded.unionByName(count)
    manifest = manifests.with_load_results(manifests.with_file_facts(manifest, facts), loaded)
    if what.save_manifest:
        manifest.write.mode("overwrite").json(what.save_manifest)
        manifest = spark.read.schema(manifests.MANIFEST).json(what.save_manifest)
    return manifest


def _differences(spark: SparkSession, database: str, loads: dict[str, DataFrame],
                 managed_prefix: str) -> dict[str, list[tuple[str, str]]]:
    """Per table the columns, by place and name, that only its files (new) or only the
    standing table (existing) have. One comparison for all tables, of a row per column."""
    if not loads:
        return {}
    new = {n: tables.own_columns(rows.columns, managed_prefix) for n, rows in loads.items()}
    old = {n: tables.own_columns(spark.table(f"{database}.{n}").columns, managed_prefix) for n in loads}
    out: dict[str, list[tuple[str, str]]] = {}
    for r in dictionaries.column_differences(dictionaries.listed_columns(spark, new), dictionaries.listed_columns(spark, old)).orderBy(
            "table_name", "side", "ordinal_position").collect():
        out.setdefault(r["table_name"], []).append((r["column_name"], r["side"]))
    return out


def _dialect(path: str, profiles: dict, what: FileLoad) -> Dialect:
    """What was sniffed over what was configured; what was not sniffed stays configured."""
    found = profiles.get(path)
    if found is None or what.mode == WHOLE_LINES:
        return what.dialect
    return replace(what.dialect, sep=found["dialect_field_delimiter"] or what.dialect.sep,
                   quote=found["dialect_quote_delimiter"] or what.dialect.quote)


def _dictionary(spark: SparkSession, listed: DataFrame, profiles: dict, what: FileLoad) -> dict[tuple, list[Row]]:
    """(table, file) -> its columns in order."""
    if what.dictionary:
        rows = dictionaries.dictionary_from_external(listed, dictionaries.read_external(spark, what.dictionary)).collect()
    else:
        rows = []
        headers = [(r["table_name"], r["file_name"], profiles[r["path"]]["first_line"], _dialect(r["path"], profiles, what))
                   for r in listed.collect() if r["path"] in profiles]
        for dialect in {h[3] for h in headers}:
            lines = spark.createDataFrame([h[:3] for h in headers if h[3] == dialect], "table_name string, file_name string, header string")
            rows += dictionaries.dictionary_from_headers(lines, dialect.sep, dialect.quote).collect()
    out: dict[tuple, list[Row]] = {}
    for r in sorted(rows, key=lambda r: r["tgt_col_ord"]):
        out.setdefault((r["table_name"], r["src_file_name"]), []).append(r)
    return out


def _rows(spark: SparkSession, items: list[Row], profiles: dict, known: dict[tuple, list[Row]], what: FileLoad) -> DataFrame:
    if what.mode == WHOLE_LINES:
        lines = read_lines(spark, [r["path"] for r in items])
        if not what.header:
            return lines.select(F.col("value").alias(LINE))
        # The first line of each file, one row per file, is its header.
        headers = lines.where("_at.split = 0").groupBy("_file").agg(F.min("_at").alias("_first"))
        return lines.join(headers, "_file").where(F.col("_at") != F.col("_first")).select(F.col("value").alias(LINE))
    groups: dict[tuple, list[Row]] = {}
    for r in items:
        columns = known.get((r["table_name"], r["file_name"]), [])
        shape = tuple((c["tgt_col_name"], c["tgt_col_type"]) for c in columns)
        groups.setdefault((shape, _dialect(r["path"], profiles, what)), []).append(r)
    parts = []
    for (shape, dialect), members in groups.items():
        paths = [r["path"] for r in members]
        if not shape:
            if not what.header:
                raise ValueError(f"files without a header that the dictionary does not describe: {paths}")
            parts.append(read_inferred(spark, paths, dialect))
            continue
        quoted = [(p, bool(profiles[p]["quoted_line_ends"])) for p in paths if p in profiles]
        rows = read_profiled(spark, quoted, [c for c, _ in shape], dialect, what.header)
        require_few_bad_rows(rows, limit=what.max_bad_rows)
        rejected_rows(rows).select("_file", F.col(BAD).alias("record"), F.col(STATUS).alias("reason")).write.mode("append").parquet(what.rejects)
        parts.append(accepted_rows(rows).select(*[
            F.col(c).cast(dictionaries.SPARK_TYPES.get(kind.upper(), kind)).alias(c) for c, kind in shape]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
