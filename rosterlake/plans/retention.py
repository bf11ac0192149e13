"""Removes what no table, view or snapshot names any more.

Marked are the versions in the locations and view texts of both databases and that of the
last finished run, which the next one builds on; of the staged tables the pieces that the
tables of pieces of those versions list; of the typed tables the finished runs. The rest is
what attempts left that died or were repeated, what a later version made anew, and versions
whose snapshots were dropped. Rejects stay: they are evidence.

A run that is under way is in no ledger yet, so only folders that have not changed for
``older_than`` go; choose it longer than any run or reader takes. Names go through the
driver, a row per piece and version at most; no file is read.
"""

from __future__ import annotations

import re
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from rosterlake.plans.catalog import ENTITIES
from rosterlake.plans.daily_load import CROSSWALK, RUN, Warehouse, finished_runs
from rosterlake.plans.staged_load import PIECE, PIECES
from rosterlake.sinks.tables import remove_folder

GRACE = timedelta(days=7)
AT_ONCE = 16
_VERSION = re.compile(r"version=([^/`'\s]+)")


def named_versions(spark: SparkSession, *databases: str) -> set[str]:
    """Versions in the locations of tables and the texts of views."""
    found: set[str] = set()
    for database in databases:
        if not spark.catalog.databaseExists(database):
            continue
        for table in spark.catalog.listTables(database):
            if table.isTemporary:
                continue
            described = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.`{table.name}`").where(
                F.col("col_name").isin("Location", "View Text"))
            for row in described.collect():
                found.update(_VERSION.findall(row["data_type"]))
    return found


def _folders(spark: SparkSession, path: str) -> dict[str, int]:
    """Folders right below a path with the time of their last change, in milliseconds."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(at):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in system.listStatus(at) if s.isDirectory()}


def unnamed(spark: SparkSession, house: Warehouse, older_than: timedelta = GRACE) -> list[str]:
    """The folders nothing names, of those that have not changed for ``older_than``."""
    finished = finished_runs(spark, house).select("pipeline", "version").collect()
    versions = named_versions(spark, house.database, house.archive)
    versions |= {max((r["pipeline"], r["version"]) for r in finished)[1]} if finished else set()
    kept = {f"version={v}" for v in versions}
    runs = {f"{RUN}={r['pipeline']}" for r in finished}
    latest = (time.time() - older_than.total_seconds()) * 1000
    out: list[str] = []

    def look(path: str, keep: set[str], prefix: str) -> None:
        out.extend(f"{path}/{name}" for name, changed in sorted(_folders(spark, path).items())
                   if name.startswith(prefix) and name not in keep and changed <= latest)

    for entity in ENTITIES:
        look(house.path("text", entity), kept, "version=")
        look(house.path("typed", entity), runs, f"{RUN}=")
        tables = house.path("pieces", entity)
        listed = [f"{tables}/{name}" for name in _folders(spark, tables) if name in kept]
        pieces = {f"{PIECE}=none.{v}" for v in versions}
        if listed:
            named = spark.read.schema(PIECES).parquet(*listed).select(PIECE).distinct()
            pieces |= {f"{PIECE}={r[PIECE]}" for r in named.collect()}
        look(house.path("staged", entity), pieces, f"{PIECE}=")
        look(tables, kept, "version=")
    for name in (CROSSWALK, "by_key", "changed"):
        look(house.path("identity", name), kept, "version=")
    # Landed records are read by their own run alone.
    look(house.path("landing", "").rstrip("/"), set(), "")
    return out


def sweep(spark: SparkSession, house: Warehouse, older_than: timedelta = GRACE) -> list[str]:
    """Removes the unnamed folders and returns them. Tables of pieces go after the pieces they
    list, so a sweep that dies leaves nothing that the next does not find."""
    paths = unnamed(spark, house, older_than)
    with ThreadPoolExecutor(AT_ONCE) as pool:
        for layer in (False, True):
            list(pool.map(lambda p: remove_folder(spark, p), [p for p in paths if ("/pieces/" in p) == layer]))
    return paths
