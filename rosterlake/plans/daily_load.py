"""One day's run: zipped drops -> landed records -> text tables -> typed tables ->
crosswalk -> staged tables -> published tables.

Every stage is written before the next one reads it, and no file a reader may hold is
overwritten: text tables and the crosswalk get a folder per attempt, typed tables a
partition per run that a repeated run replaces, and staged tables new pieces for what
changed (``staged_load``). So a run can be started again after a loss at any point,
publishing moves a pointer, and a snapshot is a name for files that already are there.
None of them copies a table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.operators.changes import changed_keys
from rosterlake.operators.identity import IDS, identities_by_key, identity_crosswalk
from rosterlake.operators.incremental import with_audit
from rosterlake.operators.quality import fitting_and_rejected
from rosterlake.plans.catalog import ENTITIES, Entity
from rosterlake.plans.staged_load import PIECES, load_pieces, staged_query
from rosterlake.plans.typed_load import build_rows
from rosterlake.schema import columns
from rosterlake.sinks import tables
from rosterlake.sinks.claims import claimed
from rosterlake.sinks.ledger import processed_entries
from rosterlake.sources import archive as zips
from rosterlake.sources.delimited import (BAD, MAX_BAD_ROWS, SHORT, STATUS, Dialect, accepted_rows, parse_records,
                                          rejected_rows, require_few_bad_rows)
from rosterlake.sources.dictionary import dictionary_from_headers
from rosterlake.sources.manifest import list_files, not_yet_processed
from rosterlake.sources.zip_source import read_zip_records

RUN = "load_run"
CROSSWALK = "crosswalk"
BY_KEY = columns("subscriber_key string, person_id bigint, demographic_id bigint, is_restricted int, copies bigint")
LANDED = columns("archive string, member string, record_no bigint, record string, feed string, file_stem string")


@dataclass(frozen=True)
class Warehouse:
    """Where the layers lie, and the databases of the published and the archived tables."""

    root: str
    database: str = "default"
    archive: str = "archive"

    def path(self, layer: str, name: str, version: str | None = None) -> str:
        path = f"{self.root.rstrip('/')}/{layer}/{name}"
        return path if version is None else f"{path}/version={version}"


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def typed_schema(entity: Entity) -> T.StructType:
    return T.StructType([*entity.schema(), T.StructField(RUN, T.StringType())])


def typed_table(spark: SparkSession, house: Warehouse, entity: Entity, runs: list[str]) -> DataFrame:
    """The rows of the given runs. What a run left that never finished belongs to none, and
    the archives it took are taken again by the next."""
    return read_or_empty(spark, house.path("typed", entity.name), typed_schema(entity)).where(
        F.col(RUN).isin(*runs)).drop(RUN)


def typed_as_of(spark: SparkSession, house: Warehouse, entity: Entity, run_id: str) -> DataFrame:
    """The table as it stood after a run; run ids sort by time."""
    return typed_table(spark, house, entity, runs_until(spark, house, run_id))


# ---------------------------------------------------------------- landing

def land_archives(spark: SparkSession, drop_root: str, house: Warehouse, runs: list[str], run_id: str,
                  dialect: Dialect = Dialect(), by_range: bool = True) -> DataFrame:
    """Records of the archives no finished run took, written once; (path) of those archives.

    Paths alone are set against the ledger; only then are the files opened: by range, or,
    where only Spark's readers reach them, whole.
    """
    ledger = read_or_empty(spark, house.path("ledger", "files"), columns("path string, run_date string"))
    fresh = not_yet_processed(list_files(spark, drop_root, "*.zip"), ledger.where(F.col("run_date").isin(*runs)))
    paths = [r["path"] for r in fresh.select("path").collect()]
    taken = spark.createDataFrame([(p,) for p in paths], "path string")
    if paths and by_range:
        records = zips.with_feed(read_zip_records(spark, paths, sep=dialect.sep, quote=dialect.quote))
    elif paths:
        records = zips.with_feed(zips.expand_archives(zips.read_archives(spark, paths), sep=dialect.sep, quote=dialect.quote))
    else:
        records = spark.createDataFrame([], LANDED)
    tables.overwrite(records, house.path("landing", run_id), "feed", "file_stem")
    return taken


def landing(spark: SparkSession, house: Warehouse, run_id: str) -> DataFrame:
    return read_or_empty(spark, house.path("landing", run_id), LANDED)


def text_rows(records: DataFrame, entity: Entity, dialect: Dialect) -> DataFrame:
    """The entity's columns as text, matched by header name, with feed and member.

    Files under the same header are parsed together. The headers go through the driver,
    one line per file.
    """
    mine = records.where(F.col("file_stem") == entity.file_stem)
    headers = mine.where(F.col("record_no") == 0).select(
        F.col("record").alias("table_name"), F.col("record").alias("file_name"), F.col("record").alias("header")).distinct()
    names: dict[str, dict[int, str]] = {}
    for r in dictionary_from_headers(headers, dialect.sep, dialect.quote).collect():
        names.setdefault(r["src_file_name"], {})[r["tgt_col_ord"]] = r["tgt_col_name"]
    parts = []
    for header, by_position in names.items():
        found = [by_position[i] for i in sorted(by_position)]
        if len(set(found)) != len(found):
            raise ValueError(f"{entity.name}: column names collide: {found}")
        missing = [c for c in entity.columns if c not in found]
        if missing:
            raise ValueError(f"{entity.name}: a file lacks {missing}")
        files = mine.where((F.col("record_no") == 0) & (F.col("record") == header)).select("archive", "member")
        body = mine.where((F.col("record_no") > 0) & (F.col("record") != ""))
        if len(names) > 1:
            body = body.join(files, ["archive", "member"], "left_semi")
        parts.append(parse_records(body, "record", found, dialect)
                     .select("feed", "archive", "member", BAD, STATUS, *entity.columns))
    if not parts:
        empty = ", ".join(f"{c} string" for c in ("feed", "archive", "member", BAD, STATUS, *entity.columns))
        return records.sparkSession.createDataFrame([], empty)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def load_text(spark: SparkSession, house: Warehouse, run_id: str, version: str, entity: Entity,
              dialect: Dialect = Dialect(), max_bad_rows: int = MAX_BAD_ROWS) -> None:
    """The entity's text table of this run: a feed that did not come has no rows in it. Bad
    rows, if any, go to the layer of rejects with their file and the reason."""
    rows = text_rows(landing(spark, house, run_id), entity, dialect)
    rows = rows.where(F.col("feed").isin(*entity.feeds))
    # Counted while the rows are written. Only more bad rows in all files together than
    # one file may have call for the scan that counts them by file.
    seen = Observation()
    counted = rows.observe(seen, F.count_if(F.col(STATUS) == SHORT).alias("bad"))
    tables.overwrite(accepted_rows(counted).select("feed", *entity.columns), house.path("text", entity.name, version))
    if seen.get["bad"] > 0:
        filed = rows.withColumn("_file", F.concat_ws("#", "archive", "member"))
        tables.overwrite(rejected_rows(filed).select("_file", F.col(BAD).alias("record"), F.col(STATUS).alias("reason")),
                         house.path("rejects", entity.name, version))
        if seen.get["bad"] > max_bad_rows:
            require_few_bad_rows(filed, limit=max_bad_rows)


# ---------------------------------------------------------------- typed, crosswalk, staged

def set_misfits_apart(house: Warehouse, text: DataFrame, version: str, entity: Entity, max_misfits: int) -> DataFrame:
    """The rows whose text fits its types. The others are written with the columns at fault,
    in one scan that counts them; more than ``max_misfits`` stop the load."""
    good, rejected = fitting_and_rejected(text, entity.types)
    seen, path = Observation(), house.path("misfits", entity.name, version)
    tables.overwrite(rejected.observe(seen, F.count(F.lit(1)).alias("misfits")), path)
    if seen.get["misfits"] > max_misfits:
        raise ValueError(f"{entity.name}: {seen.get['misfits']} rows do not fit their types, {max_misfits} may; see {path}")
    return good


def load_typed(spark: SparkSession, house: Warehouse, runs: list[str], run_id: str, version: str,
               entity: Entity, max_misfits: int | None = None) -> None:
    """Adds this run's partition, or replaces it when the run is repeated. ``runs`` are the
    finished ones without this. Text that does not fit its type stops the load, unless a
    number of such rows is given that may be set apart."""
    text = spark.read.schema(columns(", ".join(f"{c} string" for c in ("feed", *entity.columns)))).parquet(
        house.path("text", entity.name, version))
    before = typed_table(spark, house, entity, runs)
    lenient = max_misfits is not None
    if lenient:
        text = set_misfits_apart(house, text, version, entity, max_misfits)
    rows = with_audit(build_rows(entity, [text.drop("feed")], before, lenient=lenient)).withColumn(RUN, F.lit(run_id))
    tables.replace_partition(rows, house.path("typed", entity.name), RUN, run_id)


def by_key(spark: SparkSession, house: Warehouse, version: str | None) -> DataFrame:
    """The key lookup of a version; without one it has no rows."""
    if version is None:
        return spark.createDataFrame([], BY_KEY)
    return spark.read.schema(BY_KEY).parquet(house.path("identity", "by_key", version))


def load_crosswalk(spark: SparkSession, house: Warehouse, runs: list[str], version: str,
                   lookups: dict[str, DataFrame], last: str | None = None) -> None:
    """From the whole history of subscribers, in a folder per attempt. Beside the crosswalk
    are kept the key lookup, for fifteen tables are enriched from it, and the keys that it
    changes against the ``last`` version."""
    subscribers = typed_table(spark, house, ENTITIES["subscribers"], runs)
    tables.overwrite(identity_crosswalk(subscribers, **lookups), house.path("identity", CROSSWALK, version))
    crosswalk = spark.read.parquet(house.path("identity", CROSSWALK, version))
    tables.overwrite(identities_by_key(crosswalk), house.path("identity", "by_key", version))
    changed = changed_keys(by_key(spark, house, last), by_key(spark, house, version))
    tables.overwrite(changed, house.path("identity", "changed", version))


def load_staged(spark: SparkSession, house: Warehouse, runs: dict[str, str], version: str, entity: Entity,
                last: str | None = None) -> None:
    """The pieces that differ from the ``last`` version. ``runs`` are the finished ones and
    this, each with the version that loaded it."""
    typed = read_or_empty(spark, house.path("typed", entity.name), typed_schema(entity))
    pieces = spark.createDataFrame([], PIECES)
    if last is not None:
        pieces = read_or_empty(spark, house.path("pieces", entity.name, last), PIECES)
    identities = changed = None
    if entity.enriched:
        identities = by_key(spark, house, version)
        changed = spark.read.schema("subscriber_key string").parquet(house.path("identity", "changed", version))
    load_pieces(typed, pieces, runs, version, house.path("staged", entity.name),
                house.path("pieces", entity.name, version), identities, changed)


def staged_view(house: Warehouse, entity: Entity, version: str) -> str:
    """The staged rows of a version as SQL."""
    person = [*IDS, "is_restricted"] if entity.enriched else []
    return staged_query([*person, *entity.schema().names], house.path("staged", entity.name),
                        house.path("pieces", entity.name, version))


def publish_staged(spark: SparkSession, house: Warehouse, version: str, entity: Entity) -> None:
    tables.show_as(spark, f"{house.database}.{entity.name}", staged_view(house, entity, version))


def publish_crosswalk(spark: SparkSession, house: Warehouse, version: str) -> None:
    tables.point_at(spark, f"{house.database}.{CROSSWALK}", house.path("identity", CROSSWALK, version))


# ---------------------------------------------------------------- runs and snapshots

def finished_runs(spark: SparkSession, house: Warehouse) -> DataFrame:
    return read_or_empty(spark, house.path("ledger", "runs"), columns("dt date, version string, pipeline string"))


def runs_until(spark: SparkSession, house: Warehouse, run_id: str) -> list[str]:
    """Ids of the finished runs up to one; a handful per day."""
    rows = finished_runs(spark, house).where(F.col("pipeline") <= run_id).select("pipeline").distinct().collect()
    return sorted(r["pipeline"] for r in rows)


def run_versions(spark: SparkSession, house: Warehouse, runs: list[str]) -> dict[str, str]:
    """The version that loaded each run; a repeated run has that of its last repeat."""
    rows = finished_runs(spark, house).select("pipeline", "version").collect()
    return {r["pipeline"]: r["version"] for r in rows if r["pipeline"] in runs}


def previous_run(spark: SparkSession, house: Warehouse, run_id: str) -> tuple[str, str] | None:
    """(run_id, version) of the last finished run before this one; run ids sort by time."""
    last = finished_runs(spark, house).where(F.col("pipeline") < run_id).agg(
        F.max(F.struct("pipeline", "version")).alias("r")).head()["r"]
    return None if last is None else (last["pipeline"], last["version"])


def snapshot_layers(spark: SparkSession, house: Warehouse, run_id: str, run_date: str) -> None:
    """Names the state before this run in the archive database, dated the day before:
    text and published tables and the crosswalk by their folder, typed tables by their
    partitions."""
    last = previous_run(spark, house, run_id)
    if last is None:
        return
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {house.archive} LOCATION '{house.path('archive', '')}'")
    day = spark.range(1).select(F.date_format(tables.snapshot_day(F.lit(run_date).cast("date")), "yyyyMMdd")).head()[0]
    finished = ", ".join(f"'{r}'" for r in runs_until(spark, house, last[0]))
    tables.point_at(spark, f"{house.archive}.final_{CROSSWALK}_{day}", house.path("identity", CROSSWALK, last[1]))
    for e in ENTITIES.values():
        tables.point_at(spark, f"{house.archive}.text_{e.name}_{day}", house.path("text", e.name, last[1]))
        tables.show_as(spark, f"{house.archive}.final_{e.name}_{day}", staged_view(house, e, last[1]))
        listed = ", ".join(e.schema().names)
        spark.sql(f"CREATE OR REPLACE VIEW {house.archive}.typed_{e.name}_{day} AS SELECT {listed} "
                  f"FROM parquet.`{house.path('typed', e.name)}` WHERE cast({RUN} as string) IN ({finished})")


def for_each(step: Callable[[Entity], None], at_once: int) -> None:
    """The tables of a stage do not depend on each other; a few jobs run side by side so
    that a small table does not leave the cluster idle."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        for done in [pool.submit(step, e) for e in ENTITIES.values()]:
            done.result()


def run_day(spark: SparkSession, drop_root: str, house: Warehouse, lookups: dict[str, DataFrame],
            run_id: str, run_date: str, dialect: Dialect = Dialect(), snapshots: bool = True,
            at_once: int = 4, max_bad_rows: int = MAX_BAD_ROWS, by_range: bool = True,
            max_misfits: int | None = None, take_over: bool = False) -> None:
    """``lookups``: contacts, accounts, enrollees and the four person tables. ``by_range``: see
    ``land_archives``; ``max_misfits``: see ``load_typed``.

    Of two runs of one id at a time the second stops before it writes anything. A run whose
    driver died keeps its claim until the id is started again with ``take_over``.
    """
    version = f"{run_id}-{uuid.uuid4().hex[:8]}"
    with claimed(spark, f"{house.path('ledger', 'claims')}/{run_id}", version, take_over) as claim:
        if snapshots:
            snapshot_layers(spark, house, run_id, run_date)
        before = [r for r in runs_until(spark, house, run_id) if r != run_id]
        taken = land_archives(spark, drop_root, house, before, run_id, dialect, by_range)
        for_each(lambda e: load_text(spark, house, run_id, version, e, dialect, max_bad_rows), at_once)
        claim.require()
        for_each(lambda e: load_typed(spark, house, before, run_id, version, e, max_misfits), at_once)
        last = previous_run(spark, house, run_id)
        last_version = None if last is None else last[1]
        load_crosswalk(spark, house, [*before, run_id], version, lookups, last_version)
        held = {**run_versions(spark, house, before), run_id: version}
        for_each(lambda e: load_staged(spark, house, held, version, e, last_version), at_once)
        # A run that was taken over publishes nothing.
        claim.require()
        for_each(lambda e: publish_staged(spark, house, version, e), at_once)
        publish_crosswalk(spark, house, version)
        # The run's own entry comes last: until it is there, nothing above counts.
        tables.replace_partition(processed_entries(taken, F.lit(run_id)), house.path("ledger", "files"), "run_date", run_id)
        run = spark.createDataFrame([(run_date, run_id, version)], "dt string, pipeline string, version string")
        tables.replace_partitions(run.withColumn("dt", F.col("dt").cast("date")), house.path("ledger", "runs"), "pipeline")
