"""Staged tables that are made anew only where something changed.

A staged table is a set of pieces, one per load run and group of subscriber keys. A table
of pieces per version names those that make it up. A new version keeps every piece of the
last one except those of runs that were loaded again and those in which a key occurs whose
identity changed; these, and the pieces of new runs, are written under new names. No piece
is ever overwritten, so readers of older versions and their snapshots go on, and what an
attempt wrote before it died is named by no table of pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.operators.changes import NO_KEY, key_group, touched_groups
from rosterlake.operators.enrich import enrich
from rosterlake.operators.skew import hot_keys
from rosterlake.schema import columns
from rosterlake.sinks import tables

# Groups per run: a changed key has the rows of one group of each run written again.
KEY_GROUPS = 64
PIECE = "piece"
RUNS = columns("load_run string, run_version string")
PIECES = columns("load_run string, run_version string, key_group int, made string, piece string")


def next_pieces(last: DataFrame, runs: DataFrame, touched: DataFrame | None, version: str,
                groups: int = KEY_GROUPS) -> DataFrame:
    """The table of pieces of a version. ``last`` is the one before, ``runs`` the runs the
    table now holds with the version that loaded each, ``touched`` the groups whose rows
    stand for someone else now, or None where no row is enriched.

    All three have at most a row per run and group. A new run is listed with all groups: a
    piece without rows has no files.
    """
    same_load = ["load_run", "run_version"]
    kept = last.join(runs, same_load, "left_semi").select(*same_load, "key_group", "made")
    fresh = runs.join(last, same_load, "left_anti")
    now = F.lit(version)
    if touched is None:
        fresh = fresh.withColumn("key_group", F.lit(NO_KEY))
    else:
        fresh = fresh.withColumn("key_group", F.explode(F.sequence(F.lit(NO_KEY), F.lit(groups - 1))))
        stale = touched.withColumn("stale", F.lit(True))
        kept = kept.join(stale, ["load_run", "key_group"], "left").select(
            *same_load, "key_group", F.when(F.col("stale"), now).otherwise(F.col("made")).alias("made"))
    rows = kept.unionByName(fresh.withColumn("made", now))
    return rows.withColumn(PIECE, F.concat(F.lit("r"), "load_run", F.lit("."), "key_group", F.lit("."), "made"))


def rows_to_write(typed: DataFrame, pieces: DataFrame, version: str, keyed: bool, groups: int = KEY_GROUPS) -> DataFrame:
    """Typed rows of the pieces this version makes, with the piece. ``typed`` is partitioned by
    ``load_run``: the pieces prune it, so runs of which nothing is made are not read."""
    group = key_group("subscriber_key", groups) if keyed else F.lit(NO_KEY)
    making = pieces.where(F.col("made") == version).select("load_run", "key_group", PIECE)
    return (typed.withColumn("key_group", group).join(making, ["load_run", "key_group"])
            .drop("load_run", "key_group"))


def write_pieces(rows: DataFrame, path: str, version: str) -> None:
    """Pieces are brought together before they are written, so that each is a few files;
    adaptive execution cuts those of hot keys. An empty piece beside them gives readers the
    columns where no row has come yet."""
    tables.overwrite(rows.drop(PIECE).where("false"), f"{path}/{PIECE}=none.{version}")
    tables.replace_partitions(rows.hint("rebalance", PIECE), path, PIECE)


def load_pieces(typed: DataFrame, last: DataFrame, runs: dict[str, str], version: str, rows_path: str,
                pieces_path: str, identities: DataFrame | None = None, changed: DataFrame | None = None,
                groups: int = KEY_GROUPS) -> None:
    """Writes the table of pieces of ``version`` and the pieces it makes.

    ``typed`` holds all runs with their ``load_run``, ``runs`` those that count and the
    version that loaded each, ``last`` the table of pieces before. ``identities`` and
    ``changed`` are those of the enriched tables; without them rows are passed on. ``changed``
    has to cover everything since the version of ``last``.
    """
    spark = typed.sparkSession
    current = spark.createDataFrame(sorted(runs.items()), RUNS)
    touched = None
    if identities is not None:
        held = last.join(current, ["load_run", "run_version"], "left_semi").where(F.col("key_group") > NO_KEY)
        before = typed.join(held.select("load_run").distinct(), "load_run", "left_semi")
        touched = touched_groups(before, "load_run", changed, groups)
    tables.overwrite(next_pieces(last, current, touched, version, groups), pieces_path)
    pieces = spark.read.schema(PIECES).parquet(pieces_path)
    rows = rows_to_write(typed, pieces, version, identities is not None, groups)
    if identities is not None:
        rows = enrich(rows, identities, hot_keys(rows, ["subscriber_key"]))
    write_pieces(rows, rows_path, version)


def staged_query(names: list[str], rows_path: str, pieces_path: str) -> str:
    """The rows of one version as SQL, for a view: the table of pieces prunes the others' files."""
    listed = ", ".join(f"`{c}`" for c in names)
    return (f"SELECT {listed} FROM parquet.`{rows_path}` WHERE {PIECE} IN "
            f"(SELECT {PIECE} FROM parquet.`{pieces_path}` WHERE key_group >= {NO_KEY})")


def staged_rows(spark: SparkSession, names: list[str], rows_path: str, pieces_path: str) -> DataFrame:
    return spark.sql(staged_query(names, rows_path, pieces_path))
