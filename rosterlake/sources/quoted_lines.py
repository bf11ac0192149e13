"""Delimited files with quoted line ends, read in parallel.

Spark reads such a file whole in one task. Here its lines are read split by split, and
where records begin is worked out afterwards. A line maps the state it starts in (outside
or inside a quoted field) to the state it ends in. Both outcomes are known from the line
alone, so the states of a split follow up to its entry state, and the entry states follow
from the splits before: a table of one row per split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterlake.sources.delimited import (Dialect, opens_quote, parse_records, read_delimited, read_lines,
                                          stays_quoted)

# Fixed value: the longest record a load takes, in bytes. So many without the start of a
# record, whatever splits they lie in, mean a quote that is never closed.
MAX_RECORD_BYTES = 100 * 1024 * 1024
SPLIT = ["_file", "_split"]


def _running_state(rows: DataFrame, group: list[str], order: list[str], outside: str, inside: str) -> DataFrame:
    """Per row the outcome of all rows of its group up to it, for both entry states:
    ``_o`` and ``_i``.

    A row that ends alike either way fixes the state; since the last such row only rows
    that swap the state matter.
    """
    upto = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    swap = F.col(outside) & ~F.col(inside)
    fixed = F.when(F.col(outside) == F.col(inside), F.col(outside))
    rows = rows.withColumns({"_swaps": F.sum(swap.cast("int")).over(upto), "_fixed": fixed})
    rows = rows.withColumns({
        "_base": F.last("_fixed", ignorenulls=True).over(upto),
        "_base_swaps": F.last(F.when(F.col("_fixed").isNotNull(), F.col("_swaps")), ignorenulls=True).over(upto)})
    odd = (F.col("_swaps") - F.coalesce("_base_swaps", F.lit(0))) % 2 == 1
    return rows.withColumns({
        "_o": F.coalesce("_base", F.lit(False)) != odd,
        "_i": F.coalesce("_base", F.lit(True)) != odd,
    }).drop("_swaps", "_fixed", "_base", "_base_swaps")


def _never_closed() -> Column:
    return F.raise_error(F.concat(F.lit("a quote is never closed in "), "_file"))


def read_records(spark: SparkSession, paths: str | list[str], dialect: Dialect = Dialect(),
                 max_record_bytes: int | None = None) -> DataFrame:
    """(_file, record_no, record) of files with quoted line ends; record 0 of a file is its
    first. Numbers grow within a file but are not dense."""
    lines = (
        spark.read.option("lineSep", "\n").text(paths)
        .select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
                F.monotonically_increasing_id().alias("_at"), F.regexp_replace("value", "\r$", "").alias("line"))
    )
    lines = lines.withColumns({"_open": opens_quote(F.col("line"), dialect), "_stay": stays_quoted(F.col("line"), dialect)})
    lines = _running_state(lines, SPLIT, ["_at"], "_open", "_stay")
    inside = Window.partitionBy(*SPLIT).orderBy("_at")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    # Start of a record: the line before it ended outside. The first line takes the entry state.
    before = {f"_before{s}": F.lag(f"_{s}", 1, default).over(inside) for s, default in (("o", False), ("i", True))}
    lines = lines.withColumns(before).withColumns({
        f"_nth{s}": F.sum((~F.col(f"_before{s}")).cast("bigint")).over(upto) for s in ("o", "i")})

    splits = lines.groupBy(*SPLIT).agg(
        F.max_by("_o", "_at").alias("_open"), F.max_by("_i", "_at").alias("_stay"),
        F.max("_ntho").alias("_starts_o"), F.max("_nthi").alias("_starts_i"), F.sum(F.length("line")).alias("_bytes"))
    entered = _running_state(splits, ["_file"], ["_split"], "_open", "_stay")
    in_order = Window.partitionBy("_file").orderBy("_split")
    entered = entered.withColumn("_entry", F.lag("_o", 1, False).over(in_order))
    starts = F.when(F.col("_entry"), F.col("_starts_i")).otherwise(F.col("_starts_o"))
    # The bytes since the last split with a start, which may belong to one record.
    entered = entered.withColumn("_starts", starts).withColumn(
        "_run", F.sum((F.col("_starts") > 0).cast("int")).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    since = Window.partitionBy("_file", "_run").orderBy("_split").rowsBetween(Window.unboundedPreceding, 0)
    open_bytes = F.sum(F.when(F.col("_starts") == 0, F.col("_bytes")).otherwise(F.lit(0))).over(since)
    limit = MAX_RECORD_BYTES if max_record_bytes is None else max_record_bytes
    entered = entered.withColumn("_open_bytes", open_bytes)
    too_long = (F.col("_starts") == 0) & (F.col("_open_bytes") > limit)
    starts = F.when(too_long, _never_closed().cast("bigint")).otherwise(F.col("_starts"))
    # Numbers of a split's records follow those of the splits before it.
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    entered = entered.withColumn("_starts", starts).withColumn(
        "_first", F.coalesce(F.sum("_starts").over(earlier), F.lit(0)))

    placed = lines.join(entered.select(*SPLIT, "_entry", "_first"), SPLIT)
    nth = F.when(F.col("_entry"), F.col("_nthi")).otherwise(F.col("_ntho"))
    placed = placed.select("_file", (F.col("_first") + nth - 1).alias("record_no"), "_split", "_at", "line")
    # A group is the lines of one record. The guard above keeps it to a few splits; the limit
    # itself holds wherever the splits lie.
    records = placed.groupBy("_file", "record_no").agg(
        F.array_sort(F.collect_list(F.struct("_split", "_at", "line"))).alias("_l"), F.sum(F.length("line") + 1).alias("_bytes"))
    return records.select("_file", "record_no", F.when(F.col("_bytes") > limit, _never_closed()).otherwise(F.array_join("_l.line", "\n")).alias("record"))


def read_profiled(spark: SparkSession, files: Sequence[tuple[str, bool]], columns: Sequence[str],
                  dialect: Dialect = Dialect(), header: bool = True) -> DataFrame:
    """All-string rows of (file, holds quoted line ends) pairs, with file and row status."""
    plain = sorted(f for f, quoted in files if not quoted)
    quoted = sorted(f for f, quoted in files if quoted)
    parts = []
    if plain:
        parts.append(read_delimited(spark, plain, columns, dialect, header))
    if quoted:
        records = read_records(spark, quoted, dialect)
        if header:
            records = records.where(F.col("record_no") > 0)
        parts.append(parse_records(records.where(F.col("record") != ""), "record", columns, dialect).drop("record_no"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_files(spark: SparkSession, paths: str | list[str], columns: Sequence[str],
               dialect: Dialect = Dialect(), header: bool = True) -> DataFrame:
    """All-string rows with their file and a row status, whatever line ends the files hold.

    A scan of the whole files, one row each, tells which of them hold quoted line ends.
    All others are read by Spark's own splittable reader.
    """
    profiles = (read_lines(spark, paths).groupBy("_file").agg(F.max(opens_quote(F.col("value"), dialect)).alias("quoted_line_ends"))
                .collect())
    if not profiles:
        return read_delimited(spark, paths, columns, dialect, header)
    return read_profiled(spark, [(r["_file"], r["quoted_line_ends"]) for r in profiles], columns, dialect, header)
