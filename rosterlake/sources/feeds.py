"""Landed files by feed: which feeds came, and their rows with the feed as a column."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.functions.names import feed_of
from rosterlake.sources.delimited import Dialect
from rosterlake.sources.manifest import list_files, relative_to
from rosterlake.sources.quoted_lines import read_files


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """Files below root, with the feed their first folder names."""
    files = list_files(spark, root)
    inner = relative_to(F.col("path"), root)
    return files.select("path", feed_of(F.substring_index(inner, "/", 1)).alias("feed"),
                        F.element_at(F.split(inner, "/"), -1).alias("file_name")
                        ).where(~F.col("file_name").rlike("^[_.]"))


def read_landed(spark: SparkSession, files: DataFrame, columns: Sequence[str],
                dialect: Dialect = Dialect()) -> DataFrame:
    """The files of all feeds; rows carry the feed their file is listed under.

    The list of a day's files goes through the driver, as every Spark scan's does.
    """
    listed = files.select("path", "feed").collect()
    if not listed:
        names = [*columns]
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in [*names, "feed"]))
    parts = []
    for feed in sorted({r["feed"] for r in listed}):
        paths = sorted(r["path"] for r in listed if r["feed"] == feed)
        parts.append(read_files(spark, paths, columns, dialect).withColumn("feed", F.lit(feed)))
    return reduce(DataFrame.unionByName, parts)


def feed_counts(rows: DataFrame, feeds: Sequence[str]) -> DataFrame:
    """Rows per expected feed; one that did not come is reported with none."""
    counts = rows.groupBy("feed").agg(F.count(F.lit(1)).alias("landed"))
    expected = rows.sparkSession.createDataFrame([(f,) for f in feeds], "feed string")
    return expected.join(counts, "feed", "left").select("feed", F.coalesce("landed", F.lit(0).cast("bigint")).alias("landed"))
