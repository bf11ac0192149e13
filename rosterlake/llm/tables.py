"""Reading inputs, cutting lineage and global row order, as the operators share them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from rosterlake.session import scratch_dir, shuffle_partitions

ROWS_A_FILE = 10_000  # of a small table, on average
SENT_ROWS = 1 << 18  # of a table whose number of rows is known, at most, to be broadcast: some 30 MB of the driver's heap
ROW_BITS = 33  # monotonically_increasing_id() keeps the row's place in its partition below this bit


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """The rows, written to the shared scratch folder and read back: a lost executor costs no recomputation.

    Where it is known that there are about ``rows`` at most, few rows are written as few files, whatever the number
    of shuffle partitions: each file costs requests to the store, on local disks a process to set its permissions.
    """
    path = scratch_dir(df.sparkSession, label)
    (df if rows is None else df.coalesce(max(1, -(-rows // ROWS_A_FILE)))).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unsent(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` as a side of a join that broadcasts neither side where ``df`` has more than SENT_ROWS ``rows``, or an unknown number.

    Spark sizes a table by its files, which are compressed, and an exploded one by its rows before the explode, so that
    what seems to be below its limit may not fit the driver's memory.
    """
    return df.hint("merge") if rows is None or rows > SENT_ROWS else df


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds the row's place in the global order, from 0.

    The rows are range-partitioned and written once with their place in their partition.
    What lies before a partition comes from the partitions' counts, one row each. Rows
    that tie in all of ``order`` are numbered in any order, so give a unique one.
    """
    place = f"_{name}_place"
    placed = written(df.repartitionByRange(shuffle_partitions(df.sparkSession), *order)
                     .sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id()), "numbered")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(F.shiftright(place, ROW_BITS).alias("_part")).agg(F.count("*").alias("_rows"))
               .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")))
    own = F.col(place).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    # One row per partition, so its size is bounded by the partition count.
    return (placed.withColumn("_part", F.shiftright(place, ROW_BITS)).join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_before") + own).drop("_part", "_before", place))


def digits_hash(*columns: Column | str, digits: int = 15) -> Column:
    """A number below 16**digits from the MD5 of the columns as text; any SQL engine can form it."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"),
                                         F.lit("\\N")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")
