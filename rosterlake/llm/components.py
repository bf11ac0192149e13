"""Connected components of an edge table, by least labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rosterlake.llm.tables import unsent, written

ONE_TASK_EDGES = 1 << 16  # at most; a shuffle of so few rows of two numbers costs more tasks than it saves time


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("node").agg(F.min("label").alias("label"))


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """``node, label`` for every node of ``edges(src, dst)``: the least node that it reaches.

    Each round a node, and the node it is labelled with, take the least label among their
    neighbours; then labels are replaced by their own labels. Labels only ever fall, so an
    unchanged sum ends the rounds, a logarithm of the longest path in number. Minima are
    formed before each shuffle, and the joins on a hub may be split by adaptive execution.
    ``rows`` is the number of edges at most, where it is known. Up to ONE_TASK_EDGES a round is a few jobs of one task, with
    neither a shuffle nor a broadcast: each of those costs the driver a thread, a plan and a report per task.
    """
    most = None if rows is None else 2 * rows  # of nodes and of labels
    few = rows is not None and rows <= ONE_TASK_EDGES

    def near_by(df: DataFrame) -> DataFrame:
        return df.coalesce(1) if few else df

    def beside(df: DataFrame) -> DataFrame:
        return df.hint("shuffle_hash") if few else df if most is None else unsent(df, most)

    both = near_by(written(near_by(edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))).distinct(), "edges", most))
    labels, before = near_by(written(_least(both.select(F.col("src").alias("node"), F.least("src", "dst").alias("label"))), "labels", most)), None
    while True:
        total = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if total == before:
            return labels
        before = total
        near = near_by(_least(both.join(beside(labels.select(F.col("node").alias("dst"), "label")), "dst")
                              .select(F.col("src").alias("node"), "label")))
        hooked = labels.join(beside(near.withColumnRenamed("label", "near")), "node")
        lower = near_by(written(_least(near_by(hooked.select("node", F.least("label", "near").alias("label"))
                                               .unionByName(hooked.where("near < label").select(F.col("label").alias("node"), F.col("near").alias("label"))))),
                                "lower", most))
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = near_by(written(lower.join(beside(jump), "label").select("node", F.least("label", "next").alias("label")), "labels", most))


def components_of_written(edges: DataFrame) -> DataFrame:
    """``components`` of edges that are cheap to read, which are counted first."""
    return components(edges, edges.count())
