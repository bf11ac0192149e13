"""Rows without repeats by their business key: within a batch, and against a target.

A row with a null in its key is no repeat of any other; all such rows pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _has_key(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"`{k}`").isNotNull() for k in keys])


def latest_by_key(rows: DataFrame, keys: Sequence[str], latest: Sequence[str] = ()) -> DataFrame:
    """One row per key: that of the greatest values of ``latest``, nulls counting least; among
    equal ones that of the greatest values of the other columns, so a repeat gives the same.

    One greatest struct per key and task is shuffled. Rows without a key get a group each,
    which spreads them over all partitions. All columns have to be of types that can be ordered.
    """
    order = [*latest, *[c for c in rows.columns if c not in latest]]
    alone = F.when(~_has_key(keys), F.monotonically_increasing_id())
    held = rows.groupBy(*[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)], alone.alias("_alone")).agg(
        F.max(F.struct(*[F.col(f"`{c}`") for c in order])).alias("_row"))
    return held.select(*[F.col("_row").getField(c).alias(c) for c in rows.columns])


def without_known(rows: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key the target does not hold. ``rows`` are read several times, so give
    a written table.

    Of the target only the keys are read, and of those only what lies between the least and
    the greatest first key of the rows: a filter the scan uses on whole row groups. Keys the
    rows ask for are looked up by a semi-join, which Spark runs as a broadcast where they are
    few, and else with a Bloom filter of them on the target's scan once that is large
    (``spark.sql.optimizer.runtime.bloomFilter.*``). Of the target no more than the keys
    found meet the rows themselves.
    """
    first = F.col(f"`{keys[0]}`")
    complete = _has_key(keys)
    keyed = rows.where(complete)
    least, greatest = keyed.agg(F.min(first), F.max(first)).head()
    if least is None:
        return rows
    within = first.between(F.lit(least), F.lit(greatest))
    names = [F.col(f"`{k}`") for k in keys]
    asked = keyed.select(*names).where(within).distinct()
    known = target.select(*names).where(within).join(asked, list(keys), "left_semi").distinct()
    return keyed.join(known, list(keys), "left_anti").select(*rows.columns).unionByName(rows.where(~complete))
