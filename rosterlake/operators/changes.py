"""What a new version of the key lookup changes, and which written pieces that touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.operators.identity import IDS, NOT_RESTRICTED, UNKNOWN_ID

# The group of rows without a key: they stand for nobody under any lookup.
NO_KEY = -1


def changed_keys(before: DataFrame, after: DataFrame) -> DataFrame:
    """(subscriber_key) of the keys whose rows the two versions of ``identities_by_key``
    enrich differently.

    A key's identities are compared as counts, exactly: both versions are laid on top of
    each other in one shuffle by key, in which a key has as many rows as identities. A key
    that is in one version only counts as the unknown person once in the other, as
    enrichment has it, so keys that come in unresolved change nothing.
    """
    identity = ["subscriber_key", *IDS, "is_restricted"]
    none = F.lit(0).cast("bigint")
    both = (before.select(*identity, F.col("copies").alias("old"), none.alias("new"))
            .unionByName(after.select(*identity, none.alias("old"), F.col("copies").alias("new")))
            .where(F.col("subscriber_key").isNotNull()).repartition("subscriber_key"))
    unknown = (F.col("is_restricted") == NOT_RESTRICTED)
    for i in IDS:
        unknown = unknown & (F.col(i) == UNKNOWN_ID)
    at_least_one = [F.greatest(F.sum(c), F.lit(1)) for c in ("old", "new")]
    return (
        both.groupBy(*identity).agg(F.sum("old").alias("old"), F.sum("new").alias("new"))
        .groupBy("subscriber_key").agg(
            F.bool_or(F.col("old") != F.col("new")).alias("differs"),
            F.bool_and(unknown).alias("unknown"),
            (at_least_one[0] != at_least_one[1]).alias("repeated"))
        .where(F.when(F.col("unknown"), F.col("repeated")).otherwise(F.col("differs")))
        .select("subscriber_key")
    )


def key_group(key: Column | str, groups: int) -> Column:
    """Number of the group a key falls into, ``NO_KEY`` without a key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.when(key.isNull(), F.lit(NO_KEY)).otherwise(F.pmod(F.xxhash64(key), F.lit(groups)).cast("int"))


def touched_groups(rows: DataFrame, run: str, changed: DataFrame, groups: int) -> DataFrame:
    """(run, key_group) of all groups in which a changed key occurs.

    Of the rows only the run and the key are read, and equal pairs collapse before the
    shuffle, so a hot key counts once a run. Where few keys changed, adaptive execution
    hands them to every task instead.
    """
    pairs = rows.where(F.col("subscriber_key").isNotNull()).select(run, "subscriber_key").distinct()
    met = pairs.join(changed, "subscriber_key", "left_semi")
    return met.select(run, key_group("subscriber_key", groups).alias("key_group")).distinct()
