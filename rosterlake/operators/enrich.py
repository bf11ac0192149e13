"""Enrichment: the resolved person in front of every row that carries a subscriber key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.operators.identity import IDS, NOT_RESTRICTED, UNKNOWN_ID
from rosterlake.operators.skew import lookup_join


def enrich(source: DataFrame, identities: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """person_id, demographic_id, is_restricted, then all source columns.

    ``identities`` comes from ``identities_by_key``; ``hot`` from ``hot_keys`` over the
    source's subscriber_key. A key known under several crosswalk rows repeats its row.
    """
    found = lookup_join(source, identities, ["subscriber_key"], "left", hot)
    one = F.lit(1).cast("bigint")
    return found.select(
        *[F.coalesce(i, F.lit(UNKNOWN_ID).cast("bigint")).alias(i) for i in IDS],
        F.coalesce("is_restricted", F.lit(NOT_RESTRICTED)).alias("is_restricted"),
        *source.columns,
        F.explode(F.sequence(one, F.coalesce("copies", one))).alias("_copy"),
    ).drop("_copy")
