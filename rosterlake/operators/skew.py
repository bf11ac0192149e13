"""Joins that stay balanced when one key, or the null key, holds much of the left side."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.session import shuffle_partitions

# Keys that a sketch tracks, per key that may be hot. At most one key per partition is
# larger than an average partition, so the table of hot keys has as many rows at most.
TRACKED_PER_KEY, LEAST_TRACKED, MOST_TRACKED = 10, 10_000, 1_000_000
SKETCH_GROUPS = 256
# Pieces per average partition: several small ones fall more evenly than one large.
FINENESS = 4


def _listed(columns: list[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def _present(keys: list[str]) -> str:
    return " and ".join(f"`{k}` is not null" for k in keys)


def hot_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that alone exceed an average shuffle partition, with the pieces to cut them into.

    One scan of the key columns and one sketch per task; nothing is shuffled by key. The
    sketches of very many tasks are merged in two steps, so that no task gets them all.
    A sketch may misjudge a share, which changes balance only, never a result.
    """
    parts = shuffle_partitions(df.sparkSession)
    tracked = min(MOST_TRACKED, max(LEAST_TRACKED, TRACKED_PER_KEY * parts))
    sketches = (
        df.where(_present(keys))
        .selectExpr(f"xxhash64({_listed(keys)}) as h", f"pmod(spark_partition_id(), {SKETCH_GROUPS}) as g")
        .groupBy("g").agg(F.expr(f"approx_top_k_accumulate(h, {tracked}) as s"), F.expr("count(*) as n"))
        # Grouped, so that without any key there is no group: combining nothing fails.
        .groupBy((F.col("g") * 0).alias("all"))
        .agg(F.expr(f"approx_top_k_combine(s, {tracked}) as s"), F.expr("sum(n) as n"))
    )
    return (
        sketches.selectExpr(f"inline(approx_top_k_estimate(s, {min(parts, tracked)}))", "n")
        .where(f"count * {parts}D / n > 1")
        .selectExpr("item as _hot", f"ceil(count * {FINENESS * parts}D / n) as _pieces")
    )


def _check_types(left: DataFrame, right: DataFrame, keys: list[str]) -> None:
    left_types, right_types = dict(left.dtypes), dict(right.dtypes)
    for k in keys:
        if left_types[k] != right_types[k]:
            raise TypeError(f"join key {k}: {left_types[k]} and {right_types[k]}")


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left",
                hot: DataFrame | None = None) -> DataFrame:
    """Equi-join of a large left side with a lookup, on columns named alike on both sides.

    ``how`` is left, inner, left_semi or left_anti; keys have the same type on both sides.
    Left rows with a null key match nothing, so they are spread over all partitions. With
    ``hot`` (see ``hot_keys``) the left rows of a hot key are spread over its pieces and
    its right rows are repeated once per piece. Rows are spread by their content, which a
    repeated task reproduces; copies of one row stay together, so make rows distinct first.
    """
    _check_types(left, right, keys)
    spread = f"pmod(xxhash64({_listed(left.columns)}), {{}})"
    everywhere = spread.format(shuffle_partitions(left.sparkSession))
    renamed = [f"`{k}` as `_r_{k}`" for k in keys] + [f"`{c}`" for c in right.columns if c not in keys]
    lookup = right.where(_present(keys))

    if hot is None:
        salted = left.withColumn("_salt", F.expr(f"if({_present(keys)}, 0L, {everywhere})"))
        # Always 0, but not a literal: a literal would be folded away and with it
        # the salt as a join key.
        lookup = lookup.selectExpr(*renamed, f"pmod(xxhash64({_listed(keys)}), 1L) as _r_salt")
    else:
        # At most one row per shuffle partition, hence the broadcast.
        hot = F.broadcast(hot)
        pieces = spread.format("coalesce(_pieces, 1L)")
        salted = left.join(hot, F.expr(_is_hot(keys)), "left").withColumn(
            "_salt", F.expr(f"if({_present(keys)}, {pieces}, {everywhere})")).drop("_hot", "_pieces")
        lookup = lookup.join(hot, F.expr(f"xxhash64({_listed(keys)}) = _hot"), "left").selectExpr(
            *renamed, "explode(sequence(0L, coalesce(_pieces, 1L) - 1L)) as _r_salt")
    on = [F.expr(f"`{k}` = `_r_{k}`") for k in keys] + [F.expr("_salt = _r_salt")]
    return salted.join(lookup, reduce(and_, on), how).drop("_salt", "_r_salt", *[f"_r_{k}" for k in keys])


def _is_hot(keys: list[str]) -> str:
    return f"if({_present(keys)}, xxhash64({_listed(keys)}), null) = _hot"


def unique_lookup_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left",
                       hot: DataFrame | None = None) -> DataFrame:
    """As ``lookup_join``, for a right side with at most one row per key, such as one that
    was just grouped by it: it keeps the partitioning the grouping gave it and is not
    shuffled again. ``how`` is left, inner or left_anti.

    The few right rows of hot keys are broadcast, at most one per shuffle partition. Left rows
    of hot and of null keys need the shuffled join no more. They pass through it under a
    made-up key that spreads them by their content, and a condition keeps them from
    matching it. The first key must be a string or a bigint.
    """
    _check_types(left, right, keys)
    first, kind = keys[0], dict(left.dtypes)[keys[0]]
    if kind not in ("string", "bigint"):
        raise TypeError(f"join key {first} is {kind}, not string or bigint")
    payload = [c for c in right.columns if c not in keys]
    apart, found = f"not ({_present(keys)})", "_r_found"
    rows, content = left, f"cast(xxhash64({_listed(left.columns)}) as {kind})"
    if hot is not None:
        hot = F.broadcast(hot)
        # Inner, not semi: a semi-join would move below the grouping and scan its input again.
        few = right.join(hot, F.expr(f"xxhash64({_listed(keys)}) = _hot")).selectExpr(
            *[f"`{k}` as `_h_{k}`" for k in keys], *[f"`{c}` as `_h_{c}`" for c in payload], "true as _h_found")
        rows = rows.join(hot, F.expr(_is_hot(keys)), "left").drop("_pieces")
        rows = rows.join(F.broadcast(few), reduce(and_, [F.expr(f"`{k}` = `_h_{k}`") for k in keys]), "left")
        apart = f"(_hot is not null or {apart})"
        found = "coalesce(_h_found, _r_found)"
        if how == "left_anti":
            rows = rows.where("_h_found is null")
    rows = rows.withColumns({"_apart": F.expr(apart), "_first": F.expr(f"if({apart}, {content}, `{first}`)")})
    lookup = right.where(_present(keys)).selectExpr(
        *[f"`{k}` as `_r_{k}`" for k in keys], *[f"`{c}` as `_r_{c}`" for c in payload], "true as _r_found")
    on = [F.expr(f"_first = `_r_{first}`")] + [F.expr(f"`{k}` = `_r_{k}`") for k in keys[1:]] + [F.expr("not _apart")]
    if how == "left_anti":
        return rows.join(lookup, reduce(and_, on), how).selectExpr(*[f"`{c}`" for c in left.columns])
    joined = rows.join(lookup, reduce(and_, on), "left")
    if how == "inner":
        joined = joined.where(found)
    chosen = [f"`_r_{c}` as `{c}`" if hot is None else f"if(_h_found, `_h_{c}`, `_r_{c}`) as `{c}`" for c in payload]
    return joined.selectExpr(*[f"`{c}`" for c in left.columns], *chosen)
