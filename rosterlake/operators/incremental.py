"""Feed unions and the three ways a batch is set against the table it is loaded into."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.operators.skew import hot_keys, unique_lookup_join


def union_feeds(feeds: Sequence[DataFrame], distinct: bool = False) -> DataFrame:
    """Feeds matched by column name, so a feed with another column order cannot misalign."""
    if not feeds:
        raise ValueError("no feed given")
    rows = reduce(lambda a, b: a.unionByName(b), feeds)
    return rows.distinct() if distinct else rows


def _with_keys(rows: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Computed keys become columns first, so the join stays a plain equi-join."""
    return rows.select("*", *[expr.alias(name) for name, expr in keys.items()])


def _sketched(left: DataFrame, landed: DataFrame | None, names: Sequence[str], keys: Sequence[Column]) -> DataFrame:
    return left if landed is None else landed.select(*[k.alias(n) for n, k in zip(names, keys)])


def new_rows(incoming: DataFrame, existing: DataFrame, incoming_keys: Sequence[Column],
             existing_keys: Sequence[Column], salt: bool = True, landed: DataFrame | None = None) -> DataFrame:
    """Incoming rows whose key is not loaded yet. A null key counts as not loaded.

    Of the history only the distinct keys travel; copies collapse before the shuffle. Hot keys
    are looked for in ``landed``, rows with the same key columns that are cheaper to read than
    ``incoming``, such as those it was made distinct from.
    """
    names = [f"_k{i}" for i in range(len(incoming_keys))]
    left = _with_keys(incoming, dict(zip(names, incoming_keys)))
    right = existing.select(*[k.alias(n) for n, k in zip(names, existing_keys)]).distinct()
    hot = hot_keys(_sketched(left, landed, names, incoming_keys), names) if salt else None
    return unique_lookup_join(left, right, names, "left_anti", hot).select(*incoming.columns)


def key_ranges(existing: DataFrame, keys: dict[str, Column], compare: dict[str, Column]) -> DataFrame:
    """One row per key: least and greatest loaded value of each compared column, and
    whether a null was loaded. Enough to tell whether any loaded version differs from
    a given value, without joining the versions themselves."""
    aggregates = []
    for name, value in compare.items():
        aggregates += [
            F.min(value).alias(f"_min_{name}"),
            F.max(value).alias(f"_max_{name}"),
            F.max(value.isNull()).alias(f"_null_{name}"),
        ]
    return existing.groupBy(*[e.alias(n) for n, e in keys.items()]).agg(*aggregates)


def latest_versions(existing: DataFrame, keys: dict[str, Column], compare: dict[str, Column],
                    version: Sequence[Column]) -> DataFrame:
    """As ``key_ranges``, but of the greatest ``version`` of each key alone. Of rows that
    tie in it the one with the greatest compared values, in their order and nulls least,
    is the latest. One struct per key and task is shuffled, however many versions there are."""
    names = list(compare)
    kept = F.struct(*[v.alias(f"_version{i}") for i, v in enumerate(version)], *[compare[n].alias(n) for n in names])
    latest = existing.groupBy(*[e.alias(n) for n, e in keys.items()]).agg(F.max(kept).alias("_latest"))
    held = [F.col("_latest").getField(n) for n in names]
    return latest.select(*keys, *[c for n, v in zip(names, held) for c in (
        v.alias(f"_min_{n}"), v.alias(f"_max_{n}"), v.isNull().alias(f"_null_{n}"))])


def _differs(value: Column, name: str, null_safe: bool) -> Column:
    low, high = F.col(f"_min_{name}"), F.col(f"_max_{name}")
    apart = F.coalesce((value != low) | (value != high), F.lit(False))
    if not null_safe:
        return apart
    one_null = (value.isNull() & low.isNotNull()) | (value.isNotNull() & F.col(f"_null_{name}"))
    return apart | F.coalesce(one_null, F.lit(False))


def _against_history(incoming, existing, incoming_keys, existing_keys, incoming_values,
                     existing_values, how, salt, latest, landed):
    names = [f"_k{i}" for i in range(len(incoming_keys))]
    labels = [f"v{i}" for i in range(len(incoming_values))]
    left = incoming.select(
        "*",
        *[k.alias(n) for n, k in zip(names, incoming_keys)],
        *[v.alias(f"_{n}") for n, v in zip(labels, incoming_values)],
    )
    stored = existing, dict(zip(names, existing_keys)), dict(zip(labels, existing_values))
    ranges = latest_versions(*stored, latest) if latest else key_ranges(*stored)
    hot = hot_keys(_sketched(left, landed, names, incoming_keys), names) if salt else None
    return unique_lookup_join(left, ranges.withColumn("_loaded", F.lit(True)), names, how, hot), labels


def changed_rows(incoming: DataFrame, existing: DataFrame, incoming_keys: Sequence[Column],
                 existing_keys: Sequence[Column], incoming_values: Sequence[Column],
                 existing_values: Sequence[Column], null_safe: bool = False,
                 salt: bool = True, latest: Sequence[Column] = (), landed: DataFrame | None = None) -> DataFrame:
    """Incoming rows that differ from any loaded version of their key, or, where ``latest``
    names the columns that order versions, from the latest one.

    By default a change from or to null goes unseen, as ``<>`` does not see it;
    ``null_safe`` counts it as a change. ``landed`` is as in ``new_rows``.
    """
    rows, labels = _against_history(incoming, existing, incoming_keys, existing_keys,
                                    incoming_values, existing_values, "inner", salt, latest, landed)
    changed = reduce(or_, [_differs(F.col(f"_{n}"), n, null_safe) for n in labels])
    return rows.where(changed).select(*incoming.columns)


def new_or_changed(incoming: DataFrame, existing: DataFrame, incoming_keys: Sequence[Column],
                   existing_keys: Sequence[Column], incoming_values: Sequence[Column],
                   existing_values: Sequence[Column], null_safe: bool = False,
                   salt: bool = True, latest: Sequence[Column] = (), landed: DataFrame | None = None) -> DataFrame:
    """Rows of an unknown key, and rows that differ from any loaded version of theirs
    (or from the latest, as in ``changed_rows``). ``landed`` is as in ``new_rows``."""
    rows, labels = _against_history(incoming, existing, incoming_keys, existing_keys,
                                    incoming_values, existing_values, "left", salt, latest, landed)
    changed = reduce(or_, [_differs(F.col(f"_{n}"), n, null_safe) for n in labels])
    return rows.where(F.col("_loaded").isNull() | changed).select(*incoming.columns)


def with_audit(rows: DataFrame, load_ts: Column | None = None) -> DataFrame:
    """load_id in front, load_ts behind. Call it after the duplicates are gone: a load_id
    differs from row to row."""
    stamp = F.current_timestamp() if load_ts is None else load_ts
    return rows.select(F.expr("uuid()").alias("load_id"), *rows.columns, stamp.alias("load_ts"))
