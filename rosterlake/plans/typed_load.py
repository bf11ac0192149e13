"""From the all-text feeds of one entity to the rows to append to its typed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.functions.clean import blank_to_null, typed
from rosterlake.operators.incremental import new_or_changed, new_rows, union_feeds, with_audit
from rosterlake.plans.catalog import APPEND, NEW_ONLY, Entity
from rosterlake.session import keep_methods_compiled


def _raw(name: str) -> str:
    return f"_raw_{name}"


def typed_rows(entity: Entity, raw: DataFrame, lenient: bool = False) -> DataFrame:
    """Cleaned and typed. Text that does not fit its type fails the job, or is null if
    ``lenient``. Keys that are compared as they came stay beside the typed columns."""
    keep_methods_compiled(raw.sparkSession)
    return raw.select(*[typed(c, t, lenient=lenient).alias(c) for c, t in entity.types.items()],
                      *[F.col(c).alias(_raw(c)) for c in entity.raw_keys])


def pending_rows(entity: Entity, rows: DataFrame, existing: DataFrame, salt: bool = True,
                 landed: DataFrame | None = None) -> DataFrame:
    """The typed rows the entity's rule lets through; ``landed`` are those before the distinct."""
    keys = [F.col(_raw(k)) if k in entity.raw_keys else F.col(k) for k in entity.keys]
    stored = [blank_to_null(k) if k in entity.raw_keys else F.col(k) for k in entity.keys]
    if entity.rule == NEW_ONLY:
        return new_rows(rows, existing, keys, stored, salt, landed)
    values = [F.col(c) for c in entity.compare]
    latest = [F.col("load_ts"), F.col("load_id")] if entity.latest_only else ()
    return new_or_changed(rows, existing, keys, stored, values, values, salt=salt, latest=latest, landed=landed)


def build_rows(entity: Entity, feeds: Sequence[DataFrame], existing: DataFrame | None = None,
               salt: bool = True, lenient: bool = False) -> DataFrame:
    """Distinct typed rows to append, without audit columns. Where misfits have been set
    apart, ``lenient`` spares the checks.

    Feeds are not made distinct before typing: the distinct that follows covers it and
    saves a shuffle. It comes before the join with the history, so that copies, however
    many, collapse on the map side and only single rows are joined. Hot keys are looked for
    before it, in a scan of the keys alone, so that the distinct runs once.
    """
    landed = typed_rows(entity, union_feeds([f.select(*entity.columns) for f in feeds]), lenient)
    rows = landed.distinct()
    if entity.rule == APPEND or existing is None:
        rows = rows.select(*entity.columns)
        return rows.distinct() if entity.raw_keys else rows
    rows = pending_rows(entity, rows, existing, salt, landed).select(*entity.columns)
    # Rows that differ in the padding of a key only are one row now.
    return rows.distinct() if entity.raw_keys else rows


def build_load(entity: Entity, feeds: Sequence[DataFrame], existing: DataFrame | None = None,
               load_ts: Column | None = None) -> DataFrame:
    return with_audit(build_rows(entity, feeds, existing), load_ts)
