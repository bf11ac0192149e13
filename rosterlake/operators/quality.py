"""Rows that do not fit their types, set apart instead of failing the load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.functions.clean import TEXT, TIME, blank_to_null, typed


def _misfit(name: str, kind: str) -> Column:
    """A blank time is an absent time; a blank number or flag is a misfit."""
    given = blank_to_null(name) if kind == TIME else F.col(name)
    return given.isNotNull() & typed(name, kind, lenient=True).isNull()


def bad_columns(kinds: dict[str, str]) -> Column:
    """Names of the columns of a row whose text does not fit."""
    checks = [F.when(_misfit(c, k), F.lit(c)) for c, k in kinds.items() if k != TEXT]
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def fitting_and_rejected(raw: DataFrame, kinds: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(raw rows that fit, raw rows that do not with the columns at fault)."""
    judged = raw.withColumn("bad_columns", bad_columns(kinds))
    return judged.where(F.size("bad_columns") == 0).drop("bad_columns"), judged.where(F.size("bad_columns") > 0)


def typed_and_rejected(raw: DataFrame, kinds: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(typed rows, raw rows that do not fit with the columns at fault)."""
    good, rejected = fitting_and_rejected(raw, kinds)
    others = [c for c in raw.columns if c not in kinds]
    return good.select(*others, *[typed(c, k, lenient=True).alias(c) for c, k in kinds.items()]), rejected
