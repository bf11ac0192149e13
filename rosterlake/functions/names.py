"""File, table and column naming rules as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterlake.functions.clean import strip

# Length of "_yyyymmdd.zip", and of the prefix in front of a feed's name.
DATED_ZIP_SUFFIX = 13
FEED_PREFIX = 5
# Marks that part words, where a word begins inside a run of letters, and
# what no column name may hold.
PARTING_MARKS = "/ -"
WORD_AFTER_ANY = "(.)([A-Z][a-z]+)"
CAPITAL_AFTER_SMALL = "([a-z0-9])([A-Z])"
NOT_IN_NAMES = r"(?U)(^[^a-zA-Z])|(\W)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def feed_folder(archive: Column | str, suffix: int = DATED_ZIP_SUFFIX) -> Column:
    """drop_level2_20240131.zip -> drop_level2"""
    archive = _col(archive)
    return F.substring(archive, F.lit(1), F.length(archive) - F.lit(suffix))


def feed_of(folder: Column | str, prefix: int = FEED_PREFIX) -> Column:
    """drop_level2 -> level2"""
    folder = _col(folder)
    return F.substring(folder, F.lit(prefix + 1), F.length(folder))


def file_stem(file: Column | str) -> Column:
    """Text before the first dot."""
    return F.substring_index(_col(file), ".", 1)


def file_type(file: Column | str) -> Column:
    """Text after the last dot."""
    return F.substring_index(_col(file), ".", -1)


def landing_table(folder: Column | str, file: Column | str) -> Column:
    """(drop_level2, Clicks.csv) -> level2_clicks"""
    return F.concat_ws("_", feed_of(folder), F.lower(file_stem(file)))


def without_prefix(name: Column | str, prefix: str) -> Column:
    """Every occurrence of the prefix text goes, as in the rule this follows."""
    return F.replace(_col(name), F.lit(prefix), F.lit("")) if prefix else _col(name)


def without_tail(name: Column | str, delimiter: str) -> Column:
    """Drops what follows the last delimiter; a name without one is unchanged."""
    d = re.escape(delimiter)
    return F.regexp_replace(_col(name), f"(?s){d}[^{d}]*$", "")


def affixed(name: Column | str, prefix: str = "", suffix: str = "") -> Column:
    return F.lower(F.concat(F.lit(prefix), _col(name), F.lit(suffix)))


def column_name(header: Column | str) -> Column:
    """Header text -> snake-case column name."""
    words = F.translate(strip(header), PARTING_MARKS, "_" * len(PARTING_MARKS))
    for begin in (WORD_AFTER_ANY, CAPITAL_AFTER_SMALL):
        words = F.regexp_replace(words, begin, "$1_$2")
    single = F.replace(F.lower(words), F.lit("__"), F.lit("_"))
    return F.regexp_replace(single, NOT_IN_NAMES, "_")
