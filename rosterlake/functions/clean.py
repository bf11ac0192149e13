"""Cleaning and typing of all-text columns. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space a text column is trimmed of.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: month/day/year, twelve-hour clock. Single digits are accepted too.
TIME_PATTERN = "M/d/yyyy h:m:s a"

BIGINT, TEXT, TIME, BOOL = "bigint", "string", "timestamp_ntz", "boolean"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(strip(c), F.lit(""))


def to_bigint(c: Column | str) -> Column:
    """Strict: with ANSI mode on, text that is no number (also '') fails the job."""
    return _col(c).cast("bigint")


def to_bool(c: Column | str) -> Column:
    """Strict: only true and false, in any case. Spark alone would also take 1, y, t."""
    c = _col(c)
    word = F.lower(c)
    return (
        F.when(c.isNull(), F.lit(None).cast("boolean"))
        .when(word == "true", F.lit(True))
        .when(word == "false", F.lit(False))
        .otherwise(F.raise_error(F.concat(F.lit("not a boolean: "), c)).cast("boolean"))
    )


def to_time(c: Column | str) -> Column:
    """Strict: bad text fails the job. The stored time carries no zone."""
    return F.to_timestamp_ntz(blank_to_null(c), F.lit(TIME_PATTERN))


def try_bigint(c: Column | str) -> Column:
    return _col(c).try_cast("bigint")


def try_bool(c: Column | str) -> Column:
    word = F.lower(_col(c))
    return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))


def try_time(c: Column | str) -> Column:
    # try_to_timestamp decides whether the text parses; the value is taken zone-free.
    text = blank_to_null(c)
    pattern = F.lit(TIME_PATTERN)
    return F.when(F.try_to_timestamp(text, pattern).isNotNull(), F.to_timestamp_ntz(text, pattern))


_STRICT = {BIGINT: to_bigint, TEXT: blank_to_null, TIME: to_time, BOOL: to_bool}
_LENIENT = {BIGINT: try_bigint, TEXT: blank_to_null, TIME: try_time, BOOL: try_bool}


def typed(c: Column | str, kind: str, lenient: bool = False) -> Column:
    return (_LENIENT if lenient else _STRICT)[kind](c)
