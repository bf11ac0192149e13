"""Schemas from short column lists, without needing a session at import time."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "date": T.DateType(),
          "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(),
          "timestamp_ntz": T.TimestampNTZType()}


def columns(listed: str) -> T.StructType:
    """"a string, b bigint" -> StructType"""
    pairs = [part.split() for part in listed.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])
