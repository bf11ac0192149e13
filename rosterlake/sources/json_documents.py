"""JSON documents with a ``results`` array: one row per element."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_documents(spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None,
                   multi_line: bool = True) -> DataFrame:
    """Documents as read; without a schema Spark infers the union of keys in an extra scan.
    Files with one document per line (``multi_line=False``) can be split."""
    reader = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(paths)


def result_rows(documents: DataFrame) -> DataFrame:
    """One row per element of results, one column per key any element has."""
    return documents.select(F.explode("results").alias("r")).select("r.*")


def objects_to_text(rows: DataFrame) -> DataFrame:
    """Objects become JSON text, a missing one stays null. Lists are left alone."""
    return rows.select(*[
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, T.StructType) else F.col(f.name)
        for f in rows.schema])


def text_to_variant(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.withColumns({c: F.parse_json(F.col(c)) for c in columns})


def result_variants(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row ``element`` per element of results, each as it came; a line holds one document."""
    document = F.parse_json(F.col(column))
    return lines.select(F.explode(F.variant_get(document, "$.results", "array<variant>")).alias("element"))


def _member(key: str, kind: str = "variant") -> Column:
    """A path cannot escape quotes, so a key with both kinds of them is looked up in a map."""
    if "'" in key and '"' in key:
        return F.try_variant_get(F.get(F.map_values(F.map_filter(F.col("element").cast("map<string,variant>"), lambda k, _: k == key)), F.lit(0)), "$", kind)
    quote = '"' if "'" in key else "'"
    return F.variant_get("element", f"$[{quote}{key}{quote}]", kind)


def mixed_objects_to_text(elements: DataFrame) -> DataFrame:
    """Typed columns of ``element``. A key that holds an object in any row is JSON text in all of
    them, so a text in it keeps its quotes and can be told from an object; nulls stay null.

    Two passes before the rows: the merged types of all keys, and, for keys of several types
    only, whether one of them is an object. Each leaves one row per task.
    """
    merged = elements.agg(F.schema_of_variant_agg("element").alias("s")).first().s
    if merged is None or not merged.startswith("OBJECT<"):
        return elements.limit(0).drop("element")
    fields = T.StructType.fromDDL(merged.replace("OBJECT<", "STRUCT<")[len("STRUCT<"):-1])
    several = [f.name for f in fields if isinstance(f.dataType, T.VariantType)]
    seen = elements.agg(*[F.max(F.schema_of_variant(_member(k)).startswith("OBJECT<")).alias(f"_{i}") for i, k in enumerate(several)]).first() if several else ()
    objects = {k for k, held in zip(several, seen) if held} | {f.name for f in fields if isinstance(f.dataType, T.StructType)}

    def value(field: T.StructField) -> Column:
        held = _member(field.name)
        if field.name in objects:
            return F.when(~F.is_variant_null(held), F.to_json(held))
        return _member(field.name, "string" if isinstance(field.dataType, (T.VariantType, T.NullType)) else field.dataType.simpleString())

    return elements.select(*[value(f).alias(f.name) for f in fields])
