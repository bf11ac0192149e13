"""JSON documents: landing per path and day, and the typed tables they are loaded into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlake.schema import columns

# The columns of the two document tables.
CRITICS = ("display_name varchar(50), sort_name varchar(50), status varchar(50), bio string, "
           "seo_name varchar(50), multimedia string")
REVIEWS = ("display_title varchar(50), mpaa_rating varchar(50), critics_pick int, byline varchar(50), "
           "headline string, summary_short string, publication_date date, opening_date date, "
           "date_updated date, link string, multimedia string")
# Filled in on load, ahead of the document's own columns.
AUDIT = "id string, ingested_at timestamp, "


def text_limits(listed: str) -> dict[str, int]:
    """Column -> greatest length, of a DDL column list."""
    out = {}
    for part in listed.split(", "):
        name, kind = part.split(" ", 1)
        if kind.startswith("varchar("):
            out[name] = int(kind[len("varchar("):-1])
    return out


def spark_schema(listed: str) -> T.StructType:
    plain = ", ".join(
        f"{p.split(' ', 1)[0]} {'string' if 'varchar' in p else p.split(' ', 1)[1]}" for p in listed.split(", "))
    return columns(plain)


def land_documents(documents: DataFrame, root: str) -> None:
    """(path, ds, value): one partition per path and day, replaced when landed again.

    A document becomes one line, so that files can be split and several documents in one
    file are all read. Line ends in JSON are mere spacing; in texts they are escaped.
    """
    one_line = F.regexp_replace("value", "[\\r\\n]+", " ").alias("value")
    (documents.select(one_line, "path", "ds").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("path", "ds").text(root))


def typed_documents(rows: DataFrame, listed: str, lenient: bool = False) -> DataFrame:
    """Columns matched by name and cast. One the document lacks is null, one the table
    lacks stops the load."""
    schema = spark_schema(listed)
    extra = sorted(set(rows.columns) - set(schema.names))
    if extra:
        raise ValueError(f"columns the table does not have: {extra}")
    return rows.select(*[
        ((F.col(f.name).try_cast if lenient else F.col(f.name).cast)(f.dataType)
         if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema])


def too_long(listed: str) -> Column:
    """Whether any text exceeds its column."""
    limits = text_limits(listed)
    return F.coalesce(
        F.greatest(*[F.coalesce(F.length(c) > n, F.lit(False)) for c, n in limits.items()], F.lit(False)),
        F.lit(False))


def with_identity(rows: DataFrame, load_ts: Column | None = None) -> DataFrame:
    """id and ingested_at in front, as the table fills them in itself."""
    stamp = F.current_timestamp() if load_ts is None else load_ts
    return rows.select(F.expr("uuid()").alias("id"), stamp.alias("ingested_at"), *rows.columns)
