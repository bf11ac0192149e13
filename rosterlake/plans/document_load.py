"""One day's JSON documents of one path: landed partition -> rows -> typed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from rosterlake.operators.business_keys import latest_by_key, without_known
from rosterlake.session import scratch_dir
from rosterlake.sinks import json_load as J
from rosterlake.sinks.tables import create_if_missing, insert_by_name, overwrite, remove_folder
from rosterlake.sources.json_documents import mixed_objects_to_text, objects_to_text, read_documents, result_rows, result_variants

TABLES = {"critics": J.CRITICS, "reviews": J.REVIEWS}


def load_path(spark: SparkSession, landing_root: str, path: str, ds: str, table: str, location: str,
              schema: T.StructType | None = None, mixed: bool = False, key: Sequence[str] = (),
              latest: Sequence[str] = ()) -> None:
    """Appends the day's rows; a missing document or a text too long stops the load.
    Where a key may hold objects in some rows and text in others, ``mixed`` tells them apart,
    for two more passes over the day's documents.

    With a business ``key`` only rows of keys that the table does not hold are appended, of
    several of one key that of the greatest ``latest``; a day loaded again adds nothing. The
    day's rows are then written once, beside the table, before the table's keys are read."""
    listed = TABLES[path]
    create_if_missing(spark, table, J.AUDIT + listed, location)
    folder = f"{landing_root.rstrip('/')}/path={path}/ds={ds}"
    if mixed:
        rows = mixed_objects_to_text(result_variants(spark.read.text(folder)))
    else:
        rows = objects_to_text(result_rows(read_documents(spark, folder, schema, multi_line=False)))
    rows = J.typed_documents(rows, listed)
    if not key:
        insert_by_name(J.with_identity(rows), table)
        return
    day = scratch_dir(spark, "documents-of-a-day")
    try:
        overwrite(latest_by_key(rows, key, latest), day)
        once = spark.read.schema(rows.schema).parquet(day)
        insert_by_name(J.with_identity(without_known(once, spark.table(table), key)), table)
    finally:
        remove_folder(spark, day)
