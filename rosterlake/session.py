"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# The largest method, in bytes of bytecode, that HotSpot compiles. Spark fuses the cleaning of a wide
# table's columns into one method and by itself runs it interpreted beyond that; under this
# limit it evaluates such a projection by several smaller methods.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A task that lands files holds few of them: several open writers spare the sort by partition.
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    METHOD_LIMIT[0]: METHOD_LIMIT[1],
}


def build_session(app: str, master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """Session with the settings the loads rely on; cluster sizing stays with the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keep_methods_compiled(spark: SparkSession) -> None:
    """Sets the limit of method sizes in a session that ``build_session`` did not make. One
    that the session names already is left as it is."""
    key, limit = METHOD_LIMIT
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, limit)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the cluster's shared checkpoint folder.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only where that
    is unset and the session is local, as in tests, is a temporary folder used: on a
    cluster no executor would see what another wrote there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="rosterlake-")
    return f"{root.rstrip('/')}/rosterlake/{label}-{uuid.uuid4().hex}"
