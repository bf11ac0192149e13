"""Extendible hashing: shards by hash prefix, split only where they are too large.

A row's hash is KEY_DIGITS hexadecimal digits of its key's hash and then ROW_DIGITS of its
content's. Sizes are summed once per directory cell (a prefix of a few bits more than
shards are needed on average) and then for all shorter prefixes. A cell's shard is its
shortest prefix that fits the byte limit. Cells that are still too large are cut on with
the next bits, rows of these cells alone. So rows of one key share a shard as long as they
fit one, and a key that holds much of the data is cut by the rows' content.

Defined results: a null text has size zero; a null key is a key; a shard above the limit is
a single row, or rows that are equal in key and content, and is told as ``oversized``; other
columns are ignored; no rows give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.llm.tables import digits_hash, written

LIMIT_BYTES = 1 << 20
KEY_DIGITS = 9
ROW_DIGITS = 6
HASH_BITS = 4 * (KEY_DIGITS + ROW_DIGITS)
SPARE_BITS = 5  # cells per shard, as a power of two


def _cells(rows: DataFrame, least_bits: int, total_bits: int, limit: int) -> DataFrame:
    """``cell, depth, shard_bytes, fits``: the shard, of at least ``least_bits`` bits, of each prefix of ``total_bits``."""
    sizes = rows.withColumn("cell", F.shiftright("hash", HASH_BITS - total_bits)).groupBy("cell").agg(F.sum("size").alias("bytes"))
    prefixes = sizes.select("cell", "bytes", F.explode(F.sequence(F.lit(least_bits), F.lit(total_bits))).alias("depth")).withColumn(
        "prefix", F.expr(f"shiftright(cell, {total_bits} - depth)"))
    nodes = prefixes.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"))
    fitting = prefixes.join(nodes, ["depth", "prefix"]).withColumn("fits", F.col("shard_bytes") <= limit)
    chosen = F.min(F.struct(~F.col("fits"), F.when(F.col("fits"), F.col("depth")).otherwise(-F.col("depth")).alias("order"), "depth", "shard_bytes", "fits"))
    return fitting.groupBy("cell").agg(chosen.alias("best")).select("cell", "best.depth", "best.shard_bytes", "best.fits")


def shards(docs: DataFrame, row: Column, key: Column, content: list[Column], size: Column, limit: int = LIMIT_BYTES) -> DataFrame:
    """``row, size, shard, depth, shard_bytes, oversized``; ``shard`` is the hash prefix, in binary digits."""
    rows = written(docs.select(row.alias("row"), F.coalesce(size, F.lit(0)).cast("long").alias("size"),
                               (F.shiftleft(digits_hash(key, digits=KEY_DIGITS), 4 * ROW_DIGITS) + digits_hash(*content, digits=ROW_DIGITS)).alias("hash")),
                   "sized")
    total = rows.agg(F.sum("size")).first()[0] or 0
    bits = min(HASH_BITS, max(1, (total // limit).bit_length() + SPARE_BITS))
    waiting, placed, least_bits = rows, [], 0
    while True:
        cells = written(_cells(waiting, least_bits, bits, limit), "cells")
        large = bits < HASH_BITS and not cells.where("not fits").isEmpty()
        known = cells.where("fits") if large else cells
        matched = waiting.withColumn("cell", F.shiftright("hash", HASH_BITS - bits)).join(known, "cell")
        placed.append(matched.select("row", "size", F.substring(F.lpad(F.bin("hash"), HASH_BITS, "0"), F.lit(1), F.col("depth")).alias("shard"),
                                     "depth", "shard_bytes", (~F.col("fits")).alias("oversized")))
        if not large:
            break
        over = cells.where("not fits").select("cell")
        waiting = written(waiting.withColumn("cell", F.shiftright("hash", HASH_BITS - bits)).join(over, "cell", "left_semi").drop("cell"), "waiting")
        least_bits, bits = bits + 1, min(HASH_BITS, bits + SPARE_BITS)
    result = placed[0]
    for more in placed[1:]:
        result = result.unionByName(more)
    return result
