"""One-permutation MinHash fingerprints of documents.

All shingles of five words are hashed once; the hash picks a bin, and each bin keeps its
least value. An empty bin copies the bin that comes first in an order of all bins drawn
for it alone (optimal densification), and of every bin the lowest bits are kept. Bins that
agree by chance are taken out of the likeness.

Neighbours in id order meet without one task seeing all rows: ids are cut into ranges at
their quantiles, and the least id of each range is sent to the range before it as well.

Defined results: a null text is empty; texts without words share a fingerprint of their
own, likeness 1 to each other and 0 to all else; texts under five words are one shingle;
ids are numbers, null ids come last; rows of the same id are ordered by text; a sole row is its own next;
other columns are ignored; no rows give none.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from rosterlake.llm.tables import written
from rosterlake.session import shuffle_partitions

SHINGLE_WORDS = 5
BIN_BITS = 10
KEPT_BITS = 4
BLOCK_BYTES = 1 << 21  # of texts, hashed at once (or one text)
BLOCK_ROWS = 256
SEED = 42
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
RANGES = 2  # per shuffle partition
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache
def _orders(bins: int) -> np.ndarray:
    """For each bin an order of all bins, in which it looks for a filled one."""
    return np.argsort(np.random.default_rng(SEED).random((bins, bins)), axis=1).astype(np.int32)


@lru_cache
def _ranks(bins: int) -> np.ndarray:
    return np.argsort(_orders(bins), axis=1).astype(np.int32)


def shingle_hashes(texts: list[str], words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and the text that each belongs to."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.string())))
    flat, parent = lists.flatten(), np.asarray(pc.list_parent_indices(lists))
    real = np.asarray(pc.greater(pc.binary_length(flat), 0))
    coded = flat.dictionary_encode()
    of_word = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in coded.dictionary.cast(pa.binary()).to_pylist()), np.uint64,
                          len(coded.dictionary))
    hashes, parent = of_word[np.asarray(coded.indices)[real]], parent[real]
    counts = np.bincount(parent, minlength=len(texts))
    with np.errstate(over="ignore"):
        starts = np.cumsum(counts) - counts
        many = max(0, len(hashes) - words + 1)
        sums = np.zeros(many, np.uint64)
        for k in range(words):
            sums = sums * MULTIPLIER + hashes[k:k + many]
        whole = parent[:many] == parent[words - 1:words - 1 + many] if many else np.zeros(0, bool)
        short = np.flatnonzero((counts > 0) & (counts < words))
        singles = []
        for text in short:  # at most four words each
            h = np.uint64(counts[text])
            for w in hashes[starts[text]:starts[text] + counts[text]]:
                h = h * MULTIPLIER + w
            singles.append(h)
    return _mix(np.concatenate((sums[whole], np.array(singles, np.uint64)))), np.concatenate((parent[:many][whole], short))


def signatures(texts: list[str], bin_bits: int = BIN_BITS, kept_bits: int = KEPT_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Kept bits of every bin, and which texts have words at all."""
    bins = 1 << bin_bits
    hashes, parent = shingle_hashes(texts)
    least = np.full(len(texts) * bins, EMPTY)
    np.minimum.at(least, parent.astype(np.int64) * bins + (hashes >> np.uint64(64 - bin_bits)).astype(np.int64),
                  hashes & np.uint64((1 << (64 - bin_bits)) - 1))
    least = least.reshape(len(texts), bins)
    filled = least != EMPTY
    count = filled.sum(1)
    source = np.tile(np.arange(bins, dtype=np.int32), (len(texts), 1))
    for t in np.flatnonzero((count > 0) & (count < bins // 16)):
        at = np.flatnonzero(filled[t])
        source[t] = np.where(filled[t], source[t], at[np.argmin(_ranks(bins)[:, at], axis=1)])
    t, b = np.nonzero(~filled & (count >= bins // 16)[:, None])
    orders = _orders(bins)
    for step in range(bins):
        if not len(t):
            break
        found = orders[b, step]
        hit = filled[t, found]
        source[t[hit], b[hit]] = found[hit]
        t, b = t[~hit], b[~hit]
    # Mixed with the bin, so that bins that hold one value agree with another text's by chance each on its own.
    with np.errstate(over="ignore"):
        kept = _mix(np.take_along_axis(least, source.astype(np.int64), axis=1) + np.arange(bins, dtype=np.uint64) * MULTIPLIER)
    bits = kept & np.uint64((1 << kept_bits) - 1)
    bits[count == 0] = 0
    return bits.astype(np.uint8), count > 0


def packed(bits: np.ndarray, any_words: bool, kept_bits: int = KEPT_BITS) -> str:
    """A flag byte for texts with words, then the bins' bits, as base 64."""
    rows = np.unpackbits(bits[:, None], axis=1)[:, 8 - kept_bits:]
    return base64.b64encode(bytes([int(any_words)]) + np.packbits(rows).tobytes()).decode()


def likeness(a: np.ndarray, a_words: bool, b: np.ndarray, b_words: bool, kept_bits: int = KEPT_BITS) -> float:
    """Estimate of the share of common shingles, less what agrees by chance."""
    if not (a_words and b_words):
        return float(a_words == b_words)
    chance = 1.0 / (1 << kept_bits)
    return max(0.0, (float((a == b).mean()) - chance) / (1.0 - chance))


def edited(text: str, following: str) -> str:
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def _in_ranges(docs: DataFrame) -> DataFrame:
    """``id, text, part, extra``: a partition per range of ids; an ``extra`` row is a later range's first."""
    spark = docs.sparkSession
    ids = docs.select("id")
    wanted = RANGES * shuffle_partitions(spark)
    cuts = ids.agg(F.percentile_approx("id", [k / wanted for k in range(1, wanted)], 10 * wanted)).first()[0] if wanted > 1 else None
    # One cut per range, so the cuts and the table of ranges below are bounded by the partition count.
    cuts = sorted({float(c) for c in cuts or [0]})
    ranges = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="id", outputCol="part", handleInvalid="keep")

    def in_range(df: DataFrame) -> DataFrame:
        return ranges.transform(df).withColumn("part", F.coalesce(F.col("part").cast("int"), F.lit(len(cuts) + 1)))

    firsts = in_range(ids).groupBy("part").agg(F.min("id").alias("first"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("part").over(Window.orderBy("part")), F.last("part").over(order))
    firsts = written(firsts.select("part", "first", before.alias("before")), "ranges")
    rows = in_range(docs).join(F.broadcast(firsts), "part")
    both = F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("extra")), F.struct(F.col("before").alias("part"), F.lit(True).alias("extra")))
    copies = F.when(F.col("id").eqNullSafe(F.col("first")), both).otherwise(F.slice(both, 1, 1))
    return rows.select("id", "text", F.explode(copies).alias("copy")).select("id", "text", "copy.part", "copy.extra").repartitionById(
        len(cuts) + 2, "part")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_column].dataType)] + [T.StructField(n, t) for n, t in (
        ("n_chars", T.LongType()), ("edited_sha256", T.StringType()), ("fingerprint", T.StringType()),
        ("edited_fingerprint", T.StringType()), ("near_edited", T.DoubleType()), ("near_next", T.DoubleType()))])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        """Rows of one range in order, each block ending with the row that follows its last."""
        block, size = [], 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if block and row[2] != block[-1][2]:
                    yield block
                    block, size = [], 0
                if block and block[-1][3]:
                    continue  # of rows that share a later range's first id, the first follows
                block.append(row)
                size += len(row[1])
                if len(block) > BLOCK_ROWS or size > BLOCK_BYTES and len(block) > 1:
                    yield block
                    block, size = [row], len(row[1])
        if block:
            yield block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for block in blocks(batches):
            own, texts = block[:-1], [r[1] for r in block]
            if not own:
                continue
            changed = [edited(t, n) for t, n in zip(texts, texts[1:])]
            bits, some = signatures(texts)
            new_bits, new_some = signatures(changed)
            columns = [[r[0] for r in own], [len(t) for t in texts[:-1]], [hashlib.sha256(t.encode()).hexdigest() for t in changed],
                       [packed(bits[k], some[k]) for k in range(len(own))], [packed(new_bits[k], new_some[k]) for k in range(len(own))],
                       [likeness(bits[k], some[k], new_bits[k], new_some[k]) for k in range(len(own))],
                       [likeness(bits[k], some[k], bits[k + 1], some[k + 1]) for k in range(len(own))]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    return _in_ranges(rows).sortWithinPartitions("part", "extra", F.col("id").asc_nulls_last(), "text").mapInArrow(run, schema)
