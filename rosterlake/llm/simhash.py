"""SimHash near-duplicates, found through deletion variants of fingerprint segments.

Two fingerprints of at most ``d`` differing bits, cut into d // 2 + 1 segments, have a
segment that differs in at most one bit. Each segment is indexed once per bit with that
bit blanked, so such a pair meets in an equality join and is verified there.

Near copies make dense groups, in which all pairs would meet. So fingerprints that share
a one-bit deletion of the whole (at most 65 share one) are first tied to the least of
them. The join then compares only fingerprints that are not known to be connected, and
index keys held by one component alone are left out.

Defined results: a null or blank text has fingerprint zero and links like any other; equal
texts and repeated rows share a fingerprint; a component is named by its least id that is
not null; other columns are ignored; no rows give none.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from rosterlake.llm.components import components
from rosterlake.llm.tables import written

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 3
BLOCK_BYTES = 1 << 20  # of a text, hashed at once
_SPACE = re.compile(rb"[ \t-\r]")


def _shingles(text: bytes, words: int) -> Iterator[list[bytes]]:
    """Space-joined shingles of the lower-cased text, a block of it at a time."""
    text, start, carried, any_shingle = text.lower(), 0, [], False
    while start < len(text):
        cut = _SPACE.search(text, start + BLOCK_BYTES)
        end = cut.start() if cut else len(text)
        found, start = carried + text[start:end].split(), end
        if len(found) >= words:
            any_shingle = True
            yield list(map(b" ".join, zip(*[found[i:] for i in range(words)])))
            carried = found[len(found) - words + 1:]
        else:
            carried = found
    if carried and not any_shingle:
        yield [b" ".join(carried)]


def majority(blocks: Iterable[np.ndarray]) -> int:
    """64 bits, as a signed number; a bit is set where over half the hashes set it, all blocks together."""
    counts, n = np.zeros(64, np.int64), 0
    for hashes in blocks:
        counts += np.unpackbits(hashes.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
        n += len(hashes)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The ``majority`` of the shingles' hashes."""
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8", len(shingles))
                    for shingles in _shingles((text or "").encode(), words))


def fingerprint_column(text: str) -> Column:
    @F.pandas_udf(T.LongType())
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return fingerprints(F.coalesce(F.col(text), F.lit("")))


def _tie(nodes: DataFrame) -> DataFrame:
    """Edges between fingerprints that become equal when one set bit is cleared, or none."""
    keys = nodes.select("fp", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("bit")).selectExpr(
        "fp", "case when bit = 64 then fp when getbit(fp, bit) = 1 then fp ^ shiftleft(1L, bit) end as key")
    hub = F.min("fp").over(Window.partitionBy("key"))
    return (keys.where("key is not null").withColumn("hub", hub).where("fp != hub")
            .select(F.col("fp").alias("src"), F.col("hub").alias("dst")).distinct())


def _segments(max_bits: int) -> list[tuple[int, int]]:
    parts = max_bits // 2 + 1
    edges = [64 * k // parts for k in range(parts + 1)]
    return list(zip(edges, edges[1:]))


def deletion_variants(rows: DataFrame, column: str = "fp", max_bits: int = MAX_BITS) -> DataFrame:
    """Each row once per bit of the fingerprint in ``column``, with ``bit`` and ``rest``: the bit's segment with this bit blanked."""
    segments = _segments(max_bits)
    first_bit = "case " + " ".join(f"when bit < {e} then {s}" for s, e in segments) + " end"
    mask = "case " + " ".join(f"when bit < {e} then {_signed((1 << (e - s)) - 1)}L" for s, e in segments) + " end"
    return (rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit"))
            .selectExpr("*", f"shiftrightunsigned(`{column}`, {first_bit}) & {mask} & ~shiftleft(1L, bit - {first_bit}) as rest"))


def _link(labelled: DataFrame, max_bits: int) -> DataFrame:
    """Edges between labels of fingerprints of at most ``max_bits`` differing bits.

    A pair is taken under one key only: that of its first segment with at most one
    differing bit, with this bit blanked (the segment's lowest, if none differs).
    """
    index = deletion_variants(labelled.select("fp", "label"), "fp", max_bits)
    # Keys that one label holds alone link nothing new.
    group = Window.partitionBy("bit", "rest")
    shared = written(index.withColumns({"lo": F.min("label").over(group), "hi": F.max("label").over(group)})
                     .where("lo < hi").drop("lo", "hi"), "shared")
    x = "(a.fp ^ b.fp)"
    taken = ""
    for s, e in _segments(max_bits):
        own = f"({x} & {_signed(((1 << (e - s)) - 1) << s)}L)"
        taken += (f" when bit_count({own}) <= 1 then a.bit >= {s} and a.bit < {e} and "
                  f"case when {own} = 0 then a.bit = {s} else {own} = shiftleft(1L, a.bit) end")
    pairs = shared.alias("a").join(shared.alias("b"), F.expr(
        f"a.bit = b.bit and a.rest = b.rest and a.label < b.label and bit_count({x}) <= {max_bits} and case{taken} end"))
    return pairs.select(F.col("a.label").alias("src"), F.col("b.label").alias("dst")).distinct()


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def classes(fingerprints: DataFrame, id_column: str, max_bits: int = MAX_BITS) -> DataFrame:
    """``fp, label, first``: each fingerprint's component and the component's least id."""
    nodes = written(fingerprints.groupBy("fp").agg(F.min(id_column).alias("first")), "nodes")
    tied = components(_tie(nodes)).withColumnRenamed("node", "fp") if max_bits >= 2 else None
    labelled = nodes if tied is None else nodes.join(tied, "fp", "left")
    labelled = written(labelled.select("fp", "first", (F.col("fp") if tied is None else F.coalesce("label", "fp")).alias("label")), "labelled")
    joined = components(_link(labelled.select("fp", "label"), max_bits)).select(F.col("node").alias("label"), F.col("label").alias("root"))
    rooted = labelled.join(joined, "label", "left").select("fp", "first", F.coalesce("root", "label").alias("label"))
    rooted = written(rooted, "rooted")
    named = written(rooted.groupBy("label").agg(F.min("first").alias("first")), "named")
    return rooted.drop("first").join(named, "label").select("fp", "label", "first")


def simhash_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """Per row: id, fingerprint as hexadecimal digits, least id of its component."""
    marked = written(docs.select(F.col(id_column).alias("doc_id"), fingerprint_column(text_column).alias("fp")), "fingerprints")
    return marked.join(classes(marked, "doc_id", max_bits), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that carry their component's least id, one of each component."""
    columns = docs.columns
    marked = written(docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{id_column}`").alias("id"),
                                 fingerprint_column(text_column).alias("fp")), "marked")
    groups = written(classes(marked.select("id", "fp"), "id", max_bits), "classes")
    return one_of_each(marked, groups)


def one_of_each(marked: DataFrame, groups: DataFrame) -> DataFrame:
    """The ``row`` of ``marked(row, id, fp)`` with the least id, ``first``, of each label of ``groups(fp, label, first)``."""
    kept = marked.join(groups, "fp").where(F.col("id").eqNullSafe(F.col("first"))).select("row", "label")
    least = marked.select("id", "fp").join(groups, "fp").where(F.col("id").eqNullSafe(F.col("first")))
    repeated = written(least.groupBy("label").count().where("count > 1").select("label"), "repeated")
    if not repeated.isEmpty():  # the least id occurs several times: one of its rows stays
        several = kept.join(repeated, "label", "left_semi").groupBy("label").agg(F.min("row").alias("row"))
        kept = kept.join(repeated, "label", "left_anti").unionByName(several.select("row", "label"))
    return kept.select("row.*")
