"""Near copies: texts whose five-word shingles are alike to 0.8 or more (Jaccard), one kept of each group.

Candidates come from the SimHash operator: a fingerprint of each text's five-word shingles, indexed by
the deletion variants of its segments (``simhash.py``). Texts that share a variant are verified on the
whole shingle sets, whatever the rest of their fingerprints.

Texts alike to 0.8 differ in some 10 of 64 bits, out of reach of one-bit deletions of 32-bit segments.
For these pairs only, texts that no fingerprint has linked, there are MinHash keys: BANDS of them, each of
ROWS least values over all shingles of a text. A pair alike to exactly 0.8 shares no such key with
probability (1 - 0.8 ** 5) ** 32, some 3 in a million, and a more alike pair more seldom.

Copies make keys that very many texts share, so their pairs are not listed. In a round over
the variants and a few over the MinHash keys each set is compared with one other, the hub of a key that it
shares with texts not yet linked with it, and what is linked is contracted: of a group of copies, a
comparison or two a set remain. Keys of either kind that still join several groups are compared whole: in
each cluster of them the sets beyond its largest group meet all others, in blocks bounded in sets and bytes,
and only links between different groups leave a comparison.

Defined results: null texts are empty; texts without words are copies of each other; texts
under five words are one shingle; groups are chains of linked pairs, and the row of the least
id that is not null stays; shingles and sets are told apart by 64-bit hashes; no rows give none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from rosterlake.llm.components import components_of_written as components
from rosterlake.llm.minhash import BLOCK_BYTES, SEED, _mix, shingle_hashes
from rosterlake.llm.simhash import deletion_variants, majority, one_of_each
from rosterlake.llm.tables import unsent, written

LEAST_LIKENESS = (4, 5)  # a fraction, so that 0.8 itself is met exactly
BANDS = 32
ROWS = 5
ROUNDS = 2  # comparisons with hubs of MinHash keys, after one with hubs of variants and before what is left is compared whole
HUB_SETS = 4096  # compared with one copy of a hub, on average
BLOCK_SETS = 256
BLOCK_SHINGLES = 1 << 21  # of a block's sets, on average
MATRIX_COLUMNS = 4096
COUNTED_HASHES = 1 << 16  # whose bits are counted at once
_DRAWN = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64)


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Per text the sorted hashes of its distinct shingles."""
    hashes, parent = shingle_hashes(texts)
    order = np.lexsort((hashes, parent))
    hashes, parent = hashes[order], parent[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (parent[1:] != parent[:-1])
    hashes, parent = hashes[new], parent[new]
    return np.split(hashes, np.searchsorted(parent, np.arange(1, len(texts)))) if texts else []


def fingerprint(hashes: np.ndarray) -> int:
    """The SimHash fingerprint of a set."""
    return majority(hashes[k:k + COUNTED_HASHES] for k in range(0, len(hashes), COUNTED_HASHES))


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """A row of BANDS keys for each set; the sets are not empty."""
    flat, starts = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    keys = np.empty((len(sets), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for band in range(BANDS):
            key = np.full(len(sets), band, np.uint64)
            for k in range(band * ROWS, (band + 1) * ROWS):
                key = _mix(key ^ np.minimum.reduceat((flat ^ _DRAWN[0, k]) * (_DRAWN[1, k] | np.uint64(1)), starts)) + np.uint64(k)
            keys[:, band] = key
    return keys


def _blocks(texts: list[str]) -> Iterator[list[str]]:
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text)
        if size > BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


@F.pandas_udf(T.StructType().add("fp", T.LongType()).add("size", T.LongType()).add("bits", T.LongType()).add("keys", T.ArrayType(T.LongType())))
def _sketch(texts: pd.Series) -> pd.DataFrame:
    """The set's name, its size, its fingerprint, and its band keys, none for a text without words."""
    names, sizes, bits, keys = [], [], [], []
    for block in _blocks(texts.tolist()):
        sets = shingle_sets(block)
        names += [xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets]
        sizes += [len(s) for s in sets]
        bits += [fingerprint(s) for s in sets]
        some = [s for s in sets if len(s)]
        rows = iter(band_keys(some).view(np.int64) if some else ())
        keys += [next(rows) if len(s) else np.empty(0, np.int64) for s in sets]
    return pd.DataFrame({"fp": np.array(names, np.uint64).view(np.int64), "size": sizes, "bits": bits, "keys": keys})


@F.pandas_udf(T.BinaryType())
def _set(texts: pd.Series) -> pd.Series:
    return pd.Series([s.tobytes() for block in _blocks(texts.tolist()) for s in shingle_sets(block)], dtype=object)


def alike(one: np.ndarray, other: np.ndarray) -> bool:
    """Whether two sorted sets, not both empty, are linked."""
    small, large = sorted((one, other), key=len)
    if len(small) * LEAST_LIKENESS[1] < len(large) * LEAST_LIKENESS[0]:
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int((large[at] == small).sum())
    return common * LEAST_LIKENESS[1] >= (len(small) + len(large) - common) * LEAST_LIKENESS[0]


def linked(sets: list[np.ndarray], labels: list[int] | None = None) -> list[int]:
    """For each set the first one that it is linked with, over others or directly; equal labels are linked."""
    sizes, n = np.array([len(s) for s in sets]), len(sets)
    _, columns, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rows, shared = np.repeat(np.arange(n), sizes), times[columns] > 1
    rows, columns = rows[shared], (np.cumsum(times > 1) - 1)[columns[shared]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    common = np.zeros((n, n), np.int64)
    for start in range(0, columns[-1] + 1 if len(columns) else 0, MATRIX_COLUMNS):
        lo, hi = np.searchsorted(columns, (start, start + MATRIX_COLUMNS))
        found = np.zeros((n, min(MATRIX_COLUMNS, columns[-1] + 1 - start)), np.float32)
        found[rows[lo:hi], columns[lo:hi] - start] = 1
        common += (found @ found.T).astype(np.int64)
    near = common * LEAST_LIKENESS[1] >= (sizes[:, None] + sizes - common) * LEAST_LIKENESS[0]
    if labels is not None:
        of = np.array(labels)
        near |= of[:, None] == of[None, :]
    first = np.full(n, -1)
    for k in range(n):
        reached = np.zeros(n, bool)
        edge = [k] if first[k] < 0 else []
        while len(edge):
            reached[edge] = True
            edge = np.flatnonzero(near[edge].any(0) & ~reached)
        first[reached] = k
    return first.tolist()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in range(2)], names=["src", "dst"])


def _with_hub(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``src, dst`` labels of linked sets from ``hub, part, member, label, other, shingles``, a hub's own row first."""
    found: list[tuple[int, int]] = []
    centre = np.empty(0, np.uint64)
    for _, _, member, label, other, shingles in _rows(batches):
        own = np.frombuffer(shingles, np.uint64)
        if not member:
            centre = own
        elif alike(own, centre):
            found.append((label, other))
        if len(found) >= 10_000:
            yield _edges(found)
            found = []
    yield _edges(found)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``src, dst`` labels from ``cluster, i, j, fp, label, shingles``, sorted by the first four."""
    for _, group in groupby(_rows(batches), key=lambda r: r[:3]):
        sets = {r[3]: (r[4], np.frombuffer(r[5], np.uint64)) for r in group}  # a repeated row counts once
        labels = [label for label, _ in sets.values()]
        first = linked([s for _, s in sets.values()], labels)
        edges = {(label, labels[k]) for label, k in zip(labels, first) if label != labels[k]}
        if edges:
            yield _edges(sorted(edges))


EDGES = T.StructType().add("src", T.LongType()).add("dst", T.LongType())


def _by_variants(marked: DataFrame) -> DataFrame:
    """``fp, size, key`` for the deletion variants of the fingerprints; sets without shingles have none."""
    prints = marked.where("size > 0").select("fp", "size", "bits").distinct()
    return deletion_variants(prints, "bits").select("fp", "size", F.xxhash64("bit", "rest").alias("key"))


def _by_bands(marked: DataFrame) -> DataFrame:
    return marked.select("fp", "size", F.explode("keys").alias("key"))


def _shared(index: DataFrame) -> DataFrame:
    """``key, fp, size`` of the keys that several sets share."""
    keys = index.groupBy("key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo < hi").select("key")
    return written(index.join(unsent(keys), "key").distinct(), "shared-keys")


def _mixed(index: DataFrame, turn: int) -> DataFrame:
    """``key, hub`` of the keys whose sets bear several labels; the hub is another set each turn."""
    hub = F.min(F.struct(F.xxhash64("fp", F.lit(turn)).alias("order"), "fp", "label", "size"))
    return index.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), hub.alias("hub")).where("lo < hi").select("key", "hub")


def _hub_links(index: DataFrame, sets: DataFrame, turn: int, most: int) -> DataFrame:
    """Edges between labels, from comparing each set, ``most`` in number, with one hub of another label."""
    fits = F.least("size", "hub.size") * LEAST_LIKENESS[1] >= F.greatest("size", "hub.size") * LEAST_LIKENESS[0]
    asked = index.join(unsent(_mixed(index, turn)), "key").where(F.col("label") != F.col("hub.label")).where(fits)
    asked = written(asked.groupBy("fp", "label").agg(F.min("hub").alias("hub")), "asked", most)
    # A hub that very many ask for is sent out several times, for a part of them each.
    parts = written(asked.groupBy(F.col("hub.fp").alias("hub")).agg(F.ceil(F.count("*") / HUB_SETS).cast("int").alias("parts")), "hubs", most)
    parts = unsent(parts, parts.count())
    members = asked.select("fp", "label", F.col("hub.fp").alias("hub"), F.col("hub.label").alias("other")).join(parts, "hub").join(sets, "fp").select(
        "hub", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("part"), F.lit(True).alias("member"), "label", "other", "shingles")
    hubs = parts.join(sets, F.col("hub") == F.col("fp")).select(
        "hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("member"), F.lit(0).cast("long").alias("label"),
        F.lit(0).cast("long").alias("other"), "shingles")
    return written(members.unionByName(hubs).repartition("hub", "part").sortWithinPartitions("hub", "part", "member").mapInArrow(_with_hub, EDGES).distinct(), "hub-links", most)


def _relabelled(labels: DataFrame, edges: DataFrame, most: int) -> DataFrame:
    if edges.isEmpty():
        return labels
    roots = components(edges).select(F.col("node").alias("label"), F.col("label").alias("root"))
    return written(labels.join(unsent(roots, roots.count()), "label", "left").select("fp", F.coalesce("root", "label").alias("label")), "labels", most)


def _rest_links(index: DataFrame, sets: DataFrame, most: int) -> DataFrame:
    """Edges between labels, from comparing all sets of different labels in each cluster of the keys that join them; ``most`` is the number of sets."""
    mixed = index.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key", "lo")
    left = written(index.join(unsent(mixed), "key").select("fp", "label", "size", "lo").distinct(), "left")
    rows = left.count()
    stars = components(written(left.where("label != lo").select(F.col("label").alias("src"), F.col("lo").alias("dst")).distinct(), "stars", rows))
    named = left.select("fp", "label", "size").distinct().join(unsent(stars.select(F.col("node").alias("label"), F.col("label").alias("cluster")), rows), "label")
    named = written(named, "clusters", most)
    groups = written(named.groupBy("cluster", "label").agg(F.count("*").alias("n"), F.sum("size").alias("shingles")), "groups", most)
    largest = groups.groupBy("cluster").agg(F.max(F.struct("n", "label")).alias("top")).select("cluster", F.col("top.label").alias("largest"))
    count = F.ceil(F.greatest(F.sum("n") / BLOCK_SETS, F.sum("shingles") / BLOCK_SHINGLES)).cast("int")
    counts = groups.join(unsent(largest, rows), "cluster").groupBy("cluster", (F.col("label") == F.col("largest")).alias("main")).agg(count.alias("blocks"))
    blocks = written(counts.groupBy("cluster").agg(F.max(F.when(F.col("main"), F.col("blocks"))).alias("of_main"),
                                                   F.max(F.when(~F.col("main"), F.col("blocks"))).alias("of_rest")).join(unsent(largest, rows), "cluster"), "blocks", most)
    # Blocks of the largest group are numbered first; they need not meet each other.
    dealt = F.pmod(F.xxhash64("fp"), F.when(F.col("label") == F.col("largest"), F.col("of_main")).otherwise(F.col("of_rest"))).cast("int")
    own = dealt + F.when(F.col("label") == F.col("largest"), 0).otherwise(F.col("of_main"))
    met = (named.join(unsent(blocks, blocks.count()), "cluster").withColumn("own", own)
           .withColumn("other", F.explode(F.expr("sequence(if(own < of_main, of_main, 0), of_main + of_rest - 1)"))).where("own != other")
           .select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp", "label").join(unsent(sets), "fp"))
    return written(met.select("cluster", "i", "j", "fp", "label", "shingles").repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "fp")
                   .mapInArrow(_compare, EDGES).distinct(), "rest-links")


def _grouped(marked: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """``fp, label`` of the sets that share a key with another, equal labels for linked sets; ``most`` is the number of sets."""
    variants, bands = _shared(_by_variants(marked)), _shared(_by_bands(marked))
    keys = variants.unionByName(bands)
    labels = written(keys.select("fp").distinct().select("fp", F.col("fp").alias("label")), "labels", most)
    text = F.coalesce(F.col("text"), F.lit(""))
    sets = written(marked.join(unsent(nodes.join(unsent(labels, most), "fp", "left_semi"), most), "fp").where(F.col("id").eqNullSafe(F.col("first")))
                   .select("fp", _set(text).alias("shingles")), "sets")
    for turn, kind in enumerate([variants] + [bands] * ROUNDS):
        index = written(kind.join(unsent(labels, most), "fp"), "index")
        labels = _relabelled(labels, _hub_links(index, sets, turn, most), most)
    return _relabelled(labels, _rest_links(written(keys.join(unsent(labels, most), "fp"), "index"), sets, most), most)


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that carry their group's least id, one of each group."""
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    marked = written(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_column}`").alias("id"),
                                 _sketch(text).alias("sketch")).select("row", "id", "sketch.*"), "marked")
    nodes = written(marked.groupBy("fp").agg(F.min("id").alias("first")), "nodes", marked.count())
    texts = marked.select("fp", "size", "bits", "keys", "id", F.col("row").getField(text_column).alias("text"))
    most = nodes.count()
    grouped = _grouped(texts, nodes, most)
    rooted = written(nodes.join(unsent(grouped, most), "fp", "left").select("fp", "first", F.coalesce("label", "fp").alias("label")), "rooted", most)
    named = written(rooted.groupBy("label").agg(F.min("first").alias("first")), "named", most)
    groups = written(rooted.drop("first").join(unsent(named, most), "label").select("fp", "label", "first"), "groups", most)
    return one_of_each(marked.select("row", "id", "fp"), unsent(groups, most))
