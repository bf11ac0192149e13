"""Vectors as codes: one byte a part, found through dictionaries of the values each dimension takes.

Components become integers, and few of them occur in a dimension. So of every batch each
dimension keeps a dictionary of its distinct integers and, per integer, the squared
difference to all entries of the part's codebook. The distance of a part to an entry is then
a sum of gathers: one table row per dimension, chosen by the value's place in the dictionary.

Codebooks start as parts of the first vectors in id order and are refined in rounds: parts
choose their nearest entry, entries become the means of their parts, rounded down. A round
reads the integers once and shuffles a row per entry and position from each task. Codebooks
(at most 256 entries of a vector's length) and one batch's tables are all that a task holds;
equal parts of a batch are compared once.

Defined results: vectors that are null or hold a null or a number that is not finite take no
part; shorter vectors are filled up with zeros to the longest (and that to a multiple of the
parts); ids may repeat or be null, null ids come last and rows of one id are ordered by their
integers; an entry that no part chooses stays; equal distances go to the lower index; a
component beyond 2**62 in size counts as that, and errors stop at 2**63 - 1; fewer vectors
than entries give a shorter codebook; other columns are ignored; no rows give none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from rosterlake.llm.tables import written

PARTS = 4
ENTRIES = 256  # two hexadecimal digits each
ROUNDS = 4
SCALE = 1024.0
BATCH_ROWS = 4096  # vectors compared at once
_EDGE = float(2 ** 62)
_MOST = 2 ** 63 - 1


def integers(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """``id, label, v`` of the rows that take part, ``v`` as integers."""
    scaled = F.transform("v", lambda x: F.floor(F.greatest(F.least(x * F.lit(SCALE), F.lit(_EDGE)), F.lit(-_EDGE))))
    return (vectors.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").alias("label"),
                           F.col(f"`{vector_column}`").cast("array<double>").alias("v"))
            .where("v is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
            .withColumn("v", scaled))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of equal length, filled up with zeros."""
    flat, lengths = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    filled = np.zeros((len(lengths), width), np.int64)
    filled[np.arange(width)[None, :] < lengths[:, None]] = flat
    return filled


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each part's nearest entry, the lower index among equals."""
    reach = max(int(abs(int(x))) for m in (parts, entries) for x in ((m.min(), m.max()) if m.size else (0,)))
    most = (2 * reach) ** 2 * parts.shape[1]
    number = np.int32 if most < 2 ** 31 else np.int64 if most < 2 ** 63 else object
    best, least = np.zeros(len(parts), np.int64), np.zeros(len(parts), object if number is object else np.int64)
    tables = []
    for column, of_entries in zip(parts.T, entries.T):
        values, codes = np.unique(column, return_inverse=True)
        tables.append(((values.astype(number)[:, None] - of_entries.astype(number)[None, :]) ** 2, codes))
    step = max(1, (1 << 18) // max(1, len(entries)))  # rows whose distances stay in the cache
    for at in range(0, len(parts), step):
        sums = np.zeros((len(parts[at:at + step]), len(entries)), number)
        for table, codes in tables:
            sums += table[codes[at:at + step]]
        chosen = sums.argmin(axis=1)
        best[at:at + step], least[at:at + step] = chosen, sums[np.arange(len(sums)), chosen]
    return best, least


def _batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            rows = batch.slice(at, BATCH_ROWS)
            yield rows, _matrix(rows.column("v"), width)


def _means(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks, each entry replaced by the mean of the parts that choose it, rounded down."""
    parts, entries, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(books.shape, object), np.zeros((parts, entries), np.int64)
        for _, matrix in _batches(batches, parts * size):
            exact = object if np.abs(matrix.astype(float)).max(initial=0) * len(matrix) > 2.0 ** 62 else np.int64
            for p in range(parts):
                own = matrix[:, p * size:(p + 1) * size]
                chosen = nearest(own, books[p])[0]
                added = np.zeros((entries, size), exact)
                np.add.at(added, chosen, own.astype(exact))
                sums[p] += added
                counts[p] += np.bincount(chosen, minlength=entries)
        p, e = np.nonzero(counts)
        place = np.tile(np.arange(size), len(p))
        p, e = np.repeat(p, size), np.repeat(e, size)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(place, pa.int32()), pa.array(counts[p, e], pa.int64()),
                                          pa.array([Decimal(s) for s in sums[p, e, place]], pa.decimal128(38, 0))], names=["part", "entry", "place", "n", "sum"])

    means = (rows.select("v").mapInArrow(run, "part int, entry int, place int, n long, sum decimal(38,0)")
             .groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"))).collect()  # a codebook's size at most
    new = books.copy()
    for row in means:
        new[row.part, row.entry, row.place] = int(row.sum) // row.n
    return new


def codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Integers by part, entry and position; None without rows."""
    first = rows.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()  # `entries` rows at most
    if not first:
        return None
    size = -(-rows.agg(F.max(F.size("v"))).first()[0] // parts)
    books = np.zeros((len(first), parts * size), np.int64)
    for book, row in zip(books, first):
        book[:len(row.v)] = row.v
    books = np.ascontiguousarray(books.reshape(len(first), parts, size).transpose(1, 0, 2))
    for _ in range(rounds):
        books = _means(rows, books)
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in books.ravel()).encode()).hexdigest()


def coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``id, label, code, error`` of each row."""
    parts, _, size = books.shape
    schema = T.StructType([*rows.select("id", "label").schema.fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, matrix in _batches(batches, parts * size):
            codes, errors = np.zeros((len(matrix), parts), np.uint8), 0
            for p in range(parts):
                codes[:, p], least = nearest(matrix[:, p * size:(p + 1) * size], books[p])
                errors = errors + least.astype(object)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                                              pa.array([min(int(e), _MOST) for e in errors], pa.int64())], names=schema.names)

    return rows.select("id", "label", "v").mapInArrow(run, schema)


def compressed(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
               parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of each vector that takes part."""
    if entries > 256:
        raise ValueError("an index has to fit two hexadecimal digits")
    rows = written(integers(vectors, id_column, vector_column, label_column), "integers")
    books = codebooks(rows, parts, entries, rounds)
    if books is None:
        return rows.select(F.col("id").alias("vec_id"), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    found = written(coded(rows, books), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_MOST).cast("decimal(38,0)")).cast("long")
    # Sums are formed before the shuffle; the join may be split where a label is large.
    sums = found.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "of")
    return found.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
