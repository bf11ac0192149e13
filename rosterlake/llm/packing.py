"""Hierarchical packing: documents are routed to context-size tiers and packed tier by tier.

A document goes to the shortest tier that holds it; what exceeds the longest window is cut
off in whole windows first. Windows of the longest tier are opened first. Their gaps take
the longest waiting pieces that fit, from shorter tiers too, and where none fits, the head
of the shortest longer piece. So every window is full. Each task packs what it reads, and
its texts are never shuffled; only what is left at its end (less than one longest window)
travels, as ids, and is packed with the rests of TAILS neighbouring tasks. Last, the
windows of a tier are sorted by attention cost and dealt to step groups of equal tokens.

Defined results: a null text is an empty document of the end token alone; a null id stays
null; repeated rows are documents of their own; other columns are ignored; no rows give
none. A window that could not be filled exists once per TAILS tasks at most.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from rosterlake.llm.tables import numbered, unsent, written
from rosterlake.llm.tokens import tokenizer

TIERS = (512, 1024, 2048, 4096)
CHUNK_TOKENS = 1 << 22  # packed at once in a task; what stays open goes on to the next chunk
TAILS = 64  # tasks whose rests are packed together
STEP_TOKENS = 1 << 16  # of a step group
TAIL_SEQUENCES = 1 << 62  # sequence ids from here on belong to packed rests
BATCH_CHARACTERS = 1 << 22  # tokenized at once


@dataclass
class Piece:
    doc: object
    ids: np.ndarray
    start: int
    doc_tokens: int

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc, self.ids[:n], self.start, self.doc_tokens),
                Piece(self.doc, self.ids[n:], self.start + n, self.doc_tokens))


@dataclass
class Packer:
    """Waiting pieces by length; a bit set of the lengths finds the best fit at once."""

    tiers: tuple[int, ...]
    first: int = 0
    full: list[tuple[int, int, int, Piece]] = field(default_factory=list)  # tier, sequence, offset, piece
    waiting: dict[int, list[Piece]] = field(default_factory=dict)
    lengths: int = 0
    tokens: int = 0

    def add(self, piece: Piece) -> None:
        longest = self.tiers[-1]
        while len(piece.ids) >= longest:
            head, piece = piece.cut(longest)
            self._emit(longest, [head])
        if n := len(piece.ids):
            self.waiting.setdefault(n, []).append(piece)
            self.lengths |= 1 << n
            self.tokens += n

    def _emit(self, tier: int, window: list[Piece]) -> None:
        offset = 0
        for piece in window:
            self.full.append((tier, self.first, offset, piece))
            offset += len(piece.ids)
        self.first += 1

    def _take(self, n: int) -> Piece:
        pieces = self.waiting[n]
        piece = pieces.pop()
        if not pieces:
            del self.waiting[n]
            self.lengths ^= 1 << n
        self.tokens -= n
        return piece

    def _fitting(self, gap: int) -> int:
        """Length of the longest waiting piece of at most ``gap``, or 0."""
        return max(0, (self.lengths & ((2 << gap) - 1)).bit_length() - 1)

    def _longer(self, gap: int) -> int:
        above = self.lengths >> (gap + 1)
        return gap + (above & -above).bit_length() if above else 0

    def _fill(self, tier: int) -> None:
        """One full window; there must be that many tokens."""
        window, gap = [], tier
        while gap:
            if n := self._fitting(gap):
                window.append(self._take(n))
                gap -= n
            else:
                head, rest = self._take(self._longer(gap)).cut(gap)
                window.append(head)
                gap = 0
                self.add(rest)
        self._emit(tier, window)

    def pack(self) -> None:
        """Every tier, longest first, as long as pieces routed to it wait and fill it."""
        for shorter, tier in zip((0, *self.tiers)[-2::-1], self.tiers[::-1]):
            while self._fitting(tier) > shorter and self.tokens >= tier:
                self._fill(tier)

    def finish(self) -> None:
        """What waits, cut as needed: full windows, longest first, and one that is not full."""
        for tier in self.tiers[::-1]:
            while self.tokens >= tier:
                self._fill(tier)
        if self.tokens:
            self._emit(self.tiers[-1], [self._take(n) for n in sorted(self.waiting, reverse=True)
                                        for _ in range(len(self.waiting[n]))])

    def rest(self) -> list[Piece]:
        return [piece for pieces in self.waiting.values() for piece in pieces]


def _rows(packed: list[tuple[int, int, int, Piece]], schema: pa.Schema, first: int, part: int,
          open_pieces: bool = False) -> pa.RecordBatch:
    pieces = [p for *_, p in packed]
    columns = [[p.doc for p in pieces], [p.start for p in pieces], [len(p.ids) for p in pieces],
               [zlib.crc32(p.ids.astype("<u4")) for p in pieces], [p.doc_tokens for p in pieces],
               [None if open_pieces else first + s for _, s, _, _ in packed], [o for _, _, o, _ in packed],
               [t for t, *_ in packed], [part] * len(packed),
               [p.ids.astype("<u4").tobytes() if open_pieces else None for p in pieces]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of a batch, a bounded number of characters at a time (or one text)."""
    ids, texts, size = [], [], 0
    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        text = text.as_py() or ""
        if texts and size + len(text) > BATCH_CHARACTERS:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(doc)
        texts.append(text)
        size += len(text)
    if texts:
        yield ids, texts


def pack(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text",
         tiers: tuple[int, ...] = TIERS, end_id: int = 2, chunk_tokens: int = CHUNK_TOKENS,
         tails: int = TAILS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: where in its document and where in which sequence it lies.

    ``tier`` is the sequence's length where it is full, ``step_group`` numbers, within the
    tier, groups of windows of like attention cost that hold ``step_tokens`` together.
    """
    spark = docs.sparkSession
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_column].dataType)] + [
        T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "part")
    ] + [T.StructField("ids", T.BinaryType())])

    def pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, part, words = to_arrow_schema(schema), TaskContext.get().partitionId(), tokenizer(tokenizer_path)
        packer, end = Packer(tiers), None
        for batch in batches:
            for ids, texts in _slices(batch):
                for doc, found in zip(ids, words.encode_batch(texts)):
                    if end is None:
                        end = np.array([end_id], found.dtype)
                    packer.add(Piece(doc, np.concatenate((found, end)), 0, len(found) + 1))
                if packer.tokens >= chunk_tokens:
                    packer.pack()
                if packer.full:
                    yield _rows(packer.full, arrow, part << 32, part)
                    packer.full.clear()
        packer.pack()
        if packer.full:
            yield _rows(packer.full, arrow, part << 32, part)
        if rest := packer.rest():
            yield _rows([(0, 0, 0, p) for p in rest], arrow, 0, part, open_pieces=True)

    def pack_tails(key, group):
        packer = Packer(tiers)
        for row in group.sort_by([("part", "ascending"), ("doc_id", "ascending"), ("start", "ascending")]).to_pylist():
            packer.add(Piece(row["doc_id"], np.frombuffer(row["ids"], "<u4"), row["start"], row["doc_tokens"]))
        packer.pack()
        packer.finish()
        number = key[0].as_py()
        return pa.Table.from_batches([_rows(packer.full, group.schema, TAIL_SEQUENCES + (number << 32), number)])

    pieces = written(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
                     .mapInArrow(pack_task, schema), "packed")
    rests = (pieces.where("sequence_id is null").groupBy(F.floor(F.col("part") / tails).alias("tails"))
             .applyInArrow(pack_tails, schema))
    placed = written(pieces.where("sequence_id is not null").unionByName(rests).drop("ids", "part"), "placed")
    sequences = placed.groupBy("sequence_id", "tier").agg(F.sum(F.col("length") * F.col("length")).alias("cost"))
    ranked = numbered(sequences, ["tier", "cost", "sequence_id"], "rank")
    firsts = ranked.groupBy("tier").agg(F.min("rank").alias("first"))
    grouped = ranked.join(F.broadcast(firsts), "tier").select(  # one row per tier
        "sequence_id", F.floor((F.col("rank") - F.col("first")) / F.greatest(F.lit(step_tokens) / F.col("tier"), F.lit(1)))
        .alias("step_group"))
    return placed.join(unsent(grouped), "sequence_id").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group")
