"""Zipped drops: one archive per feed and day, one delimited file per table inside."""

from __future__ import annotations

import io
import itertools
import struct
import sys
import zipfile
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.functions.names import feed_folder, feed_of, file_stem

# Workers need not have this package: what they run travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PACKED = "archive string, member string, method int, crc bigint, packed binary"
RECORDS = "archive string, member string, record_no bigint, record string"
BATCH_ROWS = 10_000
# Fixed value: the longest record a load takes, in characters; beyond it a quote was never closed.
MAX_RECORD_CHARACTERS = 100 * 1024 * 1024
# Fixed value: length of the fixed part of a zip entry's header.
ENTRY_HEADER = 30


def read_archives(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Zip files with their bytes, from a folder or a list of files."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.zip")
            .option("recursiveFileLookup", "true").load(paths))


def ends_quoted(line: str, quoted: bool, sep: str, quote: str) -> bool:
    """Whether a quoted field is still open behind this line. A quote inside an unquoted
    field is plain text."""
    at, end = 0, len(line)
    while at <= end:
        if quoted:
            at = line.find(quote, at)
            if at < 0:
                return True
            if line[at + 1:at + 2] == quote:
                at += 2
                continue
            quoted = False
        elif line[at:at + 1] == quote:
            quoted, at = True, at + 1
            continue
        at = line.find(sep, at)
        if at < 0:
            return False
        at += 1
    return quoted


def records_of(stream: io.TextIOBase, sep: str, quote: str, longest: int = MAX_RECORD_CHARACTERS) -> Iterator[str]:
    """Logical records: lines, put together where a line end is quoted."""
    held: list[str] = []
    quoted, size = False, 0
    for line in stream:
        line = line.rstrip("\r\n") if not line.endswith("\r\n") else line[:-2]
        if quoted or quote in line:
            quoted = ends_quoted(line, quoted, sep, quote)
        if quoted:
            held.append(line)
            size += len(line) + 1
            if size > longest:
                raise ValueError(f"a quote is never closed: a record exceeds {longest} characters")
        elif held:
            yield "\n".join([*held, line])
            held, size = [], 0
        else:
            yield line
    if held:
        yield "\n".join(held)


def packed_members(path: str, content: bytes, extension: str) -> Iterator[tuple]:
    """The members of an archive, still compressed."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for info in archive.infolist():
            if info.is_dir() or not info.filename.lower().endswith("." + extension):
                continue
            if info.flag_bits & 1 or info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                raise ValueError(f"{path}: {info.filename} is encrypted or packed in an unknown way")
            name_length, extra_length = struct.unpack_from("<HH", content, info.header_offset + ENTRY_HEADER - 4)
            start = info.header_offset + ENTRY_HEADER + name_length + extra_length
            yield path, info.filename, info.compress_type, info.CRC, content[start:start + info.compress_size]


class Unpacked(io.RawIOBase):
    """A packed member, given in chunks, as a stream; reading its end checks its checksum."""

    def __init__(self, name: str, method: int, crc: int, packed: Iterable[bytes]):
        self._name, self._crc, self._seen = name, crc, 0
        self._packed, self._rest = iter(packed), b""
        self._inflate = zlib.decompressobj(-zlib.MAX_WBITS) if method == zipfile.ZIP_DEFLATED else None

    def readable(self) -> bool:
        return True

    def _some(self, most: int) -> bytes:
        if self._inflate is None:
            data, self._rest = self._rest[:most], self._rest[most:]
        else:
            data = self._inflate.decompress(self._rest, most)
            self._rest = self._inflate.unconsumed_tail
        return data

    def readinto(self, buffer) -> int:
        data = self._some(len(buffer))
        while not data and (chunk := next(self._packed, b"")):
            self._rest += chunk
            data = self._some(len(buffer))
        buffer[:len(data)] = data
        self._seen = zlib.crc32(data, self._seen)
        if not data and self._seen != self._crc:
            raise ValueError(f"{self._name} is damaged")
        return len(data)


def record_stream(unpacked: Unpacked, sep: str, quote: str, longest: int) -> Iterator[str]:
    text = io.TextIOWrapper(io.BufferedReader(unpacked, 1 << 20), encoding="utf-8-sig", newline="\n")
    return records_of(text, sep, quote, longest)


def expand_archives(archives: DataFrame, extension: str = "csv", sep: str = "|", quote: str = '"',
                    longest: int = MAX_RECORD_CHARACTERS) -> DataFrame:
    """binaryFile rows -> one row per record of every member. Record 0 is the header.

    One task opens an archive but only hands its members on, compressed as they are; they
    are unpacked and cut into records in parallel, a member being one stream. Records
    leave as text and are parsed by Spark.
    """
    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                for member in packed_members(path, content, extension):
                    yield pd.DataFrame([member], columns=["archive", "member", "method", "crc", "packed"])

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for m in batch.itertuples():
                unpacked = Unpacked(f"{m.archive}#{m.member}", m.method, m.crc, [m.packed])
                numbered = enumerate(record_stream(unpacked, sep, quote, longest))
                while rows := [(m.archive, m.member, n, r) for n, r in itertools.islice(numbered, BATCH_ROWS)]:
                    yield pd.DataFrame(rows, columns=["archive", "member", "record_no", "record"])

    # One task per core: sized by bytes, a few compressed members would end up in one task.
    tasks = archives.sparkSession.sparkContext.defaultParallelism
    members = archives.select("path", "content").mapInPandas(split, PACKED)
    return members.repartition(tasks, "archive", "member").mapInPandas(unpack, RECORDS)


def with_feed(records: DataFrame) -> DataFrame:
    """feed and file_stem columns from the archive's and the member's name."""
    name = F.substring_index("archive", "/", -1)
    member = F.substring_index("member", "/", -1)
    return records.withColumns({"feed": feed_of(feed_folder(name)), "file_stem": F.lower(file_stem(member))})
