"""Zip archives as a Spark data source that reads members by range.

Planning reads each archive's directory, at its end, and nothing else. A partition is a
list of members of about equal packed size, each with the place where it lies; its task
opens the archive there and unpacks as it reads, so neither an archive nor a member is ever
one value and archives may be of any size. A member is one compressed stream and so lies in
one task. Files are opened by Arrow, for local and mounted paths, S3, GCS, HDFS and Azure;
where only Spark's own readers reach them, ``archive.expand_archives`` does the same.

Archives without a member of the extension, and empty members, give no rows; equal members
of an archive are read each; a member that is encrypted, damaged or packed in another way
than deflated or stored fails the job.
"""

from __future__ import annotations

import json
import struct
import sys
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from rosterlake.sources.archive import ENTRY_HEADER, MAX_RECORD_CHARACTERS, RECORDS, Unpacked, record_stream

# Workers need not have this package: what they run travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "zip_records"
# Packed bytes that a task takes on at most, unless one member has more.
PARTITION_BYTES = 64 << 20
CHUNK = 1 << 20
# A batch of records ends at either bound.
BATCH_ROWS, BATCH_CHARACTERS = 10_000, 8 << 20
DIRECTORY_READERS = 32


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path within it, for URIs as Spark writes them and for plain paths."""
    scheme, _, rest = path.partition("://")
    if rest and scheme in ("s3a", "s3n"):
        path = f"s3://{rest}"
    elif path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def found_archives(roots: list[str]) -> list[str]:
    """The zip files among paths and below folders, each once."""
    out = {}
    for root in roots:
        system, path = opened(root)
        info = system.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(root)
        if info.type == fs.FileType.File:
            out[root] = None
            continue
        inside = system.get_file_info(fs.FileSelector(path, recursive=True))
        for name in sorted(f.path for f in inside if f.type == fs.FileType.File and f.path.endswith(".zip")):
            out[root.rstrip("/") + name.removeprefix(path.rstrip("/"))] = None
    return list(out)


def listed_members(path: str, extension: str) -> list[tuple]:
    """(archive, member, method, crc, place of its header, packed bytes), from the directory."""
    system, name = opened(path)
    out = []
    with system.open_input_file(name) as file, zipfile.ZipFile(file) as archive:
        for info in archive.infolist():
            if info.is_dir() or not info.filename.lower().endswith("." + extension):
                continue
            if info.flag_bits & 1 or info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                raise ValueError(f"{path}: {info.filename} is encrypted or packed in an unknown way")
            out.append((path, info.filename, info.compress_type, info.CRC, info.header_offset, info.compress_size))
    return out


def shares(members: list[tuple], most: int) -> list[list[tuple]]:
    """Members in lists of at most ``most`` packed bytes, or one larger member; largest first,
    so that the long tasks start first."""
    out: list[list[tuple]] = []
    size = most
    for member in sorted(members, key=lambda m: -m[5]):
        if size + member[5] > most:
            out.append([])
            size = 0
        out[-1].append(member)
        size += member[5]
    return out


def packed_chunks(file, start: int, length: int) -> Iterator[bytes]:
    """A member's packed bytes from the archive, a chunk at a time."""
    file.seek(start)
    name_length, extra_length = struct.unpack_from("<HH", file.read(ENTRY_HEADER), ENTRY_HEADER - 4)
    file.seek(start + ENTRY_HEADER + name_length + extra_length)
    while length > 0:
        chunk = file.read(min(CHUNK, length))
        if not chunk:
            raise ValueError("the archive ends within a member")
        length -= len(chunk)
        yield chunk


class ZipRecords(DataSource):
    """Options: ``paths`` (JSON list of files and folders), ``extension``, ``sep``, ``quote``,
    ``longest`` record in characters, ``tasks`` wanted at least if there are as many members."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RECORDS

    def reader(self, schema) -> DataSourceReader:
        return ZipRecordsReader(dict(self.options))


class ZipRecordsReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = json.loads(options["paths"])
        self.extension, self.sep, self.quote = (options[k] for k in ("extension", "sep", "quote"))
        self.longest, self.tasks = int(options["longest"]), int(options["tasks"])

    def partitions(self) -> list[InputPartition]:
        with ThreadPoolExecutor(DIRECTORY_READERS) as pool:
            listed = pool.map(lambda p: listed_members(p, self.extension), found_archives(self.paths))
            members = [m for archive in listed for m in archive]
        total = sum(m[5] for m in members)
        most = max(1, min(PARTITION_BYTES, -(-total // self.tasks)))
        return [InputPartition(json.dumps(share)) for share in shares(members, most)] or [InputPartition("[]")]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for path, member, method, crc, start, length in json.loads(partition.value):
            system, name = opened(path)
            with system.open_input_file(name) as file:
                unpacked = Unpacked(f"{path}#{member}", method, crc, packed_chunks(file, start, length))
                held, size, first = [], 0, 0
                for record in record_stream(unpacked, self.sep, self.quote, self.longest):
                    held.append(record)
                    size += len(record)
                    if len(held) >= BATCH_ROWS or size >= BATCH_CHARACTERS:
                        yield batch_of(path, member, first, held)
                        first, held, size = first + len(held), [], 0
                if held:
                    yield batch_of(path, member, first, held)


def batch_of(path: str, member: str, first: int, records: list[str]) -> pa.RecordBatch:
    n = len(records)
    return pa.RecordBatch.from_arrays(
        [pa.repeat(pa.scalar(path), n), pa.repeat(pa.scalar(member), n),
         pa.array(range(first, first + n), pa.int64()), pa.array(records, pa.string())],
        names=["archive", "member", "record_no", "record"])


def read_zip_records(spark: SparkSession, paths: str | list[str], extension: str = "csv", sep: str = "|",
                     quote: str = '"', longest: int = MAX_RECORD_CHARACTERS) -> DataFrame:
    """One row per record of every member of the archives; record 0 is the header."""
    spark.dataSource.register(ZipRecords)
    options = {"paths": json.dumps([paths] if isinstance(paths, str) else paths), "extension": extension, "sep": sep,
               "quote": quote, "longest": str(longest), "tasks": str(spark.sparkContext.defaultParallelism)}
    return spark.read.format(FORMAT).options(**options).load()
