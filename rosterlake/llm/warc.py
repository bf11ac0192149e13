"""WARC archives: written by Spark's text writer, read back, and assembled into captures.

A record's end mark (two empty lines) serves as line separator, so the archives are written
and committed like any other table, and read as a stream without one value per archive.
Python joins the pieces of a record again by its stated length. Request and metadata
records name the response they are concurrent to; that identifier joins a capture.

Of equal payloads of at least ``least_bytes`` the page with the least id is the response and
the others are revisits, which name its record. A group of equal payloads may be any size:
the least id is found by a partial aggregation, and adaptive execution may split the join.

Defined results: a null html is an empty payload; a null url has a placeholder; pages of a
null id are responses; rows equal in id, url and html are captures of their own with one
identifier; other columns are ignored; no rows give none.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterlake.llm.tables import written
from rosterlake.session import scratch_dir

END = "\r\n\r\n"
LEAST_BYTES = 100
CAPTURES_PER_ARCHIVE = 20_000
DATE = "2026-01-01T00:00:00Z"
NO_URL = "urn:page:unknown"
# Fixed value: the profile of a revisit of an identical payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE_FIELDS = ("record_id", "type", "target_uri", "date", "refers_to", "payload_digest", "http_header", "payload")
BATCH_BYTES = 1 << 23
RECORD = ("record_id string, type string, target_uri string, date string, concurrent_to string, refers_to string, "
          "payload_digest string, content_type string, http_header string, payload binary")


def _record(kind: str, identity: Column, url: Column, content_type: str, block: Column, *headers: Column) -> Column:
    """A record as text; headers that are null are left out."""
    lines = F.concat_ws("\r\n", F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: "), identity),
                        F.lit(f"WARC-Date: {DATE}"), F.concat(F.lit("WARC-Target-URI: "), url), *headers,
                        F.lit(f"Content-Type: {content_type}"), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(lines, F.lit(END), block)


def write_warc(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Response or revisit, request and metadata record of every page, as gzip archives in a folder."""
    rows = pages.select(F.col("page_id"), F.col("url"), F.coalesce("html", F.lit("")).alias("html")).withColumns({
        "digest": F.sha2("html", 256), "bytes": F.octet_length("html")})
    rows = rows.withColumn("key", F.concat_ws(":", F.lit("urn:capture"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
                                              F.sha2(F.concat_ws(" ", "digest", F.coalesce("url", F.lit(""))), 256)))
    large = rows.where((F.col("bytes") >= least_bytes) & F.col("page_id").isNotNull())
    # Written, so that the join has a shuffle on either side that adaptive execution may split.
    first = written(large.groupBy("digest").agg(F.min(F.struct("page_id", "key")).alias("first"), F.count("*").alias("n"))
                    .where("n > 1").select("digest", "first"), "firsts")
    revisit = F.col("first.key").isNotNull() & F.col("page_id").isNotNull() & (F.col("first.key") != F.col("key"))
    told = rows.join(first, "digest", "left").select(
        "page_id", "url", "html", "digest", "bytes", "key", F.when(revisit, F.col("first.key")).alias("original"))
    uri = F.regexp_replace(F.coalesce("url", F.lit(NO_URL)), r"[\x00-\x20\x7F]", "")
    identity = F.concat(F.lit("<"), F.col("key"), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    digest = F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest"))
    host, target = F.regexp_extract(uri, "://([^/?#]*)", 1), F.regexp_extract(uri, "://[^/?#]*([^#]*)", 1)
    to = F.concat(F.lit("WARC-Concurrent-To: "), identity)

    def named(part: str) -> Column:
        return F.concat(F.lit("<"), F.col("key"), F.lit(f":{part}>"))

    response = _record("response", identity, uri, "application/http;msgtype=response", F.concat(http, F.col("html")), digest)
    repeat = _record("revisit", identity, uri, "application/http;msgtype=response", http, digest, F.lit(f"WARC-Profile: {PROFILE}"),
                     F.concat(F.lit("WARC-Refers-To: <"), F.col("original"), F.lit(">")))
    request = _record("request", named("request"), uri, "application/http;msgtype=request",
                      F.concat(F.lit("GET "), F.when(target.startswith("/"), target).otherwise(F.concat(F.lit("/"), target)),
                               F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END)), to)
    metadata = _record("metadata", named("metadata"), uri, "application/json",
                       F.to_json(F.struct("page_id", "url"), {"ignoreNullFields": "false"}), to)
    (told.select(F.explode(F.array(F.when(F.col("original").isNull(), response).otherwise(repeat), request, metadata)).alias("value"))
     .write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", 3 * CAPTURES_PER_ARCHIVE).text(path))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _parsed(header: bytes, block: bytes) -> tuple:
    first, _, rest = header.lstrip(b"\r\n").partition(b"\r\n")
    if not first.startswith(b"WARC/"):
        raise ValueError("no WARC record starts here; archives have to be compressed, or Spark splits them")
    fields: dict[str, str] = {}
    for line in rest.decode("utf-8", "replace").split("\r\n"):
        name, _, value = line.partition(":")
        fields.setdefault(name.strip().lower(), value.strip())
    head, payload = None, block
    if fields.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(END.encode())
        head = head.decode("utf-8", "replace")
    return (fields.get("warc-record-id"), fields.get("warc-type"), fields.get("warc-target-uri"), fields.get("warc-date"),
            fields.get("warc-concurrent-to"), fields.get("warc-refers-to"), fields.get("warc-payload-digest"),
            fields.get("content-type"), head, payload)


def _length(header: bytes) -> int:
    for line in header.split(b"\r\n"):
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            return int(value)
    raise ValueError("a WARC record states no length")


def records_of(pieces: Iterator[bytes]) -> Iterator[tuple]:
    """Records of one archive, given as what lies between its end marks."""
    mark, buffer, header, length = END.encode(), bytearray(), None, 0
    for piece in pieces:
        buffer += piece
        buffer += mark
        while True:
            if header is None:
                at = buffer.find(mark)
                if at < 0 or not buffer[:at].strip():
                    break
                header = bytes(buffer[:at])
                length = _length(header)
                del buffer[:at + 4]
            if len(buffer) < length + 4:
                break
            yield _parsed(header, bytes(buffer[:length]))
            del buffer[:length + 4]
            header = None
    if header is not None or buffer.strip():
        raise ValueError("the archive ends within a record")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All records of the gzip archives under a path."""
    lines = spark.read.option("lineSep", END).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        schema = pa.schema([(c.split()[0], pa.binary() if c.endswith("binary") else pa.string()) for c in RECORD.split(", ")])
        pieces = ((f, v) for b in batches for f, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        rows, size = [], 0
        for _, own in groupby(pieces, key=lambda piece: piece[0]):
            for row in records_of(v for _, v in own):
                rows.append(row)
                size += len(row[-1])
                if size > BATCH_BYTES:
                    yield _batch(rows, schema)
                    rows, size = [], 0
        yield _batch(rows, schema)

    return lines.mapInArrow(run, RECORD)


def captures(records: DataFrame, of_response: tuple[str, ...] = RESPONSE_FIELDS) -> DataFrame:
    """One nested row per capture: ``capture_id, response, request, metadata``.

    ``response``, of the columns ``of_response``, is the response or revisit record, and its payload is a revisit's only if it
    has one. Of several requests or metadata records the one of the least content stands.
    Responses that share an identifier are captures each.
    """
    main = F.col("type").isin("response", "revisit")
    keyed = records.where(main | F.col("type").isin("request", "metadata")).withColumn(
        "capture_id", F.when(main, F.col("record_id")).otherwise(F.col("concurrent_to")))
    http = F.struct(*of_response)
    other = F.struct("record_id", "date", "content_type", "http_header", "payload")
    grouped = keyed.groupBy("capture_id").agg(
        F.min(F.when(main, http)).alias("response"), F.min(F.when(F.col("type") == "request", other)).alias("request"),
        F.min(F.when(F.col("type") == "metadata", other)).alias("metadata"), F.count(F.when(main, 1)).alias("n"))
    return grouped.withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest("n", F.lit(1)).cast("int")))).drop("n", "copy")


def page_digests(pages: DataFrame) -> DataFrame:
    """Writes the pages as archives, reads them back and tells of every page what its capture holds."""
    spark = pages.sparkSession
    path = scratch_dir(spark, "warc")
    write_warc(pages, path)
    # What is asked of a payload is worked out where it is read, so that it does not travel.
    records = read_warc(spark, path).withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    nested = captures(records, ("record_id", "type", "refers_to", "bytes", "digest"))
    page = F.from_json(F.col("metadata.payload").cast("string"), "page_id long").getField("page_id")
    told = written(nested.select("capture_id", page.alias("page_id"), "response.*"), "captures")
    response = told.where("type = 'response'").select("capture_id", "page_id", "bytes", "digest")
    # Written for the same reason: many revisits may name one response.
    originals = written(response.groupBy("capture_id").agg(F.min(F.struct("page_id", "bytes", "digest")).alias("of")), "originals")
    revisits = told.where("type = 'revisit'").select("page_id", F.col("refers_to").alias("capture_id")).join(originals, "capture_id")
    return response.select("page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                           F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")).unionByName(
        revisits.select("page_id", F.col("of.bytes").alias("payload_bytes"), F.col("of.digest").alias("payload_digest"),
                        F.lit("revisit").alias("record_type"), F.col("of.page_id").alias("refers_to")))
