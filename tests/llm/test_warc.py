"""Archives: what is written comes back, whatever the payloads hold."""

import gzip
import hashlib

import pytest

from rosterlake.llm import warc as W
from rosterlake.session import scratch_dir

BIG = "x" * 99
PAGES = [(1, "http://a.example/x?y#z", "<p>" + BIG), (2, "http://b.example", "<p>" + BIG), (3, None, None), (4, "no scheme", ""), (5, "http://c/", "short"),
         (6, "http://c/", "short"), (7, "http://d/", "WARC/1.1\r\nContent-Length: 5\r\n\r\nab\r\n\r\n\r\n" + BIG), (8, "http://e/\r\nWARC-Type: evil", "end\r\n\r\n" * 30),
         (9, "http://f/", "é字\r\n" * 40 + "\r"), (10, "http://g/", "\r\n\r\n" * 2_000_00), (11, "http://g/", "\r\n\r\n" * 2_000_00),
         (12, "http://h/", BIG + "z"), (12, "http://h/", BIG + "z"), (12, "http://h2/", BIG + "z"), (None, "http://i/", BIG + "z"), (13, "http://j/", BIG + "z"), (14, "u", BIG)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "n", 1) for p in PAGES], "page_id long, url string, html string, digest string, bytes int").repartition(3)


def test_digests(spark, pages):
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in W.page_digests(pages).collect()), key=repr)
    want = []
    for page, url, html in PAGES:
        data = (html or "").encode()
        of = [(p, u or "") for p, u, h in PAGES if h == html and p is not None]
        first = min(of)[0] if of else None
        revisit = len(data) >= 100 and page is not None and (page != first or (page, url) == (12, "http://h2/"))
        want.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert got == sorted(want, key=repr)
    assert W.page_digests(pages.limit(0)).collect() == []


def test_captures_are_nested_and_whole(spark, pages):
    path = scratch_dir(spark, "warc-test")
    W.write_warc(pages, path)
    records = W.read_warc(spark, path)
    assert records.count() == 3 * len(PAGES)
    rows = W.captures(records).collect()
    assert len(rows) == len(PAGES)
    payloads = sorted(bytes(r.response.payload) for r in rows if r.response.type == "response")
    assert payloads[-1] == max((h or "").encode() for _, _, h in PAGES)
    for r in rows:
        assert r.request.http_header.startswith("GET /") and r.metadata.content_type == "application/json"
        assert r.capture_id == r.response.record_id and (r.response.type == "response" or not r.response.payload)


def test_foreign_archive_of_several_members(spark, tmp_path):
    def record(kind, own, block, *more):
        head = "\r\n".join(["WARC/1.0", f"warc-type: {kind}", f"WARC-Record-ID: {own}", *more, f"Content-Length: {len(block)}"])
        return gzip.compress(head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n")

    http = "Content-Type: application/http; msgtype=response"
    payload = bytes(range(256)) * 3
    members = [record("warcinfo", "<i>", b"software: x"), record("request", "<q>", b"GET / HTTP/1.1\r\n\r\n", "WARC-Concurrent-To: <r>", http),
               record("response", "<r>", b"HTTP/1.1 200 OK\r\n\r\n" + payload, http), record("metadata", "<m>", b"", "WARC-Concurrent-To: <r>"),
               record("request", "<lone>", b"", "WARC-Concurrent-To: <none>")]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(members))
    rows = {r.capture_id: r for r in W.captures(W.read_warc(spark, str(tmp_path))).collect()}
    assert set(rows) == {"<r>", "<none>"} and rows["<none>"].response is None
    assert bytes(rows["<r>"].response.payload) == payload and rows["<r>"].request.record_id == "<q>" and rows["<r>"].metadata.record_id == "<m>"


def test_broken_archives_are_told(spark):
    good = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc"
    assert [r[-1] for r in W.records_of(iter([b"WARC/1.1\r\nContent-Length: 3", b"abc"]))] == [b"abc"]
    with pytest.raises(ValueError, match="ends within"):
        list(W.records_of(iter([good[:-2]])))
    with pytest.raises(ValueError, match="no WARC record"):
        list(W.records_of(iter([b"HTML\r\nContent-Length: 3", b"abc"])))
    with pytest.raises(ValueError, match="no length"):
        list(W.records_of(iter([b"WARC/1.1\r\nA: 3", b"abc"])))
