import base64
import gzip
import hashlib

import pytest

from docsift.llm import warc
from docsift.session import new_path

PAGES = [
    (1, "http://a/1", "<p>one</p>\n"), (2, "http://a/2", "<p>one</p>\n"), (9, "http://a/9", "<p>one</p>\n"),
    (3, "http://a/\r\nX-Injected: 1", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"), (4, None, None), (5, "u", ""),
    (6, "http://ä/ß", "é\x00\r\n\r\n\r\nend"), (7, "http://long", "line\n" * 60_000), (7, "http://long", "line\n" * 60_000),
    (8, "http://one-line", "x" * 500_000), (None, "http://nobody", "<b>alone</b>"), (None, "n", "<p>one</p>\n"),
]


def written(spark, rows, **options):
    path = new_path(spark, "test-warc")
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    warc.write_archives(frame.repartition(3), path, **options)
    return path


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.mark.parametrize("least", [0, 1, 12])
def test_captures_equal_pages(spark, least):
    found = warc.captures(warc.read_records(spark, written(spark, PAGES, least_bytes=least))).collect()
    got = []
    by_record = {r["record_id"]: r for r in found}
    for r in found:
        page = r["metadata"]["payload"].decode().removeprefix("page_id: ").strip()
        response = r["response"]
        revisit = response["record_type"] == "revisit"
        assert response["complete"] and r["request"]["payload"].startswith(b"GET ")
        bytes_ = response["http_length"] if revisit else response["payload_bytes"]
        sha = response["recorded_digest"] if revisit else response["payload_digest"]
        assert sha == response["recorded_digest"]
        target = by_record[response["refers_to"]]["metadata"]["payload"].decode().split()[-1] if revisit else ""
        got.append((page, bytes_, sha, response["record_type"], target))
    want = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        equal = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        first = max(equal, default=None)
        revisit = len(data) >= least and first is not None and page != first
        kind, target = ("revisit", str(first)) if revisit else ("response", "")
        want.append(("" if page is None else str(page), len(data), digest(data), kind, target))
    assert sorted(got) == sorted(want)


def test_archives_follow_the_format(spark):
    path = written(spark, PAGES[:2])
    lines = b""
    for row in spark.read.format("binaryFile").load(path + "/*.gz").collect():
        lines += gzip.decompress(bytes(row["content"]))
    records = [r for r in lines.split(b"WARC/1.1\r\n") if r]
    assert len(records) == 6
    for record in records:
        head, _, block = record.partition(b"\r\n\r\n")
        headers = dict(line.split(b": ", 1) for line in head.split(b"\r\n"))
        assert headers[b"WARC-Record-ID"].startswith(b"<urn:uuid:") and b"WARC-Date" in headers
        assert block[int(headers[b"Content-Length"]) :] == b"\r\n\r\n"


def test_foreign_archives(spark, tmp_path):
    """Orphans, unknown types, a member per record, and a record cut off."""

    def record(kind, name, block, **more):
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{name}>\r\n"
        head += "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in more.items())
        return head.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\nhello"
    members = [
        record("warcinfo", "i", b"software: x\r\n"), record("response", "r1", http),
        record("request", "q1", b"GET / HTTP/1.1\r\n\r\n", WARC_Concurrent_To="<r1>"),
        record("request", "q2", b"", WARC_Concurrent_To="<unknown>"), record("resource", "r2", b"\xff\xfe raw"),
        record("response", "r3", http)[:-20],
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(m) for m in members))
    records = warc.read_records(spark, str(tmp_path))
    assert records.count() == 6
    found = {r["record_id"]: r for r in warc.captures(records).collect()}
    assert set(found) == {"<r1>", "<r2>", "<r3>", "<unknown>"}
    assert found["<r1>"]["response"]["payload"] == b"hello" and found["<r1>"]["request"]["record_id"] == "<q1>"
    assert found["<unknown>"]["response"] is None and found["<r2>"]["response"]["payload"] == b"\xff\xfe raw"
    assert not found["<r3>"]["response"]["complete"] and found["<r1>"]["metadata"] is None
