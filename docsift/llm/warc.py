"""WARC archives: written from pages, read back, and assembled into captures.

A capture is a request, a response (or a revisit of an equal payload) and a
metadata record; request and metadata name the response's record as concurrent.
Archives are gzip text files of Spark's own writer, whose line separator is the
end of a WARC record; reading streams lines and cuts records by their length.

Defined results: null html is an empty payload; a null url leaves out the target
URI; a page without id has an empty id field and comes back as null. Rows equal
in id and payload are all the response. Line breaks in a url are escaped. A
request or metadata record that names no known response gives a capture without
one. A record cut off by the end of its file is returned as incomplete.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

END = "\r\n\r\n"
#: Alphabet of base 32, and the digits ``conv`` uses for it (fixed values).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payload bytes a task gathers before it hands records on.
BYTES_OUT = 4 << 20


def payload_digest(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: every 5 hex digits are 4 of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), CONV32, BASE32)


def _urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws(":", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: Column | str, headers: list[tuple[str, Column]], block: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.lit("WARC/1.1\r\nWARC-Type: "), kind]
    for name, value in headers:  # a null value leaves its header out
        lines.append(F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value), F.lit("")))
    size = F.octet_length(block).cast("string")
    return F.concat(*lines, F.lit("\r\nContent-Length: "), size, F.lit(END), block)


def write_archives(
    pages: DataFrame,
    path: str,
    least_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> None:
    """One request, response or revisit, and metadata record for every page.

    Of pages with equal payloads of at least ``least_bytes`` the one with the
    largest id is the response. The largest ids per payload come from partial
    aggregates; the join with them leaves a hot payload to Spark's skew join.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    url = F.replace(F.replace(F.col(url_col), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    rows = pages.select(
        F.col(id_col).alias("id"),
        url.alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).alias("bytes"),
        payload_digest(payload).alias("digest"),
    )
    equal = rows.filter(F.col("bytes") >= least_bytes)
    latest = equal.groupBy("digest", "bytes").agg(F.max("id").alias("latest"))
    rows = rows.join(latest, ["digest", "bytes"], "left")
    revisit = F.col("latest").isNotNull() & ~F.col("id").eqNullSafe(F.col("latest"))
    name = F.coalesce(F.col("id").cast("string"), F.lit(""))
    kind = F.when(revisit, "revisit").otherwise("response")
    urn = _urn(F.lit("response"), name, F.col("digest"))
    original = F.when(revisit, _urn(F.lit("response"), F.col("latest").cast("string"), F.col("digest")))
    labelled = F.concat(F.lit("sha1:"), F.col("digest"))
    length = F.concat(F.lit("\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"), length)
    common = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("url"))]
    request = _record(
        "request",
        [
            ("WARC-Record-ID", _urn(F.lit("request"), name, F.col("digest"))),
            ("WARC-Concurrent-To", urn),
            *common,
            ("Content-Type", F.lit("application/http;msgtype=request")),
        ],
        F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(" HTTP/1.1" + END)),
    )
    response = _record(
        kind,
        [
            ("WARC-Record-ID", urn),
            *common,
            ("WARC-Payload-Digest", labelled),
            ("WARC-Profile", F.when(revisit, PROFILE)),
            ("WARC-Refers-To", original),
            ("Content-Type", F.lit("application/http;msgtype=response")),
        ],
        F.when(revisit, http).otherwise(F.concat(http, F.col("payload"))),
    )
    metadata = _record(
        "metadata",
        [
            ("WARC-Record-ID", _urn(F.lit("metadata"), name, F.col("digest"))),
            ("WARC-Concurrent-To", urn),
            *common,
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        F.concat(F.lit("page_id: "), name, F.lit("\r\n")),
    )
    records = rows.select(F.concat(request, F.lit(END), response, F.lit(END), metadata).alias("value"))
    records.write.option("lineSep", END).option("compression", "gzip").text(path)


RECORD = (
    "record_type string, record_id string, concurrent_to string, refers_to string, uri string, "
    "recorded_digest string, http_length long, payload binary, payload_bytes long, payload_digest string, "
    "complete boolean"
)


class _Parser:
    """Cuts records out of lines that come one after the other."""

    def __init__(self):
        self.headers: dict[str, str] | None = None
        self.block: list[bytes] = []
        self.missing = 0

    def feed(self, line: bytes) -> Iterator[dict]:
        if self.missing > 0:
            self.block.append(line)
            self.missing -= len(line)
        elif self.headers is None:
            if line.startswith(b"WARC/"):
                self.headers = {}
            return
        elif line.strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            self.headers.setdefault(name.strip().lower(), value.strip())
            return
        else:
            size = self.headers.get("content-length", "0")
            self.missing = int(size) if size.isdigit() else 0
        if self.missing <= 0:
            yield self.finish(True)

    def finish(self, complete: bool) -> dict:
        headers, block = self.headers or {}, b"".join(self.block)
        if self.missing < 0:
            block = block[: self.missing]
        self.headers, self.block, self.missing = None, [], 0
        kind, payload, http_length = headers.get("warc-type", ""), block, None
        if kind in ("response", "revisit"):
            head, _, payload = block.partition(b"\r\n\r\n")
            for line in head.split(b"\r\n"):
                name, _, value = line.partition(b":")
                if name.strip().lower() == b"content-length" and value.strip().isdigit():
                    http_length = int(value)
        digest = headers.get("warc-payload-digest", "")
        return {
            "record_type": kind,
            "record_id": headers.get("warc-record-id"),
            "concurrent_to": headers.get("warc-concurrent-to"),
            "refers_to": headers.get("warc-refers-to"),
            "uri": headers.get("warc-target-uri"),
            "recorded_digest": digest.removeprefix("sha1:") or None,
            "http_length": http_length,
            "payload": payload,
            "payload_bytes": len(payload),
            "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode(),
            "complete": complete,
        }


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the gzip archives under ``path``; a task streams whole files line by line."""
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(F.col("value").cast("binary").alias("line"), F.xxhash64("_metadata.file_path").alias("file"))
    )
    shape = pa.schema(
        [(c.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[
            c.split()[1]]) for c in RECORD.split(", ")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, file, out, held = _Parser(), None, [], 0
        for batch in batches:
            pairs = zip(batch.column("line").to_pylist(), batch.column("file").to_pylist(), strict=True)
            for line, now in pairs:
                if now != file:
                    if parser.headers is not None:
                        out.append(parser.finish(False))
                    parser, file = _Parser(), now
                for record in parser.feed(line + b"\n"):
                    out.append(record)
                    held += 256 + record["payload_bytes"]
                if held > BYTES_OUT:
                    yield pa.RecordBatch.from_pylist(out, shape)
                    out, held = [], 0
        if parser.headers is not None:
            out.append(parser.finish(False))
        if out:
            yield pa.RecordBatch.from_pylist(out, shape)

    return lines.mapInArrow(run, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """``(record_id, response, request, metadata)``: one nested row per capture."""
    nested = F.struct(*[c for c in records.columns])
    main = records.filter(F.col("record_type").isin("response", "revisit", "resource"))
    main = main.select(F.col("record_id").alias("own_id"), nested.alias("response"))
    others = records.filter(F.col("record_type").isin("request", "metadata"))
    of_type = lambda kind: F.min(F.when(F.col("record_type") == kind, nested)).alias(kind)
    others = others.groupBy("concurrent_to").agg(of_type("request"), of_type("metadata"))
    joined = main.join(others, F.col("own_id") == F.col("concurrent_to"), "full")
    return joined.select(F.coalesce("own_id", "concurrent_to").alias("record_id"), "response", "request", "metadata")
