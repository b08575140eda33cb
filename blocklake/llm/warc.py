"""WARC archives: write pages as response and revisit records, read them back and reassemble segments.

Writing: a payload that several rows share is stored once, under the smallest id; the others become revisit
records. Blocks longer than `segment_bytes` are cut into continuation records, so no record and no archive file
grows with a single page. HTTP bodies use chunked transfer framing. Spark's text writer stores one record per
line with CRLF as the line end, which is exactly the record separator; files are gzip-compressed archives.

Reading: whole files come through Spark's binary reader and are parsed as a stream. Records that were not cut
are decoded where they are read; continuation records are grouped by origin identifier, ordered by segment
number, checked for gaps and for the declared total length, joined, and their chunked framing is decoded.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blocklake.llm.common import BROADCAST_ROWS, materialize

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
RECORDS_PER_FILE = 16_384
SALTS = 16
EMIT_BYTES = 4 << 20
CRLF = b"\r\n"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PARSED = ("rid string, segment int, total long, type string, refers_to string, uri string, declared string, "
          "n_bytes long, digest string, payload binary, block binary, error string")


class Malformed(ValueError):
    """A record or an HTTP body that breaks its format."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    out = bytearray()
    for i in range(0, len(payload), size):
        part = payload[i : i + size]
        out += b"%x\r\n%b\r\n" % (len(part), part)
    return bytes(out + b"0\r\n\r\n")


def dechunk(body: bytes) -> bytes:
    """Decode chunked framing; chunk extensions and trailers are skipped, anything after them is an error."""
    out, at = bytearray(), 0
    while True:
        end = body.find(CRLF, at)
        if end < 0:
            raise Malformed("chunk size line is cut")
        digits = body[at:end].split(b";")[0].strip()
        if not digits or digits.strip(b"0123456789abcdefABCDEF"):
            raise Malformed("chunk size is not hexadecimal")
        size, at = int(digits, 16), end + 2
        if not size:
            break
        if body[at + size : at + size + 2] != CRLF:
            raise Malformed("chunk is cut")
        out += body[at : at + size]
        at += size + 2
    while (end := body.find(CRLF, at)) != at:  # trailer lines
        if end < 0:
            raise Malformed("trailer is cut")
        at = end + 2
    if at + 2 != len(body):
        raise Malformed("bytes after the last chunk")
    return bytes(out)


def http_payload(block: bytes) -> bytes:
    head, mark, body = block.partition(CRLF + CRLF)
    if not mark:
        raise Malformed("no end of the HTTP head")
    fields = _fields(head.split(CRLF)[1:])
    return dechunk(body) if fields.get("transfer-encoding", "").lower() == "chunked" else body


def _fields(lines: list[bytes]) -> dict[str, str]:
    return {k.strip().decode("utf-8", "replace").lower(): v.strip().decode("utf-8", "replace")
            for k, _, v in (x.partition(b":") for x in lines)}


def _record(kind: str, rid: str, block: bytes, **fields: str | None) -> bytes:
    named = {"WARC-Type": kind, "WARC-Record-ID": f"<{rid}>", **{k.replace("_", "-"): v for k, v in fields.items()},
             "Content-Length": str(len(block))}
    head = "".join(f"{k}: {v}\r\n" for k, v in named.items() if v is not None)
    return VERSION + CRLF + head.encode() + CRLF + block + CRLF  # the writer's line end is the last CRLF


def page_records(key: str | None, uri: str | None, payload: bytes, refers: str | None, revisit: bool, date: str,
                 segment_bytes: int) -> Iterator[bytes]:
    digest = payload_digest(payload)
    urn = lambda k: f"urn:page:{quote(k or '', safe='')}:{digest}"
    common = {"WARC_Date": date, "WARC_Target_URI": quote(uri, safe="%/:?#[]@!$&'()*+,;=~-._") if uri else None,
              "Content_Type": "application/http; msgtype=response", "WARC_Payload_Digest": f"sha1:{digest}"}
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if revisit:
        yield _record("revisit", urn(key), head + b"Content-Length: %d\r\n\r\n" % len(payload), **common,
                      WARC_Profile=REVISIT_PROFILE, WARC_Refers_To=f"<{urn(refers)}>")
        return
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment_bytes:
        yield _record("response", urn(key), block, **common)
        return
    for number, i in enumerate(range(0, len(block), segment_bytes), 1):
        part = block[i : i + segment_bytes]
        if number == 1:
            yield _record("response", urn(key), part, **common, WARC_Segment_Number="1")
        else:
            total = str(len(block)) if i + segment_bytes >= len(block) else None
            yield _record("continuation", f"{urn(key)}:{number}", part, WARC_Date=date,
                          WARC_Segment_Origin_ID=f"<{urn(key)}>", WARC_Segment_Number=str(number),
                          WARC_Segment_Total_Length=total)


def write_warc(pages: DataFrame, path: str, page_id: str = "page_id", uri: str = "url", payload: str = "html",
               segment_bytes: int = SEGMENT_BYTES, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write every row as a response or a revisit record below `path`.

    Null payloads count as empty; empty payloads are equal to one another. Among rows of one payload, those with
    the smallest id are responses (rows equal in id and payload are the same record) and the others refer to it;
    a null id comes after all others. A null uri is left out. Only the three named columns are read.
    """
    rows = pages.select(F.col(page_id).alias("id"), F.col(uri).alias("uri"),
                        F.coalesce(F.col(payload), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    shared = rows.groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).where("n > 1")
    shared = materialize(shared.select("sha", "first", F.lit(True).alias("shared")), "shared")
    if shared.count() <= BROADCAST_ROWS:
        rows = rows.join(F.broadcast(shared), "sha", "left")
    else:  # a payload may hold a third of all rows, so each is met under several salts
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")).alias("salt")
        rows = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
        rows = rows.join(shared.select("*", salts), ["sha", "salt"], "left")
    revisit = F.coalesce(F.col("shared"), F.lit(False)) & ~F.col("id").eqNullSafe(F.col("first"))
    rows = rows.select(F.col("id").cast("string"), "uri", "payload", F.col("first").cast("string"), revisit)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            held, size = [], 0
            for i in range(rb.num_rows):
                key, link, body, first, again = (rb.column(c)[i].as_py() for c in range(5))
                for r in page_records(key, link, body, first, again, date, segment_bytes):
                    held.append(r)
                    size += len(r)
                if size >= EMIT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["record"])
                    held, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["record"])

    records = rows.mapInArrow(run, "record binary").select(F.col("record").cast("string"))
    (records.write.option("lineSep", "\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def parse_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(named fields, block) of each record of an archive stream."""
    while line := stream.readline():
        if line == CRLF:
            continue
        if line.rstrip() != VERSION:
            raise Malformed(f"not a record: {line[:40]!r}")
        lines = []
        while (line := stream.readline()) != CRLF:
            if not line:
                raise Malformed("record head is cut")
            lines.append(line.rstrip(CRLF))
        fields = _fields(lines)
        block = stream.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]) or stream.read(4) != CRLF * 2:
            raise Malformed(f"record {fields.get('warc-record-id')} is cut")
        yield fields, block


def _decoded(block: bytes, declared: str | None, keep: bool) -> tuple:
    """(n_bytes, digest, payload, error) of a whole HTTP block."""
    try:
        body = http_payload(block)
    except Malformed as e:
        return None, None, None, str(e)
    digest = payload_digest(body)
    error = None if declared in (None, digest) else "payload digest differs from the declared one"
    return len(body), digest, body if keep else None, error


def _parsed(fields: dict[str, str], block: bytes, keep: bool) -> tuple:
    strip = lambda k: fields[k].strip("<>") if k in fields else None
    kind, declared = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    number, total = int(fields.get("warc-segment-number", 0)), fields.get("warc-segment-total-length")
    rid = strip("warc-segment-origin-id") if kind == "continuation" else strip("warc-record-id")
    n, digest, body, error = None, None, None, None
    if kind == "revisit":
        length = _fields(block.split(CRLF)[1:]).get("content-length")
        n, digest = int(length) if length else None, declared
    elif not number:
        n, digest, body, error = _decoded(block, declared, keep)
    return (rid, max(number, 1), int(total) if total else None, kind, strip("warc-refers-to"),
            fields.get("warc-target-uri"), declared, n, digest, body, block if number else None, error)


def _emit(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
        zip(*rows, strict=True) if rows else [[]] * len(names), types, strict=True)], names)


_TYPES = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
_NAMES, _KINDS = zip(*((a, _TYPES[b]) for a, b in (x.split(" ") for x in PARSED.split(", "))), strict=True)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Per response or revisit record: id, record_type, uri, n_bytes, digest, refers_to, payload, error.

    `error` names what is wrong with a record (missing segment, wrong total length, broken framing, digest that
    differs) and is null for a sound one; a file that is no archive fails the read. Revisits carry no payload:
    their digest and length are the archived ones. Records written more than once are returned as often.
    """
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for content in rb.column(0):
                held, size = [], 0
                with gzip.open(pa.BufferReader(content.as_buffer())) as stream:
                    for fields, block in parse_records(stream):
                        held.append(_parsed(fields, block, payload))
                        size += len(block)
                        if size >= EMIT_BYTES:
                            yield _emit(held, list(_NAMES), list(_KINDS))
                            held, size = [], 0
                yield _emit(held, list(_NAMES), list(_KINDS))

    parsed = files.mapInArrow(run, PARSED)
    # Segments that were written more than once are one segment; this also bounds a group to one payload.
    segments = parsed.groupBy("rid", "segment").agg(F.first(F.struct(*[c for c in _NAMES if c not in (
        "rid", "segment")])).alias("s"), F.count(F.lit(1)).alias("copies"))
    head = F.max_by("s", F.col("segment") == 1)
    whole = segments.groupBy("rid").agg(
        head.alias("head"), F.max(F.when(F.col("segment") == 1, F.col("copies"))).alias("copies"),
        F.sort_array(F.collect_list(F.when(F.col("s.block").isNotNull(), F.struct(
            "segment", "s.total", "s.block")))).alias("parts"))
    names = ["rid", "type", "refers_to", "uri", "n_bytes", "digest", "payload", "error", "copies"]

    def join(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            rows = []
            for i in range(rb.num_rows):
                rid, h, copies, parts = (rb.column(c)[i].as_py() for c in range(4))
                n, digest, body, error = h["n_bytes"], h["digest"], h["payload"], h["error"]
                if parts:
                    block = b"".join(p["block"] for p in parts)
                    if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
                        error = "a segment is missing"
                    elif parts[-1]["total"] != len(block):
                        error = "the segments differ from the total length"
                    else:
                        n, digest, body, error = _decoded(block, h["declared"], payload)
                rows.append((rid, h["type"], h["refers_to"], h["uri"], n, digest, body, error, copies or 1))
            yield _emit(rows, names, [_TYPES[t] for t in (
                "string", "string", "string", "string", "long", "string", "binary", "string", "long")])

    out = whole.select("rid", "head", "copies", "parts").mapInArrow(
        join, "rid string, type string, refers_to string, uri string, n_bytes long, digest string, payload binary, "
        "error string, copies long")
    key = lambda c: F.nullif(F.url_decode(F.regexp_extract(c, "^urn:page:([^:]*):", 1)), F.lit(""))
    out = out.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_copy"))
    return out.select(key("rid").alias("id"), F.col("type").alias("record_type"), "uri", "n_bytes", "digest",
                      key("refers_to").alias("refers_to"), "payload", "error")
