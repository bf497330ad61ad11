"""WARC archives: writing with segmentation and chunked framing, and reassembly when read back.

A page becomes a response record whose HTTP message is in chunked transfer coding; a message longer than ``segment``
bytes is split over a first record and continuation records. Of pages with equal payloads one is the response, the
others are revisit records that name it. Archives are written and read by Spark's own file sources (gzip text with the
record end as line separator; whole binary files of a bounded number of records), so any store that Spark reaches will
do, and a lost task leaves no half file.

Reading parses each file in its task. Records in one piece are decoded there; only the pieces of segmented ones are
shuffled, grouped by the record they continue, sorted by segment number and checked against the total length.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridpulse.llm.packed import packed_texts, unpacked
from gridpulse.sources.scratch import cut, scratch_path

SEGMENT = 64 << 10  # bytes of an HTTP message in one record
CHUNK = 4096  # bytes of a transfer chunk
FILE_RECORDS = 512  # records of a file, hence at most 32 MB before compression
RECORD_END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"

_PAGE = ("page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
         "payload_digest string, payload binary, problem string")
_PIECE = ("origin string, number int, total bigint, page_id bigint, url string, payload_digest string, block binary")


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """Chunked transfer coding."""
    parts = [b"%x\r\n%s\r\n" % (len(c), c) for c in (payload[i: i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; raises ValueError on broken framing."""
    at, out = 0, []
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[end + 2: end + 2 + size])
        at = end + 2 + size
        if len(out[-1]) != size or body[at: at + 2] != b"\r\n":
            raise ValueError("broken chunk")
        at += 2


def _record(kind: str, headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {DATE}", *(f"{k}: {v}" for k, v in headers if v is not None),
             f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def page_records(page_id, url, payload: bytes, refers_to, segment: int = SEGMENT) -> list[bytes]:
    """The records of one page; ``refers_to`` makes it a revisit."""
    name = digest(payload)
    record_id = f"<urn:x-page:{page_id}:{name}>"
    target = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    shared = [("WARC-Record-ID", record_id), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{name}")]
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http = [("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        block = f"{head}Content-Length: {len(payload)}\r\n\r\n".encode()
        refers = [("WARC-Refers-To", f"<urn:x-page:{refers_to}:{name}>"), ("WARC-Profile", profile)]
        return [_record("revisit", [*shared, *refers, *http], block)]
    message = f"{head}Transfer-Encoding: chunked\r\n\r\n".encode() + chunked(payload)
    if len(message) <= segment:
        return [_record("response", [*shared, *http], message)]
    parts = [message[i: i + segment] for i in range(0, len(message), segment)]
    out = [_record("response", [*shared, ("WARC-Segment-Number", 1), *http], parts[0])]
    for k, part in enumerate(parts[1:], 2):
        total = len(message) if k == len(parts) else None
        out.append(_record("continuation", [
            ("WARC-Record-ID", f"<urn:x-page:{page_id}:{name}:{k}>"), ("WARC-Segment-Origin-ID", record_id),
            ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", total)], part))
    return out


def write_archives(pages: DataFrame, path: str, revisit_from: int = 0, segment: int = SEGMENT) -> None:
    """Write the records of all pages below ``path``.

    Among equal payloads of at least ``revisit_from`` bytes the page with the largest page_id is the response. A null
    html is an empty payload; a page without a page_id is always a response, and so is every row of the largest id.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("text"), F.sha1(html).alias("name"))
    top = cut(rows.where(F.octet_length("text") >= revisit_from).groupBy("name").agg(F.max("page_id").alias("top")))

    def run(batches):
        for b in batches:
            records = []
            for page, url, top_page, payload in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "top")), unpacked(b.column("packed"))):
                refers_to = top_page if page is not None and top_page not in (None, page) else None
                records.extend(page_records(page, url, payload, refers_to, segment))
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])

    # whole pages go through this shuffle, compressed; a payload with very many pages is a splittable hot key
    placed = packed_texts(rows).join(top, "name", "left").select("page_id", "url", "top", "packed")
    placed.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value")).write.option(
        "lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def parse(data: bytes):
    """(headers, block) of each record of an archive; header names in lower case."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(headers["content-length"])
        yield headers, data[end + 4: end + 4 + size]
        at = end + 4 + size + len(RECORD_END)


def _decoded(message: bytes, name: str, keep: bool):
    """payload_bytes, payload_digest, payload, problem of a whole HTTP message."""
    head, _, body = message.partition(b"\r\n\r\n")
    try:
        payload = dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
    except ValueError:
        return None, None, None, "broken transfer framing"
    found = digest(payload)
    return len(payload), found, payload if keep else None, None if found == name else "digest differs"


def _page_id(record_id: str):
    number = record_id.split(":")[2]
    return None if number == "None" else int(number)


def _files(batches):
    for b in batches:
        for content in b.column("content"):
            yield parse(gzip.decompress(content.as_buffer()))


def _batch(rows, schema_names, kinds):
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], schema_names)


_PAGE_NAMES = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload", "problem"]
_PAGE_KINDS = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()]
_PIECE_NAMES = ["origin", "number", "total", "page_id", "url", "payload_digest", "block"]
_PIECE_KINDS = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per page record: page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload, problem.

    ``payload`` is null for revisits (their size and digest are those of the response) and without ``payloads``.
    ``problem`` names a broken framing, a missing segment, a total length or a digest that does not fit; else null.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")

    def whole(batches):
        for records in _files(batches):
            out = []
            for h, block in records:
                if h["warc-type"] == "continuation" or "warc-segment-number" in h:
                    continue
                name, page = h["warc-payload-digest"].removeprefix("sha1:"), _page_id(h["warc-record-id"])
                if h["warc-type"] == "revisit":
                    size = re.search(rb"(?i)content-length: (\d+)", block)
                    facts = int(size[1]), name, None, None
                    out.append((page, h.get("warc-target-uri"), "revisit", _page_id(h["warc-refers-to"]), *facts))
                else:
                    out.append((page, h.get("warc-target-uri"), "response", None, *_decoded(block, name, payloads)))
            yield _batch(out, _PAGE_NAMES, _PAGE_KINDS)

    def pieces(batches):
        for records in _files(batches):
            out = []
            for h, block in records:
                if "warc-segment-number" in h:
                    origin = h.get("warc-segment-origin-id", h["warc-record-id"])
                    total = h.get("warc-segment-total-length")
                    out.append((origin, int(h["warc-segment-number"]), None if total is None else int(total), _page_id(origin),
                                h.get("warc-target-uri"), h.get("warc-payload-digest", "").removeprefix("sha1:"), block))
            yield _batch(out, _PIECE_NAMES, _PIECE_KINDS)

    def joined(batches):
        for b in batches:
            out = []
            for origin, parts in zip(b.column("origin").to_pylist(), b.column("parts").to_pylist()):
                first = [p for p in parts if p["number"] == 1] or [parts[0]]
                # a page that was archived twice has each of its segments twice
                single = {p["number"]: p for p in parts}
                order = sorted(single)
                message = b"".join(single[n]["block"] for n in order)
                total = next((p["total"] for p in parts if p["total"] is not None), None)
                if order != list(range(1, len(order) + 1)) or total != len(message):
                    facts = None, None, None, "segments missing or total length wrong"
                else:
                    facts = _decoded(message, first[0]["payload_digest"], payloads)
                out.extend([(_page_id(origin), first[0]["url"], "response", None, *facts)] * len(first))
            yield _batch(out, _PAGE_NAMES, _PAGE_KINDS)

    segmented = files.mapInArrow(pieces, _PIECE).groupBy("origin").agg(
        F.collect_list(F.struct("number", "total", "url", "payload_digest", "block")).alias("parts"))
    return files.mapInArrow(whole, _PAGE).unionAll(segmented.mapInArrow(joined, _PAGE))


def archive_and_read(pages: DataFrame, revisit_from: int = 0, payloads: bool = True, segment: int = SEGMENT) -> DataFrame:
    """Write the pages as WARC archives in the scratch folder and read them back; one row per page.

    Repeated rows stay, an empty table gives no rows, columns other than page_id, url and html are ignored.
    """
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, revisit_from, segment)
    return read_archives(pages.sparkSession, path, payloads)
