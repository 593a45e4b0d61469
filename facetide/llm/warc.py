"""Legacy archives to WARC: reads ARC files of both versions, writes WARC files, and reads those.

An ARC file begins with a version block, ``filedesc://...``, whose second line names the version. A record is one header line
and as many bytes as the line declares:

    version 1: URL IP-address Archive-date Content-type Archive-length
    version 2: URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length

The converter gives each record an identifier made from archive and offset, a WARC timestamp, a type (``response`` for HTTP,
else ``resource``) and block and payload digests. Of equal payloads of ``REVISIT_BYTES`` or more, the record with the largest
page id stays a response and the others become revisits of it, which hold the HTTP header only.

Archives are files of at most ``ARCHIVE_BYTES`` (or one record), compressed by gzip, written by Spark's text writer: the
last line end of an archive is the writer's. So they can be in any store that Spark writes, and a lost task is written again.
Payloads are not shuffled: digests are, as narrow rows; the choice goes back to each archive as a list.

Defined cases: a null html is an empty payload; a null URL is written as ``-``, and space and control characters in a URL
are percent-encoded; a null page id has no header line and reads back as null, the least. Repeated rows are records of
their own; of those alike, the last in the archives is the response. No pages give no archives.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from facetide.session import scratch_path, ship

ARCHIVE_BYTES = 8 << 20
REVISIT_BYTES = 1000
DATE = "20090101000000"
ORIGIN = "facetide"
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE = "X-Page-Id"
_REFERS = "X-Refers-To-Page-Id"


def _escaped(url: str | None) -> str:
    return "-" if not url else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", "%2D" if url == "-" else url)


def _http(page: int | None, size: int) -> bytes:
    held = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n"
    return (held + (f"{_PAGE}: {page}\r\n" if page is not None else "") + "\r\n").encode()


def _version_block(version: int, name: str) -> bytes:
    body = f"{version} {1 if version == 2 else 0} {ORIGIN}\n{FIELDS[version]}\n\n".encode()
    return _arc_line(version, f"filedesc://{name}", "text/plain", "200", 0, name, len(body)) + body + b"\n"


def _arc_line(version: int, url: str, kind: str, code: str, offset: int, name: str, size: int) -> bytes:
    more = f" {code} - - {offset} {name}" if version == 2 else ""
    return f"{url} 0.0.0.0 {DATE} {kind}{more} {size}\n".encode()


def write_arc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", body: str = "html") -> None:
    """Write pages as ARC files, of version 1 and 2 in turn."""
    ship(pages.sparkSession)

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, 0
        for batch in batches:
            for page, address, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                version = 1 + number % 2
                if not held:
                    name = f"{uuid.uuid4().hex}.arc"
                    held = [_version_block(version, name)]
                    size = len(held[0])
                block = _http(page, len(payload)) + payload
                line = _arc_line(version, _escaped(address), "text/html", "200", size, name, len(block))
                held += [line, block, b"\n"]
                size += len(line) + len(block) + 1
                if size >= ARCHIVE_BYTES:
                    yield _one(held)
                    held, number = [], number + 1
        if held:
            yield _one(held)

    rows = pages.select(F.col(key).cast("long"), F.col(url), F.col(body).cast("binary"))
    _write(rows.mapInArrow(archives, "archive binary"), path)


def _one(parts: list[bytes]) -> pa.RecordBatch:
    # The writer ends the line.
    return pa.RecordBatch.from_pydict({"archive": pa.array([b"".join(parts)[:-1]], pa.binary())})


def _write(archives: DataFrame, path: str) -> None:
    archives.select(F.col("archive").cast("string")).write.option("compression", "gzip").option(
        "zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")


def parse_arc(data: bytes) -> Iterator[tuple[int, str | None, str, str, bytes, bytes]]:
    """(offset, url, ip, date, content type, block) of each record but the version block."""
    if not data:  # a task without pages writes an empty file
        return
    at = data.index(b"\n") + 1
    size = int(data[:at].rsplit(b" ", 1)[1])
    version = int(data[at:at + size].split(b" ", 1)[0])
    fields = len(FIELDS[version].split())
    at += size
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        end = data.index(b"\n", at)
        line = data[at:end].decode().split(" ")
        # A content type may hold spaces; the fields before and after it do not.
        url, ip, date = line[:3]
        tail = line[-(fields - 4):]
        kind, size = " ".join(line[3:len(line) - len(tail)]), int(tail[-1])
        block = data[end + 1:end + 1 + size]
        if len(block) < size:
            raise ValueError(f"the record at {at} declares {size} bytes, but {len(block)} follow")
        yield at, None if url == "-" else url, ip, date, kind, block
        at = end + 1 + size


def _payload(block: bytes) -> int:
    """Where the payload begins; -1 if the block is not HTTP."""
    if not block.startswith(b"HTTP/"):
        return -1
    at = block.find(b"\r\n\r\n")
    return len(block) if at < 0 else at + 4


def _field(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*(.*?)\r?$", head)
    return found[1].decode() if found else None


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(archive: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{offset}')}>"


def _date(arc: str) -> str:
    d = arc.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _header(fields: list[tuple[str, str | None]], size: int) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {size}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def _index(spark: SparkSession, arc_path: str) -> DataFrame:
    """A narrow row per record: file, offset, page, size and digest of the payload."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for offset, url, _, _, _, block in parse_arc(_unzipped(content)):
                    start = max(0, _payload(block))
                    page = _field(block[:start], _PAGE)
                    digest = hashlib.sha1(memoryview(block)[start:]).digest()
                    rows.append((path, offset, url, int(page) if page else None, len(block) - start, digest))
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=pa.schema(
                    [("path", pa.string()), ("offset", pa.int64()), ("url", pa.string()), ("page", pa.int64()),
                     ("size", pa.int64()), ("digest", pa.binary())]))

    names = ("path", "offset", "url", "page", "size", "digest")
    return _files(spark, arc_path).mapInArrow(
        read, "path string, offset long, url string, page long, size long, digest binary")


def _unzipped(content: pa.Scalar) -> bytes:
    data, out = content.as_buffer().to_pybytes(), []
    while data:  # members may follow each other
        reader = zlib.decompressobj(31)
        out.append(reader.decompress(data))
        data = reader.unused_data
    return b"".join(out)


def convert(spark: SparkSession, arc_path: str, warc_path: str) -> None:
    """Convert all archives of a folder; each becomes one WARC file."""
    ship(spark)
    from facetide.llm.common import stored

    index = stored(_index(spark, arc_path), "arc-index")
    order = F.struct(F.col("page").isNotNull().alias("known"), "page", "path", "offset")
    groups = index.where(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size").agg(
        F.max(F.struct(order.alias("at"), F.col("url").alias("url"))).alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1")
    kept = groups.select("digest", "size", F.col("kept.at.path").alias("to_path"), F.col("kept.at.offset").alias("to_offset"),
                         F.col("kept.at.page").alias("to_page"), F.col("kept.url").alias("to_url"))
    revisits = index.join(kept, ["digest", "size"]).where("path != to_path or offset != to_offset")
    lists = revisits.groupBy("path").agg(F.collect_list(
        F.struct("offset", "to_path", "to_offset", "to_page", "to_url")).alias("revisits"))  # of one archive's records

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content, listed in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                yield _one(list(_converted(_name(path), _unzipped(content), {r["offset"]: r for r in listed or ()})))

    files = _files(spark, arc_path).join(lists, "path", "left").select("path", "content", "revisits")
    _write(files.mapInArrow(write, "archive binary"), warc_path)


def _converted(archive: str, data: bytes, revisits: dict[int, dict]) -> Iterator[bytes]:
    about = f"software: {ORIGIN}\r\nformat: WARC File Format 1.1\r\nconversion-of: {archive}\r\n".encode()
    yield _header([
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(archive, 0)), ("WARC-Date", _date(DATE)),
        ("WARC-Filename", archive), ("Content-Type", "application/warc-fields")], len(about)) + about + b"\r\n\r\n"
    for offset, url, ip, date, kind, block in parse_arc(data):
        start = _payload(block)
        fields = [("WARC-Record-ID", _record_id(archive, offset)), ("WARC-Date", _date(date)), ("WARC-Target-URI", url),
                  ("WARC-IP-Address", ip), ("WARC-Payload-Digest", _digest(block[max(0, start):]))]
        to = revisits.get(offset)
        if start < 0:
            fields = [("WARC-Type", "resource"), *fields, ("Content-Type", kind)]
        elif to is None:
            fields = [("WARC-Type", "response"), *fields, ("Content-Type", "application/http; msgtype=response")]
        else:
            block = block[:start]
            page = to["to_page"]
            fields = [("WARC-Type", "revisit"), *fields, ("WARC-Profile", PROFILE),
                      ("WARC-Refers-To", _record_id(_name(to["to_path"]), to["to_offset"])),
                      ("WARC-Refers-To-Target-URI", to["to_url"]), (_REFERS, None if page is None else str(page)),
                      ("Content-Type", "application/http; msgtype=response")]
        fields.append(("WARC-Block-Digest", _digest(block)))
        yield _header(fields, len(block)) + block + b"\r\n\r\n"


def parse_warc(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(header, block) of each record."""
    at = 0
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        end = data.index(b"\r\n\r\n", at) + 4
        head = data[at:end]
        size = int(_field(head, "Content-Length"))
        yield head, data[end:end + size]
        at = end + size


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row per page record: page_id, url, date, record_id, record_type, payload_bytes, payload_digest (hex), refers_to
    (page), refers_to_record. Blocks and payloads are checked by their digests."""
    ship(spark)
    names = ("page_id", "url", "date", "record_id", "record_type", "payload_bytes", "payload_digest", "refers_to",
             "refers_to_record")
    kinds = ("long", "string", "string", "string", "string", "long", "string", "long", "string")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, pa.int64() if k == "long" else pa.string()) for n, k in zip(names, kinds)])
        for batch in batches:
            for content in batch.column(1):
                rows = []
                for head, block in parse_warc(_unzipped(content)):
                    kind = _field(head, "WARC-Type")
                    if kind == "warcinfo":
                        continue
                    start = max(0, _payload(block))
                    digest = _field(head, "WARC-Payload-Digest")
                    page, size = _field(block[:start], _PAGE), len(block) - start
                    if _digest(block) != _field(head, "WARC-Block-Digest"):
                        raise ValueError("a block does not have its digest")
                    if kind == "revisit":
                        size = int(_field(block[:start], "Content-Length"))
                    elif _digest(block[start:]) != digest:
                        raise ValueError("a payload does not have its digest")
                    to = _field(head, _REFERS)
                    rows.append(dict(zip(names, (
                        int(page) if page else None, _field(head, "WARC-Target-URI"), _field(head, "WARC-Date"),
                        _field(head, "WARC-Record-ID"), kind, size, base64.b32decode(digest[5:]).hex(),
                        int(to) if to else None, _field(head, "WARC-Refers-To")))))
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return _files(spark, path).mapInArrow(read, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def pages_to_warc(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> str:
    """Write pages as ARC files, convert them, and return the folder of the WARC files."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, key, url, body)
    convert(spark, arc, warc)
    return warc
