"""Operator 10, WARC: a converter of legacy ARC archives.

An ARC file opens with a version block that names its fields (five in version 1, ten in version 2); every record is a
header line of those fields and a block of the declared length. The converter walks by these lengths and synthesises
for each record the WARC headers that ARC lacks: identifier, ISO timestamp, type, block and payload digests. Records
with equal payloads of at least ``least_revisit`` bytes become one response, at the smallest page_id, and revisits of
it. Archives are read as plain bytes or as any sequence of gzip members, whether a member holds one record, several or
a part of one; those written here have one a record. A record that is cut short, or whose length does not lead to the
next header, is an error.

A null html is an empty payload; a null or blank URL is ``about:blank`` and white space or control characters in one
are percent-encoded. A null page_id is written without an identifier, read back as null, and comes after all others
when the response is chosen; of repeated rows the first written is the response. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, shared_files

#: The field lists of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: A file is closed once it holds so many bytes before compression.
FILE_BYTES = 256 << 20
#: Bytes of a header line.
MOST_HEADER = 1 << 20
CRAWL_DATE = "20240101000000"
LEVEL = 1
_SPACE = re.compile(r"[\x00-\x20\x7f]")


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


def _member(data: bytes) -> bytes:
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


class Stream:
    """Lines and runs of bytes of an archive's content, a bounded part of it at a time in memory."""

    def __init__(self, source, chunk: int = 1 << 20) -> None:
        self.source, self.chunk, self.buffer, self.at = source, chunk, b"", 0
        self.rest = source.read(chunk)
        self.inflate = zlib.decompressobj(31) if self.rest[:2] == b"\x1f\x8b" else None
        self.inside = False  # a member that has not ended

    def _content(self) -> bytes:
        """The next part; nothing at the end."""
        while True:
            data = self.rest or self.source.read(self.chunk)
            self.rest = b""
            if self.inflate is None or not (data or self.inside):
                return data
            out = self.inflate.decompress(data, self.chunk)
            self.inside = not self.inflate.eof
            if self.inflate.eof:
                self.rest, self.inflate = self.inflate.unused_data, zlib.decompressobj(31)
            else:
                self.rest = self.inflate.unconsumed_tail
                if not (data or out):
                    raise ValueError("the last gzip member is cut short")
            if out:
                return out

    def _more(self) -> bool:
        part = self._content()
        self.buffer, self.at = self.buffer[self.at :] + part, 0
        return bool(part)

    def line(self) -> bytes:
        """Up to the next line feed, with it; nothing at the end."""
        while (end := self.buffer.find(b"\n", self.at) + 1) == 0:
            if len(self.buffer) - self.at > MOST_HEADER:
                raise ValueError("a header line is too long")
            if not self._more():
                end = len(self.buffer)
                break
        found, self.at = self.buffer[self.at : end], end
        return found

    def run(self, n: int) -> bytes:
        """The next ``n`` bytes, or what there is."""
        parts = []
        while n > 0 and (self.at < len(self.buffer) or self._more()):
            parts.append(self.buffer[self.at : self.at + n])
            self.at += len(parts[-1])
            n -= len(parts[-1])
        return b"".join(parts)


def _text(data: bytes) -> str:
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return data.decode("latin-1")


def clean_url(url: str | None) -> str:
    url = _SPACE.sub(lambda m: f"%{ord(m[0]):02X}", (url or "").strip())
    return url or "about:blank"


def arc_version_block(version: int, name: str) -> bytes:
    body = f"{version} {0 if version == 1 else 1} quillmark\n{ARC_FIELDS[version]}\n\n".encode()
    fields = [f"filedesc://{name}", "0.0.0.0", CRAWL_DATE, "text/plain"]
    if version == 2:
        fields += ["200", "-", "-", "0", name]
    return f"{' '.join(fields)} {len(body)}\n".encode() + body


def arc_record(version: int, url: str, date: str, block: bytes, checksum: str, offset: int, name: str) -> bytes:
    fields = [url, "0.0.0.0", date, "text/html"]
    if version == 2:
        fields += ["200", checksum, "-", str(offset), name]
    return f"\n{' '.join(fields)} {len(block)}\n".encode() + block


def parse_arc(source) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(number, header fields, block) of every record, the version block first."""
    stream, names, number = Stream(source), [], 0
    while head := stream.line():
        if not head.strip():
            continue
        fields = _text(head).rstrip("\r\n").split(" ")
        if not fields[-1].isdigit():
            raise ValueError(f"record {number}: no length in its header")
        length = int(fields[-1])
        block = stream.run(length)
        if len(block) < length or stream.line().strip():
            raise ValueError(f"record {number}: its declared length is wrong")
        if not number:
            about = _text(block).split("\n")
            version = about[0].split(" ")[0]
            names = about[1].strip().split(" ") if len(about) > 1 else []
            if not version.isdigit() or names != ARC_FIELDS.get(int(version), "").split(" "):
                raise ValueError(f"unknown ARC version or fields: {about[:2]}")
        if len(fields) != len(names):
            raise ValueError(f"record {number}: {len(fields)} fields, {len(names)} declared")
        yield number, dict(zip(names, fields, strict=True)), block
        number += 1


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Header part, with its blank line, and payload of an HTTP response; no header part if it is none."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    at = block.find(b"\r\n\r\n")
    return (block, b"") if at < 0 else (block[: at + 4], block[at + 4 :])


def _page_id(head: bytes) -> int | None:
    m = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", head)
    return int(m[1]) if m else None


def warc_date(date: str) -> str:
    date += "00000101000000"[len(date) :]  # a shorter date is the first moment of its year, month or day
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def record_id(url: str, date: str, digest: str, page_id: int | None) -> str:
    """The same for the same capture, so that a revisit can name its response without looking it up."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {digest} {page_id}')}>"


def warc_record(headers: dict[str, str], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in {**headers, "Content-Length": str(len(block))}.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def convert_record(fields: dict[str, str], block: bytes, response: dict | None) -> bytes:
    """The WARC record of an ARC record; a revisit of ``response`` (url, date, page_id) if that is given."""
    head, payload = split_http(block)
    url, date, digest = fields["URL"], fields["Archive-date"], sha1(payload)
    headers = {
        "WARC-Type": "response" if head else "resource", "WARC-Record-ID": record_id(url, date, digest, _page_id(head)), "WARC-Date": warc_date(date), "WARC-Target-URI": url,
        "WARC-IP-Address": fields["IP-address"], "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response" if head else fields["Content-type"],
    }
    if response is not None:
        block = head
        headers |= {
            "WARC-Type": "revisit", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "WARC-Refers-To": record_id(response["url"], response["date"], digest, response["page_id"]), "WARC-Refers-To-Target-URI": response["url"],
            "WARC-Refers-To-Date": warc_date(response["date"]), "X-Payload-Length": str(len(payload)),
        }
        if response["page_id"] is not None:
            headers["X-Refers-To-Page-Id"] = str(response["page_id"])
    headers["WARC-Block-Digest"] = f"sha1:{sha1(block)}"
    return warc_record(headers, block)


def parse_warc(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record, by the declared lengths."""
    stream = Stream(source)
    while first := stream.line():
        if not first.strip():
            continue
        if first.rstrip(b"\r\n") != b"WARC/1.1":
            raise ValueError(f"not a WARC record: {first[:80]!r}")
        headers = {}
        while (line := stream.line()).strip():
            name, _, value = line.decode("utf-8").rstrip("\r\n").partition(": ")
            headers[name] = value
        n = int(headers["Content-Length"])
        block = stream.run(n)
        if len(block) < n or stream.run(4) != b"\r\n\r\n":
            raise ValueError("a record's declared length is wrong")
        yield headers, block


_MANIFEST = "path string, records long"


def _manifest(path: str, records: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"path": path, "records": records}], schema=pa.schema([("path", pa.string()), ("records", pa.int64())]))


def write_arc(pages: DataFrame, folder: str) -> DataFrame:
    """Legacy archives of the pages, versions 1 and 2 in turn; returns the manifest (path, records)."""
    common.prepare(pages.sparkSession)

    def run(batches):
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        rows = (r for b in batches for r in zip(*(b.column(c) for c in ("page_id", "url", "html")), strict=True))
        row = next(rows, None)
        while row is not None:
            version, name, written, n = 1 + (part + seq) % 2, f"pages-{part:06d}-{seq:04d}.arc.gz", 0, 0
            with shared_files.new_file(folder, name[:-7], ".arc.gz") as (path, out):
                out.write(_member(arc_version_block(version, name)))
                while row is not None and written < FILE_BYTES:
                    page_id, url, html = (x.as_py() for x in row)
                    payload = (html or "").encode()
                    own = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
                    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{own}\r\n".encode() + payload
                    out.write(_member(arc_record(version, clean_url(url), CRAWL_DATE, block, "-", out.tell(), name)))
                    written += len(block)
                    n += 1
                    row = next(rows, None)
            yield _manifest(path, n)
            seq += 1

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return common.held(rows.mapInArrow(run, _MANIFEST))


def _files(manifest: DataFrame) -> DataFrame:
    """A task for each file."""
    return manifest.repartition(max(1, manifest.count()), "path")


def arc_index(manifest: DataFrame) -> DataFrame:
    """(path, number, page_id, url, date, bytes, digest) of every archived record."""
    schema = pa.schema([("path", pa.string()), ("number", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("bytes", pa.int64()), ("digest", pa.string())])

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                out = []
                with shared_files.opened(path) as source:
                    for k, fields, block in parse_arc(source):
                        if k:
                            head, payload = split_http(block)
                            out.append((path, k, _page_id(head), fields["URL"], fields["Archive-date"], len(payload), sha1(payload)))
                for first in range(0, len(out), 20_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[first : first + 20_000], strict=True), schema, strict=True)], schema=schema)

    return _files(manifest).select("path").mapInArrow(run, "path string, number long, page_id long, url string, date string, bytes long, digest string")


def revisits(index: DataFrame, folder: str, least: int) -> DataFrame:
    """(path, number, page_id, url, date): the response that each revisit names. ``index`` must be a written table."""
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "path", "number", "url", "date")
    firsts = index.where(F.col("bytes") >= least).groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    # both sides of the join are read from tables, so that a payload with a third of the rows can be split
    firsts = common.written(firsts.select(F.col("digest").alias("_d"), "first"), f"{folder}/responses")
    found = index.where(F.col("bytes") >= least).join(firsts, F.col("digest") == F.col("_d"))
    found = found.where((F.col("path") != F.col("first.path")) | (F.col("number") != F.col("first.number")))
    return found.select("path", "number", F.col("first.page_id").alias("page_id"), F.col("first.url").alias("url"), F.col("first.date").alias("date"))


def convert(manifest: DataFrame, folder: str, least_revisit: int = 0) -> DataFrame:
    """WARC files of the ARC files; returns their manifest (path, records)."""
    spark = manifest.sparkSession
    index = common.written(arc_index(manifest), f"{folder}/index")
    to = F.struct("number", "page_id", "url", "date")
    # a list a file, whose length the file size bounds
    lists = revisits(index, folder, least_revisit).groupBy(F.col("path").alias("_path")).agg(F.collect_list(to).alias("again"))
    work = _files(common.held(manifest.select("path").join(lists, F.col("path") == F.col("_path"), "left").select("path", "again")))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                again = {x["number"]: x for x in row["again"] or []}
                stem = row["path"].rsplit("/", 1)[1].rsplit("-", 1)[0]
                n = 0
                with shared_files.opened(row["path"]) as source, shared_files.new_file(folder, stem, ".warc.gz") as (path, out):
                    for k, fields, block in parse_arc(source):
                        if k == 0:
                            info = f"software: quillmark\r\nformat: WARC File Format 1.1\r\nconformsTo: ARC {block[:1].decode()}\r\n".encode()
                            name = f"{stem}.warc.gz"
                            out.write(_member(warc_record({
                                "WARC-Type": "warcinfo", "WARC-Record-ID": record_id(fields["URL"], fields["Archive-date"], name, None), "WARC-Date": warc_date(fields["Archive-date"]),
                                "WARC-Filename": name, "Content-Type": "application/warc-fields",
                            }, info)))
                        else:
                            out.write(_member(convert_record(fields, block, again.get(k))))
                            n += 1
                yield _manifest(path, n)

    out = common.held(work.mapInArrow(run, _MANIFEST))
    common.drop(spark, f"{folder}/index", f"{folder}/responses")
    return out


def read_warc(manifest: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record but the file headers; digests are checked."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                out = []
                with shared_files.opened(path) as source:
                    for headers, block in parse_warc(source):
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        if headers["WARC-Block-Digest"] != f"sha1:{sha1(block)}":
                            raise ValueError("a block's digest is wrong")
                        head, payload = split_http(block)
                        digest, revisit = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"] == "revisit"
                        if not revisit and digest != sha1(payload):
                            raise ValueError("a payload's digest is wrong")
                        size = int(headers["X-Payload-Length"]) if revisit else len(payload)
                        to = headers.get("X-Refers-To-Page-Id")
                        out.append((_page_id(head), size, digest, headers["WARC-Type"], int(to) if to else None))
                for first in range(0, len(out), 20_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[first : first + 20_000], strict=True), schema, strict=True)], schema=schema)

    return _files(manifest).mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(spark: SparkSession, pages: DataFrame, least_revisit: int = 0) -> DataFrame:
    """Archive the pages the legacy way, convert, read the result back and hold what it says."""
    folder = common.scratch(spark, "warc")
    arcs = write_arc(pages, f"{folder}/arc")
    out = common.held(read_warc(convert(arcs, f"{folder}/warc", least_revisit)))
    common.drop(spark, folder)
    return out


#: Base 32 of a SHA-1 by its hexadecimal digits: five digits make four characters.
_DIGEST = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, {5 * g + 1}, 5) AS BIGINT) // {32 ** (3 - k)}) % 32 AS INTEGER) + 1, 1)" for g in range(8) for k in range(4)
)
SQL = f"""
WITH hashed AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT h AS fh, min(page_id) AS first_id FROM hashed GROUP BY h)
SELECT page_id, payload_bytes, {_DIGEST} AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM hashed JOIN firsts ON h = fh
"""
