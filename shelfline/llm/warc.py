"""Web archives: WARC records written into ZIP packages, and read back by ranges without extraction.

A package holds a stored (not compressed) WARC member and a stored index member.  The reader parses the end
record, the ZIP64 end record where there is one, and the central directory; finds where the stored members begin; reads
the index; and fetches records by byte ranges.  Ranges are dealt out over tasks, so one large package
is read by many.  Files are reached through ``pyarrow.fs``, so the shared folder may be any store that
it knows (HDFS needs libhdfs on the executors).

A writing task gives every package a name of its own and reports it in its result; only reported packages are
read.  A task that is lost or runs twice leaves a file that nothing refers to.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import batches, rows_of, small_batches, spread_join, stored
from shelfline.session import new_folder

DATE = "2024-01-01T00:00:00Z"
WARC_MEMBER, INDEX_MEMBER = "archive/data.warc", "indexes/index.cdxj"
# Bytes after which a task begins another package, and bytes that one range read covers.
PACKAGE_BYTES, RANGE_BYTES = 256 << 20, 4 << 20
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
ReadAt = Callable[[int, int], bytes]  # (offset, length)


# -- records ------------------------------------------------------------------------------------

def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """One WARC record; with ``refers_to`` a revisit, which names the record that holds the payload."""
    block = b"" if refers_to is not None else HTTP_HEAD + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=~-._')}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_name(refers_to)}", f"X-Payload-Length: {len(payload)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    else:
        head.append("Content-Type: application/http; msgtype=response")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_head(data: bytes) -> tuple[dict[str, str], int]:
    """Header fields by lower-case name, and where the block begins."""
    end = data.find(b"\r\n\r\n")
    if end < 0 or not data.startswith(b"WARC/"):
        raise ValueError("no WARC record at this place")
    lines = data[:end].decode().split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, end + 4


def parse(data: bytes) -> tuple:
    """(page_id, url, record_type, digest, payload length, refers_to, payload) of one record."""
    head, at = parse_head(data)
    block = data[at:at + int(head["content-length"])]
    told = head["warc-payload-digest"].removeprefix("sha1:")
    url = unquote(head["warc-target-uri"]) if "warc-target-uri" in head else None
    if head["warc-type"] == "revisit":
        return (_page(head["warc-record-id"]), url, "revisit", told, int(head["x-payload-length"]), _page(head["warc-refers-to"]), None)
    payload = block[block.index(b"\r\n\r\n") + 4:]
    if payload_digest(payload) != told:
        raise ValueError(f"payload of {head['warc-record-id']} does not have its digest")
    return _page(head["warc-record-id"]), url, "response", told, len(payload), None, payload


# -- packages: writing ----------------------------------------------------------------------------

class _Sink:
    """What zipfile needs of a file that can only be appended to."""

    def __init__(self, stream):
        self.stream, self.at = stream, 0

    def write(self, data) -> int:
        self.stream.write(bytes(data))
        self.at += len(data)
        return len(data)

    def tell(self) -> int:
        return self.at

    def flush(self) -> None:
        self.stream.flush()


class PackageWriter:
    def __init__(self, path: str):
        self.path = path
        system, place = fs.FileSystem.from_uri(path)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        self.stream = system.open_output_stream(place)
        self.package = zipfile.ZipFile(_Sink(self.stream), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.package.open(zipfile.ZipInfo(WARC_MEMBER, (2024, 1, 1, 0, 0, 0)), "w", force_zip64=True)
        self.bytes, self.index = 0, []

    def add(self, page_id, data: bytes) -> None:
        self.index.append(json.dumps({"page": page_id, "offset": self.bytes, "length": len(data)}))
        self.member.write(data)
        self.bytes += len(data)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.package.writestr(zipfile.ZipInfo(INDEX_MEMBER, (2024, 1, 1, 0, 0, 0)), "\n".join(self.index))
        self.package.close()
        self.stream.close()
        return self.path, len(self.index), self.bytes


# -- packages: reading ------------------------------------------------------------------------------

@dataclass
class Member:
    name: str
    method: int
    size: int
    header: int  # where its local header is


def central_directory(read_at: ReadAt, size: int) -> list[Member]:
    """Members of a ZIP file, from the end record, the ZIP64 end record and the central directory."""
    tail_at = max(0, size - 65557)
    tail = read_at(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    while end >= 0 and end + 22 + int.from_bytes(tail[end + 20:end + 22], "little") != len(tail):
        end = tail.rfind(b"PK\x05\x06", 0, end)  # the signature inside a comment
    if end < 0:
        raise ValueError("not a ZIP file")
    count, length, start = struct.unpack("<HII", tail[end + 10:end + 20])
    stop = tail_at + end
    locator = read_at(stop - 20, 20) if stop >= 20 else b""
    if locator[:4] == b"PK\x06\x07":  # ZIP64, whether or not the plain fields are at their limits
        at = struct.unpack("<Q", locator[8:16])[0]
        wide = read_at(at, 56)
        if wide[:4] != b"PK\x06\x06":
            raise ValueError("ZIP64 end record is not where its locator says")
        count, length, start = struct.unpack("<QQQ", wide[32:56])
        stop = at
    shift = stop - length - start  # bytes before the package, as in self-extracting files
    data, at, members = read_at(start + shift, length), 0, []
    for _ in range(count):
        if data[at:at + 4] != b"PK\x01\x02":
            raise ValueError("central directory is damaged")
        flags, method = struct.unpack("<HH", data[at + 8:at + 12])
        stored_size, full_size, name, extra, comment = struct.unpack("<IIHHH", data[at + 20:at + 34])
        header = struct.unpack("<I", data[at + 42:at + 46])[0]
        text = data[at + 46:at + 46 + name].decode("utf-8" if flags & 0x800 else "cp437")
        more, end_of_more = at + 46 + name, at + 46 + name + extra
        while more + 4 <= end_of_more:
            tag, width = struct.unpack("<HH", data[more:more + 4])
            if tag == 1:  # ZIP64: only the fields that did not fit, in this order
                wide = iter(struct.unpack(f"<{width // 8}Q", data[more + 4:more + 4 + width // 8 * 8]))
                full_size = next(wide) if full_size == 0xFFFFFFFF else full_size
                stored_size = next(wide) if stored_size == 0xFFFFFFFF else stored_size
                header = next(wide) if header == 0xFFFFFFFF else header
            more += 4 + width
        if flags & 1:
            raise ValueError(f"{text} is encrypted")
        members.append(Member(text, method, full_size, header + shift))
        at = end_of_more + comment
    return members


def member_start(read_at: ReadAt, member: Member) -> int:
    """Offset of a stored member's data; its local header may be longer than the central entry says."""
    if member.method != zipfile.ZIP_STORED:
        raise ValueError(f"{member.name} is compressed; ranges of it cannot be read")
    head = read_at(member.header, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError(f"no local header for {member.name}")
    return member.header + 30 + sum(struct.unpack("<HH", head[26:30]))


def _scanned(read_at: ReadAt, start: int, size: int) -> Iterator[tuple[int, int]]:
    """Records of a WARC member without an index: header by header."""
    at = 0
    while at < size:
        width = 4096
        while True:
            data = read_at(start + at, min(width, size - at))
            if b"\r\n\r\n" in data or width >= size - at:
                break
            width *= 4
        head, body = parse_head(data)
        length = body + int(head["content-length"]) + 4
        yield at, length
        at += length


def record_places(read_at: ReadAt, size: int) -> Iterator[tuple[int, int]]:
    """Absolute offset and length of every record of a package."""
    members = central_directory(read_at, size)
    archives = [m for m in members if m.name.startswith("archive/") and m.name.endswith(".warc")]
    indexes = [m for m in members if m.name.startswith("indexes/") and m.name.endswith(".cdxj")]
    if len(archives) == 1 and indexes:
        start = member_start(read_at, archives[0])
        for index in indexes:
            at = member_start(read_at, index)
            for line in read_at(at, index.size).decode().split("\n"):
                if line:
                    place = json.loads(line)
                    yield start + place["offset"], place["length"]
    else:
        for archive in archives:
            start = member_start(read_at, archive)
            for at, length in _scanned(read_at, start, archive.size):
                yield start + at, length


def opened(path: str) -> tuple[ReadAt, int]:
    system, place = fs.FileSystem.from_uri(path)
    file = system.open_input_file(place)

    def read_at(offset: int, length: int) -> bytes:
        data = file.read_at(length, offset) if length > 0 else b""
        if len(data) != max(0, length):
            raise ValueError(f"{path} ends before {offset + length}")
        return data

    return read_at, file.size()


# -- jobs -------------------------------------------------------------------------------------------

_PACKAGES = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
_RANGES = pa.schema([("path", pa.string()), ("start", pa.int64()), ("ends", pa.list_(pa.int64()))])
_RECORDS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
                      ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id``, ``url``, ``payload`` and ``refers_to``: the smallest id with an equal payload, null for that page itself.

    Payloads are equal when their SHA-256 and length are.  Only payloads of ``least_bytes`` or more are revisits.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"print": F.sha2("payload", 256), "size": F.octet_length("payload")})
    groups = rows.select("page_id", "print", "size").filter(F.col("size") >= least_bytes).groupBy("print", "size").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    rows = spread_join(rows, stored(groups, "equal-payloads"), ["print", "size"], "page_id")
    # A page without an id revisits the first that has one.
    return rows.select("page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write_packages(records: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes ``page_id``, ``url``, ``payload``, ``refers_to`` as WARC records; returns the packages, one row each, stored."""
    small_batches(records.sparkSession)

    def run(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for columns in rows_of(iterator, "page_id", "url", "payload", "refers_to"):
            for page_id, url, payload, refers_to in zip(*columns):
                writer = writer or PackageWriter(f"{folder}/{uuid.uuid4().hex}.wacz")
                writer.add(page_id, record(page_id, url, payload, refers_to))
                if writer.bytes >= package_bytes:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        if done:
            yield batches(_PACKAGES.names, list(zip(*done)), _PACKAGES)

    rows = records.select("page_id", "url", "payload", "refers_to")
    return stored(rows.mapInArrow(run, "path string, records long, bytes long"), "packages")


def read_packages(packages: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records of the packages named in column ``path``: ``page_id``, ``url``, ``record_type``, ``payload_digest``,
    ``payload_bytes``, ``refers_to``, ``payload`` (null for revisits, whose length and digest are of the full payload)."""
    def locate(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (paths,) in rows_of(iterator, "path"):
            for path in paths:
                start, ends, out = None, [], [[], [], []]
                for at, length in record_places(*opened(path)):
                    if start is not None and (at != ends[-1] or at + length - start > range_bytes):
                        for column, value in zip(out, (path, start, ends)):
                            column.append(value)
                        start = None
                    if start is None:
                        start, ends = at, []
                    ends.append(at + length)
                if start is not None:
                    for column, value in zip(out, (path, start, ends)):
                        column.append(value)
                yield batches(_RANGES.names, out, _RANGES)

    def fetch(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in rows_of(iterator, "path", "start", "ends"):
            for path, start, ends in zip(*columns):
                read_at, _ = opened(path)
                data = read_at(start, ends[-1] - start)
                found = [parse(data[a - start:b - start]) for a, b in zip([start, *ends], ends)]
                yield batches(_RECORDS.names, list(zip(*found)), _RECORDS)

    ranges = packages.select("path").mapInArrow(locate, "path string, start long, ends array<long>")
    # Ranges of one package go to many tasks.
    return ranges.repartition(F.xxhash64("path", "start")).mapInArrow(
        fetch, "page_id long, url string, record_type string, payload_digest string, payload_bytes long, "
               "refers_to long, payload binary")


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages written to packages in the shared folder and read back.

    Null ``html`` is an empty payload; a null url is left out of its record.  Rows that repeat a page id with its payload are
    records each, all of the type of that page.  No pages, no packages.
    """
    folder = new_folder(pages.sparkSession, "archives")
    return read_packages(write_packages(with_revisits(pages, least_bytes), folder))
