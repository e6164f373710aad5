"""WARC records in ZIP-packaged archives: written in parallel, read by ranges without unpacking.

An archive is a ZIP file whose members are stored, not compressed:
`archive/data-NNN.warc.gz` (one gzip member per record, as is usual for WARC) and
`indexes/index.cdxj` (one JSON line per record: member, offset, length).  The
reader parses the end record, its ZIP64 form and the central directory itself,
finds where the stored members lie in the file, and reads single records by
offset and length; nothing is extracted.

Of records with equal payloads of at least `least` bytes the one with the largest
page_id is a response and the others are revisits of it.  Equality is judged by
SHA-1 and length.

Defined cases: a NULL html is an empty payload; rows that share the largest
page_id of a payload are all responses; a NULL page_id is never the largest
unless all are NULL, when all are responses; a NULL url is an empty target; line
breaks in a url are percent-encoded; an empty table gives no archives and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.llm.frames import prepare, stored
from layerwright.llm.stores import open_folder

LEAST = 1000
MEMBER_BYTES = 32 << 20
ARCHIVE_BYTES = 256 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:x-page:"


def with_references(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST) -> DataFrame:
    """page_id, url, payload, digest, n_bytes and refers_to (NULL for responses)."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    source = pages.select(F.col(page).cast("bigint").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"), payload.alias("payload"))
    source = source.select("*", F.unhex(F.sha1("payload")).alias("digest"), F.octet_length("payload").cast("bigint").alias("n_bytes"))
    # Only payloads that occur twice need a partner, so the join's small side is short and the counting is combined first.
    groups = source.where(F.col("n_bytes") >= least).groupBy("digest", "n_bytes").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1")
    groups = groups.select(F.col("digest").alias("d"), F.col("n_bytes").alias("b"), "last")
    joined = source.join(groups, (F.col("digest") == F.col("d")) & (F.col("n_bytes") == F.col("b")), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    return joined.select("page_id", "url", "payload", "digest", "n_bytes", refers.alias("refers_to"))


def _record(page_id: int | None, url: str, payload: bytes, digest: bytes, refers_to: int | None) -> bytes:
    url = url.replace("\r", "%0D").replace("\n", "%0A")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _gzip(record: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


class ArchiveWriter:
    """One ZIP archive on an output stream that need not be seekable."""

    def __init__(self, stream, member_bytes: int = MEMBER_BYTES, level: int = 1):
        self.zip = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member_bytes, self.level = member_bytes, level
        self.member, self.name, self.at, self.written, self.members = None, "", 0, 0, 0
        self.index: list[str] = []

    def add(self, page_id, url, payload, digest, refers_to) -> None:
        if self.member is None or self.at >= self.member_bytes:
            if self.member is not None:
                self.member.close()
            self.name = f"archive/data-{self.members:03d}.warc.gz"
            self.members, self.at = self.members + 1, 0
            self.member = self.zip.open(zipfile.ZipInfo(self.name), "w", force_zip64=True)
        packed = _gzip(_record(page_id, url, payload, digest, refers_to), self.level)
        self.member.write(packed)
        self.index.append(json.dumps({"filename": self.name, "offset": self.at, "length": len(packed)}))
        self.at += len(packed)
        self.written += len(packed)

    def close(self) -> None:
        if self.member is not None:
            self.member.close()
        self.zip.writestr("indexes/index.cdxj", "\n".join(self.index))
        self.zip.close()


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, level: int = 1) -> DataFrame:
    """Write with_references() rows into `folder`; one manifest row per archive: file, records."""
    prepare(records.sparkSession)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        part = TaskContext.get().partitionId()
        made: dict[str, list] = {"file": [], "records": []}
        out = stream = None
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for row in zip(*columns):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}.wacz"
                    stream = fs.open_output_stream(f"{root}/{name}")
                    out = ArchiveWriter(stream, level=level)
                out.add(*(v.as_py() for v in row))
                if out.written >= archive_bytes:
                    _finish(out, stream, name, made)
                    out = None
        if out is not None:
            _finish(out, stream, name, made)
        yield pa.RecordBatch.from_pydict(made, pa.schema([("file", pa.string()), ("records", pa.int64())]))

    return stored(records.mapInArrow(write, "file string, records bigint"), "archive-manifest")


def _finish(out: ArchiveWriter, stream, name: str, made: dict[str, list]) -> None:
    out.close()
    stream.close()
    made["file"].append(name)
    made["records"].append(len(out.index))


@dataclass
class Member:
    name: str
    method: int
    size: int
    header: int  # where its local header starts


class ZipDirectory:
    """Members of a ZIP file by range reads: end record, ZIP64 end record, central directory."""

    def __init__(self, read, size: int):
        """read(offset, length) gives bytes of the file."""
        self.read = read
        tail_at = max(0, size - 65_557)
        tail = read(tail_at, size - tail_at)
        end = tail.rfind(b"PK\x05\x06")
        if end < 0:
            raise ValueError("no end of central directory: not a ZIP file")
        entries, length, start = struct.unpack("<HII", tail[end + 10 : end + 20])
        locator_at = tail_at + end - 20
        locator = read(locator_at, 20) if locator_at >= 0 else b""
        if locator[:4] == b"PK\x06\x07" and (entries == 0xFFFF or 0xFFFFFFFF in (length, start)):
            record = read(struct.unpack("<Q", locator[8:16])[0], 56)
            if record[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end record where its locator points")
            entries, length, start = struct.unpack("<QQQ", record[32:56])
        self.members = {m.name: m for m in self._central(read(start, length), entries)}

    @staticmethod
    def _central(raw: bytes, entries: int) -> Iterator[Member]:
        at = 0
        for _ in range(entries):
            if raw[at : at + 4] != b"PK\x01\x02":
                raise ValueError("a central directory entry is damaged")
            flags, method = struct.unpack("<HH", raw[at + 8 : at + 12])
            packed, plain, n_name, n_extra, n_comment = struct.unpack("<IIHHH", raw[at + 20 : at + 34])
            header = struct.unpack("<I", raw[at + 42 : at + 46])[0]
            name = raw[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = raw[at + 46 + n_name : at + 46 + n_name + n_extra]
            while len(extra) >= 4:
                kind, size = struct.unpack("<HH", extra[:4])
                if kind == 1:  # ZIP64: only the fields whose short form is full, in this order
                    wide = iter(struct.unpack(f"<{size // 8}Q", extra[4 : 4 + size // 8 * 8]))
                    plain = next(wide) if plain == 0xFFFFFFFF else plain
                    packed = next(wide) if packed == 0xFFFFFFFF else packed
                    header = next(wide) if header == 0xFFFFFFFF else header
                extra = extra[4 + size :]
            yield Member(name, method, packed, header)
            at += 46 + n_name + n_extra + n_comment

    def data_at(self, name: str) -> int:
        """Offset of a stored member's bytes in the file."""
        member = self.members[name]
        if member.method != 0:
            raise ValueError(f"{name} is compressed: it can't be read by ranges")
        local = self.read(member.header, 30)
        if local[:4] != b"PK\x03\x04":
            raise ValueError(f"{name} has no local header")
        return member.header + 30 + sum(struct.unpack("<HH", local[26:30]))


class Archive:
    """Records of one archive, by their index."""

    def __init__(self, file):
        self.file = file

        def read(offset: int, length: int) -> bytes:
            file.seek(offset)
            return file.read(length)

        self.directory = ZipDirectory(read, file.size())
        self.read = read

    def index(self) -> Iterator[tuple[str, int, int]]:
        for name in sorted(n for n in self.directory.members if n.startswith("indexes/")):
            at, size = self.directory.data_at(name), self.directory.members[name].size
            for line in self.read(at, size).splitlines():
                entry = json.loads(line)
                yield entry["filename"], entry["offset"], entry["length"]

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """WARC headers and block of every record, each read by its own range."""
        start: dict[str, int] = {}
        for name, offset, length in self.index():
            if name not in start:
                start[name] = self.directory.data_at(name)
            yield parse_record(zlib.decompress(self.read(start[name] + offset, length), 31))


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, v in (line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])}
    return headers, rest[: int(headers["content-length"])]


def _page(uri: str | None) -> int | None:
    number = (uri or "").strip("<>").removeprefix(_ID)
    return int(number) if number else None


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per record, from the archives: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    A response's digest and length are those of the payload read; a revisit has none and states both.
    """
    prepare(spark)
    files = manifest.select("file").repartition(max(1, manifest.count()), "file")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with fs.open_input_file(f"{root}/{name}") as file:
                    rows = []
                    for headers, block in Archive(file).records():
                        rows.append(_summary(headers, block))
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_pylist(rows, _SUMMARY)
                            rows = []
                    yield pa.RecordBatch.from_pylist(rows, _SUMMARY)

    return files.mapInArrow(read, "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


_SUMMARY = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
])


def _summary(headers: dict[str, str], block: bytes) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
    size = int(next(line for line in http.split(b"\r\n") if line.startswith(b"Content-Length: "))[16:])
    if headers["warc-type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
    return {
        "page_id": _page(headers["warc-record-id"]), "url": headers["warc-target-uri"], "payload_bytes": size,
        "payload_digest": digest, "record_type": headers["warc-type"], "refers_to": _page(headers.get("warc-refers-to")),
    }
