"""Web pages as WARC records in ZIP-packaged archives, and a reader that fetches records by range.

An archive is a ZIP file with two stored (uncompressed) members: `archive/data.warc.gz`, one gzip stream per
record, and `indexes/index.cdx`, one line per record with its place. Of records with equal payloads the one
with the least page id is a response and the others are revisits that refer to it.

The reader parses the central directory, in its ZIP64 form where needed, locates the stored members, reads
the index and then only ranges of the data member; nothing is extracted. Ranges are dealt to tasks, so one
large archive is read by many. Files are reached through `pyarrow.fs`, which knows local, HDFS, S3 and GCS
paths. A task writes to a name of its own and renames at the end, so a repeated task changes nothing.

Null html is an empty payload, and empty payloads are equal. A null url is an empty one. A null page id is
greater than all others. Repeated rows are records of their own: all but one revisit. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as files
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakestream.llm.corpus import batches, only, ready, settled

DATA_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdx"
#: An archive that has grown to this is closed and the next one begun.
ARCHIVE_BYTES = 256 << 20
#: Bytes of a data member that a task reads at once (a single longer record is read by itself).
RANGE_BYTES = 2 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

END_RECORD, END_LOCATOR, END_RECORD_64 = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06"
CENTRAL_ENTRY, LOCAL_ENTRY = b"PK\x01\x02", b"PK\x03\x04"


# ---- records ----


def warc_record(kind: str, page, url: str, digest: str, size: int, payload: bytes, first=None) -> bytes:
    """A gzip stream of one record; its HTTP headers hold the size of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    block = http.encode() + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Target-URI: {uri}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}"]
        lines += [f"WARC-Refers-To: <urn:page:{'' if first is None else first}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    head = "\r\n".join(lines).encode() + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def parsed_record(packed: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers (names in lower case) and payload of one record."""

    def headers(head: bytes) -> dict[str, str]:
        pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:])
        return {name.strip().lower(): value.strip() for name, _, value in pairs}

    head, _, rest = zlib.decompress(packed, 31).partition(b"\r\n\r\n")
    warc = headers(head)
    http, _, payload = rest[: int(warc["content-length"])].partition(b"\r\n\r\n")
    return warc, headers(http), payload


def page_of(record_id: str) -> str | None:
    return record_id.removeprefix("<urn:page:").removesuffix(">") or None


# ---- ZIP ----


@dataclass
class Member:
    name: str
    method: int
    size: int
    header_at: int


class ZipReader:
    """The directory of a ZIP file and ranges of its stored members, by reads of the parts needed."""

    def __init__(self, path: str):
        system, name = files.FileSystem.from_uri(path)
        self.file = system.open_input_file(name)
        self.members = {m.name: m for m in self._directory()}

    def close(self) -> None:
        self.file.close()

    def read(self, at: int, size: int) -> bytes:
        data = self.file.read_at(size, at)
        if len(data) != size:
            raise ValueError(f"the archive ends before byte {at + size}")
        return data

    def _end(self) -> tuple[int, int]:
        """Where the central directory starts, and its size."""
        total = self.file.size()
        tail_at = max(0, total - 22 - 65535)  # a comment of at most 65535 bytes may follow the end record
        tail = self.read(tail_at, total - tail_at)
        at = tail.rfind(END_RECORD)
        while at >= 0 and at + 22 + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
            at = tail.rfind(END_RECORD, 0, at)
        if at < 0:
            raise ValueError("not a ZIP file: no end record")
        entries, size, start = struct.unpack_from("<10xHII", tail, at)[0:3]
        if entries != 0xFFFF and size != 0xFFFFFFFF and start != 0xFFFFFFFF:
            return start, size
        locator_at = tail_at + at - 20
        if locator_at < 0:
            return start, size
        locator = self.read(locator_at, 20)
        if locator[:4] != END_LOCATOR:
            return start, size
        record = self.read(struct.unpack_from("<8xQ", locator)[0], 56)
        if record[:4] != END_RECORD_64:
            raise ValueError("the ZIP64 end record is not where its locator says")
        size, start = struct.unpack_from("<40xQQ", record)
        return start, size

    def _directory(self) -> Iterator[Member]:
        start, size = self._end()
        data, at = self.read(start, size), 0
        while at < size:
            if data[at : at + 4] != CENTRAL_ENTRY:
                raise ValueError("damaged central directory")
            flags, method = struct.unpack_from("<8xHH", data, at)
            packed, full, name_size, extra_size, comment_size = struct.unpack_from("<20xIIHHH", data, at)
            header_at = struct.unpack_from("<42xI", data, at)[0]
            name = data[at + 46 : at + 46 + name_size].decode("utf-8" if flags & 0x800 else "cp437")
            extra, extra_end = at + 46 + name_size, at + 46 + name_size + extra_size
            while extra + 4 <= extra_end:
                tag, length = struct.unpack_from("<HH", data, extra)
                if tag == 1:  # ZIP64: 8-byte values for those fields that are all ones, in this order
                    value = extra + 4
                    if full == 0xFFFFFFFF:
                        full, value = struct.unpack_from("<Q", data, value)[0], value + 8
                    if packed == 0xFFFFFFFF:
                        packed, value = struct.unpack_from("<Q", data, value)[0], value + 8
                    if header_at == 0xFFFFFFFF:
                        header_at = struct.unpack_from("<Q", data, value)[0]
                extra += 4 + length
            yield Member(name, method, full, header_at)
            at = extra_end + comment_size

    def data_at(self, name: str) -> tuple[int, int]:
        """Where a stored member's bytes start in the file, and how many there are."""
        member = self.members[name]
        if member.method != zipfile.ZIP_STORED:
            raise ValueError(f"{name} is compressed; only stored members can be read by range")
        head = self.read(member.header_at, 30)
        if head[:4] != LOCAL_ENTRY:
            raise ValueError(f"{name} is not where the directory says")
        name_size, extra_size = struct.unpack_from("<26xHH", head)
        return member.header_at + 30 + name_size + extra_size, member.size


class ArchiveWriter:
    """One archive, written front to back."""

    def __init__(self, folder: str, name: str):
        self.system, base = files.FileSystem.from_uri(folder)
        self.system.create_dir(base, recursive=True)
        # every attempt of a task has names of its own: not every file system replaces a file by renaming
        name = f"{name}-{uuid.uuid4().hex}"
        self.final, self.path = f"{base}/{name}.zip", f"{folder}/{name}.zip"
        self.own = f"{base}/.{name}"
        self.stream = self.system.open_output_stream(self.own)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(zipfile.ZipInfo(DATA_MEMBER), "w", force_zip64=True)
        self.size, self.index = 0, []

    def add(self, record: bytes) -> None:
        self.data.write(record)
        self.index.append(f"{self.size} {len(record)}")
        self.size += len(record)

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX_MEMBER), "".join(f"{line}\n" for line in self.index))
        self.zip.close()
        self.stream.close()
        self.system.move(self.own, self.final)
        return self.path, len(self.index), self.size


# ---- Spark ----


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per record to be written: `page`, `url`, `digest`, `size`, `first` (of a revisit) and, of a
    response, `record`, its gzip stream.

    Digests alone decide what a row becomes. Response records are compressed before they are shuffled, and of
    equal payloads only one per task is.
    """
    ready(pages.sparkSession)
    key = pages.schema[id_col].dataType.simpleString()
    source = only(pages, id_col, url_col, html_col).toDF("page", "url", "html")
    source = source.withColumn("html", F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary"))

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(table):
            page, url, html = (c.to_pylist() for c in batch.columns)
            digest = [digest_of(h) for h in html]
            packed = [
                warc_record("response", p, u, d, len(h), h) for p, u, d, h in zip(page, url, digest, html)
            ]
            sizes = [len(h) for h in html]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digest), pa.array(sizes, pa.int64()), pa.array(packed)],
                ["page", "url", "digest", "size", "record"],
            )

    written = source.mapInArrow(run, f"page {key}, url string, digest string, size long, record binary")
    order = F.struct(F.isnull("page").alias("no_page"), "page", "url", "size", "record")
    responses = written.groupBy("digest").agg(F.min(order).alias("r"))
    responses = responses.select(
        "r.page", "r.url", "digest", "r.size", F.lit(None).cast(key).alias("first"), "r.record"
    )
    light = source.select("page", "url", F.sha1("html").alias("sha1"), F.octet_length("html").alias("size"))
    firsts = light.groupBy("sha1").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n"))
    # settled, as AQE splits the join for a payload with very many pages only between two plain shuffles
    firsts = settled(firsts.filter("n > 1"))
    copies = Window.partitionBy("sha1", "page").orderBy("url")
    marked = light.withColumn("copy", F.row_number().over(copies)).join(firsts, "sha1")
    revisits = marked.filter(~((F.col("page").eqNullSafe(F.col("first"))) & (F.col("copy") == 1)))
    return responses.unionByName(
        revisits.select(
            "page",
            "url",
            F.col("sha1").alias("digest"),
            F.col("size").cast("long"),
            "first",
            F.lit(None).cast("binary").alias("record"),
        )
    )


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """`rows` of `records` written into ZIP archives in `folder`: a row per archive with `path`, `n`, `bytes`."""

    def run(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, archive, done = TaskContext.get().partitionId(), 0, None, []
        for batch in table:
            for page, url, digest, size, first, record in zip(*(c.to_pylist() for c in batch.columns)):
                if archive is None:
                    archive = ArchiveWriter(folder, f"pages-{part:06d}-{number:04d}")
                    number += 1
                if record is None:
                    digest = base64.b32encode(bytes.fromhex(digest)).decode()
                    record = warc_record("revisit", page, url, digest, size, b"", first)
                archive.add(record)
                if archive.size >= archive_bytes:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string())]
            + [pa.array([d[i] for d in done], pa.int64()) for i in (1, 2)],
            ["path", "n", "bytes"],
        )

    return settled(rows.mapInArrow(run, "path string, n long, bytes long"))


def read_archives(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per record of the archives named by `path`: `page`, `url`, `record_type`, `refers_to`,
    `payload_bytes`, `payload_digest` and, of responses, the `payload`."""
    ready(archives.sparkSession)

    def locate(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in table:
            for path in batch.column(0).to_pylist():
                reader = ZipReader(path)
                try:
                    start, _ = reader.data_at(DATA_MEMBER)
                    lines = reader.read(*reader.data_at(INDEX_MEMBER)).decode().splitlines()
                finally:
                    reader.close()
                ranges, lengths, held = [], [], 0
                for line in lines:
                    offset, length = map(int, line.split())
                    if not lengths or held + length > range_bytes:
                        lengths, held = [], 0
                        ranges.append((start + offset, lengths))
                    lengths.append(length)
                    held += length
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(ranges), pa.string()),
                        pa.array([r[0] for r in ranges], pa.int64()),
                        pa.array([r[1] for r in ranges], pa.list_(pa.int64())),
                    ],
                    ["path", "at", "lengths"],
                )

    def fetch(table: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
        kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
        for batch in table:
            for path, at, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                reader = ZipReader(path)
                try:
                    data = reader.read(at, sum(lengths))
                finally:
                    reader.close()
                out, begin = [], 0
                for length in lengths:
                    warc, http, payload = parsed_record(data[begin : begin + length])
                    begin += length
                    stated = warc["warc-payload-digest"].removeprefix("sha1:")
                    response = warc["warc-type"] == "response"
                    if response and digest_of(payload) != stated:
                        raise ValueError(f"damaged record {warc['warc-record-id']} in {path}")
                    refers = page_of(warc.get("warc-refers-to", ""))
                    size = len(payload) if response else int(http["content-length"])
                    out.append(
                        (
                            page_of(warc["warc-record-id"]),
                            warc["warc-target-uri"],
                            warc["warc-type"],
                            refers,
                            size,
                            stated,
                            payload if response else None,
                        )
                    )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*out), kinds)], names
                )

    tasks = 4 * archives.sparkSession.sparkContext.defaultParallelism
    located = archives.select("path").repartition(tasks).mapInArrow(
        locate, "path string, at long, lengths array<long>"
    )
    return located.repartition(tasks).mapInArrow(
        fetch,
        "page string, url string, record_type string, refers_to string, payload_bytes long, "
        "payload_digest string, payload binary",
    )
