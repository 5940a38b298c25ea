"""WARC records in ZIP-packaged archives: written by tasks, read back by byte ranges.

Writing.  Every task streams its rows into archives of its own: a ZIP with two
stored members, the WARC file (one gzip member per record) and a CDXJ index of
the records' offsets.  Sizes follow the data (data descriptors), directories
are written in their ZIP64 form.  A payload of at least ``min_bytes`` that
several pages share is stored once, with the largest page id; the others are
revisit records that point at it.  An archive counts only when its row reaches
the manifest, a table that Spark commits; what a lost or repeated task attempt
left behind is never read.

Reading.  The end of each archive gives the (ZIP64) end record, that gives the
central directory, and that locates the stored members.  The index member is
read, neighbouring records are joined into ranges of a few MB, the ranges are
dealt out to tasks, and each is read with one seek.  Nothing is extracted and
no archive is read whole.

Files are opened through ``pyarrow.fs``, so the folder may be a local or
shared path or any URI it knows (file, hdfs, s3, gs).

Defined results: a null html is an empty payload; a null page id is written
without one and read as null; rows that repeat the largest page id of a shared
payload are responses each; empty tables give no archives and no records.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, in_arrow, written

MIN_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
RANGE_BYTES = 8 << 20
WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"

# fixed values of the ZIP format
LOCAL, DESCRIPTOR, CENTRAL, END, END64, LOCATOR64 = (b"PK\x03\x04", b"PK\x07\x08", b"PK\x01\x02", b"PK\x05\x06",
                                                     b"PK\x06\x06", b"PK\x06\x07")
FULL16, FULL32, ZIP64_EXTRA, ZIP64_VERSION, FLAGS = 0xFFFF, 0xFFFFFFFF, 1, 45, 0x0808  # sizes follow, UTF-8 names
EPOCH_DATE = 0x21  # 1980-01-01, the format's first day


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class StoredZip:
    """Streams stored members into a ZIP file with ZIP64 directories."""

    def __init__(self, sink):
        self.sink, self.at, self.members = sink, 0, []

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode("utf-8")
        self.members.append([raw, self.at, 0, 0])
        extra = struct.pack("<HHQQ", ZIP64_EXTRA, 16, 0, 0)
        self._put(LOCAL + struct.pack("<HHHHHIIIHH", ZIP64_VERSION, FLAGS, 0, 0, EPOCH_DATE, 0, FULL32, FULL32,
                                      len(raw), len(extra)) + raw + extra)

    def write(self, data: bytes) -> None:
        member = self.members[-1]
        member[2], member[3] = zlib.crc32(data, member[2]), member[3] + len(data)
        self._put(data)

    def end(self) -> None:
        _, _, crc, size = self.members[-1]
        self._put(DESCRIPTOR + struct.pack("<IQQ", crc, size, size))

    def close(self) -> None:
        first = self.at
        for raw, at, crc, size in self.members:
            extra = struct.pack("<HHQQQ", ZIP64_EXTRA, 24, size, size, at)
            self._put(CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", ZIP64_VERSION, ZIP64_VERSION, FLAGS, 0, 0,
                                            EPOCH_DATE, crc, FULL32, FULL32, len(raw), len(extra), 0, 0, 0, 0, FULL32)
                      + raw + extra)
        size, n, end64 = self.at - first, len(self.members), self.at
        self._put(END64 + struct.pack("<QHHIIQQQQ", 44, ZIP64_VERSION, ZIP64_VERSION, 0, 0, n, n, size, first))
        self._put(LOCATOR64 + struct.pack("<IQI", 0, end64, 1))
        self._put(END + struct.pack("<HHHHIIH", 0, 0, FULL16, FULL16, FULL32, FULL32, 0))
        self.sink.close()


@dataclass
class Member:
    name: str
    method: int
    offset: int  # of the member's bytes in the archive
    size: int


def directory(source, size: int) -> list[Member]:
    """The members of a ZIP file, from its central directory; ``source`` has read_at(n, offset)."""
    tail_at = max(0, size - 22 - FULL16)
    tail = source.read_at(size - tail_at, tail_at)
    found = tail.rfind(END)
    while found >= 0 and tail[found + 20:found + 22] != struct.pack("<H", max(0, len(tail) - found - 22)):
        found = tail.rfind(END, 0, found)  # the signature inside a comment
    if found < 0:
        raise ValueError("no end of central directory")
    n, length, first = struct.unpack_from("<HII", tail, found + 10)
    if FULL16 == n or FULL32 in (length, first):
        at = tail_at + found - 20
        locator = source.read_at(20, at)
        if locator[:4] != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        end64 = source.read_at(56, struct.unpack_from("<Q", locator, 8)[0])
        if end64[:4] != END64:
            raise ValueError("no ZIP64 end of central directory")
        n, length, first = struct.unpack_from("<QQQ", end64, 32)
    data, at, out = source.read_at(length, first), 0, []
    for _ in range(n):
        if data[at:at + 4] != CENTRAL:
            raise ValueError("broken central directory")
        method, = struct.unpack_from("<H", data, at + 10)
        packed, full, names, extras, comments = struct.unpack_from("<IIHHH", data, at + 20)
        header, = struct.unpack_from("<I", data, at + 42)
        name = data[at + 46:at + 46 + names].decode("utf-8")
        extra, stop = at + 46 + names, at + 46 + names + extras
        while extra + 4 <= stop:
            kind, long = struct.unpack_from("<HH", data, extra)
            if kind == ZIP64_EXTRA:  # holds, in this order, only what did not fit above
                values = iter(struct.unpack_from(f"<{long // 8}Q", data, extra + 4))
                full = next(values) if full == FULL32 else full
                packed = next(values) if packed == FULL32 else packed
                header = next(values) if header == FULL32 else header
            extra += 4 + long
        local = source.read_at(30, header)
        if local[:4] != LOCAL:
            raise ValueError(f"no local header for {name}")
        out.append(Member(name, method, header + 30 + sum(struct.unpack_from("<HH", local, 26)), packed))
        at = stop + comments
    return out


def _line(text: str) -> str:
    return "".join(c for c in text if c not in "\r\n")


def warc_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit holds the HTTP headers only."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>",
            "WARC-Date: 1970-01-01T00:00:00Z",  # the table has no capture times
            f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>",
                 f"Refers-To-Page-ID: {refers_to}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[:int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _gunzip(data: bytes) -> bytes:
    return zlib.decompress(data, 31)


def _write_archive(folder: str, rows: Iterator[tuple], limit: int) -> tuple[str, int]:
    """Write rows until the archive is full; its path and number of records."""
    path = f"{folder}/{uuid.uuid4().hex}.wacz"
    system, at = _open(path)
    system.create_dir(at.rpartition("/")[0], recursive=True)
    zipped, index, offset = StoredZip(system.open_output_stream(at, compression=None)), [], 0
    zipped.begin(WARC_MEMBER)
    for page_id, url, payload, refers_to in rows:
        data = _gzip(warc_record(page_id, url, payload, refers_to))
        zipped.write(data)
        entry = {"url": url, "offset": offset, "length": len(data), "filename": WARC_MEMBER.rpartition("/")[2]}
        index.append(f"{_line(url or '-')} 19700101000000 {json.dumps(entry)}\n")
        offset += len(data)
        if offset >= limit:
            break
    zipped.end()
    zipped.begin(INDEX_MEMBER)
    for line in sorted(index):
        zipped.write(line.encode("utf-8"))
    zipped.end()
    zipped.close()
    return path, len(index)


def write_archives(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url",
                   html: str = "html", min_bytes: int = MIN_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every page; returns the manifest (archive, records)."""
    folder = folder or fresh_path(pages.sparkSession, "archives")
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    keyed = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    shared = (keyed.where(F.col("size") >= min_bytes).groupBy("digest", "size")
              .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1 and keeper is not null")
              .drop("n"))
    roles = (keyed.join(written(shared, "shared-payloads"), ["digest", "size"], "left")
             .select("page_id", "url", "payload",
                     F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper")).alias("refers_to")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
        for first in waiting:
            path, n = _write_archive(folder, _after(first, waiting), archive_bytes)
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], ["archive", "records"])

    return written(in_arrow(roles, run, "archive string, records long"), "manifest")


def _after(first, rest):
    """``rest`` goes on after this generator is closed, so no ``yield from``."""
    yield first
    for row in rest:  # noqa: UP028
        yield row


def record_ranges(manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(archive, start, lengths): neighbouring records, found through directories and indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                ranges = list(_ranges(path, range_bytes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(ranges), pa.string()), pa.array([r[0] for r in ranges], pa.int64()),
                     pa.array([r[1] for r in ranges], pa.list_(pa.int64()))], ["archive", "start", "lengths"])

    return in_arrow(manifest.select("archive"), run, "archive string, start long, lengths array<long>")


def _ranges(path: str, range_bytes: int) -> Iterator[tuple[int, list[int]]]:
    system, at = _open(path)
    with system.open_input_file(at) as source:
        members = {m.name: m for m in directory(source, source.size()) if not m.method}
        for name, index in members.items():
            if not name.endswith(".cdxj"):
                continue
            lines = source.read_at(index.size, index.offset).decode("utf-8").splitlines()
            entries = sorted((e["filename"], e["offset"], e["length"])
                             for e in (json.loads(line[line.index(" {") + 1:]) for line in lines))
            start, lengths, of = 0, [], None
            for file, offset, length in entries:
                place = members[f"archive/{file}"].offset + offset
                if lengths and (file != of or place != start + sum(lengths) or sum(lengths) >= range_bytes):
                    yield start, lengths
                    lengths = []
                if not lengths:
                    start, of = place, file
                lengths.append(length)
            if lengths:
                yield start, lengths


def read_records(ranges: DataFrame) -> DataFrame:
    """(record_type, page_id, refers_to, target_uri, digest, payload) of every record in the ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                system, at = _open(path)
                with system.open_input_file(at) as source:
                    data = source.read_at(sum(lengths), start)
                rows, begin = [], 0
                for length in lengths:
                    headers, payload = parse_record(_gunzip(data[begin:begin + length]))
                    begin += length
                    page, refers = headers.get("page-id"), headers.get("refers-to-page-id")
                    digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
                    rows.append((headers["warc-type"], page and int(page), refers and int(refers),
                                 headers.get("warc-target-uri"), digest, payload))
                columns = list(zip(*rows))
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], NAMES)

    tasks = int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return in_arrow(ranges.repartition(tasks), run, "record_type string, page_id long, refers_to long, target_uri string, "
                                  "digest string, payload binary")


NAMES = ["record_type", "page_id", "refers_to", "target_uri", "digest", "payload"]


def resolved(records: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to, digest_ok.

    A revisit takes size and digest from the response that it points at;
    ``digest_ok`` tells whether the bytes read give the digest in its header.
    """
    own = records.select("page_id", "record_type", "refers_to", "digest",
                         F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("sha1"))
    own = written(own, "records")
    kept = (own.where("record_type = 'response' and page_id is not null")
            .select(F.col("page_id").alias("of"), F.col("bytes").alias("of_bytes"), F.col("sha1").alias("of_sha1"))
            .distinct())
    response = own.where("record_type = 'response'").select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"), "record_type",
        "refers_to", (F.col("sha1") == F.col("digest")).alias("digest_ok"))
    revisit = (own.where("record_type = 'revisit'")
               .join(kept, (F.col("refers_to") == F.col("of")) & (F.col("digest") == F.col("of_sha1")), "left")
               .select("page_id", F.col("of_bytes").alias("payload_bytes"), F.col("of_sha1").alias("payload_digest"),
                       "record_type", "refers_to", F.col("of").isNotNull().alias("digest_ok")))
    return response.unionByName(revisit)
