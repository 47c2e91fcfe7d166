"""WARC records in ZIP packages: written as stored members with an index, read by ranges.

A package holds ``archive/data.warc.gz`` (each record its own gzip member) and
``indexes/index.cdxj`` (a line per record: id, offset, length), both stored and
not deflated. The reader goes from the package's end to its central directory,
ZIP64 where a size or offset needs it, from there to the index, and fetches
records by range; no member is ever extracted whole.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.sources.scratch import scratch_path, stored

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
LEAST_SHARED = 100
# Fixed values of the ZIP format: signatures, and what stands for "see the ZIP64 field".
LOCAL, CENTRAL, END, END64, LOCATOR64 = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
MAX16, MAX32 = 0xFFFF, 0xFFFFFFFF
# Compressed bytes of records fetched at once, and what a package may reach before the next is begun.
FETCH = 4 << 20
PACKAGE_BYTES = 1 << 30
# Compressed bytes a task reads back; a range's row is small, so its size says nothing of the work.
TASK_BYTES = 32 << 20


def open_store(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a URI or plain path, as the executors reach it."""
    return arrow_fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


# --- ZIP -----------------------------------------------------------------------------------------


class Member(NamedTuple):
    name: str
    method: int
    crc: int
    size: int
    stored: int
    header: int


def _zip64(*values: int) -> bytes:
    return struct.pack(f"<HH{len(values)}Q", 1, 8 * len(values), *values)


class PackageWriter:
    """Writes stored members to a stream that cannot seek; sizes follow the data in a descriptor."""

    def __init__(self, write: Callable[[bytes], object], force64: bool = False):
        self._write, self.at, self.members, self.force64 = write, 0, [], force64

    def _put(self, data: bytes) -> None:
        self._write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.header, self.crc = name.encode(), self.at, 0
        # bit 3: descriptor follows; the ZIP64 field announces that it has 8-byte sizes
        head = struct.pack("<IHHHHHIIIHH", LOCAL, 45, 0x0808, 0, 0, 0x21, 0, MAX32, MAX32, len(self.name), 20)
        self._put(head + self.name + _zip64(0, 0))
        self.start = self.at

    def data(self, data: bytes) -> int:
        """Append to the member; where in it the data lies."""
        at = self.at - self.start
        self.crc = zlib.crc32(data, self.crc)
        self._put(data)
        return at

    def end(self) -> None:
        size = self.at - self.start
        self._put(struct.pack("<4sIQQ", b"PK\x07\x08", self.crc, size, size))
        self.members.append((self.name, self.crc, size, self.header))

    def close(self) -> None:
        start = self.at
        for name, crc, size, header in self.members:
            wide = self.force64 or size >= MAX32 or header >= MAX32
            extra = _zip64(size, size, header) if wide else b""
            size32, header32 = (MAX32, MAX32) if wide else (size, header)
            self._put(struct.pack(
                "<IHHHHHHIIIHHHHHII", CENTRAL, 45, 45, 0x0808, 0, 0, 0x21, crc, size32, size32,
                len(name), len(extra), 0, 0, 0, 0, header32,
            ) + name + extra)
        size, n = self.at - start, len(self.members)
        wide = self.force64 or start >= MAX32 or size >= MAX32 or n >= MAX16
        if wide:
            end64 = self.at
            self._put(struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, size, start))
            self._put(struct.pack("<IIQI", LOCATOR64, 0, end64, 1))
        n16, size32, start32 = (MAX16, MAX32, MAX32) if wide else (n, size, start)
        self._put(struct.pack("<IHHHHIIH", END, 0, 0, n16, n16, size32, start32, 0))


def read_directory(read: Callable[[int, int], bytes], length: int) -> dict[str, Member]:
    """Members by name from the central directory; ``read(at, size)`` fetches a range."""
    tail_at = max(0, length - 22 - MAX16)
    tail = read(tail_at, length - tail_at)
    found = tail.rfind(struct.pack("<I", END))
    # a comment may hold the signature: the true one's comment reaches the end
    while found >= 0 and (found + 22 > len(tail) or found + 22 + struct.unpack_from("<H", tail, found + 20)[0] != len(tail)):
        found = tail.rfind(struct.pack("<I", END), 0, found)
    if found < 0:
        raise ValueError("no end of central directory")
    _, _, _, _, n, size, start, _ = struct.unpack_from("<IHHHHIIH", tail, found)
    at = tail_at + found
    if at >= 20:
        signature, _, end64, _ = struct.unpack("<IIQI", read(at - 20, 20))
        if signature == LOCATOR64:
            signature, _, _, _, _, _, _, n, size, start = struct.unpack("<IQHHIIQQQQ", read(end64, 56))
            if signature != END64:
                raise ValueError("broken ZIP64 end of central directory")
    directory, members, i = read(start, size), {}, 0
    for _ in range(n):
        fields = struct.unpack_from("<IHHHHHHIIIHHHHHII", directory, i)
        if fields[0] != CENTRAL:
            raise ValueError("broken central directory")
        method, crc, packed, plain, name_size, extra_size, comment_size, header = (
            fields[4], fields[7], fields[8], fields[9], fields[10], fields[11], fields[12], fields[16],
        )
        name = directory[i + 46 : i + 46 + name_size].decode()
        extra, j = directory[i + 46 + name_size : i + 46 + name_size + extra_size], 0
        while j + 4 <= len(extra):
            kind, width = struct.unpack_from("<HH", extra, j)
            if kind == 1:
                # only the values that did not fit are there, in this order
                wide = iter(struct.unpack_from(f"<{width // 8}Q", extra, j + 4))
                plain = next(wide) if plain == MAX32 else plain
                packed = next(wide) if packed == MAX32 else packed
                header = next(wide) if header == MAX32 else header
            j += 4 + width
        members[name] = Member(name, method, crc, plain, packed, header)
        i += 46 + name_size + extra_size + comment_size
    return members


def data_start(read: Callable[[int, int], bytes], member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method != 0:
        raise ValueError(f"{member.name} is not stored")
    head = struct.unpack("<IHHHHHIIIHH", read(member.header, 30))
    if head[0] != LOCAL:
        raise ValueError(f"no local header for {member.name}")
    return member.header + 30 + head[9] + head[10]


# --- WARC ----------------------------------------------------------------------------------------


def _uri(url: str | None) -> str:
    """A URL as one header line: everything but printable ASCII is percent-encoded."""
    raw = (url or "").encode()
    return "".join(chr(b) if 0x20 < b < 0x7F else f"%{b:02X}" for b in raw)


def _record_id(page_id: object) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def build_record(page_id: object, url: str | None, payload: bytes, digest: str, refers_to: object, revisit: bool) -> bytes:
    """A response with the payload, or a revisit without it; both state digest and length of the whole payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {_uri(url)}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {_record_id(refers_to)}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(text: bytes) -> dict[str, str]:
    lines = text.decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def parse_record(data: bytes) -> dict:
    """A record's fields; a response's payload must have the digest its header states."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = warc["warc-payload-digest"].removeprefix("sha256:")
    kind = warc["warc-type"]
    length = int(_headers(http)["content-length"])
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {warc['warc-record-id']} differs from its digest")

    def page(name: str) -> str | None:
        return warc.get(name, "").removeprefix("<urn:x-page:").removesuffix(">") or None

    return {
        "page_id": page("warc-record-id"), "payload_bytes": length, "payload_digest": digest, "record_type": kind,
        "refers_to": page("warc-refers-to"), "payload": payload if kind == "response" else None,
    }


# --- Spark ---------------------------------------------------------------------------------------


def mark_revisits(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int = LEAST_SHARED) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: the last is set for rows that revisit another's payload.

    Digests are counted with a partial step first; only digests that repeat are
    joined back, so one payload may be on any share of the rows. Short payloads
    have no partner and are spread by id and url instead.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    long = rows.where(F.octet_length("payload") >= least)
    repeated = long.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    repeated = repeated.where((F.col("n") > 1) & F.col("first").isNotNull()).select(F.col("digest").alias("d"), "first")
    # stored, so that the join has two fresh exchanges and the rows of one payload can be split
    repeated, _ = stored(repeated, "repeated")
    spread = F.xxhash64("page_id", "url").cast("string")
    key = F.when(F.octet_length("payload") >= least, F.col("digest")).otherwise(spread)
    joined = rows.withColumn("key", key).join(repeated, F.col("key") == F.col("d"), "left")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("first")), F.lit(None)).otherwise(F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write_packages(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least: int = LEAST_SHARED,
    package_bytes: int = PACKAGE_BYTES,
    force64: bool = False,
) -> DataFrame:
    """Write a record per row and return ``package, records, bytes``, the list of complete packages.

    Of rows with equal payloads of at least ``least`` bytes those with the
    smallest id are responses, the others revisit it; all shorter ones are
    responses. A null payload counts as empty. A row without id is a record
    without id, which revisits where a row with an id has its payload.

    Each attempt of a task writes packages under names of its own, and only what
    a finished task returns is listed: packages of lost attempts are never read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        rows = (row for batch in batches for part in _pieces(batch) for row in part.to_pylist())
        row = next(rows, None)
        while row is not None:
            name, lines = f"{uuid.uuid4().hex}.zip", []
            with store.open_output_stream(f"{base}/{name}") as out:
                package = PackageWriter(out.write, force64)
                package.begin(DATA)
                while row is not None and (not lines or package.at < package_bytes):
                    refers = row["refers_to"]
                    record = build_record(
                        row["page_id"], row["url"], row["payload"], row["digest"], refers, refers is not None
                    )
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    packed = packer.compress(record) + packer.flush()
                    line = {"id": row["page_id"], "offset": package.data(packed), "length": len(packed)}
                    lines.append(json.dumps(line))
                    row = next(rows, None)
                package.end()
                package.begin(INDEX)
                for start in range(0, len(lines), 10_000):
                    package.data("".join(f"{x}\n" for x in lines[start : start + 10_000]).encode())
                package.end()
                package.close()
            yield pa.RecordBatch.from_pydict({
                "package": [name], "records": pa.array([len(lines)], pa.int64()),
                "bytes": pa.array([package.at], pa.int64()),
            })

    marked = mark_revisits(pages, id_col, url_col, payload_col, least)
    return stored(marked.mapInArrow(run, "package string, records long, bytes long"), "packages")[0]


def _pieces(batch: pa.RecordBatch, rows: int = 64) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(batch), rows):
        yield batch.slice(start, rows)


RECORD = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"


def read_packages(packages: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """A row per record of the listed packages, read by ranges.

    One task reads a package's directory and index; the ranges it finds are
    dealt out evenly, so a large package is read by many tasks. Ids come back as
    the text they were written as, null where there was none. With
    ``with_payload`` the bytes of responses are returned too, null for revisits.
    """

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        for name in (n for batch in batches for n in batch.column(0).to_pylist()):
            with store.open_input_file(f"{base}/{name}") as file:
                read = lambda at, size: file.read_at(size, at)
                members = read_directory(read, file.size())
                start = data_start(read, members[DATA])
                at, left, rest = data_start(read, members[INDEX]), members[INDEX].size, b""
                spans: list[tuple[int, list[int]]] = []
                end = 0
                while left:
                    size = min(left, FETCH)
                    *lines, rest = (rest + read(at, size)).split(b"\n")
                    at, left = at + size, left - size
                    for line in map(json.loads, lines):
                        offset, length = start + line["offset"], line["length"]
                        if spans and end == offset and offset + length - spans[-1][0] <= FETCH:
                            spans[-1][1].append(length)
                        else:
                            spans.append((offset, [length]))
                        end = offset + length
                    if len(spans) > 1:
                        yield _ranges(name, spans[:-1])
                        spans = spans[-1:]
                if spans:
                    yield _ranges(name, spans)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        names = [part.split()[0] for part in schema.split(", ")]
        types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        kinds = [types[part.split()[1]] for part in schema.split(", ")]
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{base}/{row['package']}") as file:
                    data = memoryview(file.read_at(sum(row["lengths"]), row["offset"]))
                found, at = [], 0
                for length in row["lengths"]:
                    found.append(parse_record(zlib.decompress(data[at : at + length], 31)))
                    at += length
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[n] for r in found], k) for n, k in zip(names, kinds)], names
                )

    schema = RECORD + (", payload binary" if with_payload else "")
    ranges = packages.select("package").mapInArrow(locate, "package string, offset long, lengths array<long>")
    total = packages.agg(F.sum("bytes")).first()[0] or 0
    return ranges.repartition(1 + total // TASK_BYTES, "package", "offset").mapInArrow(fetch, schema)


def _ranges(name: str, spans: list[tuple[int, list[int]]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "package": [name] * len(spans), "offset": pa.array([o for o, _ in spans], pa.int64()),
        "lengths": pa.array([s for _, s in spans], pa.list_(pa.int64())),
    })


def new_folder(pages: DataFrame) -> str:
    """A fresh shared folder for packages."""
    return scratch_path(pages.sparkSession, "warc")
