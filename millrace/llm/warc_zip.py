"""WARC records in ZIP-packaged web archives: written by tasks, read back by ranges."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from millrace.llm.tables import arrow, new_folder, saved

# Signatures of the ZIP format.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
MAX16, MAX32 = 0xFFFF, 0xFFFFFFFF

RECORDS, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdxj", "datapackage.json"
# Bytes of records from which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
ID = "urn:page:"


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path (a URI, or a local path) and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path.replace("file:///", "file:/").replace("file:/", "file:///"))


# --- ZIP ---------------------------------------------------------------------------------------------


class ZipWriter:
    """Stored members written to a stream in one go; sizes follow each member, and ZIP64 is used throughout."""

    def __init__(self, out):
        self.out, self.at, self.members = out, 0, []

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.start, self.crc, self.size = name.encode(), self.at, 0, 0
        # Flags: sizes in a descriptor behind the data, names in UTF-8.
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self.write(struct.pack("<4s5H3I2H", LOCAL, 45, 0x0808, 0, 0, 0x21, 0, MAX32, MAX32, len(self.name), len(extra)))
        self.write(self.name + extra)

    def add(self, data: bytes) -> None:
        self.crc = zlib.crc32(data, self.crc)
        self.size += len(data)
        self.write(data)

    def end(self) -> None:
        self.write(struct.pack("<4sIQQ", b"PK\x07\x08", self.crc, self.size, self.size))
        self.members.append((self.name, self.crc, self.size, self.start))

    def close(self) -> None:
        start = self.at
        for name, crc, size, offset in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, offset)
            self.write(
                struct.pack("<4s6H3I5H2I", CENTRAL, 45, 45, 0x0808, 0, 0, 0x21, crc, MAX32, MAX32, len(name), len(extra), 0, 0, 0, 0, MAX32)
            )
            self.write(name + extra)
        size, end, n = self.at - start, self.at, len(self.members)
        self.write(struct.pack("<4sQ2H2I4Q", END64, 44, 45, 45, 0, 0, n, n, size, start))
        self.write(struct.pack("<4sIQI", LOCATOR64, 0, end, 1))
        self.write(struct.pack("<4s4H2IH", END, 0, 0, MAX16, MAX16, MAX32, MAX32, 0))


def directory(file, size: int) -> dict[str, tuple[int, int, int]]:
    """The members of a ZIP by name: (compression method, offset of the data, stored size).

    Reads the end record (with a comment of any length), the ZIP64 records where they are, the central
    directory, and each member's local header; the data stay where they are.
    """
    tail_size = min(size, 22 + MAX16 + 20)
    tail = file.read_at(tail_size, size - tail_size)
    found = tail.rfind(END)
    while found >= 0 and (len(tail) - found < 22 or struct.unpack_from("<H", tail, found + 20)[0] != len(tail) - found - 22):
        found = tail.rfind(END, 0, found)
    if found < 0:
        raise ValueError("no end of central directory")
    _, _, _, _, count, length, start, _ = struct.unpack_from("<4s4H2IH", tail, found)
    at = size - tail_size + found
    if (count == MAX16 or MAX32 in (length, start)) and at >= 20:
        mark, _, end64, _ = struct.unpack("<4sIQI", file.read_at(20, at - 20))
        if mark == LOCATOR64:
            record = file.read_at(56, end64)
            if record[:4] != END64:
                raise ValueError("no ZIP64 end record where its locator points")
            count, length, start = struct.unpack_from("<3Q", record, 32)
    central = file.read_at(length, start)
    members, at = {}, 0
    for _ in range(count):
        (mark, _, _, flags, method, _, _, _, stored, whole, n, m, k, _, _, _, offset) = struct.unpack_from("<4s6H3I5H2I", central, at)
        if mark != CENTRAL:
            raise ValueError("broken central directory")
        name = central[at + 46 : at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        stored, offset = _wide(central[at + 46 + n : at + 46 + n + m], stored, whole, offset)
        at += 46 + n + m + k
        head = file.read_at(30, offset)
        if head[:4] != LOCAL:
            raise ValueError(f"no local header of {name}")
        n, m = struct.unpack_from("<2H", head, 26)
        members[name] = (method, offset + 30 + n + m, stored)
    return members


def _wide(extra: bytes, stored: int, whole: int, offset: int) -> tuple[int, int]:
    """Size and offset, taken from the ZIP64 field where the short ones are full."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            field = at + 4
            if whole == MAX32:
                field += 8
            if stored == MAX32:
                stored = struct.unpack_from("<Q", extra, field)[0]
                field += 8
            if offset == MAX32:
                offset = struct.unpack_from("<Q", extra, field)[0]
        at += 4 + length
    return stored, offset


# --- WARC --------------------------------------------------------------------------------------------


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member. A revisit holds the response's headers alone and names the first one.

    The record of a page without an id has a random one of its own.
    """
    name = uuid.uuid4().urn if page_id is None else f"{ID}{page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{name}>",
        f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}",
    ]
    if url:
        lines.append(f"WARC-Target-URI: {''.join(url.split())}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{ID}{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", 1, mtime=0)


def parsed(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """The WARC headers, the HTTP headers (names in lower case) and the payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, warc = _headers(head)
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    body = rest[: int(warc["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    return warc, _headers(http)[1], payload


def _headers(block: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = block.decode("utf-8", "replace").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _page(name: str | None) -> int | None:
    """The page's id in a record's name; None for records of pages without one."""
    return int(name.strip("<>").removeprefix(ID)) if name and not name.strip("<>").startswith("urn:uuid:") else None


def surt(url: str | None) -> str:
    """A URL's sort key: the host's labels from the back, then the path."""
    try:
        parts = urlsplit(url or "")
    except ValueError:
        return "-"
    host = ",".join(reversed((parts.hostname or "-").split(".")))
    return f"{host}){parts.path or '/'}{'?' + parts.query if parts.query else ''}".replace(" ", "%20")


# --- operators ---------------------------------------------------------------------------------------


def first_holders(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, refers_to): the payload of each page, and the page that it repeats, or null.

    Equal payloads (by SHA-256) belong to the smallest page_id. The smallest is found in an aggregate with a
    map-side half, so a payload that a third of the pages share is one row when it is joined back.
    """
    read = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"),
        F.coalesce(F.col("html").cast("binary"), F.to_binary(F.lit(""), F.lit("utf-8"))).alias("payload"),
    ).withColumn("key", F.unhex(F.sha2("payload", 256)))
    holders = read.where("page_id IS NOT NULL").groupBy("key").agg(F.min("page_id").alias("holder"), F.count("*").alias("n"))
    return read.join(holders.where("n > 1").drop("n"), "key", "left").select(
        "page_id", "url", "payload", F.when(F.col("page_id") != F.col("holder"), F.col("holder")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, least: int = 0, without_id: bool = False) -> DataFrame:
    """Write a record per page into archives below ``folder``; returns (path, records, bytes), one per archive.

    ``pages`` needs page_id, url and html; other columns are ignored. Of records with equal payloads of at
    least ``least`` bytes the one with the smallest page_id is a response and the others are revisits; smaller
    ones are responses. An archive holds its records as one stored member of gzip members, an index and a
    package description, and is written as a stream. A task writes under a name of its own, so one that
    is run again leaves no half archive in the result, which is saved: it lists each page once.

    Pages without an id have no record, or, if asked for (``without_id``), a response each under a random name
    that reads back as a null page_id. Repeated rows of a page are written again, each as its first row
    would be. Null html is an empty payload, a null url leaves the target out. No pages give no archives.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for page, url, payload, refers in zip(
                batch["page_id"].to_pylist(), batch["url"].to_pylist(), batch["payload"], batch["refers_to"].to_pylist(), strict=True
            ):
                out = out or _Archive(folder)
                out.add(page, url, payload.as_py(), refers)
                if out.zip.size >= ARCHIVE_BYTES:
                    yield out.close()
                    out = None
        if out:
            yield out.close()

    held = first_holders(pages)
    if not without_id:
        held = held.where("page_id IS NOT NULL")
    if least:
        held = held.withColumn("refers_to", F.when(F.length("payload") >= least, F.col("refers_to")))
    return saved(arrow(held, write, "path string, records long, bytes long"), "manifest")


class _Archive:
    def __init__(self, folder: str):
        self.system, base = opened(folder)
        self.system.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.wacz"
        self.path, self.file = f"{folder}/{name}", self.system.open_output_stream(f"{base}/{name}")
        self.zip, self.index = ZipWriter(self.file), []
        self.zip.begin(RECORDS)

    def add(self, page: int | None, url: str | None, payload: bytes, refers: int | None) -> None:
        data = record(page, url, payload, refers)
        entry = {"offset": self.zip.size, "length": len(data), "digest": f"sha1:{digest(payload)}"}
        self.index.append(f"{surt(url)} {DATE[:4]}0101000000 {json.dumps(entry)}\n")
        self.zip.add(data)

    def close(self) -> pa.RecordBatch:
        self.zip.end()
        size = self.zip.size
        self.zip.begin(INDEX)
        for line in sorted(self.index):
            self.zip.add(line.encode())
        self.zip.end()
        self.zip.begin(PACKAGE)
        self.zip.add(json.dumps({"profile": "data-package", "wacz_version": "1.1.1", "resources": [
            {"path": RECORDS, "bytes": size}, {"path": INDEX, "bytes": sum(len(x.encode()) for x in self.index)}]}).encode())
        self.zip.end()
        self.zip.close()
        self.file.close()
        return pa.RecordBatch.from_pydict({"path": [self.path], "records": [len(self.index)], "bytes": [self.zip.at]})


LOCATED = "path string, offset long, length long"


def located(archives: DataFrame) -> DataFrame:
    """(path, offset, length) of every record: from the central directory and the index of each archive.

    ``archives`` has a path per archive. Offsets count from the start of the ZIP file. Members and indexes are
    found by their names; ones that are compressed can't be read by ranges and fail with a message. An index in
    gzip form is read, too.
    """

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                system, inner = opened(path)
                with system.open_input_file(inner) as file:
                    members = directory(file, file.size())
                    warcs = {n.rsplit("/", 1)[-1]: m for n, m in members.items() if n.endswith((".warc.gz", ".warc"))}
                    rows = []
                    for name, (method, start, size) in members.items():
                        if not name.endswith((".cdxj", ".cdx", ".cdxj.gz", ".cdx.gz", ".idx")) or name.endswith(".idx"):
                            continue
                        if method:
                            raise ValueError(f"{path}: {name} is compressed within the ZIP")
                        text = file.read_at(size, start)
                        for line in (gzip.decompress(text) if name.endswith(".gz") else text).splitlines():
                            entry = json.loads(line[line.index(b"{") :])
                            kind, at, _ = warcs[entry["filename"]] if "filename" in entry else next(iter(warcs.values()))
                            if kind:
                                raise ValueError(f"{path}: its records are compressed within the ZIP")
                            rows.append((at + int(entry["offset"]), int(entry["length"])))
                offsets, lengths = zip(*rows, strict=True) if rows else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(rows), pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                    names=["path", "offset", "length"],
                )

    return arrow(archives.select("path"), locate, LOCATED)


READ = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ]
)

# Neighbouring records are fetched in one range read of at most so many bytes.
RANGE = 4 << 20


def read_records(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Per record of the archives: page_id, url, payload (null for revisits, or if not asked for), the size
    and digest of the full payload, record_type and refers_to (the response's page_id, for revisits).

    Index entries are dealt by stretches of their archive, so one large archive is read by many tasks. A
    response's payload must have the digest that its header names, or the task fails.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, file = None, None
        for batch in batches:
            rows = []
            entries = sorted(zip(batch["path"].to_pylist(), batch["offset"].to_pylist(), batch["length"].to_pylist(), strict=True))
            block, begin = b"", 0
            for i, (path, offset, length) in enumerate(entries):
                if path != last:
                    if file:
                        file.close()
                    system, inner = opened(path)
                    last, file, block, begin = path, system.open_input_file(inner), b"", 0
                if not begin <= offset <= offset + length <= begin + len(block):
                    until = offset + length
                    for other, o, n in entries[i + 1 :]:
                        if other != path or o > until + 4096 or o + n - offset > RANGE:
                            break
                        until = max(until, o + n)
                    block, begin = file.read_at(until - offset, offset), offset
                data = block[offset - begin : offset - begin + length]
                warc, http, payload = parsed(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data)
                found = warc["warc-payload-digest"].removeprefix("sha1:")
                response = warc["warc-type"] == "response"
                if response and digest(payload) != found:
                    raise ValueError(f"{path}: the payload at {offset} has another digest than its header names")
                rows.append((
                    _page(warc["warc-record-id"]), warc.get("warc-target-uri"), payload if response and payloads else None,
                    len(payload) if response else int(http["content-length"]), found, warc["warc-type"], _page(warc.get("warc-refers-to")),
                ))
            columns = list(zip(*rows, strict=True)) or [[]] * len(READ)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, READ, strict=True)], schema=READ)
        if file:
            file.close()

    # Stretches of an archive keep neighbouring records together.
    stretch = (F.col("offset") / RANGE).cast("long")
    dealt = located(archives).repartition("path", stretch)
    return arrow(
        dealt, read,
        "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long",
    )


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write all pages, also those without an id, into archives in the shared folder and read every record back
    (without payloads)."""
    folder = new_folder(pages.sparkSession, "archives")
    return read_records(write_archives(pages, folder, least, without_id=True), payloads=False)
