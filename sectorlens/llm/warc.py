"""Operator 3: WARC records in ZIP-packaged archives, read by ranges.

An archive is a ZIP file with two stored (uncompressed) members: the WARC
records, and an index with each record's offset and length. Directories are
written and read with ZIP64 fields. The reader needs only ``read_at(offset,
length)``: it parses the end records and the central directory, finds where
the members' bytes begin, and fetches one record at a time; nothing is
extracted. Archives live in a table of bounded binary rows, so that every
file system Spark can write to will do.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes the one with
the smallest page_id is the response and the others revisit it.

Defined cases: a null html is an empty payload; a null url gives no target
URI; a null page_id is kept as null and never referred to (if all equal
payloads have null ids, each is a response); rows repeating the smallest id
are responses; control characters in urls are percent-encoded; a payload
larger than an archive's size has an archive of its own; no pages, no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import broadcast_checked, stored

MIN_REVISIT = 100
ARCHIVE_BYTES = 8 << 20
WARC_MEMBER, INDEX_MEMBER = "archive/data.warc", "indexes/index.cdxj"
RECORD_DATE = "1970-01-01T00:00:00Z"
ReadAt = Callable[[int, int], bytes]

# Signatures and layouts of ZIP structures.
LOCAL, CENTRAL, END, END64, LOCATOR = b"PK\3\4", b"PK\1\2", b"PK\5\6", b"PK\6\6", b"PK\6\7"
LOCAL_LAYOUT, CENTRAL_LAYOUT = "<4s5H3I2H", "<4s6H3I5H2I"
END_LAYOUT, END64_LAYOUT, LOCATOR_LAYOUT = "<4s4H2IH", "<4sQ2H2I4Q", "<4sIQI"
FULL16, FULL32, VERSION64, DOS_EPOCH = 0xFFFF, 0xFFFFFFFF, 45, 33


# ---- writing -------------------------------------------------------------------------------------------------------

def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
              f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {RECORD_DATE}",
              f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        fields.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        fields += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                   f"WARC-Refers-To: <urn:page:{refers_to}>"]
    fields.append(f"Content-Length: {len(block)}")
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def zip_archive(members: list[tuple[str, bytes]]) -> bytes:
    """A ZIP file of stored members whose directories carry ZIP64 fields."""
    out, directory = bytearray(), bytearray()
    for name, data in members:
        raw, crc, at, size = name.encode(), zlib.crc32(data), len(out), len(data)
        extra = struct.pack("<2H2Q", 1, 16, size, size)
        out += struct.pack(LOCAL_LAYOUT, LOCAL, VERSION64, 0, 0, 0, DOS_EPOCH, crc, FULL32, FULL32, len(raw), len(extra))
        out += raw + extra + data
        extra = struct.pack("<2H3Q", 1, 24, size, size, at)
        directory += struct.pack(CENTRAL_LAYOUT, CENTRAL, VERSION64, VERSION64, 0, 0, 0, DOS_EPOCH, crc, FULL32, FULL32,
                                 len(raw), len(extra), 0, 0, 0, 0, FULL32) + raw + extra
    start, end = len(out), len(out) + len(directory)
    out += directory
    out += struct.pack(END64_LAYOUT, END64, 44, VERSION64, VERSION64, 0, 0, len(members), len(members), end - start, start)
    out += struct.pack(LOCATOR_LAYOUT, LOCATOR, 0, end, 1)
    out += struct.pack(END_LAYOUT, END, 0, 0, FULL16, FULL16, FULL32, FULL32, 0)
    return bytes(out)


def pack_records(records: list[tuple[int | None, bytes]]) -> bytes:
    offset, index = 0, []
    for page_id, record in records:
        index.append(json.dumps({"page_id": page_id, "offset": offset, "length": len(record)}))
        offset += len(record)
    return zip_archive([(WARC_MEMBER, b"".join(r for _, r in records)), (INDEX_MEMBER, "\n".join(index).encode())])


# ---- reading -------------------------------------------------------------------------------------------------------

def bytes_reader(data: bytes) -> ReadAt:
    view = memoryview(data)
    return lambda offset, length: bytes(view[offset:offset + length])


def file_reader(path: str) -> ReadAt:
    """Ranges of a file in a folder that this machine mounts."""
    def read_at(offset: int, length: int) -> bytes:
        with open(path, "rb") as f:
            f.seek(offset)
            return f.read(length)
    return read_at


def _extra64(extra: bytes, values: list[int]) -> list[int]:
    """Sizes and offset, those at their limit taken from the ZIP64 extra field, in order."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            wide = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            return [next(wide) if v == FULL32 else v for v in values]
        at += 4 + size
    return values


def zip_members(read_at: ReadAt, size: int) -> dict[str, tuple[int, int]]:
    """(offset, length) of the bytes of each stored member, from the directories alone."""
    tail_at = max(0, size - struct.calcsize(END_LAYOUT) - FULL16)
    tail = read_at(tail_at, size - tail_at)
    found = tail.rfind(END)
    if found < 0:
        raise ValueError("no end of central directory: not a ZIP archive")
    *_, total, length, start, _ = struct.unpack_from(END_LAYOUT, tail, found)
    if FULL16 == total or FULL32 in (length, start):
        width = struct.calcsize(LOCATOR_LAYOUT)
        mark, _, end64, _ = struct.unpack(LOCATOR_LAYOUT, read_at(tail_at + found - width, width))
        if mark != LOCATOR:
            raise ValueError("the ZIP64 locator is missing")
        end = struct.unpack(END64_LAYOUT, read_at(end64, struct.calcsize(END64_LAYOUT)))
        if end[0] != END64:
            raise ValueError("the ZIP64 end record is missing")
        total, length, start = end[7:10]
    directory, at, members = read_at(start, length), 0, {}
    fixed, local = struct.calcsize(CENTRAL_LAYOUT), struct.calcsize(LOCAL_LAYOUT)
    for _ in range(total):
        head = struct.unpack_from(CENTRAL_LAYOUT, directory, at)
        if head[0] != CENTRAL:
            raise ValueError("broken central directory")
        method, packed, plain, n_name, n_extra, n_comment, where = head[4], head[8], head[9], *head[10:13], head[16]
        name = directory[at + fixed:at + fixed + n_name].decode()
        extra = directory[at + fixed + n_name:at + fixed + n_name + n_extra]
        plain, packed, where = _extra64(extra, [plain, packed, where])
        if method == 0:
            head = struct.unpack(LOCAL_LAYOUT, read_at(where, local))
            if head[0] != LOCAL:
                raise ValueError(f"no local header of {name}")
            members[name] = (where + local + head[9] + head[10], packed)
        at += fixed + n_name + n_extra + n_comment
    return members


def read_record(raw: bytes) -> dict:
    """Fields of a WARC record, its HTTP payload and payload length."""
    head, _, block = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this range")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    http, _, payload = block[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    full = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and (len(payload) != full or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
    refers = fields.get("WARC-Refers-To")
    return {"page_id": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": full,
            "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": refers and _page(refers),
            "payload": payload if fields["WARC-Type"] == "response" else None}


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def read_archive(read_at: ReadAt, size: int) -> Iterator[dict]:
    """Every indexed record of an archive, range by range."""
    members = zip_members(read_at, size)
    index = read_at(*members[INDEX_MEMBER]).decode()
    start = members[WARC_MEMBER][0]
    for line in index.split("\n") if index else []:
        entry = json.loads(line)
        yield read_record(read_at(start + entry["offset"], entry["length"]))


# ---- Spark jobs ----------------------------------------------------------------------------------------------------

def write_archives(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """A stored table with one archive per row (column ``archive``) holding all ``pages`` (page_id, url, html).

    Pages are packed where they are read. Only digests shared by several
    pages are joined to them; they are broadcast if their size allows it.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    records = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                           payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    shared = (records.where(F.octet_length("payload") >= MIN_REVISIT)
              .groupBy(F.col("digest").alias("shared_digest"))
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").drop("n"))
    shared = broadcast_checked(stored(shared, "shared_digests"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    ready = (records.join(shared, F.col("digest") == F.col("shared_digest"), "left")
             .select("page_id", "url", "payload", "digest", refers.alias("refers_to")))

    def pack(batches):
        held, size = [], 0
        for batch in batches:
            ids, urls, payloads, digests, refs = (batch.column(i) for i in range(5))
            for i in range(batch.num_rows):
                page_id = ids[i].as_py()
                record = warc_record(page_id, urls[i].as_py(), payloads[i].as_py(), digests[i].as_py(), refs[i].as_py())
                if held and size + len(record) > archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([pack_records(held)], pa.binary())], names=["archive"])
                    held, size = [], 0
                held.append((page_id, record))
                size += len(record)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([pack_records(held)], pa.binary())], names=["archive"])
    return stored(ready.mapInArrow(pack, "archive binary"), "archives")


def read_archives(archives: DataFrame, payload: bool = False) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to (and payload) of every record."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payload
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def unpack(batches):
        for batch in batches:
            for data in batch.column(0):
                data = data.as_buffer()
                rows: list[dict] = list(read_archive(bytes_reader(data), data.size))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[n] for r in rows], t) for n, t in zip(names, kinds)], names=names)
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return archives.select("archive").mapInArrow(unpack, schema + ", payload binary" * payload)
