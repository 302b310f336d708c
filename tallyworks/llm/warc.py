"""WARC records in seekable Zstandard bundles, written and read by Spark tasks.

Each task groups its records into frames of about ``frame_bytes`` that decompress on their own, writes
them one after another and closes the file with a seek table: a skippable frame that lists the
compressed and plain size of every frame, then the number of frames and the magic number. The index table maps a
record id to archive, frame and the offset inside the plain frame, so one record costs one small read.

The index is what commits an archive: a file of a task that was lost or ran twice stands in no index row
and is never read. Archives are read frame by frame, spread over tasks by the seek tables.

Records of equal payload (of ``revisit_bytes`` or more) are stored once, at the smallest id; the others
are revisit records that name it. Which ids are repeated is found on digests alone; payloads move only
if the table of repeated ids is too large to be sent to every task.

Defined cases: a null payload is empty; a null id sorts last and is written as an empty id; rows that
repeat the smallest id and its payload are each a response; a null address is empty; a record longer
than a frame is a frame of its own; an empty table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import math

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.common import stored
from tallyworks.session import new_folder

# compressed bytes of frames that a task unpacks
READ_BYTES = 1 << 20
FRAME_BYTES = 1 << 20
ARCHIVE_BYTES = 1 << 30
# fixed values of the seekable Zstandard format
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_TABLE_MAGIC = 0x8F92EAB1
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "record_id string, archive string, frame int, frame_offset long, frame_bytes long, offset long, bytes long"
FRAMES = "archive string, frame int, frame_offset long, frame_bytes long"
RECORDS = (
    "record_id string, record_type string, refers_to string, address string, payload_digest string, payload_bytes long, "
    "payload binary, archive string, frame int, offset long"
)


def urn(record_id: str) -> str:
    return f"<urn:x-record:{record_id}>"


def record_of(urn_text: str) -> str:
    return urn_text.removeprefix("<urn:x-record:").removesuffix(">")


def record_bytes(record_id: str, address: str, payload: bytes, sha1: bytes, refers_to: str | None, date: str) -> bytes:
    """One WARC record: a response with the payload, or a revisit with the response's headers alone."""
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    )
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {urn(record_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {address}".replace("\r", "%0D").replace("\n", "%0A"),
        f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {urn(refers_to)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed_records(plain: bytes, only: set[int] | None = None) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``(offset, headers, block)`` of the records of one plain frame, or of those at the given offsets."""
    at = 0
    while at < len(plain):
        head_end = plain.index(b"\r\n\r\n", at)
        lines = plain[at:head_end].decode().split("\r\n")
        headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
        start = head_end + 4
        end = start + int(headers["content-length"])
        if only is None or at in only:
            yield at, headers, plain[start:end]
        at = end + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", packed, plain) for packed, plain in sizes) + struct.pack("<IBI", len(sizes), 0, SEEK_TABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(source) -> list[tuple[int, int]]:
    """``(offset, packed size)`` of every frame of an open archive."""
    size = source.size()
    source.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEK_TABLE_MAGIC:
        raise ValueError("no seek table at the end of the archive")
    source.seek(size - 9 - 8 * count)
    sizes = struct.unpack(f"<{2 * count}I", source.read(8 * count))
    out, at = [], 0
    for packed in sizes[::2]:
        out.append((at, packed))
        at += packed
    return out


def _files(folder: str):
    """File system and path of a folder or file; any store that Arrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


class Bundle:
    """One archive in the making."""

    def __init__(self, path: str, frame_bytes: int, date: str):
        import zstandard

        system, place = _files(path)
        self.path, self.frame_bytes = path, frame_bytes
        self.out = system.open_output_stream(place, compression=None)  # Arrow would pack it by its name
        self.packer = zstandard.ZstdCompressor(level=3)
        self.sizes: list[tuple[int, int]] = []
        self.written, self.plain, self.waiting, self.index = 0, bytearray(), [], []
        info = b"software: tallyworks\r\nformat: WARC File Format 1.1\r\n"
        self.plain += (
            f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x-archive:{path.rsplit('/', 1)[-1]}>\r\nWARC-Date: {date}\r\n"
            f"Content-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
        ).encode() + info + b"\r\n\r\n"

    def add(self, record_id: str, record: bytes) -> None:
        if self.plain and len(self.plain) + len(record) > self.frame_bytes:
            self.end_frame()
        self.waiting.append((record_id, len(self.plain), len(record)))
        self.plain += record

    def end_frame(self) -> None:
        packed = self.packer.compress(bytes(self.plain))
        self.out.write(packed)
        self.index += [
            (name, self.path, len(self.sizes), self.written, len(packed), offset, size) for name, offset, size in self.waiting
        ]
        self.sizes.append((len(packed), len(self.plain)))
        self.written += len(packed)
        self.plain, self.waiting = bytearray(), []

    def close(self) -> list[tuple]:
        if self.plain:
            self.end_frame()
        self.out.write(seek_table(self.sizes))
        self.out.close()
        return self.index


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_INDEX_ARROW = pa.schema(
    [("record_id", pa.string()), ("archive", pa.string()), ("frame", pa.int32()), ("frame_offset", pa.int64()),
     ("frame_bytes", pa.int64()), ("offset", pa.int64()), ("bytes", pa.int64())]
)
_FRAMES_ARROW = pa.schema([("archive", pa.string()), ("frame", pa.int32()), ("frame_offset", pa.int64()), ("frame_bytes", pa.int64())])
_RECORDS_ARROW = pa.schema(
    [("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("address", pa.string()),
     ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("archive", pa.string()),
     ("frame", pa.int32()), ("offset", pa.int64())]
)


def _writer(folder: str, frame_bytes: int, archive_bytes: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, count, bundle = TaskContext.get(), 0, None
        for batch in batches:
            for name, address, payload, sha1, refers in zip(*(batch.column(i) for i in range(5))):
                if bundle is None:
                    # the attempt is part of the name: no two runs of a task write the same file
                    name_of = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{count}.warc.zst"
                    bundle, count = Bundle(f"{folder}/{name_of}", frame_bytes, date), count + 1
                record = record_bytes(
                    name.as_py(), address.as_py(), payload.as_buffer().to_pybytes(), bytes.fromhex(sha1.as_py()), refers.as_py(), date
                )
                bundle.add(name.as_py(), record)
                if bundle.written >= archive_bytes:
                    yield _as_batch(bundle.close(), _INDEX_ARROW)
                    bundle = None
        if bundle is not None:
            yield _as_batch(bundle.close(), _INDEX_ARROW)

    return write


def _frames_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, place = _files(path)
            with system.open_input_file(place) as source:
                table = read_seek_table(source)
            yield _as_batch([(path, i, at, size) for i, (at, size) in enumerate(table)], _FRAMES_ARROW)


def _read_frames(payloads: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpacker, opened, source = zstandard.ZstdDecompressor(), None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["archive"] != opened:
                    if source is not None:
                        source.close()
                    system, place = _files(row["archive"])
                    opened, source = row["archive"], system.open_input_file(place)
                source.seek(row["frame_offset"])
                plain = unpacker.decompress(source.read(row["frame_bytes"]))
                only = set(row["offsets"]) if row.get("offsets") is not None else None
                out = []
                for offset, headers, block in parsed_records(plain, only):
                    if headers["warc-type"] == "warcinfo":
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    length = next(int(x[16:]) for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    stored_here = headers["warc-type"] == "response"
                    if stored_here and (len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                        raise ValueError(f"damaged payload of {headers['warc-record-id']} in {opened}")
                    refers = headers.get("warc-refers-to")
                    out.append(
                        (record_of(headers["warc-record-id"]), headers["warc-type"], refers and record_of(refers), headers["warc-target-uri"],
                         digest, length, payload if payloads and stored_here else None, opened, row["frame"], offset)
                    )
                yield _as_batch(out, _RECORDS_ARROW)
        if source is not None:
            source.close()

    return read


def write_archives(
    pages: DataFrame,
    folder: str,
    record_id: str = "page_id",
    address: str = "url",
    payload: str = "html",
    revisit_bytes: int = 0,
    frame_bytes: int = FRAME_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Writes the records below ``folder`` and returns the index table, stored beside them."""
    rows = pages.select(
        F.col(record_id).alias("id"),
        F.coalesce(F.col(address).cast("string"), F.lit("")).alias("address"),
        F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    digests = rows.where(F.octet_length("payload") >= revisit_bytes).select("id", F.unhex("sha1").alias("digest"))
    first = digests.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL")
    first = stored(first.select("digest", "first"), "warc-first")
    again = digests.join(first, "digest").where(F.col("id").isNull() | (F.col("id") > F.col("first")))
    again = stored(again.select(F.col("id").alias("again"), F.hex("digest").alias("again_sha1"), "first").distinct(), "warc-again")
    marked = rows.join(again, rows["id"].eqNullSafe(again["again"]) & (F.upper(rows["sha1"]) == again["again_sha1"]), "left").select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("record_id"), "address", "payload", "sha1", F.col("first").cast("string")
    )
    system, place = _files(folder)
    system.create_dir(place, recursive=True)
    return stored(marked.mapInArrow(_writer(folder, frame_bytes, archive_bytes, date), INDEX), "warc-index")


def frames(archives: DataFrame) -> DataFrame:
    """``archive, frame, frame_offset, frame_bytes`` of archives named in the column ``archive``, out of their seek tables."""
    return archives.select("archive").distinct().mapInArrow(_frames_of, FRAMES)


def read_archives(archives: DataFrame, payloads: bool = True, read_bytes: int = READ_BYTES) -> DataFrame:
    """All records of the archives named in the column ``archive``; payload digests are verified."""
    found = stored(frames(archives), "warc-frames")
    # rows of frames are small, what they name is not: as many tasks as the bytes ask for
    tasks = max(1, math.ceil((found.agg(F.sum("frame_bytes")).first()[0] or 0) / read_bytes))
    return found.repartition(tasks, "archive", "frame").mapInArrow(_read_frames(payloads), RECORDS)


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that the index rows name, by their offsets inside the frames."""
    wanted = index.groupBy("archive", "frame", "frame_offset", "frame_bytes").agg(F.collect_set("offset").alias("offsets"))
    return wanted.mapInArrow(_read_frames(payloads), RECORDS)


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Writes archives in a new folder below the shared one and reads all of them back, without payloads."""
    index = write_archives(pages, new_folder(pages.sparkSession, "warc"), **options)
    return read_archives(index, payloads=False)
