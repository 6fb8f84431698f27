"""WARC archives as seekable Zstandard bundles.

A bundle is the content of one ``.warc.zst`` file: independent Zstandard frames, each with some
whole WARC records, and a skippable frame at the end with the seek table (compressed and raw
size of every frame, the public seekable format). An index maps each record's id to its bundle,
its frame and its offset within the unpacked frame, so one record is read by unpacking one frame.

Bundles are rows of a Parquet table in shared storage, written and read by Spark alone, because
executors have no file system in common that plain Python could open. A bundle row is closed at
``BUNDLE_BYTES`` of compressed data; a frame at ``FRAME_BYTES`` of records. A record larger than
that is a frame of its own.

Payloads of at least ``LEAST_SHARED`` bytes are stored once: the record with the smallest id holds
the payload, the others are revisits that name it.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import work_path
from .tables import map_rows

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 8 << 20
LEAST_SHARED = 100
LEVEL = 3

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

BUNDLE_SCHEMA = "data binary, index array<struct<page_id: bigint, frame: int, offset: int, length: int>>"
RECORD_SCHEMA = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, intact boolean"
)


def dedup(pages: DataFrame) -> DataFrame:
    """``pages`` with digest, size, record type and, for revisits, the record referred to.

    Equal means equal SHA-256 and size. Only digests that occur more than once are joined back,
    after a map-side minimum, so a payload that a third of the pages share is one row per task.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", "html").withColumns(
        {"payload_digest": F.sha2(payload, 256), "payload_bytes": F.octet_length(payload).cast("long")}
    )
    shared = (
        rows.where(F.col("payload_bytes") >= LEAST_SHARED)
        .groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1").select("digest", "first")
    )
    known = rows.join(shared, rows["payload_digest"] == shared["digest"], "left")
    repeats = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return known.select(
        "page_id", "url", F.when(~repeats, F.col("html")).alias("html"), "payload_bytes", "payload_digest",
        F.when(repeats, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(repeats, F.col("first")).alias("refers_to"),
    )


def record(row: tuple) -> bytes:
    """One WARC record; the block of a revisit is empty."""
    page_id, url, html, size, digest, kind, refers_to = row
    block = (html or "").encode() if kind == "response" else b""
    head = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {size}",
        "Content-Type: text/html; charset=UTF-8",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.insert(3, f"WARC-Target-URI: {escaped(url)}")
        if escaped(url) != url:
            head.append("X-Target-URI-Escaped: yes")
    if kind == "revisit":
        head += [f"WARC-Refers-To: {urn(refers_to)}", f"WARC-Profile: {REVISIT}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def escaped(url: str) -> str:
    """A header value can't hold line ends; where there are any, they and the escape sign are escaped."""
    return url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if set(url) & {"\r", "\n"} else url


def unescaped(url: str) -> str:
    return url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The footer: a skippable frame with the compressed and raw size of every frame before it."""
    body = b"".join(struct.pack("<II", *size) for size in sizes)
    body += struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def frames_of(data: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, raw size) of every frame, from the footer alone."""
    count, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE or flags:
        raise ValueError("no seek table at the end of the bundle")
    at = len(data) - 9 - 8 * count
    out, start = [], 0
    for _ in range(count):
        packed, raw = struct.unpack_from("<II", data, at)
        out.append((start, packed, raw))
        start, at = start + packed, at + 8
    return out


def bundle_rows(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Pack the records of one partition; nothing but the open bundle is held."""
    packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
    data, sizes, index = bytearray(), [], []
    frame, members = bytearray(), []

    def close_frame():
        packed = packer.compress(bytes(frame))
        index.extend({"page_id": p, "frame": len(sizes), "offset": o, "length": n} for p, o, n in members)
        sizes.append((len(packed), len(frame)))
        data.extend(packed)
        frame.clear()
        members.clear()

    for row in rows:
        raw = record(row)
        if frame and len(frame) + len(raw) > FRAME_BYTES:
            close_frame()
        members.append((row[0], len(frame), len(raw)))
        frame += raw
        if len(data) >= BUNDLE_BYTES:
            close_frame()
            yield bytes(data) + seek_table(sizes), index
            data, sizes, index = bytearray(), [], []
    if frame:
        close_frame()
    if sizes:
        yield bytes(data) + seek_table(sizes), index


def write(pages: DataFrame, path: str) -> None:
    """Write one record per page to a new table of bundles at ``path``.

    A null html is an empty payload; a null url is left out; a null page_id is an empty id, never
    the smallest of its group unless all are null, and copies of one page_id are each a record.
    An empty table gives an empty archive. Other columns are not read.
    """
    bundles = map_rows(dedup(pages), bundle_rows, BUNDLE_SCHEMA, at_once=1)
    bundles.write.parquet(path)


def parse(raw: bytes, at: int, length: int) -> tuple:
    """One record, with a check of its payload against its digest."""
    end = raw.index(b"\r\n\r\n", at)
    lines = raw[at:end].decode().split("\r\n")
    head = dict(line.split(": ", 1) for line in lines[1:])
    block = raw[end + 4 : end + 4 + int(head["Content-Length"])]
    if lines[0] != VERSION or end + 8 + len(block) != at + length:
        raise ValueError("not a record of this archive")
    kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(head["X-Payload-Length"])
    if kind == "response":
        intact = hashlib.sha256(block).hexdigest() == digest and len(block) == size
    else:
        intact = head["WARC-Profile"] == REVISIT and not block
    url = head.get("WARC-Target-URI")
    if "X-Target-URI-Escaped" in head:
        url = unescaped(url)
    return (
        page_of(head["WARC-Record-ID"]), url, block if kind == "response" else None, size, digest, kind,
        page_of(head["WARC-Refers-To"]) if kind == "revisit" else None, intact,
    )


def page_of(value: str) -> int | None:
    number = value.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record_rows(rows: Iterator[tuple]) -> Iterator[tuple]:
    """All records of the bundles, frame by frame."""
    unpacker = zstandard.ZstdDecompressor()
    for data, index in rows:
        frames = frames_of(data)
        open_frame, raw = -1, b""
        for entry in index:
            if entry["frame"] != open_frame:
                open_frame = entry["frame"]
                start, packed, size = frames[open_frame]
                raw = unpacker.decompress(data[start : start + packed], max_output_size=size)
            yield parse(raw, entry["offset"], entry["length"])


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record of an archive; ``payload`` only on request, null for revisits."""
    bundles = spark.read.parquet(path).select("data", "index")
    if payloads:
        return map_rows(bundles, record_rows, RECORD_SCHEMA, at_once=200)
    return map_rows(bundles, _heads, RECORD_SCHEMA)


def _heads(rows: Iterator[tuple]) -> Iterator[tuple]:
    for found in record_rows(rows):
        yield *found[:2], None, *found[3:]


def lookup(spark: SparkSession, path: str, page_ids: list[int]) -> DataFrame:
    """The records of some ids: only bundles that hold one are unpacked, and only its frames."""
    wanted = F.array(*map(F.lit, page_ids)).cast("array<bigint>")
    bundles = spark.read.parquet(path).select(
        "data", F.filter("index", lambda e: F.array_contains(wanted, e["page_id"])).alias("index")
    )
    return map_rows(bundles.where(F.size("index") > 0), record_rows, RECORD_SCHEMA, at_once=200)


def roundtrip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to a new archive in the shared folder, read it back, and return its records' heads.

    A record whose payload does not have the digest its head names ends the query with an error.
    """
    spark = pages.sparkSession
    path = work_path(spark, "warc")
    write(pages, path)
    whole = F.assert_true(F.col("intact"), "a record differs from its digest").isNull()
    return read(spark, path, payloads=False).where(whole).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )
