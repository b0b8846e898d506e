"""WARC records in seekable Zstandard bundles.

A bundle is one file of a task: independent frames of some records each, and a footer in the
public seekable format (a skippable frame with the frames' sizes).  An index table maps a
record to bundle, frame, offset in the frame and length, so one record is read by decompressing
one frame.  Records with equal payloads become one response and revisits of it.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import scratch, spill

#: Payloads below this many bytes are always stored.
LEAST = 100
#: A frame is closed at this many bytes of records, a bundle at this many of frames.
FRAME, BUNDLE = 1 << 20, 1 << 28
LEVEL = 3
#: Fixed values of the seekable format: skippable frame, footer.
SKIPPABLE, FOOTER = 0x184D2A5E, 0x8F92EAB1
DATE = "1970-01-01T00:00:00Z"
INDEX = "record long, bundle string, frame int, frame_start long, frame_bytes long, at long, bytes long"


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """(compressed, plain) sizes as a skippable frame."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, FOOTER)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(start, compressed, plain) per frame, from the end of a bundle."""
    file.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != FOOTER:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    file.seek(size - 9 - count * width)
    table, start, out = file.read(count * width), 0, []
    for k in range(count):
        packed, plain = struct.unpack_from("<II", table, k * width)
        out.append((start, packed, plain))
        start += packed
    return out


def record(kind: str, page, url: str | None, payload: bytes, digest: str, size: int, refers) -> bytes:
    """One WARC/1.1 record.  A revisit has no block; the size and digest of the full payload
    stand in its head."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {(url or '').translate({10: ' ', 13: ' '})}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Bytes: {size}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers}>")
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Head, block and end of the record at an offset."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no record here")
    head = dict(line.split(": ", 1) for line in lines[1:])
    size = int(head["Content-Length"])
    return head, data[stop + 4 : stop + 4 + size], stop + 8 + size


def resolved(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """(page, url, body, digest, size, kind, refers): digests first, so that only they and the
    keys meet; the smallest key of a digest is taken with map-side combine."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    table = pages.select(F.col(key).alias("page"), F.col(url).alias("url"), body.alias("body"))
    table = table.withColumn("size", F.length("body").cast("long")).withColumn("digest", F.sha2("body", 256))
    first = (
        table.filter(F.col("size") >= LEAST).groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n"))
        .filter("n > 1").select(F.col("digest").alias("twin"), "first")
    )
    joined = table.join(first, F.col("digest") == F.col("twin"), "left")
    revisit = F.coalesce(F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first")), F.lit(False))
    return joined.select(
        "page", "url", "body", "digest", "size",
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("first")).alias("refers"),
    )


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write the bundles of ``pages`` below ``folder`` (a URI that all executors reach) and
    return their index, INDEX.  Every attempt of a task writes files of its own name; the
    index names those of the attempts that counted, so lost attempts leave nothing wrong."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        packer = zstandard.ZstdCompressor(level=LEVEL)
        pending: list[tuple] = []  # records of the open frame
        rows: list[tuple] = []
        file = name = None
        buffer, frames, start = bytearray(), [], 0

        def end_frame() -> None:
            nonlocal start
            if not buffer:
                return
            packed = packer.compress(bytes(buffer))
            file.write(packed)
            rows.extend((page, name, len(frames), start, len(packed), at, size) for page, at, size in pending)
            frames.append((len(packed), len(buffer)))
            start += len(packed)
            buffer.clear()
            pending.clear()

        def end_bundle() -> None:
            nonlocal file
            if file is not None:
                end_frame()
                file.write(seek_table(frames))
                file.close()
                file = None

        def flush() -> Iterator[pa.RecordBatch]:
            if rows:
                kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                names = [c.split()[0] for c in INDEX.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                rows.clear()

        for batch in batches:
            for page, url_, body, digest, size, kind, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if file is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    file, frames, start = store.open_output_stream(f"{root}/{name}", compression=None), [], 0
                made = record(kind, page, url_, body, digest, size, refers)
                pending.append((page, len(buffer), len(made)))
                buffer += made
                if len(buffer) >= FRAME:
                    end_frame()
                    if start >= BUNDLE:
                        end_bundle()
            yield from flush()
        end_bundle()
        yield from flush()

    return spill(resolved(pages, key, url, payload).mapInArrow(run, INDEX))


def read_frame(file, start: int, size: int) -> bytes:
    file.seek(start)
    return zstandard.ZstdDecompressor().decompress(file.read(size))


def read_record(folder: str, bundle: str, frame: int, at: int, size: int) -> tuple[dict[str, str], bytes]:
    """One record by its place: the seek table, one frame, one slice."""
    store, root = fs.FileSystem.from_uri(folder)
    info = store.get_file_info(f"{root}/{bundle}")
    with store.open_input_file(f"{root}/{bundle}") as file:
        start, packed, _ = read_seek_table(file, info.size)[frame]
        return parse(read_frame(file, start, packed)[at : at + size])[:2]


def read(index: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of every
    record of the bundles that ``index`` names, by their seek tables, one frame at a time.  Of
    responses, size and digest are taken from the payload and must equal the head's."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def number(mark: str | None) -> int | None:
        digits = (mark or "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for bundle, frame in zip(*(c.to_pylist() for c in batch.columns)):
                size = store.get_file_info(f"{root}/{bundle}").size
                with store.open_input_file(f"{root}/{bundle}") as file:
                    start, packed, _ = read_seek_table(file, size)[frame]
                    data, at, rows = read_frame(file, start, packed), 0, []
                while at < len(data):
                    head, block, at = parse(data, at)
                    length, digest = int(head["X-Payload-Bytes"]), head["WARC-Payload-Digest"].removeprefix("sha256:")
                    kind = head["WARC-Type"]
                    if kind == "response" and (length != len(block) or digest != hashlib.sha256(block).hexdigest()):
                        raise ValueError(f"record {head['WARC-Record-ID']} of {bundle} is damaged")
                    rows.append((number(head["WARC-Record-ID"]), head["WARC-Target-URI"], length, digest, kind, number(head.get("WARC-Refers-To")), block))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    frames = index.select("bundle", "frame").distinct()
    return frames.mapInArrow(
        run,
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary",
    )


def archive(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write ``pages`` to bundles in the shared scratch folder and read them back.

    One record per row, repeated rows and null keys too.  A null payload is the empty one, a
    null url the empty text; line ends in a url become spaces.  Of equal payloads of LEAST
    bytes or more the smallest key is the response (each row of it, if the key repeats), the
    others revisit it; where all keys are null, all are responses.  Other columns of ``pages``
    are not looked at.
    """
    folder = scratch(pages.sparkSession)
    return read(write(pages, folder, key, url, payload), folder)
