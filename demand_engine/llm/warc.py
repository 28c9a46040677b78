"""Web archives as seekable Zstandard bundles of WARC records.

Records are grouped into frames of about FRAME_BYTES, each compressed by itself; a bundle ends with a seek
table in a skippable frame (the public seekable format), so a reader fetches and decompresses one frame to get
at one record. The index maps a record id to bundle, frame, and the record's offset and length in the frame.

Equal payloads are stored once: the record with the largest page id is the response, the others are revisits
that name it. Which is which comes from digests alone, counted map-side, so a payload that a third of all
pages share is no hot key; pages are shuffled by page id.

A task writes its bundles to the shared folder through the folder's file system, under names of its own
attempt, and returns the index rows of a bundle once it is closed. The index is a written table: what a failed
attempt left behind is never read, and a lost executor costs the tasks it was running.

Defined results: null html is an empty payload, a null url is ``about:blank``, line breaks in urls are escaped;
payloads under ``min_bytes`` are never revisits; rows that repeat a page id are records of their own, and of
those that repeat the response's id and payload one is the response; a null page id is smaller than any other;
an empty table gives no bundle and an empty index; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demand_engine.llm.common import pick, small_batches
from demand_engine.session import cut_lineage, shared_folder

FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 32 * 1024 * 1024
WARC_DATE = "2024-01-01T00:00:00Z"

#: Fixed values of the seekable format: the magic number of its skippable frame and of its footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_INDEX = pa.schema(
    [("record_id", pa.string()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]
)
_INDEX_DDL = "record_id string, bundle string, frame int, offset bigint, length bigint"


def record_id(page_id, digest: str, copy: int) -> str:
    return f"urn:x-page:{'null' if page_id is None else page_id}:{digest}:{copy}"


def page_of(identifier: str) -> int | None:
    number = identifier.split(":")[2]
    return None if number == "null" else int(number)


def record(identifier: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record. A revisit has no payload, but its digest and length."""
    safe = "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "about:blank")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = head if refers_to else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to else 'response'}",
        f"WARC-Record-ID: <{identifier}>",
        f"WARC-Target-URI: {safe}",
        f"WARC-Date: {WARC_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if refers_to:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{refers_to}>",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers (lower-case names) and payload of one record."""
    top, _, rest = data.partition(b"\r\n\r\n")
    lines = top.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    body = rest[: int(headers["content-length"])]
    headers["payload"] = body.partition(b"\r\n\r\n")[2]
    return headers


class BundleWriter:
    """Frames and the seek table of one bundle, in memory until it is written."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        self.frame_bytes = frame_bytes
        self.frames: list[bytes] = []
        self.table: list[tuple[int, int]] = []
        self.index: list[tuple[str, int, int, int]] = []
        self.open: list[bytes] = []
        self.offset = self.size = 0
        self.packer = zstandard.ZstdCompressor(level=3, write_checksum=True)

    def add(self, identifier: str, data: bytes) -> None:
        self.index.append((identifier, len(self.table), self.offset, len(data)))
        self.open.append(data)
        self.offset += len(data)
        if self.offset >= self.frame_bytes:
            self.end_frame()

    def end_frame(self) -> None:
        if self.open:
            packed = self.packer.compress(b"".join(self.open))
            self.frames.append(packed)
            self.table.append((len(packed), self.offset))
            self.size += len(packed)
            self.open, self.offset = [], 0

    def finish(self) -> bytes:
        self.end_frame()
        entries = b"".join(struct.pack("<II", *x) for x in self.table)
        footer = struct.pack("<IBI", len(self.table), 0, SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer


class BundleReader:
    """Random access to the frames of a bundle by its seek table."""

    def __init__(self, uri: str):
        files, path = fs.FileSystem.from_uri(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        n, descriptor, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{uri} has no seek table")
        width = 12 if descriptor & 0x80 else 8
        table = self.file.read_at(n * width, size - 9 - n * width)
        self.places, at = [], 0
        for k in range(n):
            packed, full = struct.unpack_from("<II", table, k * width)
            self.places.append((at, packed, full))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed, full = self.places[number]
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at), max_output_size=full)


def _write(folder: str, frame_bytes: int, bundle_bytes: int):
    def run(batches):
        writer = BundleWriter(frame_bytes)

        def close():
            uri = f"{folder}/bundle-{uuid.uuid4().hex}.warc.zst"
            data = writer.finish()
            files, path = fs.FileSystem.from_uri(uri)
            files.create_dir(path.rpartition("/")[0], recursive=True)
            with files.open_output_stream(path, compression=None) as out:
                out.write(data)
            ids, frames, offsets, lengths = zip(*writer.index)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip((ids, [uri] * len(ids), frames, offsets, lengths), _INDEX)], schema=_INDEX
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "sha1", "copy", "keeper", "shared")]
            for page_id, url, html, sha1, copy, keeper, shared in zip(*columns):
                payload = (html or "").encode("utf-8")
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                identifier = record_id(page_id, digest, copy)
                response = not shared or (page_id == keeper and copy == 1)
                refers_to = None if response else record_id(keeper, digest, 1)
                writer.add(identifier, record(identifier, url, payload, digest, refers_to))
                if writer.size >= bundle_bytes:
                    yield close()
                    writer = BundleWriter(frame_bytes)
        if writer.index:
            yield close()

    return run


def write_bundles(
    pages: DataFrame, min_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES
) -> DataFrame:
    """Writes a record per row of ``pages`` (``page_id, url, html``); the index, as a written table."""
    spark = pages.sparkSession
    small_batches(spark)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = (
        pick(pages, page_id="page_id", url="url", html="html")
        .withColumn("page_id", F.col("page_id").cast("bigint"))
        .withColumn("sha1", F.sha1(payload))
        # The id as text, so that null is a plain key and one shuffle serves the join and the window.
        .withColumn("key", F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    )
    slim = rows.select("page_id", "key", "sha1", F.octet_length(F.coalesce("html", F.lit(""))).alias("n"))
    keepers = (
        slim.groupBy("sha1")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("c"), F.max("n").alias("n"))
        .where((F.col("c") > 1) & (F.col("n") >= min_bytes))
        .select("sha1", "keeper", F.lit(True).alias("shared"))
    )
    decided = (
        slim.select("key", "sha1")
        .distinct()
        .join(keepers, "sha1", "left")
        .select("key", "sha1", "keeper", F.coalesce("shared", F.lit(False)).alias("shared"))
    )
    same = Window.partitionBy("key", "sha1").orderBy("url")
    placed = rows.join(decided, ["key", "sha1"]).withColumn("copy", F.row_number().over(same))
    ready = placed.select("page_id", "url", "html", "sha1", "copy", "keeper", "shared")
    folder = shared_folder(spark, "warc")
    return cut_lineage(ready.mapInArrow(_write(folder, frame_bytes, bundle_bytes), _INDEX_DDL), "warc-index")


_READ = pa.schema(
    [
        ("record_id", pa.string()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _read(batches):
    uri, bundle = None, None
    for batch in batches:
        out: list[tuple] = []
        for name, frame, records in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "records"))):
            if name != uri:
                uri, bundle = name, BundleReader(name)
            data = bundle.frame(frame)
            for r in sorted(records, key=lambda r: r["offset"]):
                found = parse(data[r["offset"] : r["offset"] + r["length"]])
                identifier = found["warc-record-id"].strip("<>")
                if identifier != r["record_id"]:
                    raise ValueError(f"the index has {r['record_id']} where {name} has {identifier}")
                digest = found["warc-payload-digest"].removeprefix("sha1:")
                revisit = found["warc-type"] == "revisit"
                if not revisit and base64.b32encode(hashlib.sha1(found["payload"]).digest()).decode() != digest:
                    raise ValueError(f"damaged payload of {identifier} in {name}")
                out.append(
                    (
                        identifier,
                        page_of(identifier),
                        found["warc-target-uri"],
                        int(found["x-payload-length"]),
                        digest,
                        found["warc-type"],
                        page_of(found["warc-refers-to"].strip("<>")) if revisit else None,
                        None if revisit else found["payload"],
                    )
                )
            if len(out) >= 1000:
                yield _batch(out)
                out = []
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in _READ]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _READ)], schema=_READ)


def read_bundles(spark: SparkSession, index: DataFrame) -> DataFrame:
    """The records that ``index`` lists: ``record_id, page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload`` (null for revisits). Each frame is fetched once; payloads are checked against digests."""
    small_batches(spark)
    frames = index.groupBy("bundle", "frame").agg(F.collect_list(F.struct("record_id", "offset", "length")).alias("records"))
    return frames.mapInArrow(
        _read,
        "record_id string, page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint, payload binary",
    )
