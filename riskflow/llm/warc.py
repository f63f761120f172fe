"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding a group of records, closed by the public
seek table in a skippable frame. The index maps each record to its bundle, frame and offset in the frame, so
one record is read with one seek. Equal payloads are stored once: the record with the smallest page_id is
the response, the others revisit it and state the payload's digest and length.

Writing tasks can be lost or run twice: an attempt writes files under names of its own, and only the index
rows of the attempt that Spark commits name files. Null pages have the empty payload; equal payloads of rows
with one page_id are all responses. Rows without an id count after all others; if no equal payload has an id,
they are responses. An empty table gives no bundle and an empty index. Only ``page_id``, ``url`` and ``html``
are read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.shares import join_groups
from riskflow.llm.tables import store, text_of
from riskflow.session import scratch_dir

# Fixed values of the seekable format: magic numbers of the skippable frame and of the footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
# Fixed values of the WARC standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

#: Full bytes of a frame and of a bundle, and of what a task reads back.
FRAME_BYTES, BUNDLE_BYTES, READ_BYTES = 1 << 20, 256 << 20, 64 << 20
INDEX = "page_id {id}, record_id string, bundle string, frame int, frame_start long, frame_size long, offset long, size long"
RECORD = "page_id {id}, payload_bytes long, payload_digest string, record_type string, refers_to {id}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _file(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def record_id(bundle: str, number: int) -> str:
    """Identifier of a bundle's record; rows that repeat an id, or have none, get different ones."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{bundle}:{number}')}>"


def make_record(name: str, page_id: object, url: str, payload: bytes | None, digest: str, length: int, refers_to: object, refers_url: str | None = None) -> bytes:
    """One WARC/1.1 record; without a payload it revisits page ``refers_to``, and its block is the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = head + (payload or b"") if payload is not None else head
    url, refers_url = ((u or "about:blank").replace("\r", " ").replace("\n", " ") for u in (url, refers_url))
    fields = [("WARC-Type", "response" if payload is not None else "revisit"), ("WARC-Record-ID", name),
              ("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("WARC-Page-ID", "" if page_id is None else page_id)]
    if payload is None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To-Target-URI", refers_url), ("WARC-Refers-To-Page-ID", refers_to)]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{lines}\r\n".encode("utf-8", "replace") + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """WARC fields, HTTP head and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no WARC record: {version[:40]!r}")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


class BundleWriter:
    """Frames of grouped records in one file; ``close`` appends the seek table."""

    def __init__(self, uri: str, frame_bytes: int) -> None:
        self.uri, self.frame_bytes = uri, frame_bytes
        fs, path = _file(uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.out, self.compressor = fs.open_output_stream(path, compression=None), zstandard.ZstdCompressor(level=3)
        self.at, self.sizes, self.open, self.filled, self.index = 0, [], [], 0, []

    def next_id(self) -> str:
        return record_id(self.uri.rpartition("/")[2], len(self.index))

    def add(self, key: object, record: bytes) -> None:
        """Append the record named by ``next_id``."""
        name = self.next_id()
        if self.filled and self.filled + len(record) > self.frame_bytes:
            self.flush()
        self.index.append([key, name, self.uri, len(self.sizes), self.at, 0, self.filled, len(record)])
        self.open.append(record)
        self.filled += len(record)

    def flush(self) -> None:
        if self.open:
            packed = self.compressor.compress(b"".join(self.open))
            self.out.write(packed)
            for row in reversed(self.index):
                if row[3] != len(self.sizes):
                    break
                row[5] = len(packed)
            self.sizes.append((len(packed), self.filled))
            self.at += len(packed)
            self.open, self.filled = [], 0

    def close(self) -> list[list]:
        self.flush()
        body = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.out.close()
        return self.index


def read_seek_table(file: pyarrow.NativeFile) -> list[tuple[int, int, int]]:
    """Start, compressed and full size of each frame, from the end of the file."""
    size = file.size()
    count, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    table, at = file.read_at(8 * count, size - 9 - 8 * count), 0
    frames = []
    for packed, full in struct.iter_unpack("<II", table):
        frames.append((at, packed, full))
        at += packed
    return frames


def _first_of_equal(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, refers_to, refers_url``; null in the last marks responses. Payloads are equal by SHA-256 and length."""
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), text_of("html").alias("html"))
    rows = rows.withColumn("key", F.unhex(F.sha2("html", 256)))
    first = rows.groupBy("key").agg(F.min("page_id").alias("first_id"), F.min_by("url", "page_id").alias("first_url"), F.count("*").alias("n")).where("n > 1")
    found = join_groups(rows, store(first, "payloads"), "key", "n", "page_id", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return found.select("page_id", "url", F.when(~revisit, F.col("html")).alias("html"), F.when(revisit, F.col("first_id")).alias("refers_to"), F.when(revisit, F.col("first_url")).alias("refers_url"),
                        F.octet_length("html").cast("long").alias("length"), F.sha1("html").alias("digest"))


def write_bundles(pages: DataFrame, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Archive every row and give the committed index; a bundle closes at ``bundle_bytes`` of records."""
    folder = scratch_dir(pages.sparkSession, "warc")
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in INDEX.split(", ")]
        writer, filled = None, 0
        for frame in frames:
            for row in frame.itertuples(index=False):
                page_id, refers_to = (None if pd.isna(x) else x for x in (row.page_id, row.refers_to))
                payload = None if refers_to is not None else row.html.encode("utf-8", "replace")
                digest = base64.b32encode(bytes.fromhex(row.digest)).decode()
                if writer is not None and filled + (len(payload) if payload else 0) > bundle_bytes:
                    yield pd.DataFrame(writer.close(), columns=names)
                    writer, filled = None, 0
                if writer is None:
                    writer = BundleWriter(f"{folder}/{uuid.uuid4().hex}.warc.zst", frame_bytes)
                record = make_record(writer.next_id(), page_id, row.url, payload, digest, row.length, refers_to, row.refers_url)
                writer.add(page_id, record)
                filled += len(record)
        if writer is not None:
            yield pd.DataFrame(writer.close(), columns=names)

    # ids as text on the way through pandas, so that nulls and any id type come through unchanged
    read = _first_of_equal(pages).withColumns({"page_id": F.col("page_id").cast("string"), "refers_to": F.col("refers_to").cast("string")})
    index = read.mapInPandas(run, INDEX.format(id="string"))
    return store(index.withColumn("page_id", F.col("page_id").cast(kind)), "warc-index")


def read_bundles(index: DataFrame) -> DataFrame:
    """Every record of the index, read back frame by frame: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Length and digest of a response are taken from the payload read; those of a revisit are stated in its record.
    """
    kind = index.schema["page_id"].dataType.simpleString()
    names = [c.split()[0] for c in RECORD.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decompressor = zstandard.ZstdDecompressor()
        for frame in frames:
            for bundle, in_bundle in frame.groupby("bundle", sort=False):
                fs, path = _file(bundle)
                with fs.open_input_file(path) as file:
                    table = read_seek_table(file)
                    for number, rows in in_bundle.groupby("frame", sort=False):
                        start, packed, full = table[number]
                        data = decompressor.decompress(file.read_at(packed, start), max_output_size=full)
                        yield pd.DataFrame([_read(data[r.offset:r.offset + r.size]) for r in rows.itertuples()], columns=names)

    # The index is small however much it points to, so its own size says nothing about the number of tasks.
    total = index.agg(F.sum("size")).first()[0] or 0
    dealt = index.repartition(max(1, -(-total // READ_BYTES)), "bundle", "frame").select("bundle", "frame", "offset", "size")
    return dealt.mapInPandas(run, RECORD.format(id="string")).withColumns(
        {"page_id": F.col("page_id").cast(kind), "refers_to": F.col("refers_to").cast(kind)})


def _read(raw: bytes) -> tuple:
    fields, http, payload = parse_record(raw)
    page_id = fields["WARC-Page-ID"] or None
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "revisit":
        length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        return page_id, length, stated, "revisit", fields["WARC-Refers-To-Page-ID"]
    digest = payload_digest(payload)
    if digest != stated:
        raise ValueError(f"record {page_id} does not have the payload that it states")
    return page_id, len(payload), digest, "response", None


def archive_round_trip(pages: DataFrame) -> DataFrame:
    return read_bundles(write_bundles(pages))
