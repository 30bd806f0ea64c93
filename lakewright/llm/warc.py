"""WARC records in seekable Zstandard bundles.

A bundle is a .warc.zst file: a run of independent zstd frames, each of a few
records, followed by the seek table of the zstd seekable format in a skippable
frame (frame sizes, frame count, descriptor, magic number). An index maps each
record to its bundle, its frame, and its place within the frame's content, so
one record is read by decompressing one frame. Any zstd reader can read a bundle
as a plain WARC file.

Tasks write the bundles into the shared folder (pyarrow's file systems: local,
HDFS, S3, GCS), under names of their own attempt; the index, a table that Spark
commits, says which of them count, so a task that is run again leaves files
that nothing refers to. Bundles are read back by Spark's binaryFile reader,
front to back, by their seek tables. A response's block is an HTTP head and the payload.

Of records with equal payloads of at least REVISIT_BYTES bytes, the smallest id
is the response; the others are revisits that carry the payload's digest and
length and name the response. Smaller payloads are all responses. Reading checks a response's
payload against its digest; verify() holds each revisit against the response it names.

A null payload is empty. A null url is written as an
empty target. Rows that repeat the smallest
id of their payload are responses each, as are rows with a null id. Very long
payloads fill a frame of their own. Empty tables give no bundle.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import join_groups, materialise, shared_dir, small_or_shuffled

REVISIT_BYTES = 100
FRAME_BYTES, BUNDLE_BYTES = 128 << 10, 8 << 20
#: Fixed values of the formats.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

BUNDLE = "name string, bytes long, entries array<struct<record_id: long, record_type: string, payload_digest: string, frame: int, offset: long, length: long>>"


def plan_records(df: DataFrame, id_col: str, payload_col: str, url_col: str | None) -> DataFrame:
    """record_id, url, payload, payload_bytes, payload_digest, record_type, refers_to."""
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    rows = df.select(F.col(id_col).cast("long").alias("record_id"), (F.col(url_col) if url_col else F.lit("")).alias("url"), payload.alias("payload"))
    size, digest = F.octet_length("payload").cast("long"), F.sha2("payload", 256)
    keys = materialise(rows.select("record_id", size.alias("payload_bytes"), digest.alias("payload_digest")), "warc-keys")
    first = keys.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest").agg(F.min("record_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    # only groups of two or more have revisits; their rows are told from the rest by id and digest
    first = materialise(first, "warc-firsts")
    same = join_groups(keys.where(F.col("payload_bytes") >= REVISIT_BYTES), first, ["payload_digest"], "n").select(F.col("record_id").alias("__id"), F.col("payload_digest").alias("__digest"), "first_id").distinct()
    sized = rows.withColumn("payload_bytes", size).withColumn("payload_digest", digest)
    joined = sized.join(same, sized["record_id"].eqNullSafe(same["__id"]) & (sized["payload_digest"] == same["__digest"]), "left").drop("__id", "__digest")
    revisit = F.col("first_id").isNotNull() & (F.col("record_id") != F.col("first_id"))
    return joined.select(
        "record_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def uri(record_id: int | None, payload_digest: str) -> str:
    return f"urn:record:{'null' if record_id is None else record_id}:{payload_digest[:16]}"


def record(row: dict) -> bytes:
    """One WARC/1.1 record; a revisit has no block."""
    revisit = row["record_type"] == "revisit"
    block = b"" if revisit else HTTP.format(len(row["payload"])).encode() + row["payload"]
    url = (row["url"] or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <{uri(row['record_id'], row['payload_digest'])}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
        f"X-Payload-Length: {row['payload_bytes']}",
        f"X-Source-ID: {'' if row['record_id'] is None else row['record_id']}",
    ]
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{uri(row['refers_to'], row['payload_digest'])}>", f"X-Refers-To-Source-ID: {row['refers_to']}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and payload (without the HTTP head) of the record at a place, and the place behind it."""
    head_end = data.index(b"\r\n\r\n", at)
    lines = data[at:head_end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC/1.1 record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    end = head_end + 4 + int(fields["Content-Length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("record doesn't end where its length says")
    _, _, payload = data[head_end + 4 : end].partition(b"\r\n\r\n")
    return fields, payload, end + 4


class BundleWriter:
    """Frames of one bundle and the places of the records in them."""

    def __init__(self, name: str):
        self.name, self.frames, self.entries, self.open, self.size = name, [], [], [], 0
        self.compressor = zstandard.ZstdCompressor(level=3)

    def add(self, row: dict) -> None:
        data = record(row)
        offset = sum(map(len, self.open))
        self.entries.append({"record_id": row["record_id"], "record_type": row["record_type"], "payload_digest": row["payload_digest"], "frame": len(self.frames), "offset": offset, "length": len(data)})
        self.open.append(data)
        if offset + len(data) >= FRAME_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.open:
            plain = b"".join(self.open)
            packed = self.compressor.compress(plain)
            self.frames.append((packed, len(plain)))
            self.size += len(packed)
            self.open = []

    def close(self) -> bytes:
        self.flush()
        sizes = b"".join(struct.pack("<II", len(packed), plain) for packed, plain in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        return b"".join(p for p, _ in self.frames) + struct.pack("<II", SKIPPABLE_MAGIC, len(sizes) + len(footer)) + sizes + footer


class BundleReader:
    """Random access to a bundle by its seek table."""

    def __init__(self, data: bytes):
        n, descriptor, magic = struct.unpack("<IBI", data[-9:])
        if magic != SEEKABLE_MAGIC or descriptor:
            raise ValueError("no seek table")
        table = np.frombuffer(data[-9 - 8 * n : -9], "<u4").reshape(n, 2).astype(np.int64)
        self.data, self.sizes = data, table
        self.starts = np.append(0, np.cumsum(table[:, 0]))
        self.last: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self.last[0] != k:
            packed = self.data[self.starts[k] : self.starts[k + 1]]
            self.last = (k, zstandard.ZstdDecompressor().decompress(packed, max_output_size=int(self.sizes[k, 1])))
        return self.last[1]

    def read(self, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
        return parse(self.frame(frame), offset)[:2]

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """All records, frame by frame."""
        for k in range(len(self.sizes)):
            plain, at = self.frame(k), 0
            while at < len(plain):
                head, payload, at = parse(plain, at)
                yield head, payload


@dataclass(frozen=True)
class Bundles:
    """Written bundles: their folder, and the table of those that count (name, bytes, entries: the index of their records)."""

    folder: str
    table: DataFrame

    def index(self) -> DataFrame:
        """name, record_id, record_type, payload_digest, frame, offset, length: where each record is."""
        return self.table.select("name", F.inline("entries"))


def _store(folder: str, name: str, data: bytes) -> None:
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/{name}", compression=None) as f:  # else a .zst name is compressed again
        f.write(data)


def write_bundles(df: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str | None = "url", folder: str | None = None) -> Bundles:
    """Write .warc.zst files into a folder that driver and executors share (a new one in the shared folder, if none is given)."""
    planned = plan_records(df, id_col, payload_col, url_col)
    folder = folder or f"{shared_dir(df.sparkSession)}/warc-{uuid.uuid4().hex}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # of this attempt alone: an attempt that is lost or run twice writes beside it
        part, mine, k = TaskContext.get().partitionId(), uuid.uuid4().hex[:12], 0

        def closed(writer: BundleWriter) -> pd.DataFrame:
            data = writer.close()
            _store(folder, writer.name, data)
            return pd.DataFrame({"name": [writer.name], "bytes": [len(data)], "entries": [writer.entries]})

        writer = BundleWriter(f"part-{part:06d}-{mine}-{k:04d}.warc.zst")
        for batch in batches:
            for row in batch.to_dict("records"):
                row = {c: None if v is None or v is pd.NA or v != v else v for c, v in row.items()}
                for c in ("record_id", "refers_to", "payload_bytes"):
                    row[c] = None if row[c] is None else int(row[c])
                writer.add(row)
                if writer.size >= BUNDLE_BYTES:
                    yield closed(writer)
                    k += 1
                    writer = BundleWriter(f"part-{part:06d}-{mine}-{k:04d}.warc.zst")
        if writer.entries:
            yield closed(writer)

    return Bundles(folder, materialise(planned.mapInPandas(run, BUNDLE), "warc-index"))


_READ = "id string, payload_bytes long, payload_digest string, record_type string, refers string, payload binary"


def read_bundles(bundles: Bundles) -> DataFrame:
    """Every record of the bundles that count, read from its file: record_id, payload_bytes, payload_digest, record_type, refers_to, payload (null for revisits)."""
    spark: SparkSession = bundles.table.sparkSession
    names = small_or_shuffled(bundles.table.select("name"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["id", "payload_bytes", "payload_digest", "record_type", "refers", "payload"]
        for batch in batches:
            for data in batch["content"]:
                out = []
                for head, payload in BundleReader(data).records():
                    kind, digest, size = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha256:"), int(head["X-Payload-Length"])
                    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
                        raise ValueError(f"payload of {head['WARC-Record-ID']} isn't what its digest says")
                    out.append((head["X-Source-ID"] or None, size, digest, kind, head.get("X-Refers-To-Source-ID"), payload if kind == "response" else None))
                    if len(out) >= 500:
                        yield pd.DataFrame(out, columns=columns)
                        out = []
                if out:
                    yield pd.DataFrame(out, columns=columns)

    if bundles.table.isEmpty():  # nothing was written, so there is no folder
        rows = spark.createDataFrame([], T._parse_datatype_string(_READ))
    else:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(bundles.folder)
        files = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content").join(names, "name", "left_semi")
        rows = files.select("content").mapInPandas(run, _READ)
    return rows.select(F.col("id").cast("long").alias("record_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers").cast("long").alias("refers_to"), "payload")


def verify(read: DataFrame) -> DataFrame:
    """What was read without its payloads, written; an error if a revisit's digest and length aren't those of the response it names."""
    rows = materialise(read.drop("payload"), "warc-read")
    facts = ["refers_to", "payload_bytes", "payload_digest"]
    wanted = rows.where("record_type = 'revisit'").select(*facts).distinct()
    lost = wanted.join(rows.where("record_type = 'response'").withColumn("refers_to", F.col("record_id")).select(*facts), facts, "left_anti")
    if not lost.isEmpty():
        raise ValueError(f"a revisit isn't what its response is: {lost.first()}")
    return rows
