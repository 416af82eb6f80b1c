"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames with a handful of records each, closed by a
seek table in a skippable frame. The index written beside the bundles maps every record
identifier to its frame and its place inside the frame, so one record costs one small read.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from zstandard import ZstdCompressor, ZstdDecompressor

from linkrank.plans import Scratch, heaviest, salted_join

FRAME_BYTES = 1 << 18  # uncompressed, at least; a larger record is a frame of its own
BUNDLE_BYTES = 1 << 28  # compressed; then the next bundle begins
FRAMES_AT_ONCE = 64  # frames a reading task takes as one piece of work
RUNS_PER_TASK = 8  # of so many frames, where there are more than cores
LEVEL = 3
REVISIT_FROM = 1_000  # payloads of at least so many bytes are stored once

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
# Fixed values of the archive format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

INDEX = "record_id long, bundle string, frame int, frame_offset long, frame_size int, place long, size long"
RECORDS = (
    "record_id long, record_type string, refers_to long, url string, payload_bytes long,"
    " payload_digest string, payload binary"
)


def planned_records(
    pages: DataFrame, id: str = "page_id", url: str = "url", body: str = "html",
    revisit_from: int = REVISIT_FROM,
) -> DataFrame:
    """``record_id, url, payload, digest, refers_to`` for every row of ``pages``.

    Of rows with equal payloads of ``revisit_from`` bytes or more, the one with the largest id is
    the response and the others refer to it. Rows that share this largest id are all responses, and so
    are rows of a group without any id. A null body is an empty payload.
    """
    payload = F.coalesce(F.col(body).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id).cast("long").alias("record_id"), F.col(url).cast("string").alias("url"),
        payload.alias("payload"), F.sha1(payload).alias("digest"),
    )
    scratch = Scratch(pages.sparkSession)
    groups = scratch.write(
        rows.where(F.octet_length("payload") >= revisit_from)
        .groupBy("digest")
        .agg(F.max("record_id").alias("response_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1"),
        "copies",
    )
    joined = salted_join(
        rows, groups.drop("n"), "digest", heaviest(groups, "digest", "n"), "left"
    )
    return joined.select(
        "record_id", "url", "payload", "digest",
        F.when(F.col("record_id").isNull() | (F.col("record_id") != F.col("response_id")),
               F.col("response_id")).alias("refers_to"),
    )


def _uri(record_id: int | None) -> str:
    return f"<urn:x-page:{'none' if record_id is None else record_id}>"


def _one_line(value: str | None) -> str:
    """A header value: line breaks and control characters would end it, so they are escaped."""
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", value or "")


def _unescaped(value: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)


def record(
    record_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> bytes:
    """One record. A revisit keeps the HTTP header, with the payload's length, but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_uri(record_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_one_line(url)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_uri(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _number(uri: str) -> int | None:
    found = uri.rsplit(":", 1)[1].rstrip(">")
    return None if found == "none" else int(found)


def parse(data: bytes, start: int = 0) -> tuple[tuple, int]:
    """The record that begins at ``start`` as a row of RECORDS, and where the next one begins."""
    end = data.index(b"\r\n\r\n", start)
    first, *lines = data[start:end].decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"no record at byte {start}")
    fields = dict(line.split(": ", 1) for line in lines)
    body, size = end + 4, int(fields["Content-Length"])
    head_end = data.index(b"\r\n\r\n", body) + 4
    kind, refers_to = fields["WARC-Type"], fields.get("WARC-Refers-To")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload, n_bytes = None, int(re.search(rb"Content-Length: (\d+)", data[body:head_end])[1])
    if kind == "response":
        payload = data[head_end : body + size]
        if len(payload) != n_bytes or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    url = fields.get("WARC-Target-URI")
    row = (
        _number(fields["WARC-Record-ID"]), kind, refers_to and _number(refers_to),
        url if url is None else _unescaped(url), n_bytes, digest, payload,
    )
    return row, body + size + 4


class BundleWriter:
    """Writes one bundle after another; knows where in its frame every record is."""

    def __init__(self, folder: str, name: str):
        self.fs, self.folder = fs.FileSystem.from_uri(folder)
        self.name, self.n_bundles, self.out = name, 0, None
        self.buffer, self.waiting = bytearray(), []

    def add(self, record_id: int | None, data: bytes) -> Iterator[tuple]:
        if self.buffer and len(self.buffer) + len(data) > FRAME_BYTES:
            yield from self.flush()
        self.waiting.append((record_id, len(self.buffer), len(data)))
        self.buffer += data
        if self.written() >= BUNDLE_BYTES:
            yield from self.flush()
            self.close()

    def written(self) -> int:
        return self.offset if self.out else 0

    def flush(self) -> Iterator[tuple]:
        """End the frame; the index rows of its records."""
        if not self.buffer:
            return
        if self.out is None:
            self.path = f"{self.name}-{self.n_bundles}.warc.zst"
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.path}", compression=None)
            self.table, self.offset = [], 0
            self.n_bundles += 1
        frame = ZstdCompressor(level=LEVEL, write_content_size=True).compress(bytes(self.buffer))
        self.out.write(frame)
        for record_id, place, size in self.waiting:
            yield (record_id, self.path, len(self.table), self.offset, len(frame), place, size)
        self.table.append((len(frame), len(self.buffer)))
        self.offset += len(frame)
        self.buffer, self.waiting = bytearray(), []

    def close(self) -> None:
        if self.out is None:
            return
        entries = b"".join(struct.pack("<II", *sizes) for sizes in self.table)
        footer = struct.pack("<IBI", len(self.table), 0, SEEKABLE_MAGIC)
        head = struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer))
        self.out.write(head + entries + footer)
        self.out.close()
        self.out = None


def seek_table(source) -> list[tuple[int, int]]:
    """Compressed and uncompressed size of every frame, from the end of an open bundle."""
    size = source.size()
    source.seek(size - 9)
    n, descriptor, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    width = 12 if descriptor & 0x80 else 8
    source.seek(size - 9 - n * width)
    data = source.read(n * width)
    return [struct.unpack_from("<II", data, k * width) for k in range(n)]


def write_bundles(records: DataFrame, folder: str) -> DataFrame:
    """Write ``record_id, url, payload, digest, refers_to`` to bundles and an index in ``folder``.

    The folder must be one that all executors reach. Each attempt of a task has files of its own,
    and the index, committed by Spark, names only those of the attempts that counted. Returns
    the index, a row per record.
    """
    names = [field.split()[0] for field in INDEX.split(", ")]
    types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
        )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        writer = BundleWriter(folder, f"part-{part:06d}-{uuid4().hex[:12]}")
        for batch in batches:
            rows: list[tuple] = []
            for at in range(batch.num_rows):
                record_id, url, payload, digest, refers_to = (c[at].as_py() for c in batch.columns)
                rows += writer.add(record_id, record(record_id, url, payload, digest, refers_to))
            yield table(rows)
        yield table(list(writer.flush()))
        writer.close()

    columns = records.select("record_id", "url", "payload", "digest", "refers_to")
    spark = records.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop)
    columns.mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the bundles that the index of ``folder`` names, a row each.

    A revisit has no payload, but its length and digest. Work is dealt out in runs of frames,
    so one large bundle is read by many tasks: a run is 16 MB of records or more behind a row of a few
    bytes, so the number of tasks follows the runs and not the bytes of these rows. A record is
    in memory as a whole, with its frame.
    """
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    runs = index.select("bundle", F.floor(F.col("frame") / FRAMES_AT_ONCE).cast("int").alias("run"))
    runs = runs.distinct()
    cores = spark.sparkContext.defaultParallelism
    n = runs.count()
    tasks = max(min(n, cores), -(-n // RUNS_PER_TASK), 1)
    return _read(runs.repartition(tasks, "bundle", "run"), folder, None)


def lookup(spark: SparkSession, folder: str, ids: DataFrame, id: str = "record_id") -> DataFrame:
    """The records with the given ids: only the frames they are in are read."""
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    wanted = index.join(ids.select(F.col(id).cast("long").alias("record_id")).distinct(), "record_id")
    places = wanted.groupBy("bundle", "frame").agg(F.collect_set("place").alias("places"))
    return _read(places, folder, "places")


def _read(work: DataFrame, folder: str, places: str | None) -> DataFrame:
    names = [field.split()[0] for field in RECORDS.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for one in batch.to_pylist():
                with system.open_input_file(f"{root}/{one['bundle']}") as source:
                    sizes = seek_table(source)
                    first = one["frame"] if places else one["run"] * FRAMES_AT_ONCE
                    last = first + 1 if places else min(first + FRAMES_AT_ONCE, len(sizes))
                    source.seek(sum(a for a, _ in sizes[:first]))
                    for packed, size in sizes[first:last]:
                        data = ZstdDecompressor().decompress(source.read(packed), size)
                        rows, at = [], 0
                        if places:
                            rows = [parse(data, place)[0] for place in sorted(one[places])]
                        while not places and at < len(data):
                            row, at = parse(data, at)
                            rows.append(row)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                            names,
                        )

    return work.mapInArrow(read, RECORDS)


def archived(pages: DataFrame, folder: str | None = None, **names: str) -> DataFrame:
    """Write ``pages`` to bundles and read them back: RECORDS of every row.

    Repeated rows have a record each; an empty table gives no record. Other columns aren't archived.
    """
    spark = pages.sparkSession
    folder = folder or Scratch(spark).path("warc")
    write_bundles(planned_records(pages, **names), folder)
    return read_bundles(spark, folder)
