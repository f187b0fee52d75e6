"""WARC archives in Zstandard: one frame per record behind a leading skippable
frame that holds the dictionary.

``write`` makes a record per page. Of equal payloads of at least ``least``
bytes the one with the smallest id is a response, the others are revisits
without payload; smaller ones are all responses. Each task sorts its pages by
id and rolls archives over at ``roll`` compressed bytes; an archive gets a
dictionary of its own, trained on its first payloads. Names depend on the
partition only and a finished file is moved into place, so a task that runs
again replaces its files with equal ones. ``read`` decodes frame by frame and
checks version, headers, lengths, end marks and digests; a wrong one raises.

The archive folder has to be one that workers can write through pyarrow's
file systems (file, hdfs, s3, gs); reading goes through Spark.

Defined results: a null page counts as empty; rows without id are responses;
rows that share the smallest id of equal payloads are all responses. Other
columns of the pages are not stored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.arrays import batches

# fixed values of the formats
DICT_FRAME = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2025-01-01T00:00:00Z"
SALTS = 16


def planned(pages: DataFrame, least: int) -> DataFrame:
    """(id, url, html, digest, size, refers_to). Only digests are grouped; the
    rows of a frequent payload are spread over ``SALTS`` parts of the join."""
    own = pages.select(F.col("page_id").cast("bigint").alias("id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    own = own.withColumns({"digest": F.sha2("html", 256), "size": F.octet_length("html").cast("bigint")})
    first = own.where(F.col("size") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    own = own.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    out = own.join(first, ["digest", "salt"], "left")
    return out.select("id", "url", "html", "digest", "size", F.when(F.col("id") != F.col("first"), F.col("first")).alias("refers_to"))


def record(page_id, url, html: str, digest: str, size: int, refers_to) -> bytes:
    payload = html.encode("utf-8") if refers_to is None else b""
    block = HTTP_HEAD + payload
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or "", safe="%/:=&?~#+!$,;'@()*[]")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Payload-Length", str(size)),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", SAME_PAYLOAD)]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def dictionary(samples: list[bytes], size: int = 16 << 10) -> bytes:
    """A dictionary from an archive's first records; empty if they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if len(samples) >= 16 else b""
    except zstandard.ZstdError:
        return b""


def archive(records: list[bytes], level: int = 3) -> Iterator[bytes]:
    """The dictionary frame, then a frame for every record."""
    raw = dictionary([r[:4096] for r in records[:400]])
    yield struct.pack("<II", DICT_FRAME, len(raw)) + raw
    known = zstandard.ZstdCompressionDict(raw) if raw else None
    press = zstandard.ZstdCompressor(level=level, dict_data=known, write_content_size=True, write_checksum=True)
    for r in records:
        yield press.compress(r)


def write(pages: DataFrame, path: str, *, least: int = 100, roll: int = 8 << 20) -> None:
    """Archives of all pages below ``path``."""

    def run(it):
        fs, folder = pyarrow.fs.FileSystem.from_uri(path)
        fs.create_dir(folder, recursive=True)
        task = TaskContext.get()
        part, attempt, number = task.partitionId(), task.taskAttemptId(), 0

        def save(records):
            name = f"{folder}/part-{part:06d}-{number:06d}.warc.zst"
            with fs.open_output_stream(f"{name}.{attempt}") as f:
                for frame in archive(records):
                    f.write(frame)
            fs.move(f"{name}.{attempt}", name)

        records, size, count = [], 0, 0
        for b in batches(it):
            for row in zip(*(b.column(c).to_pylist() for c in ("id", "url", "html", "digest", "size", "refers_to"))):
                records.append(record(*row))
                size += len(records[-1])
                count += 1
                if size >= 4 * roll:  # text shrinks to a quarter or less
                    save(records)
                    records, size, number = [], 0, number + 1
        if records:
            save(records)
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], names=["n"])

    fs, folder = pyarrow.fs.FileSystem.from_uri(path)
    fs.create_dir(folder, recursive=True)
    rows = planned(pages, least).sortWithinPartitions("id", "url", "digest")
    rows.mapInArrow(run, "n long").agg(F.sum("n")).collect()


def frames(data: bytes) -> Iterator[bytes]:
    """The decoded records of an archive."""
    magic, size = struct.unpack_from("<II", data, 0)
    if magic != DICT_FRAME or len(data) < 8 + size:
        raise ValueError("an archive starts with a dictionary frame")
    raw = data[8 : 8 + size]
    if raw[:4] == ZSTD_MAGIC:  # the dictionary may be compressed itself
        raw = zstandard.ZstdDecompressor().decompress(raw)
    known = zstandard.ZstdCompressionDict(raw) if raw else None
    open_ = zstandard.ZstdDecompressor(dict_data=known)
    at, view = 8 + size, memoryview(data)
    while at < len(data):
        one, out = open_.decompressobj(), []
        while not one.eof:
            piece = view[at : at + 65536]
            if not len(piece):
                raise ValueError("the last frame is cut off")
            out.append(one.decompress(piece))
            at += len(piece)
        at -= len(one.unused_data)
        yield b"".join(out)


def parsed(raw: bytes) -> tuple:
    """(id, size, digest, type, refers_to, payload) of a record, checked."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or lines[0] != VERSION:
        raise ValueError("not a WARC record")
    fields = dict(x.decode().split(": ", 1) for x in lines[1:])
    missing = {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "WARC-Payload-Digest"} - fields.keys()
    if missing:
        raise ValueError(f"headers missing: {sorted(missing)}")
    n = int(fields["Content-Length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError("the block is not as long as its header says")
    block, digest = rest[:n], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    payload = block.partition(b"\r\n\r\n")[2]
    size, kind = int(fields["X-Payload-Length"]), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("the payload does not match its length and digest")
    number = lambda x: int(x.removeprefix("<urn:page:").rstrip(">")) if x and x != "<urn:page:>" else None
    return number(fields["WARC-Record-ID"]), size, digest, kind, number(fields.get("WARC-Refers-To")), payload


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every
    record, with its payload if asked for."""
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    n = 6 if payloads else 5

    def run(it):
        for b in batches(it):
            for content in b.column("content"):
                rows = []
                for raw in frames(content.as_py()):
                    rows.append(parsed(raw)[:n])
                    if len(rows) == (64 if payloads else 4096):
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names[:n])
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names[:n])

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads
    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.warc.zst").load(path)
    return files.select("content").mapInArrow(run, schema)
