"""WARC archives: writing, gzip normalising with a sidecar index, reading back.

Each task writes whole-file gzip streams (one member for many records), as careless
tools do.  The normaliser inflates such a stream once, gives every record a gzip
member of its own and writes a sidecar ``.idx`` file with the place of each member,
so that single records can be read.  Files go to a folder that all executors share,
under names that depend on the partition alone, each moved into place when complete:
a task that is run again overwrites what it wrote before.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import measured, shared_dir, stable, table

#: Payloads shorter than this are never revisits.
LEAST = 1000
#: Uncompressed bytes after which a task begins its next archive.
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 20
LEVEL = 4
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


@contextmanager
def _written(uri: str):
    """A file that appears under its name only when it is complete."""
    fs, path = _store(uri)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part) as out:
        yield out
    fs.move(part, path)


def record(kind: str, record_id: str, url: str, digest: str, payload: bytes, refers_to: str | None = None) -> bytes:
    """One WARC/1.0 record.  A revisit holds the HTTP head only, whose length field
    is that of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = [
        "WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}", "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])}


def inflated(stream) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, read once."""
    z = zlib.decompressobj(31)
    while data := stream.read(CHUNK):
        while data:
            if out := z.decompress(data):
                yield out
            data = z.unused_data
            if z.eof:
                z = zlib.decompressobj(31)
    if out := z.flush():
        yield out


def records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The raw records of an inflated stream, one at a time in memory."""
    held = bytearray()
    size = None
    for chunk in chunks:
        held += chunk
        while True:
            if size is None:
                at = held.find(b"\r\n\r\n")
                if at < 0:
                    break
                size = at + 4 + int(_fields(bytes(held[:at]))["content-length"]) + 4
            if len(held) < size:
                break
            yield bytes(held[:size])
            del held[:size]
            size = None
    if held.strip():
        raise ValueError("the archive ends within a record")


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of a record."""
    at = raw.index(b"\r\n\r\n")
    fields = _fields(raw[:at])
    block = raw[at + 4 : at + 4 + int(fields["content-length"])]
    end = block.index(b"\r\n\r\n")
    return fields, _fields(block[:end]), block[end + 4 :]


def decided(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, digest, refers_to``: which record stands for a payload.

    Of equal payloads (null: empty) of ``LEAST`` bytes or more, the one with the
    largest page_id is the response; rows that tie with it are responses too, and so
    are rows without page_id.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.sha1("html"))
    many = rows.where(F.octet_length("html") >= LEAST).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    many = measured(stable(many), 128)
    return rows.join(many, "digest", "left").select("page_id", "url", "html", "digest", F.when(F.col("page_id") != F.col("first"), F.col("first")).alias("refers_to"))


def _record_id(page_id) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}"


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes whole-file gzip archives; ``file`` of each, after it is in place.

    ``pages`` has the columns of :func:`decided`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, done = TaskContext.get().partitionId(), 0, []
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        row = next(rows, None)
        while row:
            uri = f"{folder}/raw-{part:06d}-{number:04d}.warc.gz"
            number += 1
            with _written(uri) as out:
                z, size = zlib.compressobj(1, zlib.DEFLATED, 31), 0
                while row and size < ARCHIVE_BYTES:
                    page_id, url, html, digest, refers_to = row
                    kind = "response" if refers_to is None else "revisit"
                    data = record(kind, _record_id(page_id), f"{url or ''}".replace("\r", "").replace("\n", ""), digest, html.encode("utf-8", "surrogatepass"), None if refers_to is None else f"urn:page:{refers_to}")
                    data = data.replace(b"\r\n", f"\r\nX-Page-Id: {'' if page_id is None else page_id}\r\n".encode(), 1)
                    out.write(z.compress(data))
                    size += len(data)
                    row = next(rows, None)
                out.write(z.flush())
            done.append(uri)
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], ["file"])

    return pages.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(run, "file string")


def normalise(files: DataFrame) -> DataFrame:
    """Rewrites each archive record by record; ``file, index`` of the new ones.

    The sidecar has a line ``offset length type record-id`` for every member.  One
    record at a time is held in memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_files = []
            for uri in batch.column(0).to_pylist():
                new = uri.replace("/raw-", "/norm-")
                fs, path = _store(uri)
                lines, at = [], 0
                with fs.open_input_stream(path, compression=None) as stream, _written(new) as out:
                    for raw in records(inflated(stream)):
                        fields = _fields(raw[: raw.index(b"\r\n\r\n")])
                        z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = z.compress(raw) + z.flush()
                        out.write(member)
                        lines.append(f"{at} {len(member)} {fields['warc-type']} {fields['warc-record-id']}\n")
                        at += len(member)
                with _written(f"{new}.idx") as out:
                    out.write("".join(lines).encode())
                out_files.append(new)
            yield pa.RecordBatch.from_arrays([pa.array(out_files, pa.string()), pa.array([f"{f}.idx" for f in out_files], pa.string())], ["file", "index"])

    return files.mapInArrow(run, "file string, index string")


SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(archives: DataFrame) -> DataFrame:
    """The records of normalised archives, each by its place in the sidecar index.

    The payload of a response is hashed again and must agree with its digest.
    """
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, path = _store(uri)
                with fs.open_input_stream(_store(index)[1], compression=None) as f:
                    lines = f.read().decode().splitlines()
                out: list[list] = [[] for _ in range(5)]
                with fs.open_input_file(path) as f:
                    for line in lines:
                        offset, length, kind, record_id = line.split(" ")
                        fields, http, payload = parse(zlib.decompress(f.read_at(int(length), int(offset)), 31))
                        digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                        if fields["warc-type"] != kind or fields["warc-record-id"] != record_id or kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"{uri}: the record at {offset} is not what the index or its digest says")
                        to = fields.get("warc-refers-to", "").strip("<>").removeprefix("urn:page:")
                        page = fields.get("x-page-id", "")
                        for c, v in zip(out, (int(page) if page else None, int(http["content-length"]), digest, kind, int(to) if to else None)):
                            c.append(v)
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], [f.split()[0] for f in SCHEMA.split(", ")])

    return archives.mapInArrow(run, SCHEMA)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes all pages to archives in ``folder`` (default: a new one beside the
    checkpoints), normalises these and reads them back: a row per page."""
    folder = folder or f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    fs, path = _store(folder)
    fs.create_dir(path, recursive=True)
    files = stable(write(decided(pages), folder))
    spread = max(1, files.count())
    archives = stable(normalise(files.repartition(spread)))
    return read(archives)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


