"""Deterministic sharded WARC writer and reader.

Pages are dealt into shards by ranges of their id, cut where the payload bytes say, and sorted
inside a shard. A task writes its shards in order and rolls to a new file once the compressed
size is reached. Files get temporary names of the attempt that wrote them; the manifest, which
Spark commits as a table, names the files of successful attempts only. A second job moves those
to their final names, and the manifest is published last. A lost task leaves files that nothing
refers to. The same rows give the same files, byte by byte, on any number of machines.

Of records with equal payloads of at least ``REVISIT_FROM`` bytes, that with the smallest page id
is a response and the others are revisits without payload; all smaller ones are responses.
Which pages are revisits is decided on digests alone; the decisions are sorted in just before the
pages that they are for, so payloads are shuffled once and never joined.

A NULL html is an empty payload; a NULL url has no target header. Repeated rows of one page:
the first is what it would be alone, each further one a revisit of it. Rows with a NULL id come first;
they are revisits of a page with an id if there is one, else responses.

Tasks reach the folder through Arrow's file systems (shared mounts, S3, GCS, HDFS with its
client library).
"""

from __future__ import annotations

import gzip
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill.llm.common import ship_package
from assaymill.session import materialize, scratch_path

#: Payload bytes per shard and compressed bytes per file.
SHARD_BYTES = 32 * 1024 * 1024
FILE_BYTES = 16 * 1024 * 1024
REVISIT_FROM = 100
#: Id ranges whose sizes decide the shard cuts; one small row each comes to the driver.
RANGES = 4096
WHEN = "2024-01-01T00:00:00Z"
# Names in the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ENTRY = "temporary string, name string, records long, bytes long, sha256 string"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def _record_id(page_id: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}:{copy}')}>"


def _headers(pairs: list[tuple[str, object]]) -> bytes:
    lines = [VERSION, *(f"{k}: {v}" for k, v in pairs if v is not None)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def build_record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, copy: int, when: str) -> bytes:
    """One record, compressed as a gzip member of its own."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = None if url is None else " ".join(url.split())
    head = _headers(
        [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", _record_id(page_id, digest, copy)),
            ("WARC-Date", when),
            ("WARC-Target-URI", target),
            ("WARC-Page-ID", page_id),
            ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
            ("WARC-Profile", PROFILE if revisit else None),
            ("WARC-Refers-To", _record_id(refers_to, digest, 0) if revisit else None),
            ("WARC-Refers-To-Page-ID", refers_to if revisit else None),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", len(block)),
        ]
    )
    return gzip.compress(head + block + b"\r\n\r\n", compresslevel=6, mtime=0)


class _Files:
    """The files of one task attempt; gives a manifest entry for each one it closes."""

    def __init__(self, folder: str, file_bytes: int, when: str):
        self.fs, self.root = _open(folder)
        self.attempt = f"_temporary/{uuid.uuid4().hex}"
        self.fs.create_dir(f"{self.root}/{self.attempt}", recursive=True)
        self.file_bytes, self.when = file_bytes, when
        self.shard, self.number, self.stream = None, count(), None

    def write(self, shard: int, record: bytes) -> Iterator[tuple]:
        if self.stream and (shard != self.shard or self.size + len(record) > self.file_bytes):
            yield self.close()
        if shard != self.shard:
            self.shard, self.number = shard, count()
        if not self.stream:
            self.name = f"part-{shard:06d}-{next(self.number):05d}.warc.gz"
            self.stream = self.fs.open_output_stream(f"{self.root}/{self.attempt}/{self.name}", compression=None)
            self.size, self.records, self.sha = 0, 0, hashlib.sha256()
            info = b"software: assaymill\r\nformat: WARC File Format 1.1\r\n"
            head = _headers(
                [
                    ("WARC-Type", "warcinfo"),
                    ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, self.name)}>"),
                    ("WARC-Date", self.when),
                    ("WARC-Filename", self.name),
                    ("Content-Type", "application/warc-fields"),
                    ("Content-Length", len(info)),
                ]
            )
            self._put(gzip.compress(head + info + b"\r\n\r\n", mtime=0))
        self._put(record)
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.sha.update(data)
        self.size += len(data)

    def close(self) -> tuple:
        self.stream.close()
        self.stream = None
        return f"{self.attempt}/{self.name}", self.name, self.records, self.size, self.sha.hexdigest()


def _shard_of(sizes: DataFrame, shard_bytes: int) -> tuple[Column, int]:
    """The shard of a page id, and the number of shards: about equal payload bytes in each."""
    low, high = sizes.agg(F.min("page_id"), F.max("page_id")).first()
    if low is None:
        return F.lit(0), 1
    width = max(1, -(-(high - low + 1) // RANGES))
    slot = F.coalesce(F.floor((F.col("page_id") - low) / width).cast("int"), F.lit(0))
    of_slot = {r.slot: r.b for r in sizes.groupBy(slot.alias("slot")).agg(F.sum("bytes").alias("b")).collect()}
    total = sum(of_slot.values())
    each = total / max(1, math.ceil(total / shard_bytes))
    shards, seen = [], 0
    for s in range(max(of_slot) + 1):
        shards.append(int(seen / each) if each else 0)
        seen += of_slot.get(s, 0)
    return F.get(F.lit(shards), slot), shards[-1] + 1


def write_archive(
    pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, when: str = WHEN
) -> DataFrame:
    """Write ``pages(page_id, url, html)`` below ``folder``, which must be new; the manifest."""
    spark = pages.sparkSession
    ship_package(spark)
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.encode("html", "UTF-8"), F.encode(F.lit(""), "UTF-8")).alias("payload"),
    )
    sizes = materialize(
        rows.select("page_id", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("bigint").alias("bytes")),
        "warc-digests",
    )
    shard, n_shards = _shard_of(sizes, shard_bytes)
    # Per digest first, so that a payload that a third of all pages share is one row.
    firsts = (
        sizes.where(F.col("bytes") >= REVISIT_FROM)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
    )
    decided = (
        sizes.join(firsts, "digest")
        .where(~F.col("page_id").eqNullSafe(F.col("first")))
        .select("page_id", "digest", F.col("first").alias("refers_to"))
        .distinct()
    )
    stream = (
        rows.withColumn("digest", F.sha2("payload", 256))
        .unionByName(decided, allowMissingColumns=True)
        .withColumn("shard", shard)
        .repartitionByRange(n_shards, "shard")
        .sortWithinPartitions("shard", F.col("page_id").asc_nulls_first(), "digest", F.col("payload").isNotNull(), "url")
        .select("shard", "page_id", "digest", "refers_to", "url", "payload")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder, file_bytes, when)
        decision = last = None
        copy = 0
        names = ["temporary", "name", "records", "bytes", "sha256"]

        def entries(done):
            return pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*done)], names=names)

        for batch in batches:
            columns = batch.columns
            for i in range(batch.num_rows):
                shard, page_id, digest, refers_to, url, payload = (c[i].as_py() for c in columns)
                key = (page_id, digest)
                if payload is None:
                    decision = (key, refers_to)
                    continue
                copy = copy + 1 if key == last else 0
                last = key
                target = decision[1] if decision and decision[0] == key else None
                if target is None and copy and page_id is not None and len(payload) >= REVISIT_FROM:
                    target = page_id
                record = build_record(page_id, url, payload, digest, target, target is not None, copy, when)
                done = list(files.write(shard, record))
                if done:
                    yield entries(done)
        if files.stream:
            yield entries([files.close()])

    staged = f"{folder}/_manifest_temporary"
    stream.mapInArrow(write, ENTRY).write.parquet(staged)
    _publish(spark, folder, staged)
    return spark.read.schema(ENTRY).parquet(f"{folder}/_manifest")


def _publish(spark: SparkSession, folder: str, staged: str) -> None:
    """Move the manifest's files to their final names, then the manifest to its own."""
    manifest = spark.read.schema(ENTRY).parquet(staged)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                held = fs.get_file_info(f"{root}/{row['temporary']}")
                if held.type == pafs.FileType.File:  # else an earlier attempt has moved it
                    fs.move(f"{root}/{row['temporary']}", f"{root}/{row['name']}")
            yield batch

    moved = manifest.repartition(max(1, manifest.count() // 64), "name").mapInArrow(move, ENTRY)
    moved.write.format("noop").mode("overwrite").save()
    path = spark._jvm.org.apache.hadoop.fs.Path
    hadoop = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if not hadoop.rename(path(staged), path(f"{folder}/_manifest")):
        raise RuntimeError(f"cannot publish the manifest of {folder}")
    hadoop.delete(path(f"{folder}/_temporary"), True)


class _Checked:
    """A stream that knows the size and the digest of what was read from it."""

    def __init__(self, stream):
        self.stream, self.size, self.sha = stream, 0, hashlib.sha256()

    def read(self, most: int) -> bytes:
        data = self.stream.read(most)
        self.size += len(data)
        self.sha.update(data)
        return data


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one after another."""
    unzip, parts = zlib.decompressobj(31), []
    while data := stream.read(1 << 20):
        while data:
            parts.append(unzip.decompress(data))
            if not unzip.eof:
                break
            yield b"".join(parts)
            data, unzip, parts = unzip.unused_data, zlib.decompressobj(31), []
    if parts and any(parts):
        raise ValueError("a member is cut off")


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a record: {lines[0][:40]}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def _page(fields: dict[str, str], block: bytes) -> dict:
    """A page row of a response or revisit record; wrong digests or lengths are errors."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    number = lambda k: int(fields[k]) if k in fields else None
    return {
        "page_id": number("WARC-Page-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": size,
        "payload_digest": digest, "record_type": kind, "refers_to": number("WARC-Refers-To-Page-ID"),
        "payload": payload if kind == "response" else None,
    }


def read_archive(spark: SparkSession, folder: str, payload: bool = False) -> DataFrame:
    """The records of the files that the manifest names, a file at a time per task.

    With ``payload`` the responses' payloads too. Payloads are checked against their digests, and
    files against their manifest entries: a file that is cut, changed or missing is an error.
    """
    ship_package(spark)
    manifest = spark.read.schema(ENTRY).parquet(f"{folder}/_manifest")
    schema = RECORD + (", payload binary" if payload else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
        shape = pa.schema([(n, types.get(n, pa.string())) for n in names])
        for batch in batches:
            for entry in batch.to_pylist():
                name = entry["name"]
                rows, size, records = [], 0, 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as opened:
                    stream = _Checked(opened)
                    for fields, block in map(parse_record, _members(stream)):
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        records += 1
                        row = _page(fields, block)
                        rows.append({n: row[n] for n in names})
                        size += len(row["payload"] or b"") if payload else 100
                        if size > 8_000_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=shape)
                            rows, size = [], 0
                found = {"records": records, "bytes": stream.size, "sha256": stream.sha.hexdigest()}
                if found != {k: entry[k] for k in found}:
                    raise ValueError(f"{name} is not the file of the manifest: {found}")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=shape)

    return manifest.repartition(max(1, manifest.count()), "name").mapInArrow(read, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to a fresh shared folder and read the records back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    write_archive(pages, folder)
    return read_archive(spark, folder)
