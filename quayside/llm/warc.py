"""WARC archives written from, and read as, a table of payload chunks.

A payload is handled as rows (record, chunk number, bytes), each with the digest of the payload up to
its end, so no step after the first holds more of a record than a chunk:

* Records. One narrow row per record (key, URI, SHA-256 and size of its payload, number of equal rows). Of the records
  with equal payloads of ``REVISIT_BYTES`` or more the one with the smallest key is written as response, the
  others as revisits that name it. Rows combine before each shuffle and a payload shared by very many is one row
  of a stored table, joined to plain shuffled rows.
* Writing. Record rows and chunk rows go together to tasks by record and are sorted by (record, chunk): a record's
  row comes first, its chunks follow, and the task streams them into one compressed member of the archive.
  The running digest is taken anew while writing and held against each chunk's, so lost, doubled or misplaced
  chunks end the job. Archives are closed at ``ARCHIVE_BYTES``.
* Files have names of their own for each attempt. The manifest, written by Spark, lists those of the attempts
  that counted; a retried or speculative task leaves at most a file that nothing names.
* Reading. Each archive is one task's stream; payloads come out as chunk rows again, with running size and digest. The
  last chunk's digest must be the one in the record's header. Revisits hold no payload; digest and size come from their headers.

Defined results: a null payload is empty; an empty one has one chunk row of no bytes when read. A null URI is left
out. Rows that repeat key, URI and payload are records of their own: the first of them is as stated above, the others revisit
it (small ones are all responses). Records of one key with different URIs are told apart by URI, null first. A null key is
larger than all others; a revisit of one refers to null. An empty table gives an empty manifest and no archive. Other columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.store import file_system, written

CHUNK = 1 << 18
REVISIT_BYTES = 100
ARCHIVE_BYTES = 1 << 30  # compressed
SEEN = 1 << 16  # records whose chunks a task remembers to have sent
MANIFEST = "archive string, n_records long, n_responses long, n_bytes long"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_TASKS = 1 << 14

_ROW = "id string, uri string, digest binary, chunk long, data binary, upto binary, n_bytes long, copies long, record_type string, refers_to string, refers_uri string"


def records(pages: DataFrame, key: str, uri: str, payload: str) -> DataFrame:
    """(id, uri, digest, n_bytes, copies, record_type, refers_to, refers_uri): one row per key, URI and payload."""
    body = F.coalesce(F.col(f"`{payload}`"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{key}`").alias("id"), F.col(f"`{uri}`").alias("uri"), F.unhex(F.sha2(body, 256)).alias("digest"), F.octet_length(body).cast("long").alias("n_bytes")
    )
    rows = written(rows.groupBy("id", "uri", "digest", "n_bytes").agg(F.count("*").alias("copies")), "records")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", F.col("uri").isNotNull().alias("has_uri"), "uri")
    shared = rows.filter(F.col("n_bytes") >= REVISIT_BYTES).groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1")
    shared = written(shared.select("digest", F.col("first.id").alias("refers_to"), F.col("first.uri").alias("refers_uri"), F.lit(True).alias("shared")), "shared-payloads")
    joined = rows.join(shared, "digest", "left")
    first = F.col("shared").isNull() | (F.col("id").eqNullSafe(F.col("refers_to")) & F.col("uri").eqNullSafe(F.col("refers_uri")))
    return joined.select(
        "id", "uri", "digest", "n_bytes", "copies", F.when(first, "response").otherwise("revisit").alias("record_type"),
        F.when(first, F.col("id")).otherwise(F.col("refers_to")).alias("refers_to"),
        F.when(first, F.col("uri")).otherwise(F.col("refers_uri")).alias("refers_uri"),
    )


def chunk_rows(pages: DataFrame, key: str, uri: str, payload: str, chunk: int = CHUNK) -> DataFrame:
    """(id, uri, digest, chunk, data, upto) for every payload that is not empty; upto is the digest to the chunk's end.
    A row that a task has just sent is not sent again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "uri", "digest", "chunk", "data", "upto"]
        seen: dict[tuple, None] = {}
        for batch in batches:
            bodies = batch.column(2).fill_null("").cast(pa.large_binary())
            _, offsets, values = bodies.buffers()
            bounds = np.frombuffer(offsets, np.int64)[bodies.offset : bodies.offset + len(bodies) + 1].tolist()
            raw = memoryview(values) if values is not None else memoryview(b"")
            rows: list[tuple] = []
            held = 0
            for row, (own, at) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                body = raw[bounds[row] : bounds[row + 1]]
                digest = hashlib.sha256(body).digest()
                if not len(body) or (own, at, digest) in seen:
                    continue
                seen[own, at, digest] = None
                if len(seen) > SEEN:
                    del seen[next(iter(seen))]
                upto = hashlib.sha256()
                for n, start in enumerate(range(0, len(body), chunk)):
                    part = body[start : start + chunk]
                    upto.update(part)
                    rows.append((own, at, digest, n, bytes(part), upto.copy().digest()))
                    held += len(part)
                    if held >= 16 * CHUNK:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names)

    rows = pages.select(F.col(f"`{key}`").cast("string").alias("id"), F.col(f"`{uri}`").alias("uri"), F.col(f"`{payload}`").alias("body"))
    return rows.mapInArrow(run, "id string, uri string, digest binary, chunk long, data binary, upto binary")


_TYPES = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]


def _name(own: str | None, uri: str | None, digest: bytes, copy: int) -> str:
    """A record's id: the same for the same record on every attempt."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps([own, uri, digest.hex(), copy]))}>"


class _Archive:
    """One archive file: every record a compressed member of its own."""

    def __init__(self, path: str, name: str, date: str) -> None:
        store, folder = file_system(path)
        store.create_dir(folder, recursive=True)
        self.file, self.date = store.open_output_stream(f"{folder}/{name}"), date
        self.path, self.n_records, self.n_responses, self.n_bytes = f"{path}/{name}", 0, 0, 0
        block = b"software: quayside\r\nformat: WARC File Format 1.1\r\n"
        self.open({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", "Content-Type": "application/warc-fields"}, len(block))
        self.put(block)
        self.end()
        self.n_records = 0

    def open(self, fields: dict[str, str], length: int) -> None:
        self.member = zlib.compressobj(6, zlib.DEFLATED, 31)
        lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in {**fields, "WARC-Date": self.date, "Content-Length": length}.items())]
        self.put(("\r\n".join(lines) + "\r\n\r\n").encode())

    def put(self, data: bytes) -> None:
        self._raw(self.member.compress(data))

    def end(self) -> None:
        self._raw(self.member.compress(b"\r\n\r\n") + self.member.flush())
        self.n_records += 1

    def _raw(self, data: bytes) -> None:
        if data:
            self.file.write(data)
            self.n_bytes += len(data)


class _Writer:
    """Streams sorted record and chunk rows into archives."""

    def __init__(self, path: str, date: str, archive_bytes: int) -> None:
        self.path, self.date, self.most = path, date, archive_bytes
        self.attempt = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        self.n_files, self.archive = 0, None
        self.done: list[_Archive] = []
        self.row: dict | None = None  # the record whose chunks are awaited

    def close(self) -> None:
        self._complete()
        if self.archive:
            self.archive.file.close()
            self.done.append(self.archive)
            self.archive = None

    def _fields(self, row: dict, kind: str, copy: int) -> dict[str, str]:
        fields = {
            "WARC-Type": kind, "WARC-Record-ID": _name(row["id"], row["uri"], row["digest"], copy), "X-Record-Key": json.dumps(row["id"]),
            "WARC-Payload-Digest": f"sha256:{row['digest'].hex()}", "Content-Type": "application/http;msgtype=response",
        }
        if row["uri"] is not None:
            fields["WARC-Target-URI"] = urllib.parse.quote(row["uri"], safe="!\"#$%&'()*+,/:;<=>?@[\\]^_`{|}~-.")
        if kind == "revisit":
            fields |= {"WARC-Profile": PROFILE, "X-Refers-To-Key": json.dumps(row["refers_to"]), "WARC-Refers-To": _name(row["refers_to"], row["refers_uri"], row["digest"], 0)}
        return fields

    @staticmethod
    def _http(row: dict) -> bytes:
        return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['n_bytes']}\r\n\r\n".encode()

    def _revisits(self, row: dict, copies: range) -> None:
        head = self._http(row)
        for copy in copies:
            self.archive.open(self._fields(row, "revisit", copy), len(head))
            self.archive.put(head)
            self.archive.end()

    def _respond(self, row: dict, copy: int) -> None:
        head = self._http(row)
        self.archive.open(self._fields(row, "response", copy), len(head) + row["n_bytes"])
        self.archive.put(head)
        self.archive.n_responses += 1

    def record(self, row: dict) -> None:
        self._complete()
        if self.archive and self.archive.n_bytes >= self.most:
            self.close()
        if not self.archive:
            self.archive = _Archive(self.path, f"{self.attempt}-{self.n_files:04d}.warc.gz", self.date)
            self.n_files += 1
        self.row, self.next, self.digest, self.short = row, 0, hashlib.sha256(), []
        if row["record_type"] == "revisit":
            self._revisits(row, range(row["copies"]))
        elif row["n_bytes"] >= REVISIT_BYTES:
            self._respond(row, 0)

    def chunk(self, own: tuple, number: int, data: bytes, upto: bytes) -> None:
        row = self.row
        if row is None or own != (row["id"], row["uri"], row["digest"]):
            raise ValueError(f"a chunk without its record: {own[0]}")
        if row["record_type"] == "revisit" or number < self.next:
            return  # not needed, or sent by another task too
        self.digest.update(data)
        if number != self.next or self.digest.digest() != upto:
            raise ValueError(f"record {row['id']}: chunk {self.next} is lost or changed")
        self.next += 1
        if row["n_bytes"] >= REVISIT_BYTES:
            self.archive.put(data)
        else:
            self.short.append(data)

    def _complete(self) -> None:
        row, self.row = self.row, None
        if row is None or row["record_type"] == "revisit":
            return
        if self.digest.digest() != row["digest"]:
            raise ValueError(f"record {row['id']}: the payload is not whole")
        if row["n_bytes"] >= REVISIT_BYTES:
            self.archive.end()
            self._revisits(row, range(1, row["copies"]))
            return
        for copy in range(row["copies"]):
            self._respond(row, copy)
            self.archive.put(b"".join(self.short))
            self.archive.end()


def write_archives(
    pages: DataFrame, path: str, key: str = "page_id", uri: str = "url", payload: str = "html", date: str | None = None,
    chunk: int = CHUNK, archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write archives and their manifest under ``path`` (a URI that all tasks reach); returns the manifest.
    ``date`` is the records' date, by default that of the call."""
    file_system(path)  # a path that tasks cannot open ends here
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    heads = records(pages, key, uri, payload)
    heads = heads.withColumns({c: F.col(c).cast("string") for c in ("id", "refers_to")}).withColumn("chunk", F.lit(-1).cast("long"))
    rows = heads.unionByName(chunk_rows(pages, key, uri, payload, chunk), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _Writer(path, date, archive_bytes)
        for batch in batches:
            chunks, data, upto = batch.column("chunk").to_pylist(), batch.column("data"), batch.column("upto")
            own = list(zip(*(batch.column(c).to_pylist() for c in ("id", "uri", "digest")), strict=True))
            heads = iter(batch.filter(pc.equal(batch.column("chunk"), -1)).drop_columns(["data", "upto"]).to_pylist())
            for i, number in enumerate(chunks):
                if number < 0:
                    writer.record(next(heads))
                else:
                    writer.chunk(own[i], number, data[i].as_py(), upto[i].as_py())
        writer.close()
        if writer.done:
            rows = [(a.path, a.n_records, a.n_responses, a.n_bytes) for a in writer.done]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.string(), pa.int64(), pa.int64(), pa.int64()], strict=True)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in MANIFEST.split(", ")])

    names = [c.split()[0] for c in _ROW.split(", ")]
    record = ["id", "uri", "digest"]
    rows.select(names).repartition(*record).sortWithinPartitions(*record, "chunk").mapInArrow(run, MANIFEST).write.parquet(f"{path}/manifest")
    return read_manifest(pages.sparkSession, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def _fields_of(lines: Iterator[bytes]) -> dict[str, str]:
    """Header fields to the blank line; names in lower case."""
    fields = {}
    for line in lines:
        line = line.rstrip(b"\r\n")
        if not line:
            return fields
        name, _, value = line.decode().partition(":")
        fields[name.lower()] = value.strip()
    raise ValueError("a header without its end")


def _chunks(path: str, chunk: int) -> Iterator[tuple]:
    """(record id, key, URI, type, referred key, chunk number, bytes, size so far, digest so far, last) of an archive's records."""
    store, at = file_system(path)
    with store.open_input_stream(at) as raw, gzip.GzipFile(fileobj=raw) as file:
        while line := file.readline():
            if line.strip() != b"WARC/1.1":
                raise ValueError(f"{path}: no record where one should start")
            fields = _fields_of(iter(file.readline, b""))
            left = int(fields["content-length"])
            kind = fields["warc-type"]
            if kind in ("response", "revisit"):
                lines: list[bytes] = []

                def taken() -> Iterator[bytes]:
                    while got := file.readline():
                        lines.append(got)  # noqa: B023
                        yield got

                http = _fields_of(taken())
                left -= sum(map(len, lines))
                head = (fields["warc-record-id"], json.loads(fields["x-record-key"]), fields.get("warc-target-uri"), kind)
                refers = json.loads(fields.get("x-refers-to-key", "null"))
                whole = fields["warc-payload-digest"].removeprefix("sha256:")
                if kind == "revisit":
                    yield (*head, refers, 0, None, int(http["content-length"]), whole, True)
                else:
                    digest, size, number = hashlib.sha256(), 0, 0
                    while left or not number:
                        data = file.read(min(chunk, left))
                        if len(data) < min(chunk, left):
                            raise ValueError(f"{path}: {head[1]} is cut short")
                        left -= len(data)
                        size += len(data)
                        digest.update(data)
                        if not left and digest.hexdigest() != whole:
                            raise ValueError(f"{path}: the payload of {head[1]} has changed")
                        yield (*head, refers, number, data, size, digest.copy().hexdigest(), not left)
                        number += 1
            while left:
                left -= len(file.read(min(chunk, left)))
            if file.read(4) != b"\r\n\r\n":
                raise ValueError(f"{path}: a record without its end")


def read_archives(manifest: DataFrame, key: str = "page_id", key_type: str = "bigint", chunk: int = CHUNK, contents: bool = True) -> DataFrame:
    """The archives' records as chunk rows: (record_id, key, target_uri, record_type, refers_to, chunk, [data,] payload_bytes,
    payload_digest, last); size and digest (lowercase hex) reach from the payload's start to the chunk's end."""
    columns = ["record_id string", "id string", "target_uri string", "record_type string", "refers string", "chunk long", "data binary", "payload_bytes long", "payload_digest string", "last boolean"]
    types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]
    use = [i for i, c in enumerate(columns) if contents or not c.startswith("data")]
    names = [columns[i].split()[0] for i in use]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], types[i]) for i in use], names)

        for given in batches:
            for path in given.column(0).to_pylist():
                rows, held = [], 0
                for row in _chunks(path, chunk):
                    rows.append(row)
                    held += 256 + len(row[6] or b"")
                    if held >= 16 * CHUNK:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    # a stated number of partitions, which nothing folds together: one task for each archive
    tasks = min(max(manifest.count(), 1), _TASKS)
    found = manifest.select("archive").repartition(tasks).mapInArrow(run, ", ".join(columns[i] for i in use))
    kept = [c for c in ("record_id", key, "target_uri", "record_type", "refers_to", "chunk", "data", "payload_bytes", "payload_digest", "last") if contents or c != "data"]
    return found.withColumn(key, F.col("id").cast(key_type)).withColumn("refers_to", F.col("refers").cast(key_type)).select(kept)
