"""Token-id files with a minimal perfect hash index.

Documents are range-partitioned and sorted by key; each task encodes its
documents and writes one shard:

* ``shard-N.bin``: the raw ids of its documents, one after another (little-endian, 16 bits
  where the vocabulary fits, else 32), each document closed by the end id;
* ``shard-N.idx``: a minimal perfect hash over its keys. Level by level each key that is
  alone in its hashed bit keeps it, the others move on; the rank of a key's bit is its
  slot. Slots hold a 32-bit key fingerprint, the document's offset and its number of ids. A
  lookup hashes, ranks, compares the fingerprint and reads one range: constant time, and
  an absent key is told from a present one but for a 2^-32 chance.

The manifest (one row per shard) has the shard's rows, ids and keys' range. Files are
written under a temporary name and moved, so a retried or duplicated task replaces a shard
by an equal one.

Defined results: null and empty texts hold the end id only. Rows that repeat a key are kept in
order of their text; the key's entry covers all of them. A null key is a key, sorted first. An
empty table gives an empty manifest.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.store import file_system, small_side
from quayside.llm.tokens import encoder

MANIFEST = "shard int, file string, n_docs long, n_ids long, width int, key_type string, least_key string, last_key string"
GAMMA = 1.6
BLOCK = 8 << 20
ROWS, TEXT = 4096, 16 << 20  # rows, and bytes of text unless one row is longer, that are encoded at a time
TASKS = 1 << 14  # that read at a time


def _hashes(keys: list) -> np.ndarray:
    """Two 64-bit hashes a key; a null key hashes as no string can."""
    h = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([h(b"\xff" if k is None else str(k).encode()) for k in keys]), "<u8").reshape(-1, 2)


def _place(h: np.ndarray, level: int, m: int) -> np.ndarray:
    x = h[:, 0] + np.uint64(2 * level + 1) * h[:, 1]
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return (x % np.uint64(m)).astype(np.int64)


@dataclass
class PerfectHash:
    """Distinct keys to 0..n-1."""

    levels: list[np.ndarray]  # packed bits
    sizes: list[int]

    @classmethod
    def build(cls, h: np.ndarray) -> PerfectHash:
        levels, sizes = [], []
        while len(h):
            if len(levels) > 64:
                raise ValueError("two keys share a 128-bit hash")
            m = max(64, int(len(h) * GAMMA))
            at = _place(h, len(levels), m)
            alone = np.bincount(at, minlength=m)[at] == 1
            bits = np.zeros(m, np.uint8)
            bits[at[alone]] = 1
            levels.append(np.packbits(bits))
            sizes.append(m)
            h = h[~alone]
        return cls(levels, sizes)

    @cached_property
    def _before(self) -> list[np.ndarray]:
        """For each byte of a level, the keys in the bits before it, earlier levels included: a rank is then one byte's work."""
        out, base = [], 0
        for packed in self.levels:
            ends = np.cumsum(np.bitwise_count(packed), dtype=np.int64) + base
            out.append(np.r_[base, ends[:-1]])
            base = int(ends[-1])
        return out

    def slots(self, h: np.ndarray) -> np.ndarray:
        """Each key's slot; -1 where no level has its bit (certainly absent)."""
        out = np.full(len(h), -1, np.int64)
        todo = np.arange(len(h))
        for level, (packed, m, before) in enumerate(zip(self.levels, self.sizes, self._before, strict=True)):
            if not len(todo):
                break
            at = _place(h[todo], level, m)
            byte = at >> 3
            bits = packed[byte] >> (7 - (at & 7)).astype(np.uint8)  # the key's bit is the last, those before it follow
            hit = bits & 1 == 1
            out[todo[hit]] = before[byte[hit]] + np.bitwise_count(bits[hit]) - 1
            todo = todo[~hit]
        return out


def _index_bytes(keys: pa.Array, runs: np.ndarray, lengths: np.ndarray) -> bytes:
    """``keys`` distinct in order, ``runs`` rows of each, ``lengths`` ids of each row."""
    h = _hashes(keys.to_pylist())
    perfect = PerfectHash.build(h)
    slot = perfect.slots(h)
    ends = np.cumsum(lengths, dtype=np.int64)
    last = np.cumsum(runs)
    stop = ends[last - 1]
    begin = np.r_[0, stop[:-1]]
    fingerprint, offset, count = (np.empty(len(keys), t) for t in ("<u4", "<u8", "<u8"))
    fingerprint[slot] = (h[:, 1] >> np.uint64(32)).astype("<u4")
    offset[slot], count[slot] = begin, stop - begin
    sink = io.BytesIO()
    buffer = pa.BufferOutputStream()
    with pa.ipc.new_stream(buffer, pa.schema([("key", keys.type)])) as w:
        w.write_batch(pa.RecordBatch.from_arrays([keys], ["key"]))
    np.savez(
        sink, keys=np.frombuffer(buffer.getvalue(), np.uint8), runs=runs.astype("<u4"), lengths=lengths.astype("<u4"),
        fingerprint=fingerprint, offset=offset, count=count, sizes=np.array(perfect.sizes, "<i8"),
        **{f"level{i}": x for i, x in enumerate(perfect.levels)},
    )
    return sink.getvalue()


class Shard:
    """Keyed access to one written shard."""

    def __init__(self, path: str, width: int) -> None:
        self.fs, at = file_system(path)
        with self.fs.open_input_file(at + ".idx") as f:
            got = np.load(io.BytesIO(f.read()))
        self.perfect = PerfectHash([got[f"level{i}"] for i in range(len(got["sizes"]))], got["sizes"].tolist())
        self.fingerprint, self.offset, self.count = got["fingerprint"], got["offset"], got["count"]
        self.keys = pa.ipc.open_stream(got["keys"].tobytes()).read_all().column("key").combine_chunks()
        self.runs, self.lengths = got["runs"].astype(np.int64), got["lengths"].astype(np.int64)
        self.width, self.data = width, at + ".bin"

    def find(self, keys: list) -> tuple[np.ndarray, np.ndarray]:
        """(offset, number of ids) in the payload for each key; offset -1 for absent keys."""
        if not keys or not len(self.fingerprint):
            return np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        h = _hashes(keys)
        slot = self.perfect.slots(h)
        there = (slot >= 0) & (self.fingerprint[slot] == (h[:, 1] >> np.uint64(32)).astype("<u4"))
        return (
            np.where(there, self.offset[slot].astype(np.int64), -1),
            np.where(there, self.count[slot].astype(np.int64), 0),
        )

    def ids(self, offset: int, count: int, file=None) -> np.ndarray:
        own = file or self.fs.open_input_file(self.data)
        raw = own.read_at(count * self.width, offset * self.width)
        return np.frombuffer(raw, f"<u{self.width}")


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        most = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TEXT, "right"))
        stop = max(at + 1, min(at + ROWS, most))
        yield batch.slice(at, stop - at)
        at = stop


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write shards and manifest under ``path`` (a URI that all tasks reach); returns the manifest."""
    key_type = dict(docs.dtypes)[key]
    file_system(path)  # a path that tasks cannot open ends here

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        end = np.array([end_id], own.dtype).tobytes()
        shard = TaskContext.get().partitionId()
        keys: list = []
        runs: list[int] = []
        lengths: list[int] = []
        out = where = store = None
        kind = None
        for batch in batches:
            for part in _parts(batch):
                kind = part.column("key").type
                if out is None:
                    store, folder = file_system(path)
                    store.create_dir(folder, recursive=True)
                    where = f"{folder}/.{uuid.uuid4().hex}"
                    out = store.open_output_stream(where + ".bin")
                for k, ids in zip(part.column("key").to_pylist(), own.encode([t or "" for t in part.column("text").to_pylist()]), strict=True):
                    out.write(ids)
                    out.write(end)
                    if keys and keys[-1] == k:
                        runs[-1] += 1
                    else:
                        keys.append(k)
                        runs.append(1)
                    lengths.append(len(ids) // own.dtype.itemsize + 1)
        if out is None:
            return
        out.close()
        with store.open_output_stream(where + ".idx") as f:
            f.write(_index_bytes(pa.array(keys, kind), np.array(runs), np.array(lengths)))
        name = f"shard-{shard:06d}"
        for suffix in (".bin", ".idx"):
            store.move(where + suffix, f"{folder}/{name}{suffix}")
        row = [shard, f"{path}/{name}", len(lengths), int(sum(lengths)), own.dtype.itemsize, key_type, *(None if k is None else str(k) for k in (keys[0], keys[-1]))]
        types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
        names = [c.split()[0] for c in MANIFEST.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

    rows = (
        docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
        .repartitionByRange("key")
        .sortWithinPartitions("key", "text")
        .mapInArrow(run, MANIFEST)
    )
    rows.write.parquet(f"{path}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32), one row per written document, through each shard's index."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    kinds = manifest.select("key_type").distinct().take(1)
    kind = kinds[0].key_type if kinds else "bigint"
    # one row per shard: the running total is over shards, not documents
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.select("shard", "file", "width", F.coalesce(before, F.lit(0)).cast("bigint").alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["file"], row["width"])
                offset, count = shard.find(shard.keys.to_pylist())
                if (offset < 0).any():
                    raise ValueError(f"{row['file']}: the index lost a key")
                index = np.repeat(np.arange(len(offset)), shard.runs)
                first = np.r_[0, np.cumsum(shard.runs)[:-1]]
                run_start = np.r_[0, np.cumsum(shard.lengths)[:-1]]
                # place of a row within its key's range
                begin = offset[index] + run_start - run_start[first][index]
                with shard.fs.open_input_file(shard.data) as f:
                    at = 0
                    while at < len(begin):
                        stop = at + max(1, int(np.searchsorted(np.cumsum(shard.lengths[at:]) * shard.width, BLOCK)))
                        block = shard.ids(int(begin[at]), int(shard.lengths[at:stop].sum()), f).astype("<u4")
                        cuts = (begin[at:stop] - begin[at]).tolist()
                        crc = [zlib.crc32(block[c : c + n]) for c, n in zip(cuts, shard.lengths[at:stop].tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                shard.keys.take(pa.array(index[at:stop])),
                                pa.array(begin[at:stop] + row["base"], pa.int64()),
                                pa.array(shard.lengths[at:stop], pa.int64()),
                                pa.array(crc, pa.int64()),
                            ],
                            [key, "start", "n_tokens", "ids_crc32"],
                        )
                        at = stop

    # a stated number of partitions, which nothing folds together: one task for each shard
    return shards.repartition(min(max(manifest.count(), 1), TASKS)).mapInArrow(run, f"`{key}` {kind}, start long, n_tokens long, ids_crc32 long")


def look_up(keys: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, ids) of each row of ``keys`` whose key the files hold (all rows' ids of a repeated key)."""
    spark = keys.sparkSession
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    kind = dict(keys.dtypes)[key]
    k = F.col(f"`{key}`")
    low, high = F.col("least_key").cast(kind), F.col("last_key").cast(kind)
    inside = (k >= F.coalesce(low, k)) & (k <= high) | (k.isNull() & low.isNull())
    # a range lookup in the manifest, one row per shard
    routed = keys.select(k).distinct().join(small_side(manifest, 256), inside).select(k, "file", "width")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = name = None
        for batch in batches:
            keys, files, widths = (c.to_pylist() for c in batch.columns)
            at = 0
            while at < len(keys):
                # the batch's keys of one shard together
                stop = at + 1
                while stop < len(keys) and files[stop] == files[at]:
                    stop += 1
                if files[at] != name:
                    shard, name = Shard(files[at], widths[at]), files[at]
                offset, count = shard.find(keys[at:stop])
                there = np.flatnonzero(offset >= 0)
                with shard.fs.open_input_file(shard.data) as f:
                    for some in np.array_split(there, len(there) // 1024 + 1):
                        ids = [shard.ids(int(offset[i]), int(count[i]), f).astype(np.int32).tolist() for i in some]
                        own = pa.array([keys[at + i] for i in some], batch.schema.field(0).type)
                        yield pa.RecordBatch.from_arrays([own, pa.array(ids, pa.list_(pa.int32()))], [key, "ids"])
                at = stop

    tasks = min(max(manifest.count(), 1), TASKS)
    return routed.repartition(tasks, "file").sortWithinPartitions("file").mapInArrow(run, f"`{key}` {kind}, ids array<int>")
