"""Token counts through a digest cache.

The cache is a Parquet table (tokenizer digest, content digest, n_tokens). A
document's content digest is joined to it; only contents that the cache lacks are
encoded, once each, and their counts are appended. Contents travel compressed,
and a task passes on each content once, so copies (a third of all rows may be one text) are merged
before the shuffle.

The tokenizer digest covers its file and the library's version, so another file or
release never reads stale counts. Content is not rewritten before it is digested (a changed
text may count differently); only null is read as empty.

Defined results: null and empty texts have no bytes and no tokens. Repeated rows repeat;
extra columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.tokens import encoder

CACHE = "tokenizer binary, digest binary, n_tokens long"
SEEN = 200_000  # digests a task remembers to pass on a content once


def tokenizer_digest(path: str) -> bytes:
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + tokenizers.__version__.encode()).digest()


def _contents(text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = []
                for t in batch.slice(at, 512).column(text).to_pylist():
                    raw = (t or "").encode("utf-8", "surrogatepass")
                    digest = hashlib.sha256(raw).digest()
                    if digest not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(digest)
                        rows.append((digest, pack.compress(raw)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], pa.binary()) for i in (0, 1)], ["digest", "packed"]
                )

    return run


def _counted(path: str, version: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, width = encoder(path).encode, encoder(path).dtype.itemsize
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [unpack.decompress(p).decode("utf-8", "surrogatepass") for p in part.column("packed").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([version] * part.num_rows, pa.binary()),
                        part.column("digest"),
                        pa.array([len(ids) // width for ids in encode(texts)], pa.int64()),
                    ],
                    ["tokenizer", "digest", "n_tokens"],
                )

    return run


def read_cache(spark: SparkSession, cache: str, version: bytes) -> DataFrame:
    """(digest, n_tokens) of one tokenizer; appends that raced hold equal counts."""
    return (
        spark.read.schema(CACHE).parquet(cache).filter(F.col("tokenizer") == F.lit(version))
        .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    )


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` and ``n_tokens`` of each whole ``text``; ``cache`` gains the misses."""
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer)
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache)
    misses = (
        docs.select(F.col(f"`{text}`").alias("text"))
        .mapInArrow(_contents("text"), "digest binary, packed binary")
        .join(read_cache(spark, cache, version).select("digest"), "digest", "left_anti")
        .dropDuplicates(["digest"])
        .mapInArrow(_counted(tokenizer, version), CACHE)
    )
    misses.write.mode("append").parquet(cache)
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kept = [f"`{c}`" for c in docs.columns if c not in ("n_bytes", "n_tokens")]
    digested = docs.select(
        *kept, F.octet_length(content).cast("bigint").alias("n_bytes"), F.unhex(F.sha2(content, 256)).alias("__digest")
    )
    counts = read_cache(spark, cache, version).withColumnRenamed("digest", "__d")
    return digested.join(counts, F.col("__digest") == F.col("__d")).select(*kept, "n_bytes", "n_tokens")
