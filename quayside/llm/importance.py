"""Importance resampling towards a target distribution over hashed n-grams.

Every n-gram of a text falls into one of ``buckets`` buckets (CRC-32 of its bytes). A bucket's gain is
the logarithm of its smoothed rate in the target texts over its rate in the source texts; a
document's weight is the sum of its n-grams' gains, and a Gumbel number drawn from its id added
to the weight makes the highest scores a sample without replacement.

A batch of texts is handled as one byte buffer:

* A byte table folds A-Z and marks word bytes; what lies between words becomes one space, so an
  n-gram is a slice of the folded buffer, and its words' starts and ends give the slice.
* ``Interned`` is an open-addressed table of NumPy columns. An n-gram's XXH64 picks its first slot; a slot is
  claimed, or holds the same bytes (hash, length and then the bytes themselves are compared), or the
  next one is tried; all n-grams of a block probe at once. A slot stores where its n-gram
  stands, its bucket and its count, so the CRC is computed once for each distinct n-gram of a batch.
* Counting adds the slots' counts up by bucket. Weighing gathers the slots' gains by each occurrence's slot id.

Spark does the rest: bucket counts combine by task and are summed by bucket (a row per bucket and task); only the
gains, ``buckets`` numbers, go through the driver. The draw is by rank: narrow rows are ranged by score, ranks
are a range's offset and the place within it, so no task sees more than its range.

Defined results: null and empty texts have no words, weight 0 and no rank. Rows are documents of their own, also
where they repeat an id; a null id draws its number from the empty string and stands first among equal scores.
A text beyond ``BLOCK_BYTES`` is handled in pieces (single words; longer runs of words take whole texts). An empty source or target counts as zero n-grams (all rates are smoothed). Other columns pass through unread.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.store import written

BUCKETS = 10_000
WORDS = 1  # longest run of words
LEAST_WORDS = 20
DRAW_PCT = 10
SEED = "2024"
BLOCK_BYTES = 4 << 20  # text handled at a time

_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True


def _rotated(x: np.ndarray, r: int) -> np.ndarray:
    return x << np.uint64(r) | x >> np.uint64(64 - r)


class _Slices:
    """Slices ``start, size`` of a byte buffer, hashed and compared all at once."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        self.data = np.concatenate([data, np.zeros(8, np.uint8)])
        # the eight bytes from every offset on
        self.eight = np.ndarray((len(data) + 1,), "<u8", self.data, 0, (1,))
        self.start, self.size = start, size

    def xxh64(self, seed: int = 0) -> np.ndarray:
        size, h = self.size, np.uint64(seed) + _P5 + self.size.astype(np.uint64)
        for j in range(int(min(size.max(initial=0), 31)) // 8):
            i = np.flatnonzero(size >= 8 * j + 8)
            k = _rotated(self.eight[self.start[i] + 8 * j] * _P2, 31) * _P1
            h[i] = _rotated(h[i] ^ k, 27) * _P1 + _P4
        at = self.start + (size & ~7)
        i = np.flatnonzero(size & 4)
        h[i] = _rotated(h[i] ^ (self.eight[at[i]] & np.uint64(0xFFFFFFFF)) * _P1, 23) * _P2 + _P3
        at = at + (size & 4)
        for j in range(3):
            i = np.flatnonzero((size & 3) > j)
            h[i] = _rotated(h[i] ^ self.data[at[i] + j].astype(np.uint64) * _P5, 11) * _P1
        h ^= h >> np.uint64(33)
        h *= _P2
        h ^= h >> np.uint64(29)
        h *= _P3
        h ^= h >> np.uint64(32)
        for i in np.flatnonzero(size > 31).tolist():
            h[i] = xxhash.xxh64_intdigest(self.data[self.start[i] : self.start[i] + size[i]], seed)
        return h

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether slices ``a`` and ``b`` (of equal sizes) hold the same bytes."""
        ok = np.ones(len(a), bool)
        n, left, right = self.size[a], self.start[a], self.start[b]
        for j in range(0, int(n.max(initial=0)), 8):
            i = np.flatnonzero(ok & (n > j))
            if not len(i):
                break
            rest = np.minimum(n[i] - j, 8)
            x = self.eight[left[i] + j] ^ self.eight[right[i] + j]
            short = rest < 8
            x[short] &= (np.uint64(1) << (rest[short].astype(np.uint64) << np.uint64(3))) - np.uint64(1)
            ok[i] = x == 0
        return ok


class Interned:
    """Open-addressed table over the slices of one batch.

    ``owner[slot]`` is the slice that the slot stands for, ``bucket`` and ``count`` are the slot's columns, and
    ``slot_of[i]`` is the slot of slice ``i``.
    """

    def __init__(self, slices: _Slices, buckets: int, hashes: np.ndarray | None = None) -> None:
        n = len(slices.start)
        self.hashes = slices.xxh64() if hashes is None else hashes
        room = 1 << max(4, int(2 * n - 1).bit_length())  # at most half full
        mask = np.uint64(room - 1)
        owner = np.full(room, -1, np.int64)
        self.slot_of = np.empty(n, np.int64)
        todo, at = np.arange(n), (self.hashes & mask).astype(np.int64)
        while len(todo):
            free = owner[at] < 0
            # of all that claim a free slot one stays its owner, the others compare with it
            owner[at[free]] = todo[free]
            held = owner[at]
            equal = (held == todo) | (self.hashes[held] == self.hashes[todo]) & (slices.size[held] == slices.size[todo])
            check = np.flatnonzero(equal & (held != todo))
            equal[check] = slices.same(held[check], todo[check])
            self.slot_of[todo[equal]] = at[equal]
            todo, at = todo[~equal], at[~equal] + 1 & room - 1
        self.used = np.flatnonzero(owner >= 0)
        self.owner = owner
        self.count = np.bincount(self.slot_of, minlength=room)
        self.bucket = np.zeros(room, np.int64)
        raw = slices.data.tobytes()
        begin = slices.start[owner[self.used]]
        end = begin + slices.size[owner[self.used]]
        self.bucket[self.used] = [zlib.crc32(raw[b:e]) % buckets for b, e in zip(begin.tolist(), end.tolist(), strict=True)]


def _ngrams(data: np.ndarray, bounds: np.ndarray, n_words: int) -> tuple[_Slices, np.ndarray, np.ndarray]:
    """(slices, piece of each slice, words of each piece) of the texts ``data[bounds[d]:bounds[d + 1]]``."""
    docs = len(bounds) - 1
    folded = _FOLD[data]
    word = _IS_WORD[folded]
    # a word starts where its text or a run of word bytes starts
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(bounds, start, "right") - 1
    words = np.bincount(doc, minlength=docs)
    size = end - start
    if n_words > 1:
        # words side by side, one space between: a run of words is one slice
        place = np.cumsum(size + 1) - (size + 1)
        joined = np.full(int((size + 1).sum()), 32, np.uint8)
        joined[np.repeat(place - start, size) + np.flatnonzero(word)] = folded[word]
        folded, start = joined, place
    starts, sizes, owners = [start], [size], [doc]
    for k in range(2, n_words + 1):
        i = np.flatnonzero(doc[: len(doc) - k + 1] == doc[k - 1 :])
        starts.append(start[i])
        sizes.append(start[i + k - 1] + size[i + k - 1] - start[i])
        owners.append(doc[i])
    return _Slices(folded, np.concatenate(starts), np.concatenate(sizes)), np.concatenate(owners), words


def _blocks(texts: pa.Array, n_words: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of each piece, bytes, bounds) of consecutive texts, about ``BLOCK_BYTES`` at a time. A piece is a whole text, or
    for single words a part of a longer text, cut where no word runs."""
    if not len(texts):
        return
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, values = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    rows = np.arange(len(texts))
    if n_words == 1:
        cuts = []
        for row in np.flatnonzero(np.diff(bounds) > BLOCK_BYTES).tolist():
            at, end = int(bounds[row]) + BLOCK_BYTES, int(bounds[row + 1])
            while at < end:
                gap = np.flatnonzero(~_IS_WORD[_FOLD[data[at : min(at + BLOCK_BYTES, end)]]])
                if len(gap):
                    cuts.append((at + int(gap[0]), row))
                    at += int(gap[0])
                at += BLOCK_BYTES
        if cuts:
            inner, of = np.array(cuts).T
            bounds = np.sort(np.concatenate([bounds, inner]), kind="stable")
            rows = np.sort(np.concatenate([rows, of]))
    at = 0
    while at < len(rows):
        stop = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BLOCK_BYTES, "right")) - 1)
        yield rows[at:stop], data[bounds[at] : bounds[stop]], bounds[at : stop + 1] - bounds[at]
        at = stop


def bucket_counts(texts: DataFrame, text: str = "text", n_words: int = WORDS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many n-grams of all texts fall into each bucket; buckets without any have no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, data, bounds in _blocks(batch.column(0), n_words):
                slices, _, _ = _ngrams(data, bounds, n_words)
                table = Interned(slices, buckets)
                np.add.at(total, table.bucket[table.used], table.count[table.used])
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(total[there], pa.int64())], ["bucket", "n"])

    found = texts.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "bucket int, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain, in thousandths, from the two tables of bucket counts (at most ``buckets`` rows each)."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, held in ((source, s), (target, t)):
        for bucket, n in counts.collect():
            held[bucket] = n
    of_s, of_t = s.sum() + buckets, t.sum() + buckets
    return np.array([math.floor(1000 * math.log((b + 1) * of_s / ((a + 1) * of_t))) for a, b in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def with_weight(docs: DataFrame, gain: np.ndarray, text: str = "text", n_words: int = WORDS) -> DataFrame:
    """(row, n_words, n_features, weight) in front of the columns of ``docs`` but its text; row numbers the rows."""
    kept = [c for c in docs.columns if c != text]
    types = dict(docs.dtypes)
    names = ["n_words", "n_features", "weight", *(f"c{i}" for i in range(len(kept)))]
    schema = ", ".join(["n_words long", "n_features long", "weight long", *(f"c{i} {types[c]}" for i, c in enumerate(kept))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weight = np.zeros((3, batch.num_rows), np.int64)
            for rows, data, bounds in _blocks(batch.column(0), n_words):
                slices, piece, count = _ngrams(data, bounds, n_words)
                table = Interned(slices, len(gain))
                np.add.at(weight, rows[piece], gain[table.bucket][table.slot_of])
                np.add.at(features, rows[piece], 1)
                np.add.at(words, rows, count)
            own = [pa.array(x, pa.int64()) for x in (words, features, weight)]
            yield pa.RecordBatch.from_arrays(own + batch.columns[1:], names)

    rows = docs.select(F.col(f"`{text}`").alias("text"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    weighed = rows.mapInArrow(run, schema)
    return weighed.select(
        F.monotonically_increasing_id().alias("row"), "n_words", "n_features", "weight", *[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)]
    )


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows(row, id, n_words, n_features, weight, score)`` with ``place``: the number among all, by score from
    the highest and id from the least, those with too few words last."""
    # places within a range follow the sort; a range's number is the partition's
    ranged = rows.repartitionByRange(F.col("fit").desc(), F.col("score").desc(), F.col("id").asc_nulls_first(), F.col("row"))
    ranged = ranged.sortWithinPartitions(F.col("fit").desc(), F.col("score").desc(), F.col("id").asc_nulls_first(), F.col("row"))
    ranged = written(ranged.withColumn("at", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("at", 33)
    sizes = sorted(ranged.groupBy(part.alias("part")).agg(F.count("*")).collect())  # a row for each range
    offsets, before = [], 0
    for p, n in sizes:
        offsets.append((p, before))
        before += n
    table = rows.sparkSession.createDataFrame(offsets, "part long, before long")
    placed = ranged.withColumn("part", part).join(F.broadcast(table), "part")
    return placed.withColumn("place", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1)


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", n_words: int = WORDS, buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS, draw_pct: int = DRAW_PCT, seed: str = SEED,
) -> DataFrame:
    """(key, n_features, weight, score, rank) of every row; rank counts the drawn rows from the highest score, others have null.

    Of the N rows with at least ``least_words`` words, ``draw_pct`` percent (rounded down) are drawn."""
    gain = gains(bucket_counts(docs, text, n_words, buckets), bucket_counts(target, text, n_words, buckets), buckets)
    rows = with_weight(docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")), gain, "text", n_words)
    drawn = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(drawn, 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    rows = rows.withColumns({"score": F.col("weight") + gumbel, "fit": F.col("n_words") >= least_words})
    placed = _ranked(rows)
    fit = placed.filter("fit").count()
    rank = F.when(F.col("place") <= draw_pct * fit // 100, F.col("place"))
    return placed.select(F.col("id").alias(key), "n_features", "weight", "score", rank.alias("rank"))
