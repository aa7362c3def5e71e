"""Suffix-array dedup: every byte covered by a ``LENGTH``-byte string that also starts elsewhere goes.

Sorting the suffix at every byte would exchange some hundred bytes for each byte of text. The sort
is therefore over the suffixes at anchors, chosen by content so that no repeat escapes:

1. Copies of a whole text are merged (a text of ``LENGTH`` bytes or more that stands twice is all repeat). The
   distinct texts are stored bucketed by digest, so later joins leave them in place.
2. Each ``LENGTH``-byte window has one anchor: the leftmost of its ``GRAM``-byte
   strings with the smallest hash. Equal windows have equal anchors at equal offsets. Windows
   that share an anchor form one record: the text right of the anchor (a suffix,
   as far as the windows reach) and the text left of it. Anchors whose gram occurs once are dropped: their windows are unique.
3. The records are merge-sorted by right text: each task sorts
   runs, front-codes them (length of the prefix shared with the record before, then the rest) and cuts
   them at the splitters; the runs of one range meet in a task and a loser tree merges them. The
   tree keeps, for each waiting record, how much it shares with the last one out; two records that share
   unequal amounts are ordered without a look at their bytes, equal amounts are compared beyond the known prefix only.
Each run also sends the records next to its cut, up to ``REACH`` as long as they match the cut so far that a record
beyond it may need them; the ``REACH`` nearest of all runs are among them, so neighbours across ranges are seen.
Records of a run that are equal on both sides prove each other: one of them is merged for the others to see, and all are
passed on without their strings, dealt over all tasks. A passage in very many texts so takes one record a run.
4. A window reaching l left of its anchor repeats exactly if some other record matches l to the
left and LENGTH - l to the right. Partners that match enough to the right stand next to a record in the first
order, so a record looks outward until the right match is too short; what it has found then is all there is. Only a record with
more than ``REACH`` such partners on a side stays open (a passage that very many texts share): its group is also sorted by left text and
looked at the same way. The greatest right and left matches bound what is possible; windows that
are possible but proved by no partner looked at are decided in a third round, by counts instead of order: the windows of a
record are taken in bands, records meet by what all windows of a band share, and bands narrow only where texts differ.

Defined results: null texts count as empty; texts shorter than ``LENGTH`` keep all bytes. Texts are
whole UTF-8 bytes and matches never cross documents. Repeated rows are documents of their own, so each
loses what the other holds. An empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import groupby
from operator import itemgetter
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.store import fresh_path, written

LENGTH = 400
GRAM = 128
CHUNK = 1 << 20  # windows hashed at a time
RUN_ROWS, RUN_BYTES = 50_000, 24 << 20
SEEN = 200_000
SPLIT_SAMPLE = 16  # sampled records for each range
PROVED_ROWS = 5_000  # proved records passed on in one row
REACH = 24  # neighbours looked at on each side
BANDS = (64, 16, 4, 1)  # windows of a band, round by round

_B = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = CHUNK + LENGTH
    up, down = np.empty(n, np.uint64), np.empty(n, np.uint64)
    inverse = pow(_B, -1, 1 << 64)
    for out, base in ((up, _B), (down, inverse)):
        out[0], have, factor = 1, 1, base
        while have < n:  # doubling: the next stretch is the last one times base^have
            take = min(have, n - have)
            out[have : have + take] = out[:take] * np.uint64(factor)
            have += take
            factor = factor * factor & _MASK
    return up, down


def _anchors_of(t: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    up, down = _powers()
    n = len(t)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((t.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[: n - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    bits = np.uint64((1 << 21) - 1)
    v = (h & ~bits) | np.arange(len(h), dtype=np.uint64)  # ties: the leftmost
    w = length - gram + 1
    padded = np.full(-(-len(v) // w) * w, np.uint64(_MASK))
    padded[: len(v)] = v
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    low = np.minimum(behind[:windows], ahead[w - 1 : w - 1 + windows])
    at = (low & bits).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    last = np.r_[first[1:] - 1, windows - 1]
    return first, last, at[first], h[at[first]].view(np.int64)


def anchors(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(first window, last window, anchor, gram hash) of each record of a text."""
    t = np.frombuffer(raw, np.uint8)
    parts = []
    for s in range(0, max(len(t) - length + 1, 0), CHUNK):
        first, last, at, h = _anchors_of(t[s : s + CHUNK + length - 1], length, gram)
        parts.append((first + s, last + s, at + s, h))
    if not parts:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def shared(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix, known to be ``at`` or more."""
    end = min(len(a), len(b))
    while at < end:
        x, y = a[at : at + 32], b[at : at + 32]
        if x != y:
            n = min(len(x), len(y))
            d = int.from_bytes(x[:n], "big") ^ int.from_bytes(y[:n], "big")
            return at + n - (d.bit_length() + 7) // 8
        at += 32
    return end


class LoserTree:
    """Merges runs of (key, other, ...) records sorted by (key, other); each comes with the length its
    key shares with the run's record before. Yields (record, run, length shared with the record yielded before)."""

    def __init__(self, runs: list[tuple[list[tuple], list[int]]]) -> None:
        self.runs = runs
        self.k = 1
        while self.k < max(len(runs), 1):
            self.k *= 2

    def _beats(self, x: int, y: int) -> bool:
        """Is x's head before y's? The loser then holds what it shares with the winner."""
        head, lcp = self.head, self.lcp
        if head[x] is None or head[y] is None:
            return head[y] is None
        if lcp[x] != lcp[y]:
            return lcp[x] > lcp[y]  # the loser's own length is what it shares with the winner
        a, b = head[x][0], head[y][0]
        n = shared(a, b, lcp[x])
        if n < len(a) and n < len(b):
            first = a[n] < b[n]
        elif len(a) != len(b):
            first = len(a) < len(b)
        else:
            first = head[x][1] <= head[y][1]
        lcp[y if first else x] = n
        return first

    def __iter__(self) -> Iterator[tuple[tuple, int, int]]:
        k, runs = self.k, self.runs
        self.at = [0] * k
        self.head = head = [runs[r][0][0] if r < len(runs) and runs[r][0] else None for r in range(k)]
        self.lcp = lcp = [0] * k
        loser = [0] * k

        def play(node: int) -> int:
            if node >= k:
                return node - k
            x, y = play(2 * node), play(2 * node + 1)
            if self._beats(x, y):
                loser[node] = y
                return x
            loser[node] = x
            return y

        winner = play(1)
        beats, at = self._beats, self.at
        while head[winner] is not None:
            yield head[winner], winner, lcp[winner]
            records, shares = runs[winner]
            i = at[winner] = at[winner] + 1
            if i < len(records):
                head[winner], lcp[winner] = records[i], shares[i]
            else:
                head[winner] = None
            node = (winner + k) // 2
            while node:
                if not beats(winner, loser[node]):
                    winner, loser[node] = loser[node], winner
                node //= 2


# Exchanged: a run's stretch for one range. ``marks`` are the fields of each record behind its strings.
# Where ``shares`` is null, the records are proved already and only their marks and lengths of key and other are sent.
_SEGMENT = "dest int, rows int, shares binary, rests binary, others binary, sizes binary, digests binary, marks binary"
_SEGMENT_NAMES = [c.split()[0] for c in _SEGMENT.split(", ")]
_MARKS = ("a", "p1", "l1", "l2")
OUTSIDE, PROVED = 1, 2  # the last mark of a merged record: of another range; has an equal one in its run


def _segment(dest: int, rows: list[tuple], state: list[int]) -> list:
    keys = [r[0] for r in rows]
    shares = [0, *(shared(x, y) for x, y in zip(keys, keys[1:], strict=False))]
    pack = zstandard.ZstdCompressor(level=1).compress
    rests = b"".join(k[n:] for k, n in zip(keys, shares, strict=True))
    others = b"".join(r[1] for r in rows)
    sizes = np.array([[len(k), len(r[1])] for k, r in zip(keys, rows, strict=True)], "<u4")
    marks = np.array([[*r[3:], c] for r, c in zip(rows, state, strict=True)], "<i8")
    return [dest, len(rows), pack(np.array(shares, "<u4").tobytes()), pack(rests), pack(others), pack(sizes.tobytes()), b"".join(r[2] for r in rows), pack(marks.tobytes())]


def _proved(dest: int, rows: list[tuple]) -> list:
    pack = zstandard.ZstdCompressor(level=1).compress
    marks = np.array([[*r[3:], len(r[0]), len(r[1])] for r in rows], "<i8")
    return [dest, len(rows), None, None, None, None, b"".join(r[2] for r in rows), pack(marks.tobytes())]


def _opened(row: dict) -> tuple[list[tuple], list[int]]:
    unpack = zstandard.ZstdDecompressor().decompress
    shares = np.frombuffer(unpack(row["shares"]), "<u4").tolist()
    sizes = np.frombuffer(unpack(row["sizes"]), "<u4").reshape(-1, 2).tolist()
    marks = np.frombuffer(unpack(row["marks"]), "<i8").reshape(row["rows"], -1).tolist()
    rests, others = unpack(row["rests"]), unpack(row["others"])
    out, key, r, o = [], b"", 0, 0
    for i, (n, (size, other)) in enumerate(zip(shares, sizes, strict=True)):
        key = key[:n] + rests[r : r + size - n]
        r += size - n
        out.append((key, others[o : o + other], row["digests"][32 * i : 32 * i + 32], *marks[i]))
        o += other
    return out, shares


_LOOKED = "digest binary, a long, p1 long, l1 long, l2 long, best long, settled boolean, pairs array<struct<k:int,o:int>>"


def neighbours(records: DataFrame, key: str, other: str, widest: int = LENGTH, length: int = LENGTH) -> DataFrame:
    """For each record (digest, a, p1, l1, l2 and two strings): ``best``, the longest prefix of ``key`` it
    shares with any other record; ``pairs``, what keys (k) and others (o) share with partners, as far as they reach ``length``
    together and no nearer partner has more of both; ``settled``, whether every such partner was looked at.
    No string in ``other`` is longer than ``widest``."""
    spark = records.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = records.select(F.col(key).alias("key"), F.col(other).alias("other"), "digest", *_MARKS)
    # splitters: a bounded sample (ranges x SPLIT_SAMPLE records, 4,096 at most) only decides where ranges meet
    picked = rows.orderBy(F.xxhash64("digest", "p1")).limit(min(ranges * SPLIT_SAMPLE, 4096)).select("key", "other").collect()
    picked = sorted({(bytes(r.key), bytes(r.other)) for r in picked})  # equal records meet in their runs already
    cuts = sorted({picked[len(picked) * i // ranges] for i in range(1, ranges)}) if picked else []

    def to_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[tuple] = []
        size = 0

        def sent(got: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {n: pa.array([v], pa.int32() if i < 2 else pa.binary()) for i, (n, v) in enumerate(zip(_SEGMENT_NAMES, got, strict=True))}
            )

        def flush() -> Iterator[pa.RecordBatch]:
            run.sort()
            first, keys, state, proved = [], [], [], []
            for _, equal in groupby(run, key=itemgetter(0, 1)):
                same = list(equal)
                first.append(same[0])
                keys.append(same[0][:2])
                state.append(PROVED if len(same) > 1 else 0)
                if len(same) > 1:
                    proved += same
            for at in range(0, len(proved), PROVED_ROWS):
                some = proved[at : at + PROVED_ROWS]
                yield sent(_proved(crc32(some[0][2] + bytes(str(some[0][4]), "ascii")) % ranges, some))
            edges = [0, *(bisect_left(keys, c) for c in cuts), len(first)]
            for dest in range(len(edges) - 1):
                lo, hi = edges[dest], edges[dest + 1]
                # the records next to the range come along, as neighbours only
                a, b = max(lo - 1, 0), min(hi + 1, len(first))
                while dest and 0 < a and lo - a < REACH and shared(keys[a][0], cuts[dest - 1][0]) + widest >= length:
                    a -= 1
                while dest < len(cuts) and b < len(first) and b - hi < REACH and shared(keys[b - 1][0], cuts[dest][0]) + widest >= length:
                    b += 1
                if b > a:
                    yield sent(_segment(dest, first[a:b], [state[i] | (0 if lo <= i < hi else OUTSIDE) for i in range(a, b)]))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                run.append(row)
                size += len(row[0]) + len(row[1])
                if len(run) >= RUN_ROWS or size >= RUN_BYTES:
                    yield from flush()
                    run, size = [], 0
        if run:
            yield from flush()

    pair = pa.list_(pa.struct([("k", pa.int32()), ("o", pa.int32())]))
    kinds = [pa.binary(), *[pa.int64()] * 5, pa.bool_(), pair]
    names = ["digest", *_MARKS, "best", "settled", "pairs"]

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dest, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["dest"] != dest and held:
                    yield from merge(held)
                    held = []
                dest = row["dest"]
                if row["shares"] is None:
                    yield equals(row)
                else:
                    held.append(_opened(row))
        if held:
            yield from merge(held)

    def equals(row: dict) -> pa.RecordBatch:
        marks = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["marks"]), "<i8").reshape(row["rows"], -1).tolist()
        return _batch([
            (row["digests"][32 * i : 32 * i + 32], *m[:4], m[4], True, [{"k": m[4], "o": m[5]}]) for i, m in enumerate(marks)
        ])

    def merge(runs: list) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        near: list[tuple] = []  # (record, length its key shares with the one before)

        def look(at: int, step: int) -> tuple[list, bool]:
            own, pairs, most = near[at][0], [], -1
            share, i = len(own[0]), at
            for _ in range(REACH):
                i += step
                if not 0 <= i < len(near):
                    return pairs, True
                share = min(share, near[i + (step < 0)][1])
                if share + len(own[1]) < length:
                    return pairs, True
                got = shared(own[1], near[i][0][1])
                if got > most and got + share >= length:
                    pairs.append({"k": share, "o": got})
                most = max(most, got)
                if most == len(own[1]):
                    return pairs, True
            return pairs, False

        def done(at: int) -> None:
            record = near[at][0]
            if not record[7]:  # of this range and not proved
                before, all_before = look(at, -1)
                after, all_after = look(at, 1)
                best = max(near[at][1] if at else 0, near[at + 1][1] if at + 1 < len(near) else 0)
                out.append((*record[2:7], best, all_before and all_after, before + after))

        at = 0  # the next record to finish: it needs REACH records behind it
        for record, _, share in LoserTree(runs):
            near.append((record, share if near else 0))
            if len(near) - at > REACH + 1:
                done(at)
                at += 1
                if at > 4096:
                    del near[: at - REACH - 1]
                    at = REACH + 1
            if len(out) >= 10_000:
                yield _batch(out)
                out = []
        for i in range(at, len(near)):
            done(i)
        if out:
            yield _batch(out)

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names)

    return (
        rows.mapInArrow(to_runs, _SEGMENT)
        .repartitionById(ranges, F.col("dest"))  # a task for each range, not merged by size
        .sortWithinPartitions("dest")
        .mapInArrow(merged, _LOOKED)
    )


def distinct_texts(docs: DataFrame, text: str) -> DataFrame:
    """(digest, packed): each whole text once, compressed, bucketed by digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = []
                for t in batch.slice(at, 512).column(0).to_pylist():
                    raw = t.encode("utf-8", "surrogatepass")
                    digest = hashlib.sha256(raw).digest()
                    if digest not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(digest)
                        rows.append((digest, pack.compress(raw)))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.binary()) for i in (0, 1)], ["digest", "packed"])

    spark = docs.sparkSession
    path = fresh_path(spark, "texts")
    name = "texts_" + path.rsplit("-", 1)[1]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        docs.select(F.col(f"`{text}`").alias("text"))
        .filter(F.octet_length("text") >= LENGTH)
        .mapInArrow(run, "digest binary, packed binary")
        .repartition(buckets, "digest")
        .dropDuplicates(["digest"])
        .write.bucketBy(buckets, "digest").option("path", path).saveAsTable(name)
    )
    return spark.table(name)


def _records(live: DataFrame, texts: DataFrame) -> DataFrame:
    """The strings on both sides of each live anchor."""
    fields = [("digest", pa.binary()), ("a", pa.int32()), ("p1", pa.int32()), ("l1", pa.int32()), ("l2", pa.int32()), ("h", pa.int64()), ("right", pa.binary()), ("left", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                out: list[tuple] = []
                for row in batch.slice(at, 16).to_pylist():
                    raw = unpack.decompress(row["packed"])
                    for s in row["found"]:
                        a, p1, p2 = s["a"], s["p1"], s["p2"]
                        out.append((row["digest"], a, p1, a - p2, a - p1, s["h"], raw[a : p2 + LENGTH], raw[p1:a][::-1]))
                for i in range(0, len(out), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out[i : i + 10_000]], t) for j, (_, t) in enumerate(fields)], [n for n, _ in fields])

    by_text = live.groupBy("digest").agg(F.collect_list(F.struct("a", "p1", "p2", "h")).alias("found"))
    return by_text.join(texts, "digest").select("digest", "packed", "found").mapInArrow(
        run, "digest binary, a int, p1 int, l1 int, l2 int, h long, right binary, left binary"
    )


def _gaps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Window intervals that the greatest matches allow and no partner looked at proves."""
    for batch in batches:
        rows = []
        for digest, a, p1, l1, l2, right, left, proofs in batch.itertuples(index=False, name=None):
            at, hi = max(l1, LENGTH - right), min(l2, left)
            for x, y in sorted((LENGTH - p["r"], p["l"]) for p in proofs):
                if x > at and at <= hi:
                    rows.append((digest, a, p1, at, min(x - 1, hi)))
                at = max(at, y + 1)
            if at <= hi:
                rows.append((digest, a, p1, at, hi))
        yield pd.DataFrame(rows, columns=["digest", "a", "p1", "lo", "hi"])


def _stretches(records: DataFrame) -> DataFrame:
    """(gap, want_lo, want_hi, lo, hi, text): of each record the text under its windows from ``lo`` to ``hi``. The anchor
    stands ``hi`` bytes into it."""
    fields = [("gap", pa.int64()), ("want_lo", pa.int64()), ("want_hi", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("text", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                lo, hi = max(row["lo"], row["l1"]), min(row["hi"], row["l2"])
                if lo <= hi:
                    out.append((row["gap"], row["want_lo"], row["want_hi"], lo, hi, row["left"][:hi][::-1] + row["right"][: LENGTH - lo]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(fields)], [n for n, _ in fields])

    return records.mapInArrow(run, "gap long, want_lo long, want_hi long, lo long, hi long, text binary")


def _banded(rows: DataFrame) -> Iterator[DataFrame]:
    """(gap, lo, hi): stretches of the open records' windows that stand in another record of ``rows`` too. All windows of a
    band share a core; records without a partner for it are done, and so are those whose whole text under the band is
    another's. What is left goes on in narrower bands, one row for each text; a band of one window decides."""
    for width in BANDS:
        top = f"least(band + {width - 1}, {LENGTH - GRAM})"
        cut = written(
            rows.selectExpr("*", f"explode(sequence(lo - lo % {width}, hi, {width}L)) as band")
            .selectExpr("gap", "want_lo", "want_hi", "hi as whole", "text", "band", "greatest(lo, band) as lo", f"least(hi, {top}) as hi")
            .withColumn("text", F.expr(f"substring(text, int(whole - hi + 1), int(hi + {LENGTH} - lo))"))
            .selectExpr(
                "if(want_lo <= hi and want_hi >= lo, gap, null) as gap", "want_lo", "want_hi", "lo", "hi", "text", "band",
                f"unhex(sha2(substring(text, int(hi - band + 1), int(band + {LENGTH} - {top})), 256)) as core",
            ),
            "bands",
        )
        same = ["band", "core", "lo", "hi", "text"]
        # an only record's marks are its own; those of several are not used
        once = [F.max(c).alias(c) for c in ("gap", "want_lo", "want_hi")]
        texts = written(cut.groupBy(*same).agg(F.count("*").alias("n"), *once), "band-texts")
        yield cut.filter("gap is not null").join(texts.filter("n > 1").select(*same), same, "left_semi").select("gap", "lo", "hi")
        texts = texts.withColumn("gap", F.expr("if(n = 1, gap, null)"))
        open_cores = texts.groupBy("band", "core").agg(F.count("*").alias("texts"), F.count("gap").alias("gaps")).filter("texts > 1 and gaps > 0")
        rows = texts.join(open_cores.select("band", "core"), ["band", "core"], "left_semi").select("gap", "want_lo", "want_hi", "lo", "hi", "text")


def repeated_windows(texts: DataFrame) -> DataFrame:
    """(digest, start, stop): stretches covered by repeated windows of distinct texts."""

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                digests, found = [], []
                for digest, packed in zip(part.column("digest").to_pylist(), part.column("packed").to_pylist(), strict=True):
                    got = anchors(unpack.decompress(packed))
                    digests += [digest] * len(got[0])
                    found.append(got)
                first, last, at_, h = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), *(pa.array(x.astype(np.int32)) for x in (at_, first, last)), pa.array(h)],
                    ["digest", "a", "p1", "p2", "h"],
                )

    found = written(texts.select("digest", "packed").mapInArrow(anchored, "digest binary, a int, p1 int, p2 int, h long"), "anchors")
    # written, so that the join below shuffles both sides itself and can split the anchors of a hot gram
    twice = written(found.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "repeated-grams")
    records = written(_records(found.join(twice, "h"), texts), "records")
    ordered = written(neighbours(records, "right", "left", LENGTH - GRAM), "right-order")
    covered = _covered(ordered.selectExpr("digest", "a", "l1", "l2", "explode(pairs) as p"), "p.k", "p.o")
    unsettled = ordered.filter("not settled")
    if unsettled.isEmpty():
        return covered
    place = ["digest", "a", "p1"]
    groups = records.join(unsettled.select(*place), place).select("h").distinct()
    group = written(records.join(groups, "h"), "open-groups")
    by_left = written(neighbours(group, "left", "right").join(unsettled.select(*place), place, "left_semi"), "left-order")
    covered = covered.union(_covered(by_left.selectExpr("digest", "a", "l1", "l2", "explode(pairs) as p"), "p.o", "p.k"))
    open_still = unsettled.select(
        *place, "l1", "l2", F.col("best").alias("right"), F.expr("transform(pairs, p -> named_struct('r', p.k, 'l', p.o))").alias("one")
    ).join(
        by_left.filter("not settled").select(
            *place, F.col("best").alias("left"), F.expr("transform(pairs, p -> named_struct('r', p.o, 'l', p.k))").alias("two")
        ),
        place,
    )
    gaps = written(
        open_still.select(*place, "l1", "l2", "right", "left", F.concat("one", "two").alias("proofs")).mapInPandas(
            _gaps, "digest binary, a long, p1 long, lo long, hi long"
        ),
        "gaps",
    )
    if gaps.isEmpty():
        return covered
    opened = written(
        gaps.groupBy(*place).agg(F.min("lo").alias("want_lo"), F.max("hi").alias("want_hi")).withColumn("gap", F.monotonically_increasing_id()),
        "open-records",
    )
    # records of equal text are one before any join, however many copies the group holds; all their windows are repeated
    text = ["h", "l1", "l2", "right", "left"]
    alike = written(group.groupBy(*text).agg(F.count("*").alias("n")), "open-alike")
    asked = written(opened.join(group, place).join(alike, text).select("gap", "want_lo", "want_hi", *text, "n"), "open-asked")
    twins = asked.filter("n > 1").selectExpr("gap", "greatest(want_lo, l1) as lo", "least(want_hi, l2) as hi").filter("lo <= hi")
    alone = asked.filter("n = 1").drop("n")
    # written, so that its size is known before the groups' texts would be dealt by h
    wanted = written(alone.groupBy("h").agg(F.min("want_lo").alias("lo"), F.max("want_hi").alias("hi")), "open-reach")
    sides = [*text[1:], "lo", "hi"]
    partners = alike.join(alone.select(*text), text, "left_anti").join(wanted, "h").select(*sides)
    asking = alone.join(wanted, "h").select("gap", "want_lo", "want_hi", *sides)
    stretches = _stretches(written(asking.unionByName(partners, allowMissingColumns=True), "open-texts"))
    third = reduce(DataFrame.union, _banded(stretches), twins).join(opened.select("gap", "digest", "a"), "gap")
    return covered.union(third.selectExpr("digest", "a - hi as start", f"a - lo + {LENGTH} as stop"))


def _covered(proofs: DataFrame, right: str, left: str) -> DataFrame:
    """(digest, start, stop) covered by the windows that a partner's right and left match proves."""
    return proofs.selectExpr(
        "digest", "a", f"greatest(l1, {LENGTH} - {right}) as lo", f"least(l2, {left}) as hi"
    ).filter("lo <= hi").selectExpr("digest", "a - hi as start", f"a - lo + {LENGTH} as stop")


def remove_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, kept_sha256 and kept (binary: the remaining bytes; null where nothing was removed).
    Columns of ``docs`` with these names are replaced."""
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    digested = docs.withColumns({"__digest": F.unhex(F.sha2(content, 256)), "n_bytes": F.octet_length(content).cast("bigint")})
    texts = distinct_texts(docs, text)
    copied = (
        digested.filter(F.col("n_bytes") >= LENGTH).groupBy(F.col("__digest").alias("digest"), "n_bytes").agg(F.count("*").alias("n"))
        .filter("n > 1").selectExpr("digest", "0L as start", "n_bytes as stop")
    )
    spans = repeated_windows(texts).union(copied).groupBy("digest").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, len(batch), 64):
                out = []
                for digest, packed, found in batch.iloc[at : at + 64].itertuples(index=False, name=None):
                    raw, kept, end, removed, runs = unpack.decompress(packed), [], 0, 0, 0
                    edge = -1
                    for start, stop in sorted((s["start"], s["stop"]) for s in found):
                        if start > edge:  # runs that touch are one
                            runs += 1
                            kept.append(raw[end:start])
                        removed += max(0, stop - max(start, end))
                        end = max(end, stop)
                        edge = end
                    rest = b"".join([*kept, raw[end:]])
                    out.append((digest, removed, runs, hashlib.sha256(rest).hexdigest(), rest))
                yield pd.DataFrame(out, columns=["__d", "__removed", "__runs", "__sha", "__kept"])

    done = (
        spans.join(texts, "digest").select("digest", "packed", "spans")
        .mapInPandas(cut, "__d binary, __removed long, __runs long, __sha string, __kept binary")
    )
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")]
    return digested.join(done, F.col("__digest") == F.col("__d"), "left").select(
        *kept,
        "n_bytes",
        F.coalesce("__removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("__runs", F.lit(0)).cast("bigint").alias("n_spans"),
        F.coalesce("__sha", F.lower(F.hex("__digest"))).alias("kept_sha256"),
        F.col("__kept").alias("kept"),
    )
