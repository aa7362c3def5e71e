"""SimHash near-dedup over vantage-point trees.

Fingerprint: the majority vote, bit by bit, of the XXH64 (seed 42) of a text's
four-word shingles. Two fingerprints link at ``DISTANCE`` or fewer differing bits.

Search over the distinct fingerprints:

* Shards. Fingerprints of unrelated texts lie 32 +- 4 bits from any vantage
  point, so rings of full distance prune under half the pairs while most points
  overlap a boundary. The Hamming distance restricted to a block of bits is a
  metric too and never above the full one: of five blocks, two fingerprints
  within four bits have one at restricted distance zero. Each fingerprint
  therefore goes to the five shards whose boundary it touches (its own value in each block), and
  every linked pair meets in at least one.
* A shard above ``SHARD`` fingerprints is split again over its remaining bits
  by the same rule, until all fit; the recursion ends because the fingerprints
  are distinct. No pair is lost and no shard is cut short.
* Inside a shard a vantage-point tree is searched against itself: points divide at the
  median distance from a vantage point; the triangle bound lets only points within
  ``DISTANCE`` of the boundary visit the other side. A leaf yields a spanning
  forest of its links, not all pairs; a shard of a leaf's size is compared directly.

Defined results: a null text counts as empty; a text without words has fingerprint
zero and links like any other. Repeated rows repeat. A component's id is the
smallest document id in it; null ids are passed over unless nothing else is there (then null).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.components import components
from quayside.llm.store import shielded, written

WORDS = 4
DISTANCE = 4
SHARD = 1 << 14
LEAF = 48
_STEP = 1 << 15  # shingles whose hashes are held at a time


def fingerprint(text: str | None, n_words: int = WORDS) -> int:
    """Unsigned 64-bit SimHash of a whole text."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    n = max(len(found) - n_words + 1, 1)
    joined = b" ".join(found)
    ends = list(accumulate(map(len, found), lambda a, b: a + b + 1))
    starts = [0, *(e + 1 for e in ends[: n - 1])]
    stops = ends[min(n_words, len(found)) - 1 :]
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, n, _STEP):
        h = np.array([digest(joined[s:e], 42) for s, e in zip(starts[at : at + _STEP], stops[at : at + _STEP], strict=True)], np.uint64)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", n_words: int = WORDS) -> DataFrame:
    """``docs`` with a bigint column ``__fp`` (the fingerprint's bits)."""

    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, n_words) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn("__fp", F.pandas_udf(hashed, "bigint")(F.col(f"`{text}`")))


def _forest(x: np.ndarray, homes: np.ndarray, visitors: np.ndarray, far: int, out: list) -> None:
    """Append a spanning forest of the links among homes and from visitors to homes."""
    nodes = np.concatenate([homes, visitors])
    near = np.bitwise_count(x[nodes][:, None] ^ x[homes][None, :]) <= far
    i, j = np.nonzero(near)
    keep = i > j
    i, j = i[keep], j[keep]
    if not len(i):
        return
    root = list(range(len(nodes)))

    def find(a: int) -> int:
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        ra, rb = find(a), find(b)
        if ra != rb:
            root[ra] = rb
            out.append((int(nodes[a]), int(nodes[b])))


def tree_links(x: np.ndarray, far: int = DISTANCE, leaf: int = LEAF) -> list[tuple[int, int]]:
    """Index pairs within ``far`` bits that connect everything the shard links."""
    out: list[tuple[int, int]] = []
    stack = [(np.arange(len(x)), np.empty(0, np.int64))]
    while stack:
        homes, visitors = stack.pop()
        if len(homes) > leaf:
            point = x[homes[0]]
            d = np.bitwise_count(x[homes] ^ point).astype(np.int16)
            cut = int(np.median(d))
            inner = d <= cut
            if inner.all():
                cut = int(d.max()) - 1
                inner = d <= cut
            if inner.any() and not inner.all():
                dv = np.bitwise_count(x[visitors] ^ point).astype(np.int16)
                stack.append((homes[inner], visitors[dv <= cut + far]))
                stack.append((homes[~inner], np.concatenate([visitors[dv > cut - far], homes[inner & (d > cut - far)]])))
                continue
        for at in range(0, len(visitors) or 1, 4096):
            _forest(x, homes, visitors[at : at + 4096], far, out)
    return out


def _blocks(mask: int, n: int) -> list[int]:
    """The bits outside ``mask`` in ``n`` disjoint blocks, each joined with ``mask``."""
    free = [b for b in range(64) if not mask >> b & 1]
    parts = [free[len(free) * k // n : len(free) * (k + 1) // n] for k in range(n)]
    return [mask | sum(1 << b for b in p) for p in parts]


def _signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def _split(rows: DataFrame, far: int) -> DataFrame:
    """Each (mask, fp) once for every block of the bits its mask leaves."""
    # masks come from the splitting rule alone: five to the power of the depth at most
    masks = [r.mask for r in rows.select("mask").distinct().collect()]
    finer = [(m, _signed(b)) for m in masks for b in _blocks(m & (1 << 64) - 1, far + 1)]
    if masks in ([], [0]):
        return rows.select(F.explode(F.array(*[F.lit(b).cast("bigint") for _, b in finer] or [F.col("mask")])).alias("mask"), "fp")
    table = rows.sparkSession.createDataFrame(finer, "mask bigint, finer bigint")
    return rows.join(F.broadcast(table), "mask").select(F.col("finer").alias("mask"), "fp")


def links(prints: DataFrame, far: int = DISTANCE, shard: int = SHARD) -> DataFrame:
    """(a, b): links that connect all of the distinct fingerprints ``prints(fp)`` within ``far`` bits."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None

        def found(part: pd.DataFrame) -> pd.DataFrame:
            out: list[tuple[int, int]] = []
            fp = part["fp"].to_numpy(np.int64)
            key = np.stack([part["mask"].to_numpy(np.int64), part["part"].to_numpy(np.int64)])
            new = np.r_[True, (key[:, 1:] != key[:, :-1]).any(0)]
            bounds = np.r_[np.flatnonzero(new), len(fp)]
            sizes = np.diff(bounds)
            group = np.cumsum(new) - 1
            u = fp.view(np.uint64)
            small = sizes[group] <= LEAF
            # shards of a leaf's size: compare each row with the one d places on, all shards at once
            for d in range(1, min(LEAF, len(fp))):
                hit = small[d:] & (group[d:] == group[:-d])
                if not hit.any():
                    break
                i = np.flatnonzero(hit)
                i = i[np.bitwise_count(u[i] ^ u[i + d]) <= far]
                out += zip(i.tolist(), (i + d).tolist(), strict=True)
            for g in np.flatnonzero(sizes > LEAF):
                at = bounds[g]
                out += [(a + at, b + at) for a, b in tree_links(u[at : bounds[g + 1]], far)]
            a = np.array([p[0] for p in out], np.int64)
            b = np.array([p[1] for p in out], np.int64)
            return pd.DataFrame({"a": fp[a], "b": fp[b]})

        for batch in batches:
            if held is not None:
                batch = pd.concat([held, batch], ignore_index=True)
            if not len(batch):
                continue
            last = (batch["mask"] == batch["mask"].iloc[-1]) & (batch["part"] == batch["part"].iloc[-1])
            held = batch[last]
            if not last.all():
                yield found(batch[~last])
        if held is not None and len(held):
            yield found(held)

    rows = _split(prints.select(F.lit(0).cast("bigint").alias("mask"), "fp"), far)
    ready = None
    while True:
        rows = written(rows.withColumn("part", F.expr("fp & mask")), "shards")
        sizes = rows.groupBy("mask", "part").agg(F.count("*").alias("n"))
        large = written(sizes.filter(F.col("n") > shard).select("mask", "part"), "large-shards")
        if large.isEmpty():
            ready = rows if ready is None else ready.union(rows)
            break
        fit = rows.join(large, ["mask", "part"], "left_anti")
        ready = fit if ready is None else ready.union(fit)
        rows = _split(rows.join(large, ["mask", "part"], "left_semi"), far)
    found = (
        ready.select("mask", "part", "fp")
        .repartition("mask", "part")
        .sortWithinPartitions("mask", "part")
        .mapInPandas(search, "a bigint, b bigint")
    )
    return found


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", n_words: int = WORDS, far: int = DISTANCE) -> DataFrame:
    """(key, fp, component_id), one row per row of ``docs``."""
    prints = written(
        with_fingerprint(docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text")), "__text", n_words).select(
            "__key", F.col("__fp").alias("fp")
        ),
        "fingerprints",
    )
    return _grouped(prints, far).drop("root").withColumnRenamed("__key", key)


def _grouped(prints: DataFrame, far: int) -> DataFrame:
    distinct = written(prints.groupBy("fp").agg(F.min("__key").alias("least")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), far)).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    low = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = written(rooted.join(low, "root").select("fp", "root", "component_id"), "components")
    return prints.join(ids, "fp").select("__key", "fp", "root", "component_id")


@shielded
def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", n_words: int = WORDS, far: int = DISTANCE) -> DataFrame:
    """One row of each component: the one whose id is the component's. Rows that repeat that id
    within the component give one row too (the first by all their values)."""
    columns = docs.columns
    marked = written(with_fingerprint(docs, text, n_words), "marked")
    prints = marked.select(F.col(f"`{key}`").alias("__key"), F.col("__fp").alias("fp"))
    kept = (
        _grouped(prints, far)
        .filter(F.col("__key").eqNullSafe(F.col("component_id")))
        .groupBy(F.col("__key").alias("__kept"), "root", F.col("fp").alias("__kept_fp"))
        .agg(F.count("*").alias("__copies"))
    )
    # an id that stands in several rows of its component: the smallest of its fingerprints counts
    first = kept.groupBy("__kept", "root").agg(
        F.min_by("__copies", "__kept_fp").alias("__copies"), F.min("__kept_fp").alias("__kept_fp")
    ).drop("root")
    rows = marked.join(
        first, F.col(f"`{key}`").eqNullSafe(F.col("__kept")) & (F.col("__fp") == F.col("__kept_fp"))
    )
    single = rows.filter("__copies = 1")
    order = Window.partitionBy("__kept", "__kept_fp").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in columns]))
    repeated = rows.filter("__copies > 1").withColumn("__rank", F.row_number().over(order)).filter("__rank = 1").drop("__rank")
    return single.union(repeated).select(*[F.col(f"`{c}`") for c in columns])
