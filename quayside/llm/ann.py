"""Approximate nearest neighbours over balanced posting lists.

Index: about the square root of the number of vectors as centroids, from a bounded sample by median splits (two means, then the
half of the points nearer to either), so the lists start out even. Every vector goes to its nearest
centroid's list, and a boundary vector also to the next one within ``NEAR`` times
that distance. A list that grows beyond ``LIST_ROWS`` (dense regions) is dealt into chunks.

Search: a neighbour graph over the centroids, small enough for every task's memory,
is walked best first from fixed entry points; it goes on while it finds centroids within a ratio of
the nearest distance, and those lists are the query's. The ratio is set for the index at hand: for
``CALIBRATE`` sampled vectors the exact neighbours within the sample are looked up, and the ratio is the least that reaches
a list of ``RECALL`` of them. Queries and lists meet by (list, chunk); each meeting keeps the best few by exact cosine, and the best of all meetings win.

Equal vectors are one entry holding the smallest ids (as many as an answer can use), so a vector that a third
of all rows share is compared once.

Defined results: vectors that are null, empty, zero or hold null or non-finite numbers take no part,
nor do those of another length than the most frequent (ties: the shorter). A null id takes no part. Rows that repeat an id
are separate candidates; a query never returns its own id. Fewer than k candidates give fewer rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.store import written

K = 5
SAMPLE_ROWS, SAMPLE_NUMBERS = 20_000, 4_000_000  # the smaller bounds the centroid sample
LISTS = 4096  # at most; else the square root of the number of vectors, rounded up to a power of two
NEAR, REPLICAS = 1.05, 2
RECALL, CALIBRATE = 0.97, 512  # share of sampled vectors' neighbours that the distance ratio is to reach; vectors that set it
DEGREE, ENTRIES, BEAM = 16, 8, 8
LIST_ROWS = 4096
ROUNDING = 1e-14  # a product of unit vectors rounds by less than this for each dimension


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centroids(x: np.ndarray, n: int) -> np.ndarray:
    """At most ``n`` unit centroids of the unit vectors ``x`` by balanced halving."""
    out, todo = [], [np.arange(len(x))] if len(x) else []
    depth = max(0, math.ceil(math.log2(max(n, 1))))
    floor = len(x) / (1 << depth)
    while todo:
        own = todo.pop()
        if len(own) < 2 or len(own) <= floor * 1.5:
            centre = x[own].mean(axis=0)
            out.append(centre if np.abs(centre).max() > 1e-12 else x[own[0]])
            continue
        part = x[own]
        a = part[0]
        b = part[np.argmin(part @ a)]
        for _ in range(6):
            side = part @ b > part @ a
            if side.all() or not side.any():
                break
            a, b = part[~side].mean(axis=0), part[side].mean(axis=0)
        order = own[np.argsort(part @ (b - a), kind="stable")]
        todo += [order[: len(own) // 2], order[len(own) // 2 :]]
    return _unit(np.array(out)) if out else np.empty((0, x.shape[1] if x.ndim == 2 else 0))


class CentroidGraph:
    """Centroids and, for each, its nearest others; walked best first for many vectors at once."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.c = centroids
        n = len(centroids)
        degree = min(DEGREE, n - 1)
        likeness = centroids @ centroids.T
        np.fill_diagonal(likeness, -np.inf)
        near = np.argpartition(-likeness, degree - 1, axis=1)[:, :degree] if degree else np.empty((n, 0), np.int64)
        # a ring through all centroids keeps the graph connected
        self.links = np.concatenate([near, (np.arange(n)[:, None] + [1, n - 1]) % n], axis=1)
        self.entries = np.unique(np.linspace(0, n - 1, min(ENTRIES, n)).astype(np.int64))

    def distances(self, x: np.ndarray, ratio: float) -> np.ndarray:
        """Distance of each unit vector to the centroids the walk reached, infinite for the rest."""
        rows, n = len(x), len(self.c)
        d = np.full((rows, n), np.inf)
        d[:, self.entries] = self._measure(x, np.broadcast_to(self.entries, (rows, len(self.entries))))
        closed = np.zeros((rows, n), bool)
        live = np.arange(rows)
        width = min(BEAM, n)
        while len(live):
            waiting = np.where(closed[live], np.inf, d[live])
            best = d[live].min(axis=1, keepdims=True)
            pick = np.argpartition(waiting, width - 1, axis=1)[:, :width]
            reach = np.take_along_axis(waiting, pick, axis=1)
            some = np.isfinite(reach) & (reach <= best * ratio + 1e-12)
            going = some.any(axis=1)
            live, pick, some = live[going], pick[going], some[going]
            if not len(live):
                break
            r, s = np.nonzero(some)
            closed[live[r], pick[r, s]] = True
            nexts = self.links[pick[r, s]]
            row = np.repeat(live[r], nexts.shape[1])
            node = nexts.ravel()
            new = np.isinf(d[row, node])
            row, node = row[new], node[new]
            d[row, node] = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", x[row], self.c[node])))
        return d

    def _measure(self, x: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ikj->ik", x, self.c[nodes])))

    def lists(self, x: np.ndarray, ratio: float, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs: the centroids within ``ratio`` times a row's nearest distance (``most`` nearest)."""
        rows, nodes = [], []
        for at in range(0, len(x), 256):
            d = self.distances(x[at : at + 256], ratio)
            keep = d <= d.min(axis=1, keepdims=True) * ratio + 1e-12
            if most is not None and most < d.shape[1]:
                keep &= np.argsort(np.argsort(d, axis=1, kind="stable"), axis=1) < most
            r, k = np.nonzero(keep)
            rows.append(r + at)
            nodes.append(k)
        return np.concatenate(rows), np.concatenate(nodes)


def calibrated(x: np.ndarray, centroids: np.ndarray, k: int) -> float:
    """The distance ratio that reaches ``RECALL`` of the ``k`` nearest of sampled unit vectors ``x`` among themselves."""
    if len(x) < 2 or len(centroids) < 2:
        return 1.0
    pick = np.unique(np.linspace(0, len(x) - 1, min(CALIBRATE, len(x))).astype(np.int64))
    likeness = x[pick] @ x.T
    likeness[np.arange(len(pick)), pick] = -np.inf
    k = min(k, len(x) - 1)
    near = np.argpartition(-likeness, k - 1, axis=1)[:, :k]

    def distances(rows: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, 2 - 2 * x[rows] @ centroids.T))

    own = distances(pick)
    least = np.maximum(own.min(axis=1, keepdims=True), 1e-12)
    need = []
    for row, others in enumerate(near):
        d = distances(others)
        home = (d <= d.min(axis=1, keepdims=True) * NEAR) & (np.argsort(np.argsort(d, axis=1, kind="stable"), axis=1) < REPLICAS)
        need.append(np.where(home, own[row] / least[row], np.inf).min(axis=1))
    return float(np.quantile(np.concatenate(need), RECALL)) + 1e-9


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def clean_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    v = F.col("v")
    fine = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v")).filter(
        F.col("id").isNotNull()
        & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    common = fine.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).select("n")
    return fine.join(F.broadcast(common), F.size("v") == F.col("n"), "left_semi")


def _key(vector: str) -> Column:
    """128 bits that stand for a vector in joins."""
    return F.concat_ws(":", F.xxhash64(vector), F.xxhash64(F.reverse(vector), F.lit(1)))


def _pieces(n: Column, cap: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / F.lit(cap))).cast("int")


def nearest(
    vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, ratio: float | None = None
) -> DataFrame:
    """(query_id, rank, key, score): for each row of ``queries`` its ``k`` nearest found among ``vectors`` by cosine.
    ``ratio`` sets the distance ratio by hand."""
    spark = vectors.sparkSession
    rows = written(clean_vectors(vectors, key, vector), "vectors")
    kind = dict(rows.dtypes)["id"]
    # equal vectors: an answer uses k ids of them at most, and one more where the query's own is among them
    own = Window.partitionBy("v").orderBy("id")
    entries = written(
        rows.withColumn("n", F.row_number().over(own)).filter(F.col("n") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(_key("v").alias("e"), "v", "ids"),
        "entries",
    )
    asked = clean_vectors(queries, key, vector).withColumnRenamed("id", "query_id")
    schema = f"query_id {kind}, rank int, `{key}` {kind}, score double"
    first = entries.select("v").take(1)
    if not first:
        return spark.createDataFrame([], schema)
    dims, total = len(first[0].v), entries.count()
    bound = max(1, min(SAMPLE_ROWS, SAMPLE_NUMBERS // dims))
    taken = np.array([r.v for r in entries.orderBy("e").limit(bound).select("v").collect()], float)
    n_lists = int(min(LISTS, max(1, math.isqrt(total)), max(1, len(taken) // 2)))
    sample = _unit(taken)
    fitted = fit_centroids(sample, n_lists)
    ratio = calibrated(sample, fitted, k) if ratio is None else ratio
    centroids = spark.sparkContext.broadcast(fitted)  # LISTS x dims numbers at most

    def assign(most: int | None, within: float):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            graph = CentroidGraph(centroids.value)
            at = None
            for batch in batches:
                at = batch.schema.get_field_index("v")
                for s in range(0, batch.num_rows, 1024):
                    part = batch.slice(s, 1024)
                    row, node = graph.lists(_unit(_matrix(part.column(at), dims)), within, most)
                    moved = part.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays([*moved.columns, pa.array(node.astype(np.int32))], [*moved.schema.names, "list"])

        return run

    posted = written(entries.select("e", "v", F.col("ids")[0].alias("low")).mapInArrow(assign(REPLICAS, NEAR), f"e string, v array<double>, low {kind}, list int"), "lists")
    # a query vector that repeats is searched once
    sought = asked.select("v").distinct().select(_key("v").alias("q"), "v")
    probes = written(sought.mapInArrow(assign(None, ratio), "q string, v array<double>, list int"), "probes")
    # one row per list
    sizes = posted.groupBy("list").agg(_pieces(F.count("*"), LIST_ROWS).alias("chunks")).join(
        probes.groupBy("list").agg(_pieces(F.count("*"), LIST_ROWS).alias("turns")), "list"
    )
    sizes = F.broadcast(sizes)
    left = posted.join(sizes, "list").select(
        "list", F.pmod(F.hash("e", F.lit(1)), "chunks").alias("chunk"), F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), "e", "low", "v"
    )
    right = probes.join(sizes, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.pmod(F.hash("q", F.lit(1)), "turns").alias("turn"), "q", "v"
    )
    keep = k + 1

    def meet(data: pa.Table, ask: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if data.num_rows and ask.num_rows:
            x, q = _matrix(data.column("v"), dims), _matrix(ask.column("v"), dims)
            lows, es, qs = (np.array(c.to_pylist()) for c in (data.column("low"), data.column("e"), ask.column("q")))
            ux, uq = _unit(x), _unit(q)
            for at in range(0, len(q), 512):
                likeness = uq[at : at + 512] @ ux.T
                # all that may belong to the best: the product rounds, the exact score and the id decide
                last = len(x) - min(keep, len(x))
                least = np.partition(likeness, last, axis=1)[:, last] - ROUNDING * dims
                for i, own_likeness in enumerate(likeness):
                    own_pick = np.flatnonzero(own_likeness >= least[i])
                    score = cosine(x[own_pick], q[at + i])
                    order = np.lexsort((lows[own_pick], -score))[:keep]
                    out[0] += [qs[at + i]] * len(order)
                    out[1] += es[own_pick[order]].tolist()
                    out[2] += lows[own_pick[order]].tolist()
                    out[3] += score[order].tolist()
        low_type = data.schema.field("low").type
        return pa.table([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], low_type), pa.array(out[3], pa.float64())], ["q", "e", "low", "score"])

    meeting = ("list", "chunk", "turn")
    found = left.groupBy(*meeting).cogroup(right.groupBy(*meeting)).applyInArrow(meet, f"q string, e string, low {kind}, score double")
    # a boundary vector met twice has the same score twice: equal ranks, merged by distinct
    rank = F.dense_rank().over(Window.partitionBy("q").orderBy(F.desc("score"), "low", "e"))
    best = found.withColumn("r", rank).filter(F.col("r") <= keep).select("q", "e", "score").distinct()
    hits = best.join(entries.select("e", "ids"), "e").select("q", "score", F.explode("ids").alias("vec"))
    numbered = asked.select("query_id", _key("v").alias("q"))
    place = F.row_number().over(Window.partitionBy("query_id", "__row").orderBy(F.desc("score"), "vec"))
    answers = numbered.withColumn("__row", F.monotonically_increasing_id()).join(hits, "q").filter("vec <> query_id")
    return (
        answers.withColumn("rank", place).filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("vec").alias(key), "score")
    )


def cosine(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``x`` with ``q`` in double precision; scaled first so that no square overflows."""
    x, q = x / np.abs(x).max(axis=1, keepdims=True), q / np.abs(q).max()
    return (x * q).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (q * q).sum())
