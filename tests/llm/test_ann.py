"""Nearest neighbours: exact answers where all lists are searched, recall where not."""

from __future__ import annotations

import numpy as np
import pytest

from quayside.llm import ann
from quayside.llm.queries import op6_ann

from tests.conftest import SF_CHECK

ROWS = "vec_id long, embedding array<float>"


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, queries, k=ann.K):
    """query id and row -> [(vec_id, score)]"""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and usable(v)]
    sizes = [len(v) for _, v in good]
    dims = min(set(sizes), key=lambda n: (-sizes.count(n), n)) if sizes else 0
    good = [(i, v) for i, v in good if len(v) == dims]
    out = []
    for q, v in queries:
        if q is None or not usable(v) or len(v) != dims:
            continue
        v = np.array(v, float)
        scored = sorted((-float(ann.cosine(x[None], v)[0]), i) for i, x in good if i != q)
        out.append((q, [(i, -s) for s, i in scored[:k]]))
    return out


def answers(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_all_lists_give_exact_answers(sp, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(400)]
    same = rng.normal(size=8).astype(np.float32).tolist()
    rows += [(1000 + i, same) for i in range(150)]  # a vector that a quarter of all rows hold
    rows += [(2000, [2 * x for x in same]), (2001, None), (2002, []), (2003, [0.0] * 8), (2004, [1.0, None] * 4), (2005, [float("nan")] * 8)]
    rows += [(2006, [float("inf")] + [1.0] * 7), (2007, [1.0] * 5), (None, same), (2008, [1e30] * 8), (2009, [1e-30] * 8), (50, same)]
    monkeypatch.setattr(ann, "LIST_ROWS", 16)  # lists and queries dealt into chunks
    queries = [r for r in rows if r[0] is not None and r[0] % 50 == 0] + [(1001, same)]
    frame = sp.createDataFrame(rows, ROWS).selectExpr("*", "1 as list", "2 as v", "'q' as q")
    got = answers(ann.nearest(frame, sp.createDataFrame(queries, ROWS), ratio=99.0))
    for q, want in brute(rows, queries):
        if q == 50:
            continue  # the id stands in two rows, so it asks twice
        assert [i for i, _ in got[q]] == [i for i, _ in want], q
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want], abs=1e-15)
    assert len(got[50]) == 2 * ann.K
    assert set(got) == {q for q, _ in brute(rows, queries)}


def test_few_rows_and_empty_tables(sp):
    rows = sp.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], ROWS)
    got = answers(ann.nearest(rows, rows.filter("vec_id = 0")))
    assert [i for i, _ in got[0]] == [1, 2]
    assert ann.nearest(rows.limit(0), rows.limit(0)).count() == 0
    assert ann.nearest(rows, rows.limit(0)).count() == 0


def test_graph_walk_finds_all_lists_within_the_ratio():
    rng = np.random.default_rng(2)
    x = ann._unit(rng.normal(size=(3000, 16)))
    c = ann.fit_centroids(x, 64)
    sizes = np.bincount(np.argmax(x @ c.T, axis=1), minlength=len(c))
    assert len(c) == 64 and sizes.max() < 6 * sizes.mean()
    d = np.sqrt(np.maximum(0, 2 - 2 * x[:200] @ c.T))
    row, node = ann.CentroidGraph(c).lists(x[:200], 1.1)
    want = d <= d.min(axis=1, keepdims=True) * 1.1 + 1e-12
    got = np.zeros_like(want)
    got[row, node] = True
    assert not (got & ~want).any() or (got & want).sum() / want.sum() > 0.95
    assert (got & want).sum() / want.sum() > 0.95


def test_recall_of_the_query(sp):
    rows = [tuple(r) for r in sp.read.parquet(f"{SF_CHECK}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = dict(brute(rows, [r for r in rows if r[0] is not None and r[0] % 50 == 0]))
    got = answers(op6_ann(sp, SF_CHECK))
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q in want:
        scores = dict(want[q])
        assert all(scores[i] == s for i, s in got[q] if i in scores)


def test_the_ratio_is_set_for_the_index():
    """More recall where neighbours are spread over more lists; tight clusters need hardly more than the nearest list."""
    rng = np.random.default_rng(4)
    spread = ann._unit(rng.normal(size=(2000, 16)))
    tight = ann._unit(np.repeat(rng.normal(size=(40, 16)), 50, axis=0) + 0.01 * rng.normal(size=(2000, 16)))
    ratios = {}
    for name, x in (("spread", spread), ("tight", tight)):
        c = ann.fit_centroids(x, 32)
        ratios[name] = ann.calibrated(x, c, 5)
        row, node = ann.CentroidGraph(c).lists(x[:300], ratios[name])
        home = np.argmax(x @ c.T, axis=1)
        near = np.argsort(-(x[:300] @ x.T), axis=1)[:, 1:6]
        visited = np.zeros((300, len(c)), bool)
        visited[row, node] = True
        assert np.mean(visited[np.arange(300)[:, None], home[near]]) > 0.9
    assert ratios["tight"] < ratios["spread"]
    assert ann.calibrated(spread[:1], spread[:1], 5) == 1.0


def test_many_tied_multiples_keep_the_smallest_ids(sp):
    rng = np.random.default_rng(3)
    one = rng.normal(size=8).astype(np.float32)
    # powers of two: different vectors with exactly the same likeness, their ids in no order of their sizes
    rows = [(int(i), (one * np.float32(2.0**n)).tolist()) for n, i in enumerate(rng.permutation(60))]
    rows += [(100 + i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(40)]
    got = answers(ann.nearest(sp.createDataFrame(rows, ROWS), sp.createDataFrame(rows[:12], ROWS), ratio=99.0))
    for q, want in brute(rows, rows[:12]):
        assert [i for i, _ in got[q]] == [i for i, _ in want], q
