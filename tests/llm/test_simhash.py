"""Fingerprints, links and components against brute force."""

from __future__ import annotations

import random

import numpy as np
import xxhash

from quayside.llm import simhash
from quayside.llm.components import components
from quayside.llm.queries import op3_simhash

from tests.conftest import SF_SMALL


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(prints):
    prints = sorted(set(prints))
    root = {p: p for p in prints}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= simhash.DISTANCE:
                root[find(a)] = find(b)
    return {p: find(p) for p in prints}


def test_fingerprint():
    rng = random.Random(3)
    texts = [None, "", " \t\n", "one", "Two Words", "a b c", "a b c d", "É é X Y z \x1c w", "w " * 9000]
    texts += [" ".join(rng.choice("ab cd EF gh IJ").strip() or "x" for _ in range(rng.randrange(60))) for _ in range(40)]
    for t in texts:
        assert simhash.fingerprint(t) == brute_print(t), t


def test_tree_connects_what_is_linked():
    rng = np.random.default_rng(7)
    centre = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    near = [c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, rng.integers(0, 6), dtype=np.uint64)) for c in centre for _ in range(80)]
    x = np.unique(np.array([*near, *rng.integers(0, 1 << 63, 300, dtype=np.uint64)], np.uint64))
    got = list(range(len(x)))

    def find(a):
        while got[a] != a:
            a = got[a]
        return a

    for a, b in simhash.tree_links(x):
        assert int(x[a] ^ x[b]).bit_count() <= simhash.DISTANCE
        got[find(a)] = find(b)
    want = brute_roots(x.tolist())
    assert len({find(i) for i in range(len(x))}) == len(set(want.values()))


def test_links_with_shards_split_again(sp):
    """A shard size of 120 forces several rounds of splitting; one cluster holds most prints."""
    rng = random.Random(9)
    prints = {rng.getrandbits(64) for _ in range(200)}
    centre = rng.getrandbits(64)
    for _ in range(500):
        prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 5))))
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    frame = sp.createDataFrame([(v,) for v in signed.values()], "fp bigint")
    roots = {r.node: r.root for r in components(simhash.links(frame, shard=120)).collect()}
    want = brute_roots(prints)
    groups_got, groups_want = {}, {}
    for p, v in signed.items():
        groups_got.setdefault(roots.get(v, v), set()).add(p)
        groups_want.setdefault(want[p], set()).add(p)
    assert sorted(map(sorted, groups_got.values())) == sorted(map(sorted, groups_want.values()))


def test_components_of_chains_stars_and_loops(sp):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 301), (301, 300), (300, 301)]
    got = {r.node: r.root for r in components(sp.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 300: 300, 301: 300}
    assert components(sp.createDataFrame([], "a long, b long")).count() == 0


def test_query_on_given_documents(sp):
    rows = sp.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: brute_print(r.text) for r in rows}
    roots = brute_roots(prints.values())
    least = {}
    for i, p in prints.items():
        least[roots[p]] = min(i, least.get(roots[p], i))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op3_simhash(sp, SF_SMALL).collect()}
    assert got == {i: (f"{p:016x}", least[roots[p]]) for i, p in prints.items()}


def test_defined_cases_and_dropping(docs):
    text = " ".join(f"word{i}" for i in range(60))
    rows = docs((5, text), (3, text), (3, text), (9, None), (8, ""), (None, text + " more"), (None, "alone in the world"), (7, "quite another text here"))
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(rows).select("doc_id", "component_id").collect()}
    assert {(5, 3), (3, 3), (9, 8), (8, 8), (7, 7), (None, None)} <= found
    wide = rows.selectExpr("*", "1 as fp", "2 as root", "'k' as component_id")
    kept = simhash.drop_near_duplicates(wide)
    assert kept.columns == wide.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [3, 7, 8]
    assert ids.count(None) >= 1
    assert simhash.drop_near_duplicates(rows.limit(0)).count() == 0
    assert simhash.near_duplicates(rows.limit(0)).count() == 0


def test_one_id_in_two_components_keeps_both(docs):
    rows = docs((1, "a first text about one thing"), (1, "some entirely different words stand here"))
    assert simhash.drop_near_duplicates(rows).count() == 2
