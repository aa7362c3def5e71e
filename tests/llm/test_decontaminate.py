"""Containment search against brute force."""

from __future__ import annotations

import math
import random
import unicodedata

from quayside.llm import decontaminate
from quayside.llm.queries import op5_decontaminate

from tests.conftest import SF_CHECK


def brute_shingles(text):
    low, words, word = (text or "").lower(), [], ""
    for c in low + " ":
        if unicodedata.category(c)[0] in "LMN":
            word += c
        else:
            words += [word] if word else []
            word = ""
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}


def brute(docs, items):
    held, out = {}, {}
    for i, t in docs:
        held.setdefault(i, set()).update(brute_shingles(t))
    own = {}
    for i, t in items:
        own.setdefault(i, set()).update(brute_shingles(t))
    for d, s in held.items():
        for i, x in own.items():
            if x and len(s & x) >= math.ceil(0.8 * len(x) - 1e-9):
                out[d, i] = (len(s & x), len(x))
    return out


def test_query_equals_brute_force(sp):
    docs = [(r.doc_id, r.text) for r in sp.read.parquet(f"{SF_CHECK}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in sp.read.parquet(f"{SF_CHECK}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): (r.n_shared, r.n_shingles) for r in op5_decontaminate(sp, SF_CHECK).collect()}
    assert got == brute(docs, items) and got


def test_scattered_partial_and_defined_cases(sp):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 60)))) for i in range(40)]
    items += [(100, None), (101, ""), (102, "..."), (103, "short one"), (None, "a null item id holds words enough"), (104, items[0][1]), (0, items[0][1])]
    shared = "these words stand in very many items of the set "
    items += [(200 + i, shared + " ".join(rng.choice(vocab) for _ in range(4))) for i in range(20)]
    docs = [(1, None), (2, ""), (3, "Short, one!"), (4, "short one more"), (None, items[5][1]), (5, shared), (5, shared)]
    for n, (_, text) in enumerate(items[:40]):
        words = text.split()
        for hits in (0, 1, 2, 4):
            own = list(words)
            for _ in range(hits):
                own[rng.randrange(len(own))] = "changed"
            filler = [rng.choice(vocab) for _ in range(200)]
            cut = rng.randrange(len(own) + 1)
            # the two halves far apart: containment counts them all the same
            docs.append((1000 + 10 * n + hits, " ".join(filler + own[:cut] + (filler[:50] if hits == 2 else []) + own[cut:]).upper()))
    frame = sp.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item", "2 as h", "'x' as `key`", "3 as item_id")
    got = decontaminate.find_leaks(frame, sp.createDataFrame(items, "item_id long, text string")).collect()
    want = brute(docs, items)
    assert {(r.doc_id, r.item_id): (r.n_shared, r.n_shingles) for r in got} == want
    assert len(got) == len(want) and any(k[0] is None for k in want) and any(v[0] < v[1] for v in want.values())


def test_empty_tables_and_dropping(sp, docs):
    item = "a benchmark passage of some eight or nine words"
    items = sp.createDataFrame([(1, item)], "item_id long, text string")
    rows = docs((1, f"before {item} after"), (1, "clean"), (2, None), (2, None), (3, item)).selectExpr("*", "0 as containment")
    kept = decontaminate.drop_leaks(rows, items)
    assert kept.columns == rows.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == [(1, "clean"), (2, ""), (2, "")]
    assert decontaminate.drop_leaks(rows, items.limit(0)).count() == 5
    assert decontaminate.find_leaks(rows.limit(0), items).count() == 0


def test_item_over_two_rows_of_a_key(sp):
    words = [f"w{i}" for i in range(64)]
    items = [(1, " ".join(words)), (2, "another item of a few words")]
    docs = [(k, " ".join(w)) for k in (7, None) for w in (words[:34], words[30:])] + [(8, " ".join(words[:34])), (9, " ".join(words[30:]))]
    got = decontaminate.find_leaks(sp.createDataFrame(docs, "doc_id long, text string"), sp.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): (r.n_shared, r.n_shingles) for r in got} == brute(docs, items) == {(7, 1): (60, 60), (None, 1): (60, 60)}
