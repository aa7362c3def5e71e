"""Suffix dedup against a table of every window, and its merge against sorting."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from quayside.llm import suffix_dedup as s
from quayside.llm.queries import op10_suffix_dedup

from tests.conftest import SF_SMALL


def brute(texts, length=s.LENGTH):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        hit = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                hit[i : i + length] = b"\x01" * length
        kept = bytes(b for b, h in zip(r, hit, strict=True) if not h)
        runs = sum(1 for i, h in enumerate(hit) if h and (not i or not hit[i - 1]))
        out.append((len(r), sum(hit), runs, hashlib.sha256(kept).hexdigest()))
    return out


def digest(frame):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect()}


def test_loser_tree_merges_and_knows_shared_prefixes():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 7):
        runs = []
        for _ in range(k):
            own = sorted((bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))), bytes([rng.randrange(3)])) for _ in range(rng.randrange(30)))
            runs.append((own, [0, *(s.shared(a[0], b[0]) for a, b in zip(own, own[1:], strict=False))] if own else []))
        got = list(s.LoserTree(runs))
        assert [g[0] for g in got] == sorted(r for own, _ in runs for r in own)
        for a, b in zip(got, got[1:], strict=False):
            assert b[2] == s.shared(a[0][0], b[0][0])


def test_shared():
    rng = random.Random(2)
    for _ in range(500):
        a = bytes(rng.choice(b"ab") for _ in range(rng.randrange(90)))
        b = a[: rng.randrange(len(a) + 1)] + bytes(rng.choice(b"ab") for _ in range(rng.randrange(40)))
        n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert s.shared(a, b) == n == s.shared(a, b, n // 2)


def test_equal_windows_have_equal_anchors(monkeypatch):
    rng = random.Random(3)
    core = bytes(rng.choice(b"abcd") for _ in range(1500))
    a, b = b"x" * 700 + core + b"y" * 90, bytes(rng.choice(b"abcd") for _ in range(333)) + core

    def anchor_of(raw):
        return {p: (at - p, h) for first, last, at, h in zip(*s.anchors(raw), strict=True) for p in range(first, last + 1)}

    one, two = anchor_of(a), anchor_of(b)
    assert set(one) == set(range(len(a) - s.LENGTH + 1))
    for i in range(len(core) - s.LENGTH + 1):
        assert one[700 + i] == two[333 + i]
    monkeypatch.setattr(s, "CHUNK", 517)
    s._powers.cache_clear()
    assert anchor_of(a) == one
    s._powers.cache_clear()


def corpus(rng):
    word = lambda n: " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 8))) for _ in range(n))
    base, passage, edge = word(400), word(90), word(70)
    texts = [None, "", "short", base, base, base[:300] + "X" + base[300:], base.replace(" a", " zz"), passage + word(100), word(60) + passage + word(10)]
    texts += [word(rng.randrange(40)) + passage[rng.randrange(60) :] + word(30) for _ in range(25)]
    texts += [passage[: 400 + i] + word(20) for i in range(-3, 4)]
    texts += ["q" * 399, "q" * 400, "r" * 401, "abc" * 400, "z" * 1500, "z" * 700, edge + edge, (word(70) + " ") * 3, "é" * 199 + "a" + "é" * 199 + "b"]
    # families: left and right halves shared with different partners
    left, right = word(60), word(60)
    texts += [left + right, left[-260:] + right[:300] + word(30), word(30) + left[-330:] + right[:90] + word(20), left[-90:] + right[:330]]
    texts += [left[-a:] + right[:b] + word(5) for a, b in ((390, 20), (20, 390), (200, 200), (201, 199), (150, 249), (300, 130))]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(docs, seed):
    texts = corpus(random.Random(seed))
    rows = docs(*enumerate(texts)).selectExpr("*", "'d' as d", "1 as removed", "2 as n_spans", "3 as digest")
    got = s.remove_repeats(rows.repartition(3))
    assert digest(got) == dict(enumerate(brute(texts)))
    assert got.columns == [c for c in rows.columns if c != "n_spans"] + ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]


@pytest.mark.parametrize("hidden", [False, True])
def test_open_records_are_exact(docs, monkeypatch, hidden):
    """Looking at one neighbour leaves records open; hiding its proof sends every possible window to the third round."""
    real = s._gaps
    monkeypatch.setattr(s, "REACH", 1)
    if hidden:
        monkeypatch.setattr(s, "_gaps", lambda batches: real(b.assign(proofs=[[]] * len(b)) for b in batches))
    texts = corpus(random.Random(4))[:30]
    assert digest(s.remove_repeats(docs(*enumerate(texts)))) == dict(enumerate(brute(texts)))


def test_null_ids_and_empty_table(docs):
    rows = docs((None, "k" * 500), (None, "k" * 500), (1, None))
    assert sorted(r.n_removed for r in s.remove_repeats(rows).collect()) == [0, 500, 500]
    assert s.remove_repeats(rows.limit(0)).count() == 0


def test_query_on_given_documents(sp):
    rows = sp.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in rows], brute([r.text for r in rows]), strict=True))
    assert digest(op10_suffix_dedup(sp, SF_SMALL)) == want


def test_families_cut_by_splitters(sp, docs, monkeypatch):
    """Many ranges and runs of a few records: near copies whose partners lie behind a range's end."""
    monkeypatch.setattr(s, "RUN_ROWS", 9)
    rng = random.Random(6)
    word = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(n))
    texts = []
    for _ in range(12):
        left, right = word(60)[:250], word(90)[:360]
        texts += [word(20) + left[-rng.randrange(20, 250) :] + right[: rng.randrange(150, 360)] + word(20) for _ in range(9)]
    before = sp.conf.get("spark.sql.shuffle.partitions")
    sp.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = digest(s.remove_repeats(docs(*enumerate(texts)).repartition(3)))
    finally:
        sp.conf.set("spark.sql.shuffle.partitions", before)
    assert got == dict(enumerate(brute(texts)))


def test_a_hot_record_is_merged_once_a_run(sp, monkeypatch):
    """Equal records all come out proved, while a run sends one of them into the merge."""
    rng = random.Random(7)
    text = lambda n: bytes(rng.choice(b"abcdefgh") for _ in range(n))
    hot = (text(500), text(60))
    pairs = [hot] * 3000 + [(text(500), text(60)) for _ in range(300)] + [(hot[0], text(60)), (hot[0][:450] + text(50), hot[1])]
    rng.shuffle(pairs)
    rows = [(hashlib.sha256(str(i).encode()).digest(), 60, 0, -100, 60, right, left) for i, (right, left) in enumerate(pairs)]
    schema = "digest binary, a long, p1 long, l1 long, l2 long, right binary, left binary"
    frame = sp.createDataFrame(rows, schema).repartition(4)
    opened = s._opened

    def few(row):
        assert row["rows"] < 400, "equal records of a run meet in one task"
        return opened(row)

    monkeypatch.setattr(s, "_opened", few)
    got = {bytes(r.digest): r for r in s.neighbours(frame, "right", "left").collect()}
    assert len(got) == len(rows)
    for (d, *_, right, left) in rows:
        r = got[d]
        if (right, left) == hot:
            assert r.settled and r.best == 500 and (500, 60) in {(p.k, p.o) for p in r.pairs}
        elif right == hot[0]:
            assert r.best == 500 and not r.pairs == []
        elif right[:450] == hot[0][:450]:
            assert r.best >= 450 and (not r.settled or max(p.o for p in r.pairs) == 60)
        else:
            assert not r.pairs


def test_third_round_grows_with_its_records(docs, monkeypatch):
    """Near copies of one passage, all left open: rows of a band follow the records, not records times windows."""
    real, held = s.written, {}

    def noted(frame, name):
        held.setdefault(name, []).append(real(frame, name))
        return held[name][-1]

    gaps = s._gaps
    monkeypatch.setattr(s, "REACH", 1)
    monkeypatch.setattr(s, "written", noted)
    monkeypatch.setattr(s, "_gaps", lambda batches: gaps(b.assign(proofs=[[]] * len(b)) for b in batches))
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    left, right = word(300), word(380)
    texts = [word(50) + left[-rng.randrange(40, 300) :] + right[: rng.randrange(150, 380)] + word(50) for _ in range(150)]
    assert digest(s.remove_repeats(docs(*enumerate(texts)))) == dict(enumerate(brute(texts)))
    records = held["open-groups"][0].count()
    assert held["open-records"][0].count() > 50 and len(held["bands"]) == len(s.BANDS)
    assert max(b.count() for b in held["bands"]) <= 6 * records
