"""Importance resampling against a brute force, and its table against the library's hashes."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from quayside.llm import importance

from tests.llm.conftest import DOCS


def features(text, n):
    folded = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
    return words, [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute(rows, target, n=1, buckets=10_000, least=20, pct=10):
    def bucket(g):
        return zlib.crc32(g.encode()) % buckets

    s, t = [0] * buckets, [0] * buckets
    for held, texts in ((s, [x for _, x in rows]), (t, target)):
        for x in texts:
            for g in features(x, n)[1]:
                held[bucket(g)] += 1
    big_s, big_t = sum(s), sum(t)
    out = []
    for i, x in rows:
        words, grams = features(x, n)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in map(bucket, grams))
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(grams), weight, score, len(words) >= least])
    fit = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    drawn = {id(r): k for k, r in enumerate(fit[: pct * len(fit) // 100], 1)}
    return sorted(((*r[:4], drawn.get(id(r))) for r in out), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    vocabulary = ["Alpha", "beta", "ça", "日本語", "x" * 40, "y" * 33 + "é", "a1", "ÄÖ", "don't", "q-r", "Z9", "É", "\U0001f600", "w" * 8, "v" * 16]
    texts = [" ".join(rng.choice(vocabulary) + rng.choice(["", ",", "\x1f", "\n", " "]) for _ in range(rng.randrange(60))) for _ in range(80)]
    rows = [*enumerate(texts), (500, None), (501, ""), (502, "..."), (None, texts[3] + " beta" * 30), (7, texts[7]), (600, "beta " * 40), (601, "beta " * 40)]
    return rows, ["alpha beta Beta", None, "ça 日本語", "", "new words only"]


@pytest.mark.parametrize(("n", "buckets"), [(1, 10_000), (1, 7), (3, 97)])
def test_against_brute_force(sp, corpus, n, buckets):
    rows, target = corpus
    docs = sp.createDataFrame([(i, t, None, "s", 0) for i, t in rows], DOCS).selectExpr("*", "1 as row", "2 as id", "3 as weight", "4 as at", "5 as n_words")
    wanted = sp.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(docs.repartition(5), wanted, n_words=n, buckets=buckets, draw_pct=30)
    assert rows_of(got) == brute(rows, target, n, buckets, pct=30)


def test_texts_beyond_a_block_and_one_partition(sp, corpus, monkeypatch):
    rows, target = corpus
    import pyarrow as pa

    texts = pa.array([t for _, t in rows])
    for n in (1, 2):
        found = {}
        for size in (16, 300, 1 << 22):
            monkeypatch.setattr(importance, "BLOCK_BYTES", size)
            words, sums = np.zeros(len(rows), int), np.zeros(len(rows), int)
            for of, data, bounds in importance._blocks(texts, n):
                slices, piece, count = importance._ngrams(data, bounds, n)
                table = importance.Interned(slices, 1000)
                np.add.at(words, of, count)
                np.add.at(sums, of[piece], table.bucket[table.slot_of])
            found[size] = (words.tolist(), sums.tolist())
        assert found[16] == found[300] == found[1 << 22]
        assert found[16][0] == [len(features(t, 1)[0]) for _, t in rows]


def test_hashes_are_the_librarys():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 4000, np.uint8)
    start, size = rng.integers(0, 3900, 600), rng.integers(0, 80, 600)
    size[:33] = np.arange(33)
    got = importance._Slices(data, start, size).xxh64(42)
    assert got.tolist() == [xxhash.xxh64_intdigest(data[b : b + n].tobytes(), 42) for b, n in zip(start, size, strict=True)]


def test_equal_hashes_of_different_bytes_stay_apart():
    words = [b"a", b"bb", b"a", b"ab", b"ba", b"x" * 17, b"x" * 16 + b"y", b"x" * 17, b"ab"]
    data = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words])
    start = np.cumsum(size) - size
    table = importance.Interned(importance._Slices(data, start, size), 1000, hashes=np.zeros(len(words), np.uint64))
    slots = table.slot_of.tolist()
    assert len(set(slots)) == len(set(words)) and all((slots[i] == slots[j]) == (words[i] == words[j]) for i in range(9) for j in range(9))
    assert table.count[table.slot_of].tolist() == [words.count(w) for w in words]
    assert table.bucket[table.slot_of].tolist() == [zlib.crc32(w) % 1000 for w in words]


def test_empty_tables(sp):
    none = sp.createDataFrame([], "doc_id long, text string")
    some = sp.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    assert importance.resample(none, some).count() == 0
    assert rows_of(importance.resample(some, none)) == brute([(1, "a b " * 20)], [])
