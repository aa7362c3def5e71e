"""Token counts and token files against the library on whole texts."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import tokenizers

from quayside.llm import token_counts, token_files
from quayside.llm.queries import op7_token_counts, op8_token_files, tokenizer
from quayside.llm.store import fresh_path
from quayside.llm.tokens import WordEncoder

from tests.conftest import SF_SMALL

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"
HARD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "it's 's don 't x", "a\n b", "a \nb\n\n c\t d", "<|endoftext|>", "x <|endoftext|> y<|endoftext|>",
    "<|startoftext|>Hi THERE", "x<|ENDOFTEXT|>y Z<|endoftext|>Y.", "É é ́x İstanbul ΣΑΣ ς", "a b   c", "\x1c a \x1f b\x85c", "日本 語", "\U0001f600 \U0001f600‍ x",
    "123 4567 8", "$$$ a.b,c !?", "w" * 5000, "ab " * 4000,
]


@pytest.mark.parametrize("name", [BYTE, WORD])
def test_pieces_encode_as_whole_texts(name):
    own, library = WordEncoder(tokenizer(name)), tokenizers.Tokenizer.from_file(tokenizer(name))
    assert own.lead == (name == BYTE)
    rng = random.Random(1)
    alphabet = ["a", "B", " ", "  ", "\n", "'s", "é", "é", "1", "-", "\t", "<|endoftext|>", " ", "日", "Σ", "\x1c", " "]
    texts = HARD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(25))) for _ in range(1500)]
    for t, got in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(got, own.dtype).tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)
    # a small memory changes nothing
    import quayside.llm.tokens as tokens

    keep, tokens.MEMO = tokens.MEMO, 50
    try:
        assert [own.encode([t])[0] for t in texts[:300]] == WordEncoder(tokenizer(name)).encode(texts[:300])
    finally:
        tokens.MEMO = keep


@pytest.mark.parametrize("name", [BYTE, WORD])
def test_every_letter_before_every_mark(name):
    """Words that end in any character below U+0250 (U+0130 lower-cases to two), then a mark."""
    own, library = WordEncoder(tokenizer(name)), tokenizers.Tokenizer.from_file(tokenizer(name))
    texts = [f"{a}{chr(c)}{m}{b}" for c in range(0x21, 0x250) for m in ".,;:!?" for a, b in (("Ab", ""), ("", "x"), ("ab ", m))]
    texts += ["BAŞKENTİ.", "İ!", "İİ..", "x İ, y"]
    for t, got in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(got, own.dtype).tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("name", [BYTE, WORD])
def test_every_letter_before_signs(name):
    own, library = WordEncoder(tokenizer(name)), tokenizers.Tokenizer.from_file(tokenizer(name))
    texts = [f"{a}{chr(c)}{m}{b}" for c in range(0x21, 0x250) for m in ("#", "$", "%%", "&", "*", ".%%%", "#,") for a, b in (("Ab", ""), ("", "x"), ("ab ", "'s"))]
    for t, got in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(got, own.dtype).tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_new_words_are_asked_together():
    """Words of plain letters go to the library joined, once whatever their case and marks; ids are the library's."""
    own, library = WordEncoder(tokenizer(WORD)), tokenizers.Tokenizer.from_file(tokenizer(WORD))
    rng = random.Random(2)
    words = ["".join(rng.choice("abcéèçßüñøžığ") for _ in range(rng.randrange(1, 12))) for _ in range(5000)]
    texts = [" ".join(rng.choice([w, w.capitalize(), w + ",", w.upper() + ".", w + ".%%%"]) for w in words[i : i + 100]) for i in range(0, 5000, 100)]
    asked = []

    class Counted:
        def encode_batch_fast(self, said, **options):
            asked.extend(said)
            return library.encode_batch_fast(said, **options)

    own.tokenizer = Counted()
    for t, got in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(got, own.dtype).tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)
    assert len(asked) < len(words) / 50


def test_parts_of_a_batch(monkeypatch):
    """Cut by rows and by bytes; a row beyond the bytes is a part of its own, and no row is lost."""
    monkeypatch.setattr(token_files, "ROWS", 4)
    monkeypatch.setattr(token_files, "TEXT", 10)
    texts = ["", None, "a", "bb", "c" * 11, "d" * 10, "e", "é" * 5, None, *"ffffff"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["key", "text"])
    parts = [p.column("text").to_pylist() for p in token_files._parts(batch)]
    assert [t for p in parts for t in p] == texts
    assert all(len(p) <= 4 and (len(p) == 1 or sum(len((t or "").encode()) for t in p) <= 10) for p in parts)
    assert len(parts) < len(texts)


def test_a_lookup_does_not_grow_with_the_shard():
    """Times of single lookups after the first, with 20,000 and with 2,000,000 keys."""
    import time

    took = {}
    for n in (20_000, 2_000_000):
        h = np.random.default_rng(1).integers(0, 1 << 63, (n, 2)).astype(np.uint64)
        perfect = token_files.PerfectHash.build(h)
        assert sorted(perfect.slots(h).tolist()) == list(range(n))
        begin = time.perf_counter()
        for i in range(300):
            perfect.slots(h[i : i + 1])
        took[n] = time.perf_counter() - begin
    assert took[2_000_000] < 5 * took[20_000]


def test_reading_back_is_one_task_a_shard(sp, docs):
    path = fresh_path(sp, "test-files")
    rows = docs(*[(i, f"word {i} " * 30) for i in range(400)]).repartition(6)
    sp.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shards = token_files.write_token_files(rows, tokenizer(WORD), 2, path).count()
    finally:
        sp.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert shards > 1
    back = token_files.read_token_files(sp, path)
    assert back.rdd.getNumPartitions() == shards and back.count() == 400


def expected_counts(texts):
    library = tokenizers.Tokenizer.from_file(tokenizer(BYTE))
    return [(len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for t in texts]


def test_counts_and_cache(sp, docs):
    cache = fresh_path(sp, "test-cache")
    texts = [*HARD, None, "same", "same", "same"]
    rows = docs(*[(i if i else None, t) for i, t in enumerate(texts)]).selectExpr("*", "'x' as digest", "9 as n_tokens", "1 as packed")
    first = token_counts.count_tokens(rows, tokenizer(BYTE), cache)
    assert first.columns == [c for c in rows.columns if c != "n_tokens"] + ["n_bytes", "n_tokens"]
    assert sorted((r.n_bytes, r.n_tokens) for r in first.collect()) == sorted(expected_counts(texts))
    stored = sp.read.parquet(cache)
    assert stored.count() == len({t or "" for t in texts})
    # a second run encodes what is new only, and another tokenizer has entries of its own
    more = docs((1, "same"), (2, "unseen so far"))
    assert sorted((r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(more, tokenizer(BYTE), cache).collect()) == sorted(
        expected_counts(["same", "unseen so far"])
    )
    assert sp.read.parquet(cache).count() == len({t or "" for t in texts}) + 1
    token_counts.count_tokens(more, tokenizer(WORD), cache).count()
    assert sp.read.parquet(cache).select("tokenizer").distinct().count() == 2
    assert token_counts.count_tokens(rows.limit(0), tokenizer(BYTE), cache).count() == 0


def test_counts_query(sp):
    rows = sp.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: (*e, e[1] > 1024) for r, e in zip(rows, expected_counts([r.text for r in rows]), strict=True)}
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in op7_token_counts(sp, SF_SMALL).collect()} == want


def expected_files(pairs):
    library, out, start = tokenizers.Tokenizer.from_file(tokenizer(WORD)), [], 0
    for key, text in sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1] is not None, p[1] or "")):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    return out


def test_files_query(sp):
    rows = [tuple(r) for r in sp.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = op8_token_files(sp, SF_SMALL)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == expected_files(rows)


def test_files_defined_cases_and_keyed_access(sp, docs):
    pairs = [(i * 3, t) for i, t in enumerate(HARD)] + [(None, "null key"), (None, None), (6, "again"), (6, "again"), (2**40, "far")]
    path = fresh_path(sp, "test-files")
    rows = docs(*pairs).repartition(5).selectExpr("*", "1 as `key`", "2 as file", "3 as start")
    token_files.write_token_files(rows, tokenizer(WORD), 2, path)
    got = [tuple(r) for r in token_files.read_token_files(sp, path).collect()]
    want = expected_files(pairs)
    assert sorted(got, key=lambda r: r[1]) == want
    library = tokenizers.Tokenizer.from_file(tokenizer(WORD))
    asked = sp.createDataFrame([(0,), (9,), (1,), (2**40,), (-5,), (6,)], "doc_id long")
    found = {r.doc_id: r.ids for r in token_files.look_up(asked, path).collect()}
    assert set(found) == {0, 9, 2**40, 6}  # absent keys give no row
    texts = dict(pairs)
    for key in (0, 9, 2**40):
        assert found[key] == [*library.encode(texts[key], add_special_tokens=False).ids, 2]
    assert len(found[6]) == sum(w[2] for w in want if w[0] == 6)
    empty = fresh_path(sp, "test-files")
    assert token_files.write_token_files(rows.limit(0), tokenizer(WORD), 2, empty).count() == 0
    assert token_files.read_token_files(sp, empty).count() == 0


def test_perfect_hash():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 50_000):
        h = rng.integers(0, 1 << 63, (n, 2), dtype=np.uint64)
        slots = token_files.PerfectHash.build(h).slots(h)
        assert sorted(slots.tolist()) == list(range(n))


@pytest.mark.parametrize("name", [BYTE, WORD])
def test_texts_may_hold_nul(name):
    own, library = WordEncoder(tokenizer(name)), tokenizers.Tokenizer.from_file(tokenizer(name))
    rng = random.Random(5)
    texts = ["a \0b", "\0b", "a \0b, \0", "\0 \0", "b, \0, \0.", "x\0y \0\0z."]
    texts += ["".join(rng.choice(["a", "B", " ", "\0", ",", "é", "\n"]) for _ in range(rng.randrange(20))) for _ in range(1500)]
    for t, got in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(got, own.dtype).tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)
