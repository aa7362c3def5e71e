"""The Viterbi codec against the library's unigram search and a full dynamic programme."""

from __future__ import annotations

import random

import numpy as np
import pytest
import sentencepiece

from quayside.llm import piece_codec
from quayside.llm.queries import op2_sentencepiece, tokenizer

from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def codec():
    return piece_codec.PieceCodec(tokenizer("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    with open(tokenizer("piece_bpe_32k.model"), "rb") as f:
        raw = f.read()
    sp = sentencepiece.SentencePieceProcessor()
    sp.LoadFromSerializedProto(raw + b"\x12\x02\x18\x01")  # the same pieces and scores, model type unigram
    return sp


def ids(codec, text):
    return np.frombuffer(codec.encode(text), "<i4").tolist()


def total(codec, pieces, text):
    """Sum of scores of a segmentation (bytes stand for one unknown character each)."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    real = sum(sp.get_score(i) for i in pieces if not sp.is_byte(i))
    byte_run = bytes(int(sp.id_to_piece(i)[3:5], 16) for i in pieces if sp.is_byte(i)).decode()
    return real + len(byte_run) * codec.unknown


def best_score(codec, text):
    """Every piece at every place: no automaton, no units."""
    pieces = {p: v[2] for p, v in codec.automaton.items()}
    t = piece_codec.SPACE + text.replace(" ", piece_codec.SPACE)
    best = [0.0] + [-np.inf] * len(t)
    for end in range(1, len(t) + 1):
        if t[end - 1] not in pieces:
            best[end] = best[end - 1] + codec.unknown
        for start in range(max(0, end - 48), end):
            if t[start:end] in pieces:
                best[end] = max(best[end], best[start] + pieces[t[start:end]])
    return best[-1]


def test_ids_equal_the_librarys_unigram_search(codec, library):
    """Its n-best search is exact; its single-best shortcut does not always return the best path.
    (Pieces that score a billion below the rest are left to the next test: the library adds in single precision.)"""
    rng = random.Random(1)
    words = "the and thereby erst ingly zürich über señor Éclair x-ray don't data_set thing worthless".split(" ")
    for _ in range(150):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(1, 5)))
        first, second = library.nbest_encode(text, nbest_size=2, out_type=int)
        score = [sum(library.get_score(i) for i in x) for x in (ids(codec, text), first, second)]
        assert score[0] == score[1], text
        assert score[1] == score[2] or ids(codec, text) == first, text


def test_best_score_by_full_search(codec):
    rng = random.Random(2)
    for _ in range(60):
        text = "".join(rng.choice("abeinrst  éß日\n▁☃") for _ in range(rng.randrange(1, 30)))
        got = ids(codec, text)
        assert total(codec, got, text) == pytest.approx(best_score(codec, text), rel=1e-12)


def test_round_trip(codec):
    for text in ["", " ", "   ", "a", " a", "a ", "  a   b  ", "\x00\t\n", "é日本\U0001f600", "▁", "word " * 20000, "x" * 3000]:
        assert codec.decode(codec.encode(text)) == text.replace("▁", " ")
    assert codec.encode(None) == b""


def test_frame_keeps_rows_and_columns(sp, docs):
    model = tokenizer("piece_bpe_32k.model")
    rows = docs((1, "some text"), (1, "some text"), (None, None), (2, "")).selectExpr("*", "1 as ids", "'p' as piece_ids")
    got = piece_codec.decode(piece_codec.encode(rows, model), model)
    assert got.columns == [c for c in rows.columns if c != "piece_ids"] + ["piece_ids", "decoded"]
    assert sorted((r.text or "", r.decoded) for r in got.collect()) == [("", ""), ("", ""), ("some text",) * 2, ("some text",) * 2]
    assert piece_codec.encode(rows.limit(0), model).count() == 0


def test_query_round_trips_every_document(sp):
    got = op2_sentencepiece(sp, SF_SMALL)
    assert got.count() == sp.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert got.filter("not round_trip").count() == 0
