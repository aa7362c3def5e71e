"""The pipeline's rows against its stages done by brute force, and odd inputs through every stage."""

from __future__ import annotations

import numpy as np

import corpus_pipeline
from quayside.llm import piece_codec, secret_scan, simhash, toxicity
from quayside.llm.queries import tokenizer

from tests.conftest import SF_SMALL
from tests.llm.conftest import DOCS
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_secret_scan import brute as spans
from tests.llm.test_simhash import brute_print, brute_roots


def masked(text):
    out, at = "", 0
    for start, _, end in spans(text)[1]:
        if start >= at:
            out += text[at:start] + secret_scan.MASK
        at = max(at, end)
    return out + text[at:]


def expected(spark, rows, items, labels):
    model = toxicity.learn(spark.createDataFrame(rows, DOCS), labels, teach=~toxicity.held_out())
    scanner = toxicity.Scanner(model.learned)
    rows = [r for r in rows if model.score([r[1]], scanner)[0] < toxicity.THRESHOLD]
    prints = {r[0]: brute_print(r[1]) for r in rows}
    roots = brute_roots(prints.values())
    first = {}
    for r in sorted(rows):
        first.setdefault(roots[prints[r[0]]], r)
    rows = list(first.values())
    bad = {d for d, _ in leaks([(r[0], r[1]) for r in rows], items)}
    codec = piece_codec.PieceCodec(tokenizer("piece_bpe_32k.model"))
    out = {}
    for i, text, lang, source, n in rows:
        if i not in bad:
            text = None if text is None else masked(text)
            out[i] = (text, lang, source, n if text is None else len(text), np.frombuffer(codec.encode(text), "<i4").tolist())
    return out


def test_run_equals_brute_force(sp):
    rows = [tuple(r) for r in sp.read.parquet(f"{SF_SMALL}/documents.parquet").select(*[c.split()[0] for c in DOCS.split(", ")]).collect()]
    items = [(r.item_id, r.text) for r in sp.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    want = expected(sp, rows, items, sp.read.parquet(f"{SF_SMALL}/labels.parquet"))
    got = corpus_pipeline.run(sp, SF_SMALL)
    assert set(got.columns) == {c.split()[0] for c in DOCS.split(", ")} | {"piece_ids"}
    assert {r.doc_id: (r.text, r.lang, r.source, r.n_chars, r.piece_ids) for r in got.collect()} == want
    assert 0 < len(want) < len(rows)


def test_stages_take_odd_documents(sp):
    long = "plain words here " * 30_000
    rows = [(1, None, None, None, None), (None, None, None, None, None), (2, "", "en", None, 0), (3, long, "en", "s", len(long)),
            (4, "the same row twice", "en", "s", 18), (4, "the same row twice", "en", "s", 18), (None, "token=abcdef12 and text", None, "s", 5)]
    docs = sp.createDataFrame(rows, DOCS).selectExpr("*", "1 as `key`", "'r' as root", "0.5 as score")
    for empty in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(sp, empty, SF_SMALL)
            if stage is not corpus_pipeline.STAGES[-1][1]:
                assert out.columns == docs.columns
            empty = out
        left = empty.collect()
    assert left == []
    kept = docs
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(sp, kept, SF_SMALL)
    texts = sorted(r.text or "" for r in kept.collect())
    assert f"{secret_scan.MASK} and text" in texts and long in texts and texts.count("the same row twice") == 1
    # null and empty texts share fingerprint zero: the smallest id of them stays
    assert texts.count("") == 1


def test_one_stage_per_dealt_operator():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash near-dedup", "benchmark decontamination", "secret scans", "sentencepiece encoding"
    ]
    assert simhash.WORDS == 4 and simhash.DISTANCE == 4
