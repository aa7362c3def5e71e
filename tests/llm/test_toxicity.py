"""The grammar's readings, the learned model's held-out accuracy, and the defined cases."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import toxicity as t
from quayside.llm.queries import op9_toxicity

from tests.conftest import SF_CHECK

LABELS = "doc_id long, quality int, toxic int"


def read(text, learned=()):
    counts = t.Scanner(tuple(learned)).events(text)
    return {e: int(n) for e, n in zip(t.EVENTS, counts, strict=True) if n}


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (None, {}),
        ("", {}),
        ("the weather is fine. you are kind", {}),
        ("what an idiot", {"insult": 1}),
        ("You are an IDIOT, you clown", {"insult@target": 2}),
        ("you are not an idiot", {"negated insult": 1}),
        ("not that we care much but idiot", {"insult": 1}),
        ("he said you are an idiot", {"reported insult": 1}),
        ("he said so. idiot", {"insult": 1}),
        ("they will kill time", {"threat@target": 1}),
        ("we never hurt", {"negated threat": 1}),
        ("I will kill you and burn your house", {"threat": 1, "threat@target": 2}),
        ("we kill all of you", {"threat": 1}),
        ("I will never hurt you", {"negated threat": 1}),
        ("beat the eggs", {"threat": 1}),
        ("scumbag", {}),
        ("grumpf you grumpfling", {"insult": 1, "insult@target": 1}),
        ("so gloomy and gloomily", {"suspect": 1}),
        ("nice\nloser\nnice", {"insult": 1}),
    ],
)
def test_readings(text, want):
    assert read(text, [("grump", True, "insult"), ("gloomy", False, "suspect")]) == want


def test_composition_equals_running_in_turn():
    symbols = {"a", "b"}
    swap = t.Transducer({(0, "a"): (1, "b", None), (1, "a"): (0, "a", None)}, {})
    mark = t.Transducer({(0, "b"): (0, "b", "seen")}, {})
    both = t.compose(swap, mark, symbols)
    for word in ("abab", "aabb", "bbaa", "aaaa"):
        s1, s2, s = 0, 0, both.start
        for c in word:
            s1, mid, _ = swap.step(s1, c)
            s2, out, event = mark.step(s2, mid)
            s, got, got_event = both.step(s, c)
            assert (got, got_event, s) == (out, event, (s1, s2))


def test_long_text_with_many_clauses():
    assert read("you idiot. " * 20_000) == {"insult@target": 20_000}
    assert read("idiot " * 20_000) == {"insult": 20_000}


def test_query_contract_and_accuracy(sp):
    rows = op9_toxicity(sp, SF_CHECK).collect()
    labels = {r.doc_id: r.toxic for r in sp.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    assert len(rows) == sp.read.parquet(f"{SF_CHECK}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    unseen = [(labels[r.doc_id], r.predicted, r.score) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    toxic = [p for y, p, _ in unseen if y == 1]
    clean = [p for y, p, _ in unseen if y == 0]
    assert np.mean(toxic) > 0.9 and np.mean(clean) < 0.02


def test_held_out_labels_teach_nothing(sp):
    docs = sp.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = sp.read.parquet(f"{SF_CHECK}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(t.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert t.learn(docs, labels, teach=~t.held_out()) == t.learn(docs, flipped, teach=~t.held_out())


def test_threats_count_and_look_alikes_do_not(sp):
    """A threat with its target is toxic by itself; words that only begin like an insult are not."""
    docs = sp.read.parquet(f"{SF_CHECK}/documents.parquet")
    model = t.learn(docs, sp.read.parquet(f"{SF_CHECK}/labels.parquet"), teach=~t.held_out())
    scanner = t.Scanner(model.learned)
    toxic = ["I will kill you and burn your house down.", "They will kill him.", "I will kill you."]
    clean = ["Morocco lies in Africa. Morocco has mountains.", "Teams that lose one match often lose the next.", "He never hurt them."]
    assert (model.score(toxic, scanner) >= t.THRESHOLD).all()
    assert (model.score(clean, scanner) < t.THRESHOLD).all()
    assert all(len(w) >= 5 for w, stem, _ in model.learned if stem)


def test_a_stem_with_a_clean_word_is_no_insult(sp, docs):
    toxic = [f"grumbl{end} all day" for end in ("axo", "ebu", "ity", "orf", "uke", "yl")]
    for clean, learned in (("all day", True), ("grumbles all day", False)):
        rows = docs(*enumerate([*toxic, clean, "a fine day"]))
        labels = sp.createDataFrame([(i, 0, int(i < 6)) for i in range(8)], LABELS)
        stems = [w for w, stem, kind in t.learn(rows, labels).learned if stem and kind == "insult"]
        assert any(w.startswith("grum") for w in stems) == learned


def test_defined_cases(sp, docs):
    rows = docs((1, "you idiot, you worthless clown"), (1, "fine"), (None, None), (2, ""), (3, "all is well")).selectExpr("*", "'x' as toxic", "2 as x")
    labels = sp.createDataFrame([(1, 0, 1), (1, 1, 0), (None, 0, 1), (2, None, None), (9, 0, 1)], LABELS)
    for some in (labels, labels.limit(0)):
        kept = t.drop_toxic(rows, some)
        assert kept.columns == rows.columns
        assert sorted(r.text or "" for r in kept.collect()) == ["", "", "all is well", "fine"]
    assert t.drop_toxic(rows.limit(0), labels).count() == 0


def test_only_copies_teach_once(sp, docs):
    texts = [f"extraordinary thing {i} with other words {i * 7} beside it" for i in range(20)]
    rows = docs(*enumerate([*texts, texts[0], texts[1].upper().replace(" ", "  ")]))
    labels = sp.createDataFrame([(i, 0, 0) for i in range(22)], LABELS)
    assert sorted(" ".join(r.text.lower().split()) for r in t.sample(rows, labels).collect()) == sorted(texts)
