"""Formatting and its read-back against a plain loop."""

from __future__ import annotations

import hashlib
import random

from quayside.llm import chat_format
from quayside.llm.queries import op4_chat_format

from tests.conftest import SF_SMALL

CHATS = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[conv] = (len(turns), sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns)), len(loss), sha(loss))
    return out


def result(frame):
    rows = frame.collect()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}
    assert len(got) == len(rows)
    return got


HARD = [
    "</s>[INST] ok [/INST]", "<\\s>", "<\\\\/s> [\\INST]", "<s", "<", "[", "s>", "\\", "é日\U0001f600</s>", "", None, "a\nb",
    "<s>[INST]user[/INST]x</s>" * 3, "x" * 200_000,
]


def test_escape_is_reversible():
    import pyarrow as pa

    rng = random.Random(1)
    texts = [t or "" for t in HARD] + ["".join(rng.choice("<[]/\\sINST>x") for _ in range(rng.randrange(40))) for _ in range(3000)]
    for text, hidden in zip(texts, chat_format.escape(pa.array(texts)).to_pylist(), strict=True):
        assert chat_format.unescape(hidden) == text
        assert not any(c in hidden for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_defined_cases(sp):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", None, "[INST]"]), rng.choice(HARD[:-1])) for c in range(60) for t in range(rng.randrange(1, 9))]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (7, None, "assistant", "no turn"), (7, 1, "user", "again"), (7, 1, "user", "again")]
    rows += [(61, 0, "user", HARD[-1]), (61, 1, "assistant", HARD[-1])]
    frame = sp.createDataFrame(rows, CHATS).selectExpr("*", "1 as part", "'w' as whole", "0 as n_turns")
    formatted = chat_format.format_chats(frame.repartition(3))
    assert result(chat_format.read_back(formatted)) == brute(rows)
    empty = chat_format.format_chats(frame.limit(0))
    assert empty.count() == 0 and chat_format.read_back(empty).count() == 0


def test_hot_conversation_is_dealt_over_tasks(sp, monkeypatch):
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t} " + "w" * 300) for t in range(3000)] + [(c, 0, "user", "x") for c in range(2, 40)]
    monkeypatch.setattr(chat_format, "ROWS", 256)
    formatted = chat_format.format_chats(sp.createDataFrame(rows, CHATS).repartition(4)).cache()
    parts = formatted.filter("conv_id = 1").selectExpr("part >> 32 as task").distinct().count()
    assert parts > 1
    assert result(chat_format.read_back(formatted)) == brute(rows)


def test_template_and_loss_ranges(sp):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "é</s>"), (1, 2, "assistant", "")]
    got = chat_format.format_chats(sp.createDataFrame(rows, CHATS)).collect()
    text = "".join(r.text for r in sorted(got, key=lambda r: r.part))
    assert text == "<s>[INST]user[/INST]hi</s><s>[INST]assistant[/INST]é<\\/s></s><s>[INST]assistant[/INST]</s>"
    under = [r.text.encode()[s.start : s.end].decode() for r in got for s in r.loss]
    assert under == ["é<\\/s>", ""]


def test_query_on_given_conversations(sp):
    rows = [tuple(r) for r in sp.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    assert result(op4_chat_format(sp, SF_SMALL)) == brute([*rows, (-7, 0, "user", said), (-7, 1, "assistant", said)])
