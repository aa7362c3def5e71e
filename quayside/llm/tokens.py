"""Tokenizer files inside tasks, with a memory of the words they have seen.

A tokenizer cuts a text at white space before it merges, so a text is cut at
spaces first and a repeated word is looked up. A cut is made only where it changes nothing (tests hold texts of every
letter below U+0250 before every mark against the library):

* ``lead`` tokenizers (byte-level, a space starts the next word): at a single space between two
  characters that are not white space.
* others (white space is dropped): at every space, line break and tab.

Added tokens hold no white space, so the library finds them inside a piece as it would in the text.

Tokenizers of the second kind need no mark for the first piece: Arrow cuts a call's texts, numbers their words and
lays the ids out again, so Python sees a word once a call. Words that are new are asked of the library many at a time
where its tokens tell the end of a word.
"""

from __future__ import annotations

import gc
import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMO = 1_000_000  # remembered words of a worker process
_NEAR_SPACE = re.compile(r" \s|\s |^\s|\s$")
_MARKS = ".,;:!?#$%&*"
_CUT = re.compile(r"(?<=\S) (?=\S)")
# below U+0250 there are no combining marks, and but for U+0130 a character's lower case is one character, whatever is beside it
_PLAIN = re.compile("[\0-\u012f\u0131-\u024f]*").fullmatch
_LETTERS = [c for c in map(chr, range(0x250)) if c.isalpha() and c != "\u0130"]
_WORD = f"^[{''.join(_LETTERS)}]+[{_MARKS}]*$"
JOINED = 256  # new words said to the library at a time


class WordEncoder:
    """Ids of whole texts as bytes of little-endian unsigned integers of ``dtype``."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.lead = "".join(self._tokens("a b")) != "".join(self._tokens("ab"))
        self.one_case = all(self._tokens(c) == self._tokens(c.lower()) for c in ["Ab", *_LETTERS])
        self.last = self._last_of_words()
        self.memo: dict[str | tuple[str], bytes] = {}

    def _tokens(self, text: str) -> list[str]:
        # word-end marks aside: does a space leave a trace?
        return [t.replace("</w>", "") for t in self.tokenizer.encode(text, add_special_tokens=False).tokens]

    def _last_of_words(self) -> np.ndarray | None:
        """Whether an id ends a word; None if ids do not tell, or a run of plain letters is not always one word."""
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        if self.lead or not suffix:
            return None
        vocab = self.tokenizer.get_vocab()
        last = np.zeros(max(vocab.values()) + 1, bool)
        last[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        said = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in ["".join(_LETTERS), *_LETTERS]]
        return last if all(ids and last[ids[-1]] and last[ids].sum() == 1 for ids in said) else None

    def _pieces(self, text: str) -> list[str | tuple[str]]:
        parts = _CUT.split(text) if _NEAR_SPACE.search(text) else text.split(" ")
        # a later part stands for itself after a space; the first one is a tuple, as no character is free for a mark
        return [(parts[0],), *parts[1:]]

    def _said(self, piece: str | tuple[str]) -> str:
        if isinstance(piece, tuple):
            return piece[0]
        return " " + piece

    def _learn(self, new: set[str | tuple[str]]) -> dict[str | tuple[str], bytes]:
        """Ids of pieces not remembered. A mark after a letter is a word of its own to these tokenizers, so
        a piece that ends in marks is put together from the rest and the marks; where case makes no difference,
        a piece is looked up in lower case (plain characters only, whose lower case is the same everywhere)."""
        memo, parts, ask = self.memo, {}, {}
        fresh: dict[str | tuple[str], bytes] = {}
        if self.last is not None:
            fresh = self._said_together([p for p in new if p.isalpha() and p.islower() and _PLAIN(p)])
            new = new.difference(fresh)
        for p in new:
            first = isinstance(p, tuple)
            word = p[0] if first else p
            core = word.rstrip(_MARKS)
            whole = core == word and not (self.one_case and _PLAIN(word) and not word.islower())
            # U+0130, whose lower case is a letter and a combining mark, takes the marks to itself
            if not whole and core and core[-1] < "\u0250" and core[-1] != "\u0130" and core[-1].isalpha() and "<|" not in core:
                rest = word[len(core) :]
                tail = (rest,) if self.lead else rest  # said without a space before it
                if self.one_case and _PLAIN(core):
                    core = core.lower()
                head = (core,) if first else core
                parts[p] = (head, tail)
                ask[head] = None
                if rest:
                    ask[tail] = None
            else:
                ask[p] = None
        ask = [p for p in ask if p not in memo and p not in fresh]
        for at in range(0, len(ask), 4096):
            some = ask[at : at + 4096]
            said = [self._said(p) for p in some] if self.lead else some
            got = self.tokenizer.encode_batch_fast(said, add_special_tokens=False)
            fresh.update(zip(some, [array(self.code, e.ids).tobytes() for e in got], strict=True))
        for p, (core, tail) in parts.items():
            fresh[p] = (memo.get(core) or fresh.get(core, b"")) + (memo.get(tail) or fresh.get(tail, b""))
        return fresh

    def _said_together(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words of plain letters, cut where a word ends."""
        out: dict[str, bytes] = {}
        for at in range(0, len(words), JOINED):
            some = words[at : at + JOINED]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.dtype)
            ends = (np.flatnonzero(self.last[ids]) + 1) * self.dtype.itemsize
            if len(ends) != len(some):
                raise ValueError(f"{len(some)} words came back as {len(ends)}")
            raw, begin = ids.tobytes(), 0
            for word, end in zip(some, ends.tolist(), strict=True):
                out[word] = raw[begin:end]
                begin = end
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        # no cycles arise here, and scanning the memory for some costs a quarter of the time
        gc.disable()
        try:
            return self._encode(texts) if self.lead else self._encode_words(texts)
        finally:
            gc.enable()

    def _remember(self, fresh: dict[str | tuple[str], bytes]) -> None:
        if len(self.memo) + len(fresh) > MEMO:
            self.memo.clear()
        self.memo.update((p, i) for p, i in fresh.items() if len(p[0] if isinstance(p, tuple) else p) <= 48)

    def _looked_up(self, words: pa.Array) -> pa.Array:
        numbered = words.dictionary_encode()
        words = numbered.dictionary.to_pylist()
        ids = list(map(self.memo.get, words))
        fresh = self._learn({w for w, i in zip(words, ids, strict=True) if i is None})
        ids = [fresh[w] if i is None else i for w, i in zip(words, ids, strict=True)]
        self._remember(fresh)
        return pa.array(ids, pa.large_binary()).take(numbered.indices)

    def _ids(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words. Plain letters and the marks behind them (see :meth:`_learn`) are looked up apart, in lower case,
        so that the memory holds a word once."""
        if not self.one_case:
            return self._looked_up(words)
        plain = pc.match_substring_regex(words, _WORD)
        head = pc.if_else(plain, pc.utf8_lower(pc.utf8_rtrim(words, _MARKS)), words)
        marks = pc.if_else(plain, pc.utf8_ltrim(words, "".join(_LETTERS)), pa.scalar("", pa.large_string()))
        return pc.binary_join_element_wise(self._looked_up(head), self._looked_up(marks), pa.scalar(b"", pa.large_binary()))

    def _encode_words(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        spaced = [t.replace("\n", " ").replace("\r", " ").replace("\t", " ") for t in texts]
        cut = pc.split_pattern(pa.array(spaced, pa.large_string()), " ")
        numbered = cut.flatten().dictionary_encode()
        laid = self._ids(numbered.dictionary).take(numbered.indices)
        ends = np.frombuffer(laid.buffers()[1], np.int64)
        cuts = ends[cut.offsets.to_numpy()].tolist()
        raw = memoryview(laid.buffers()[2] or b"")
        return [raw[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def _encode(self, texts: list[str]) -> list[bytes]:
        memo = self.memo
        get = memo.get
        cut = [self._pieces(t) for t in texts]
        found = [[get(p) for p in pieces] for pieces in cut]
        new = {p for pieces, ids in zip(cut, found, strict=True) if None in ids for p, i in zip(pieces, ids, strict=True) if i is None}
        fresh = self._learn(new)
        out = [
            b"".join([fresh[p] if i is None else i for p, i in zip(pieces, ids, strict=True)] if None in ids else ids)
            for pieces, ids in zip(cut, found, strict=True)
        ]
        self._remember(fresh)
        return out


@lru_cache(2)
def encoder(path: str) -> WordEncoder:
    """One per worker process, so that its memory outlives a task."""
    return WordEncoder(path)
