"""Toxicity by a weighted finite-state pattern grammar over clauses.

A clause's words become symbols: insult, suspect, threat, target, negation, report or
other (a suspect is a stem that toxic texts repeat and others hold now and then). Four transducers are composed into one: negation rewrites an insult, suspect or threat
that follows a negation within three words; reported speech rewrites what follows a reporting
word; target rewrites an insult or threat in a clause that has already
named someone, and whom a threat names within two words; scoring consumes what is left, emitting one weighted event per
symbol. The composed machine runs over matched clauses only: clauses that hold
an insult or threat, found by one Aho-Corasick pass over the whole text.

The grammar's closed lists (targets, negations, reports, threats, first insults) are
fixed; further insults and suspects (words and stems) and the event weights are learned from
at most ``SAMPLE`` labelled rows (those with the smallest id hashes): whole words of many toxic rows first,
then what reaches the most of the rows left. A stem has five letters or more; it is an insult only if no clean row holds a word
under it, else it is at most a suspect, if toxic rows repeat it. A threat with a target starts
out as toxic by itself; labelled rows may say otherwise. Suspects count as far as they exceed their
learned rate in clean text. Only texts
and labels take part: language, source and ids are never inputs.

Defined results: null and empty texts score as a text without matched clauses.
A document with several labels counts as toxic if one says so; null labels and ids teach nothing.
Repeated rows repeat; other columns pass through.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.store import written

SAMPLE = 8000
THRESHOLD = 0.3
# A word or stem may be learned if SUPPORT toxic sample rows hold it (insult) or repeat it (suspect) and PURITY of
# such rows are toxic (a stem held: all). Learned are words with SURE such rows, then the fewest words and stems that
# reach the toxic rows left, each SUPPORT rows and the share GAIN of the toxic rows that the fixed lists miss.
SUPPORT, SURE, GAIN, PURITY = 2, 8, 0.01, 0.85
STEMS = (5, 6, 7, 8)
NAMED = 0.5  # what a clause with a threat and its target scores before labelled rows are seen

INSULTS = "idiot idiots moron morons scum trash loser losers pathetic worthless stupid disgusting clown clowns vermin".split()
THREATS = "kill hurt destroy beat crush smash burn töten umbringen vernichten tuer frapper détruire matar golpear destruir".split()
TARGETS = "you your yours they them he she him her these those du dich dein ihr euch sie tu toi vous vos ils elles usted ustedes ellos ellas".split()
NEGATIONS = "not no never isn't aren't don't nicht kein keine nie pas jamais aucun nunca jamás ningún".split()
REPORTS = "said says wrote quoted claimed called reported sagte schrieb nannte dit écrit appelé dijo escribió llamó".split()
REACH = 3  # words a negation reaches over

BAD = ("insult", "suspect", "threat")
EVENTS = tuple(f"{how}{b}{at}" for b in BAD for how, at in (("", ""), ("", "@target"), ("negated ", ""), ("reported ", "")))
SUSPECT = np.array(["suspect" in e for e in EVENTS])
_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
_BREAK = re.compile(r"[.!?;:\n]")


@dataclass(frozen=True)
class Transducer:
    """``arcs``: (state, symbol) -> (state, symbol, event). A missing arc goes to ``rest``'s
    state (None: stays) and copies its symbol."""

    arcs: dict
    rest: dict
    start: object = 0

    def step(self, state, symbol):
        if (state, symbol) in self.arcs:
            return self.arcs[state, symbol]
        return self.rest.get(state, state), symbol, None


def compose(first: Transducer, second: Transducer, symbols: set[str]) -> Transducer:
    """The machine that feeds ``first``'s output to ``second``, over its reachable state pairs."""
    start = (first.start, second.start)
    arcs, todo, seen = {}, [start], {start}
    while todo:
        a, b = todo.pop()
        for symbol in symbols:
            a2, mid, event = first.step(a, symbol)
            b2, out, event2 = second.step(b, mid)
            arcs[(a, b), symbol] = ((a2, b2), out, event or event2)
            if (a2, b2) not in seen:
                seen.add((a2, b2))
                todo.append((a2, b2))
    return Transducer(arcs, {}, start)


@lru_cache(1)
def grammar() -> Transducer:
    symbols = {*BAD, "target", "negation", "report", "other"}
    bad = BAD
    negation = Transducer(
        {(s, "negation"): (REACH, "negation", None) for s in range(REACH + 1)}
        | {(s, b): (s - 1, f"negated {b}", None) for s in range(1, REACH + 1) for b in bad},
        {s: s - 1 for s in range(1, REACH + 1)},
    )
    reported = Transducer(
        {(s, "report"): (1, "report", None) for s in (0, 1)} | {(1, b): (1, f"reported {b}", None) for b in bad}, {}
    )
    # 0: nobody named; 1: somebody; 2, 3: nobody, one and two words after a threat
    target = Transducer(
        {(s, "target"): (1, "target", None) for s in (0, 1)}
        | {(s, "target"): (1, "threat@target", None) for s in (2, 3)}
        | {(s, "threat"): (2, "threat", None) for s in (0, 2, 3)}
        | {(1, b): (1, f"{b}@target", None) for b in bad},
        {2: 3, 3: 0},
    )
    score = Transducer({(0, e): (0, e, e) for e in EVENTS}, {})
    return compose(compose(compose(negation, reported, symbols), target, symbols), score, symbols)


class Scanner:
    """Finds and reads the matched clauses of whole texts. ``learned``: (word or stem, is it a stem, symbol)."""

    def __init__(self, learned: tuple[tuple[str, bool, str], ...] = ()) -> None:
        words = {w: k for k, names in (
            ("report", REPORTS), ("negation", NEGATIONS), ("target", TARGETS), ("threat", THREATS), ("insult", INSULTS),
        ) for w in names}
        self.kind = {w: k for w, stem, k in learned if not stem} | words
        self.stems = {w: k for w, stem, k in learned if stem}
        self.hooks = ahocorasick.Automaton()
        for w in {*INSULTS, *THREATS, *(w for w, _, _ in learned)}:
            self.hooks.add_word(w, len(w))
        self.hooks.make_automaton()

    def symbol(self, word: str) -> str:
        kind = self.kind.get(word)
        if kind is None:
            kind = next((self.stems[word[:n]] for n in STEMS if word[:n] in self.stems), "other")
        return kind

    def events(self, text: str | None) -> np.ndarray:
        """Counts of ``EVENTS`` over all matched clauses."""
        text = (text or "").lower()
        counts, done, machine = Counter(), 0, grammar()
        for end, n in self.hooks.iter(text):
            at = end - n + 1
            if at < done or (at and text[at - 1].isalnum()):
                continue
            breaks = [text.rfind(c, done, at) for c in ".!?;:\n"]
            stop = _BREAK.search(text, at)
            clause = text[max(*breaks, done - 1) + 1 : stop.start() if stop else len(text)]
            done = stop.end() if stop else len(text)
            state = machine.start
            for word in _WORD.findall(clause):
                state, _, event = machine.step(state, self.symbol(word))
                if event:
                    counts[event] += 1
        return np.array([counts[e] for e in EVENTS], float)


@dataclass(frozen=True)
class Model:
    learned: tuple[tuple[str, bool, str], ...]
    weights: tuple[float, ...]
    bias: float
    rate: float  # suspects per character of clean text

    def score(self, texts: Iterable[str | None], scanner: Scanner) -> np.ndarray:
        x = _inputs([scanner.events(t) for t in texts], [len(t or "") for t in texts], self.rate)
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights) + self.bias, -40, 40)))


def _inputs(events: list[np.ndarray], lengths: list[int], rate: float) -> np.ndarray:
    x = np.array(events, float).reshape(-1, len(EVENTS))
    suspects = x[:, SUSPECT].sum(axis=1)
    beyond = np.maximum(0, 1 - rate * np.array(lengths, float) / np.maximum(suspects, 1))
    return np.log1p(np.where(SUSPECT, x * beyond[:, None], x))


def _signature(texts: pd.Series) -> pd.Series:
    """Digest of a text in lower case, white space evened out: only copies share it."""
    return pd.Series([hashlib.sha256(" ".join((t or "").lower().split()).encode("utf-8", "surrogatepass")).digest() for t in texts], dtype=object)


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE, teach: Column | None = None) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents, those of the smallest id hash. Copies teach once:
    rows of one label whose texts differ in case and white space at most count as one."""
    own = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null")
    own = own.filter(teach) if teach is not None else own
    picked = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # broadcast bound: ``rows`` pairs of numbers
    one = texts.join(F.broadcast(picked), "doc_id").withColumn("copy", F.pandas_udf(_signature, "binary")("text"))
    first = F.row_number().over(Window.partitionBy("toxic", "copy").orderBy("text"))
    return one.withColumn("first", first).filter("first = 1").select("text", "toxic")


def _forms(word: str) -> list[str]:
    """A word as a feature, and its stems."""
    return ["w" + word] * (len(word) > 2) + ["s" + word[:n] for n in STEMS if len(word) > n]


def _uses(text: str) -> Counter:
    """Features of a text: what it holds ("1...") and what it repeats ("2...")."""
    plain: Counter = Counter()
    for word, n in Counter(_WORD.findall(text.lower())).items():
        for f in _forms(word):
            plain[f] += n
    return Counter({"1" + f: n for f, n in plain.items()} | {"2" + f: n for f, n in plain.items() if n > 1})


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        seen: list[Counter] = [Counter(), Counter()]
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            seen[int(toxic)].update(_uses(text).keys())
        rows = [(f, n, seen[0][f]) for f, n in seen[1].items()]
        # what no toxic row of this batch holds may yet be in another batch's
        rows += [(f, 0, n) for f, n in seen[0].items() if f not in seen[1]]
        yield pd.DataFrame(rows, columns=["feature", "toxic", "clean"])


def _least(rows: int) -> int:
    """Rows a feature must reach to be chosen, of ``rows`` toxic ones that the fixed lists miss."""
    return max(SUPPORT, math.ceil(rows * GAIN))


def _cover(rows: list[list[tuple[int, int]]], known: set[int]) -> set[int]:
    """Greedy: the feature in most rows not yet reached (ties: most often used), until none reaches enough."""
    chosen: set[int] = set()
    left = [dict(r) for r in rows if not known & {f for f, _ in r}]
    least = _least(len(rows))
    while left:
        gain: Counter = Counter()
        used: Counter = Counter()
        for r in left:
            gain.update(r.keys())
            used.update(r)
        best = max(gain, key=lambda f: (gain[f], used[f], -f), default=None)
        if best is None or gain[best] < least:
            break
        chosen.add(best)
        left = [r for r in left if best not in r]
    return chosen


def _missed(text: str, fixed: Scanner) -> bool:
    """What the fixed lists read needs no learned word."""
    return not fixed.events(text)[~SUSPECT].any()


def _lexicon(taught: DataFrame) -> tuple[tuple[str, bool, str], ...]:
    """Words and stems learned from the sample."""

    def missed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fixed = Scanner()
        for batch in batches:
            yield pd.DataFrame({"n": [sum(_missed(text, fixed) for text in batch["text"])]})

    toxic = taught.filter("toxic = 1")
    n = toxic.mapInPandas(missed, "n long").agg(F.sum("n")).first()[0] or 0
    pure = F.col("toxic") >= PURITY * (F.col("toxic") + F.col("clean"))
    counts = (
        taught.mapInPandas(_features, "feature string, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        # what fewer toxic rows hold can be chosen by neither rule
        .filter(F.col("toxic") >= min(SURE, _least(n)))
        .filter(pure & ((F.substring("feature", 1, 2) != "1s") | (F.col("clean") == 0)))
        .orderBy(F.desc("toxic"), "clean", F.desc(F.length("feature")), "feature")
        .collect()
    )  # of the bounded sample
    place = {r.feature: i for i, r in enumerate(counts)}

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fixed = Scanner()
        for batch in batches:
            out = []
            for text in batch["text"]:
                if _missed(text, fixed):
                    uses = {place[f]: n for f, n in _uses(text).items() if f in place}
                    out.append((list(uses.keys()), list(uses.values())))
            yield pd.DataFrame(out, columns=["f", "n"])

    # one short list per toxic sample row
    rows = [list(zip(r.f, r.n, strict=True)) for r in toxic.mapInPandas(present, "f array<int>, n array<int>").collect()]
    sure = {i for i, r in enumerate(counts) if r.feature[1] == "w" and r.toxic >= SURE}
    chosen = sure | _cover(rows, sure)
    kept: dict[str, int] = {}
    for i in sorted(chosen, key=lambda i: (-len(counts[i].feature), counts[i].feature)):
        # of stems with equal counts the longest stands for all
        name = counts[i].feature
        if not any(k[:2] == name[:2] and k.startswith(name) and counts[j][1:] == counts[i][1:] for k, j in kept.items()):
            kept[name] = i
    out: list[tuple[str, bool, str]] = []
    for name in sorted(kept, key=lambda f: (len(f), f)):
        # a longer entry whose shorter stem is listed adds nothing
        if not any(stem and name[2:].startswith(w) for w, stem, _ in out):
            out.append((name[2:], name[1] == "s", "insult" if name[0] == "1" else "suspect"))
    return tuple(out)


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE, teach: Column | None = None) -> Model:
    """Lexicon, then weights, from the bounded sample."""
    taught = written(sample(docs, labels, rows, teach), "taught")
    learned = _lexicon(taught)

    def observed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(learned)
        for batch in batches:
            yield pd.DataFrame(
                {"x": [scanner.events(t).tolist() for t in batch["text"]], "n": [len(t) for t in batch["text"]], "y": batch["toxic"].astype(float)}
            )

    seen = taught.mapInPandas(observed, "x array<double>, n long, y double").orderBy("x", "n", "y").collect()  # SAMPLE rows at most
    x = np.array([r.x for r in seen], float).reshape(-1, len(EVENTS))
    y, lengths = np.array([r.y for r in seen], float), [r.n for r in seen]
    clean = y == 0
    rate = float(x[clean][:, SUSPECT].sum() / max(1, np.array(lengths)[clean].sum())) if len(y) else 0.0
    weights, bias = _fit(_inputs(list(x), lengths, rate), y)
    return Model(learned, tuple(weights), bias, rate)


def _fit(x: np.ndarray, toxic: np.ndarray) -> tuple[list[float], float]:
    """Ridge logistic regression by Newton steps, drawn to start weights. No rows: no evidence beyond the start.
    Fitted twice: the rate of texts without events is known after the first fit, and the start weight of a threat with its
    target is set so that one such clause in a text scores ``NAMED``."""
    start = np.where(np.array([e.startswith(("negated", "reported")) for e in EVENTS]), 0.3, 2.0)
    prior = np.r_[start, -3.0]
    a = np.c_[x, np.ones(len(x))]
    w = prior
    for _ in range(2):
        prior[EVENTS.index("threat@target")] = (math.log(NAMED / (1 - NAMED)) - w[-1]) / math.log(2)
        w = _newton(a, toxic, prior)
    return w[:-1].tolist(), float(w[-1])


def _newton(a: np.ndarray, toxic: np.ndarray, prior: np.ndarray) -> np.ndarray:
    ridge = np.diag(np.r_[np.ones(len(EVENTS)), 5.0])  # a few rows do not move the rate of texts without events
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p) + 1e-9)[:, None]) + ridge, a.T @ (toxic - p) - ridge @ (w - prior))
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def with_score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the double column ``out``: 0 to 1, higher is likelier toxic."""

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(model.learned)
        for texts in batches:
            yield pd.Series(model.score(texts, scanner))

    return docs.withColumn(out, F.pandas_udf(scored, "double")(F.col(f"`{text}`")))


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    model = learn(docs, labels, teach=~held_out())
    return with_score(docs, model, out="__toxic").filter(F.col("__toxic") < threshold).drop("__toxic")
