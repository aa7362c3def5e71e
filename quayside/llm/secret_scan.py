"""Secret scans in DataFrame functions only.

Three pattern kinds give the base spans. Entropy adds a fourth kind: over each
candidate string (a run of base-64 characters holding a digit) a window of
``WINDOW`` characters slides one character at a time. The state is
S = sum of n*log2(n) over the counts n of the characters in the window; an
entering and a leaving character change one count each, so a step updates S by
two differences, and the window's Shannon entropy is log2(WINDOW) - S / WINDOW.
A window of hexadecimal digits is held against the hexadecimal threshold, a
window with upper case, lower case and digits against the base-64 threshold.
Candidates that match the allow-list are suppressed.

Defined results: a null text counts as empty; an empty text has no spans; every
input row gives one output row (repeated rows repeat); other columns pass
through untouched. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.store import shielded

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)"""
)
# Greedy runs: asking for the least length in the pattern keeps exactly the runs that reach it.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
WINDOW = 20
# Looked at once per run: the look-behind pins the run's start, the possessive look-ahead finds a digit.
CANDIDATE = (
    r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{%d,}" % WINDOW
)
HEX_BITS = 3.0
BASE64_BITS = 3.7
# Strings that look random but are public by nature: UUIDs, counting sequences, documented examples.
ALLOW = (
    r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
    r"(?i)example",
    r"(?i)(0123456789|abcdefghij|1234567890abcdef)",
)
MASK = "[SECRET]"
BLOCK = 128  # matches gathered at a time

_SPAN = "array<struct<start:int,kind:int,end:int>>"
_LOG = "array(" + ",".join(f"{n * math.log2(n) if n else 0.0!r}D" for n in range(WINDOW + 1)) + ")"


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", r"\x27") + "'"


def _found(text: str, pattern: str) -> str:
    """SQL: the matches with their starts, from the pieces between them. ``raw`` holds a match's bytes, whose n-th is found without
    a walk. The matches are gathered in blocks, as a list is copied for each item or block that is added to it."""
    p = _quoted(pattern)
    none = "cast(array() as array<struct<start:int,hit:string,raw:binary>>)"
    block = f"""aggregate(part, named_struct('at', s.at, 'out', {none}),
        (s, x) -> named_struct(
            'at', s.at + length(x.gap) + coalesce(length(x.hit), 0),
            'out', if(x.hit is null, s.out,
                      array_append(s.out, named_struct('start', s.at + length(x.gap), 'hit', x.hit, 'raw', cast(x.hit as binary))))))"""
    return f"""if(rlike({text}, {p}), element_at(transform(array(
        zip_with(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0),
                 (g, h) -> named_struct('gap', g, 'hit', h))), pieces ->
        aggregate(transform(sequence(0, (size(pieces) - 1) div {BLOCK}), b -> slice(pieces, b * {BLOCK} + 1, {BLOCK})),
        named_struct('at', 0, 'out', {none}),
        (s, part) -> element_at(transform(array({block}), r -> named_struct('at', r.at, 'out', concat(s.out, r.out))), 1),
        s -> s.out)), 1), {none})"""


def _spans(text: str, pattern: str, kind: int, keep: str = "true") -> str:
    return f"""transform(filter({_found(text, pattern)}, m -> {keep}),
        m -> named_struct('start', m.start, 'kind', {kind}, 'end', m.start + length(m.hit)))"""


def _entropy_spans(text: str) -> str:
    """SQL: for each allowed candidate the stretch from its first to its last flagged window."""
    w = WINDOW
    n_of = "(length({win}) - length(replace({win}, {c}, '')))"
    part = "cast(substring(m.raw, {}, {}) as string)".format  # a candidate is ASCII
    leave, enter = part(f"i - {w}", 1), part("i", 1)
    before = part(f"greatest(i - {w}, 1)", f"least(i - 1, {w})")
    rest = part(f"greatest(i - {w} + 1, 1)", f"least(i - 1, {w} - 1)")
    n_leave, n_enter = n_of.format(win=before, c=leave), n_of.format(win=rest, c=enter)
    full = part(f"i - {w} + 1", w)
    s_new = (
        f"(s.sum + if(i > {w}, {_LOG}[{n_leave} - 1] - {_LOG}[{n_leave}], 0D)"
        f" + {_LOG}[{n_enter} + 1] - {_LOG}[{n_enter}])"
    )
    bits = f"({math.log2(w)!r}D - t.sum / {w})"
    flagged = f"""i >= {w} and (
        (rlike({full}, '^[0-9a-fA-F]+$') and rlike({full}, '[a-fA-F]') and {bits} >= {HEX_BITS}D) or
        (rlike({full}, '[A-Z]') and rlike({full}, '[a-z]') and rlike({full}, '[0-9]') and {bits} >= {BASE64_BITS}D))"""
    step = f"""element_at(transform(array(named_struct('sum', {s_new})), t ->
        if({flagged}, named_struct('sum', t.sum, 'a', least(s.a, i - {w}), 'b', i),
                      named_struct('sum', t.sum, 'a', s.a, 'b', s.b))), 1)"""
    allowed = " or ".join(f"rlike(m.hit, {_quoted(p)})" for p in ALLOW)
    hull = f"""aggregate(sequence(1, length(m.hit)),
        named_struct('sum', 0D, 'a', length(m.hit), 'b', 0), (s, i) -> {step},
        s -> named_struct('start', m.start + s.a, 'kind', 3, 'end', m.start + s.b, 'some', s.b > 0))"""
    return f"""transform(filter(transform(filter({_found(text, CANDIDATE)}, m -> not ({allowed})), m -> {hull}),
        x -> x.some), x -> named_struct('start', x.start, 'kind', x.kind, 'end', x.end))"""


def base_spans(text: str) -> Column:
    """The pattern spans of the string column named ``text``, by start, then kind."""
    group2 = f"length(regexp_extract(m.hit, {_quoted(ASSIGN)}, 2)) >= 6"
    parts = (
        _spans(text, ASSIGN, 0, group2),
        _spans(text, ACCESS, 1),
        _spans(text, HEX, 2),
    )
    return F.expr(f"cast(array_sort(concat({', '.join(parts)})) as {_SPAN})")


@shielded
def scan_secrets(docs: DataFrame, text: str = "text", out: str = "secret_spans") -> DataFrame:
    """``docs`` with the sorted spans of its ``text`` column: struct column ``out`` holding
    ``base`` and ``all``, each array<struct<start, kind, end>> (kind indexes ``KINDS``)."""
    kept = [c for c in docs.columns if c != out]
    clean = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__t"))
    found = clean.select("*", base_spans("__t").alias("__b"), F.expr(_entropy_spans("__t")).alias("__e"))
    return found.select(
        *[F.col(f"`{c}`") for c in kept],
        F.struct(
            F.col("__b").alias("base"),
            F.expr(f"cast(array_sort(concat(__b, __e)) as {_SPAN})").alias("all"),
        ).alias(out),
    )


def spans_text(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = "array(" + ",".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(
        f"array_join(transform({spans}, s -> concat_ws(':', {names}[s.kind], s.start, s.end)), ',')"
    )


@shielded
def mask_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every found stretch of ``text`` replaced by ``MASK`` (overlapping spans
    as one). A null text stays null; rows without spans are unchanged."""
    found = scan_secrets(docs, text, "__spans")
    # what stands between the spans, by character, so that no span is sought from the text's start
    masked = F.expr(
        f"""if(size(__spans.all) = 0, `{text}`, element_at(transform(array(split(`{text}`, '')), chars -> aggregate(__spans.all,
            named_struct('out', cast(array() as array<string>), 'at', 0),
            (s, x) -> if(x.start < s.at, named_struct('out', s.out, 'at', greatest(s.at, x.end)),
                named_struct('out', array_append(s.out, array_join(slice(chars, s.at + 1, x.start - s.at), '')), 'at', x.end)),
            s -> array_join(array_append(s.out, array_join(slice(chars, s.at + 1, size(chars)), '')), '{MASK}'))), 1))"""
    )
    return found.withColumn(text, masked).drop("__spans")
