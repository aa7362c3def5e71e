"""The filter audit against a brute force over small tables."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import functions as F

from quayside.llm import filter_audit
from quayside.llm.queries import op11_filter_audit

from tests.conftest import SF_SMALL
from tests.llm.conftest import DOCS

FILTERS = {
    "A": lambda: F.size("words") < 3,
    "C": filter_audit.ROW_FILTERS["C"],
    "D": filter_audit.ROW_FILTERS["D"],
}


def fails(letter, text, first):
    words = [w for w in text.replace("\t", " ").split(" ") if w]
    return {
        "A": len(words) < 3,
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
        "D": any(c in "#$%&*|" for c in text),
        "E": first,
    }[letter]


def brute(rows, labels, letters):
    """rows: (id, text, part); the answer by walking every order over every document."""
    docs = {}
    for i, text, part in rows:
        text, part = text or "", part or ""
        first = any(j is not None and i is not None and j < i and (t or "") == text for j, t, _ in rows)
        docs.setdefault((i, part), set()).update(x for x in letters if fails(x, text, first))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out, shares = {}, {}
    for part in {p for _, p in docs}:
        own = {i: f for (i, p), f in docs.items() if p == part}
        for order in permutations(letters):
            left = set(own)
            for step, x in enumerate(order, 1):
                failing = {i for i in own if x in own[i]}
                gone = failing & left
                shares[part, x] = shares.get((part, x), 0) + len(gone)
                left -= gone
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing - gone), sum(own[i] == {x} for i in own), len(gone & good), len(gone & toxic)
                ]
    return {k: (*v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


ROWS = [
    (1, "one two three", "x"), (2, "one two three", "x"), (3, "One", "x"), (4, "a # b c", None), (5, "", "x"), (6, None, ""), (7, "AB cd\tef gh #", "y"),
    (8, "AB cd\tef gh #", "x"), (2, "LOUD #", "x"), (2, "LOUD #", "y"), (None, "one two three", "x"), (None, "", None), (9, "a # b c", "x"), (9, "a # b c", "x"),
]
LABELS = [(2, 1, 0), (2, 0, 1), (3, None, 1), (4, 1, None), (9, 1, 0), (None, 1, 1), (77, 1, 1)]


def answer(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def frames(sp, rows=ROWS, labels=LABELS):
    docs = sp.createDataFrame([(i, t, None, p, 0) for i, t, p in rows], DOCS).selectExpr(
        "*", "1 as id", "2 as part", "'z' as words", "'q' as letters", "false as hit", "'g' as gone", "true as good"
    )
    return docs, sp.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'n' as text", "'x' as part", "0 as id")


def test_all_orders_against_brute_force(sp):
    got = filter_audit.audit(*frames(sp), filters=FILTERS)
    assert got.count() == 3 * 24 * 4
    assert answer(got) == brute(ROWS, LABELS, "ACDE")


def test_without_the_table_wide_filter_and_without_labels(sp):
    got = filter_audit.audit(*frames(sp, labels=[]), filters=FILTERS, repeats=None)
    assert answer(got) == brute(ROWS, [], "ACD")


def test_stored_relations_and_survivors(sp):
    stored = filter_audit.FailingIds(*frames(sp), filters=FILTERS)
    want = brute(ROWS, LABELS, "ACDE")
    for prefix in ("A", "EA", "DCA", "ECDA"):
        left = stored.survivors(prefix).groupBy("part").count().collect()
        order = prefix + "".join(x for x in "ACDE" if x not in prefix)
        kept = {p: want[p, order, len(prefix)][0] for p in ("", "x", "y")}
        assert {r.part: r["count"] for r in left} == {p: n for p, n in kept.items() if n}
    assert {r.id for r in stored.of("E").filter("part = 'x'").collect()} == {2, 8, 9}


def test_empty_tables(sp):
    assert filter_audit.audit(*frames(sp, [], [])).count() == 0


def test_joins_of_a_level_are_semi_and_anti_on_ids(sp):
    stored = filter_audit.FailingIds(*frames(sp), filters=FILTERS)
    plan = stored.survivors("AC")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 2
    # one filter's table is one folder
    scan = stored.of("A")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and "letter" in scan.split("PartitionFilters")[1]


def test_query_has_all_rows(sp):
    parts = sp.read.parquet(f"{SF_SMALL}/documents.parquet").select(F.coalesce("source", F.lit(""))).distinct().count()
    assert op11_filter_audit(sp, SF_SMALL).count() == parts * 600
