"""Filter interaction audit over failing-id relations.

A document passes a list of filters in some order; a filter removes what fails it and still stands.
What a filter removes, and what it finds already gone, depends only on the set of filters before it:

1. One scan judges every text; a text's repeats are found through its digest. Each filter's
   failing ids are stored as an id table of its own (one folder a filter), with the label flags.
2. Level by level the prefix sets grow by one filter. ``left_anti`` against the new filter's id table
   keeps the failing ids that the longer prefix leaves for the audited filter (its removals);
   ``left_semi`` gives the ids which that new filter takes away (its redundancies). Both
   relations hold the prefix set as a column, so a level is two joins, whatever the number of sets.
   Sets are reached in ascending order of their filters, hence once.
3. ``left_anti`` of all ids against all failing ids gives the survivors of the whole list; a
   shorter prefix keeps those and what the filters after it remove.

Only ids, parts and flags are shuffled, never texts; joins are on ids, which no hot key shares, and counts
combine before their shuffle. The orders are laid out at the end, per part.

Defined results: null text and null part count as empty. A document is an id within a part: rows that
share both are one document, which fails what any of its rows fails. A null id is an id of its
own; it is smaller than none and larger than none, so it neither repeats nor is repeated. Labels
that repeat an id count as their largest values; an unlabelled id loses nothing. Empty
documents give an empty result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.store import fresh_path, written

BLANK = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
LEAST_DISTINCT_PCT = 65
MOST_CAPITALS_PCT = 5
MARKS = "[#$%&*|]"
REPEATS = "E"

#: Letter -> whether a row (columns text and words) fails; the letter REPEATS is the table-wide one.
ROW_FILTERS: dict[str, Callable[[], Column]] = {
    "A": lambda: F.size("words") < MIN_WORDS,
    "B": lambda: 100 * F.size(F.array_distinct("words")) < LEAST_DISTINCT_PCT * F.size("words"),
    "C": lambda: 100 * F.length(F.regexp_replace("text", "[^A-Z]", "")) > MOST_CAPITALS_PCT * F.length("text"),
    "D": lambda: F.col("text").rlike(MARKS),
}


def judged(docs: DataFrame, key: str, text: str, part: str, filters: dict[str, Callable[[], Column]]) -> DataFrame:
    """(id, part, digest, failing letters) of every row, written once: the only pass over texts."""
    rows = docs.select(
        F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{part}`"), F.lit("")).alias("part"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )
    rows = rows.withColumn("words", F.filter(F.split("text", BLANK), lambda w: w != ""))
    letters = [F.when(fails(), F.lit(letter)) for letter, fails in filters.items()]
    return written(
        rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), F.array_compact(F.array(*letters)).alias("letters")), "judged"
    )


def repeated(rows: DataFrame) -> DataFrame:
    """(id, part) of the rows whose text also stands under a smaller id."""
    first = rows.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("last > first")
    # a stored table: both sides of the join are plain shuffles, so a text with very many rows is split over tasks
    first = written(first.select("digest", "first"), "first-ids")
    return rows.select("digest", "id", "part").join(first, "digest").filter("id > first").select("id", "part")


class FailingIds:
    """The stored relations: all ids, and one failing-id table a filter."""

    def __init__(
        self, docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source",
        filters: dict[str, Callable[[], Column]] | None = None, repeats: str | None = REPEATS,
    ) -> None:
        filters = ROW_FILTERS if filters is None else filters
        self.letters = [*filters, *([repeats] if repeats else [])]
        rows = judged(docs, key, text, part, filters)
        fails = rows.select("id", "part", F.explode("letters").alias("letter"))
        if repeats:
            fails = fails.union(repeated(rows).select("id", "part", F.lit(repeats).alias("letter")))
        flags = labels.groupBy(F.col(f"`{key}`").alias("id")).agg(
            F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
            F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
        )
        fails = fails.distinct().join(flags, "id", "left").na.fill(False, ["good", "toxic"])
        self.path = fresh_path(docs.sparkSession, "failing-ids")
        fails.select("id", "part", "good", "toxic", "letter").write.partitionBy("letter").parquet(self.path)
        self.ids = rows.select("id", "part").distinct()
        self._schema = f"id {dict(docs.dtypes)[key]}, part string, good boolean, toxic boolean, letter string"
        self.spark = docs.sparkSession

    def all(self) -> DataFrame:
        return self.spark.read.schema(self._schema).parquet(self.path)

    def of(self, letter: str) -> DataFrame:
        """One filter's table: a folder of its own, so the others are not read."""
        return self.all().filter(F.col("letter") == letter).drop("letter")

    def survivors(self, prefix: str) -> DataFrame:
        """(id, part) left after the filters of ``prefix``."""
        left = self.ids
        for letter in prefix:
            left = left.join(self.of(letter).withColumnsRenamed({"id": "gone", "part": "in"}), _same("gone", "in"), "left_anti")
        return left


def _same(key: str, part: str) -> Column:
    return F.col("id").eqNullSafe(F.col(key)) & (F.col("part") == F.col(part))


def levels(stored: FailingIds) -> DataFrame:
    """(part, done, at, removed, good, toxic, newly): for the filter ``at`` behind the set ``done`` (bits), what it
    removes, and what the set's last filter took from it. Sets that leave nothing have no row."""
    n = len(stored.letters)
    number = F.array_position(F.array(*[F.lit(x) for x in stored.letters]), F.col("letter")).cast("int") - 1
    fails = stored.all().withColumn("at", number).drop("letter")
    behind = fails.select(F.col("at").alias("by"), F.col("id").alias("gone"), F.col("part").alias("in"))
    match = (F.col("next") == F.col("by")) & _same("gone", "in")
    level = fails.withColumn("done", F.lit(0)).withColumn("hit", F.lit(False))
    found = []
    for k in range(n):
        found.append(level.select("part", "done", "at", "hit", "good", "toxic"))
        if k == n - 1:
            break
        # the next filter is above all of the set and is not the audited one
        wider = level.filter("not hit").withColumn(
            "next", F.explode(F.expr(f"filter(sequence(0, {n - 1}), s -> shiftleft(1, s) > done and s <> at)"))
        )
        longer = (F.col("done").bitwiseOR(F.expr("shiftleft(1, next)"))).alias("done")
        columns = ["id", "part", "good", "toxic", "at", longer]
        stay = wider.join(behind, match, "left_anti").select(*columns, F.lit(False).alias("hit"))
        go = wider.join(behind, match, "left_semi").select(*columns, F.lit(True).alias("hit"))
        level = written(stay.union(go), f"prefixes-{k + 1}")
    rows = found[0]
    for more in found[1:]:
        rows = rows.union(more)
    return rows.groupBy("part", "done", "at").agg(
        F.count_if(~F.col("hit")).alias("removed"),
        F.count_if(F.expr("not hit and good")).alias("good"),
        F.count_if(F.expr("not hit and toxic")).alias("toxic"),
        F.count_if(F.col("hit")).alias("newly"),
    )


def _grid(letters: list[str]) -> str:
    """The steps of all orders as JSON. A cell is ``done * n + at``; ``chain`` holds the cells whose newly redundant ids
    add up to the step's, ``later`` the cells of the steps behind it."""
    n = len(letters)
    out = []
    for order in permutations(range(n)):
        done, cells = 0, []
        for at in order:
            cells.append((done, at))
            done |= 1 << at
        for i, (before, at) in enumerate(cells):
            chain = [(before & (2 << s) - 1) * n + at for s in range(n) if before >> s & 1]
            out.append({
                "filter_order": "".join(letters[x] for x in order), "step": i + 1, "at": at, "cell": before * n + at,
                "chain": chain, "later": [d * n + a for d, a in cells[i + 1 :]], "alone": ((1 << n) - 1 - (1 << at)) * n + at,
            })
    return json.dumps(out)


def audit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source",
    filters: dict[str, Callable[[], Column]] | None = None, repeats: str | None = REPEATS,
) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every order
    of the filters and every step, in every part."""
    stored = FailingIds(docs, labels, key, text, part, filters, repeats)
    n = len(stored.letters)
    gone = stored.all().select(F.col("id").alias("gone"), F.col("part").alias("in"))
    # part -> survivors of all filters; a part without any has a zero
    clean = stored.ids.join(gone, _same("gone", "in"), "left_anti").groupBy("part").agg(F.count("*").alias("clean"))
    cells = levels(stored).groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct((F.col("done") * n + F.col("at")).alias("cell"), F.struct("removed", "good", "toxic", "newly")))).alias("m")
    )
    parts = clean.join(cells, "part", "full")
    none = "named_struct('removed', 0L, 'good', 0L, 'toxic', 0L, 'newly', 0L)"
    parts = parts.select(
        "part", F.coalesce("clean", F.lit(0)).alias("clean"),
        F.expr(f"transform(sequence(0, {(n << n) - 1}), i -> coalesce(try_element_at(m, i), {none}))").alias("cells"),
    )
    # a set stands before a filter in as many orders as its own and the others' arrangements; sets that hold the filter have no rows
    shares = " + ".join(
        f"{factorial(s.bit_count()) * factorial(n - 1 - s.bit_count())} * cells[{s * n} + at].removed" for s in range((1 << n) - 1)
    )
    parts = parts.withColumn("shares", F.expr(f"transform(sequence(0, {n - 1}), at -> {shares})"))
    step = "filter_order string, step int, at int, cell int, chain array<int>, later array<int>, alone int"
    rows = parts.withColumn("s", F.explode(F.from_json(F.lit(_grid(stored.letters)), f"array<struct<{step}>>")))

    def total(cells: str, name: str) -> str:
        return f"aggregate({cells}, 0L, (t, c) -> t + cells[c].{name})"

    return rows.selectExpr(
        "part", "s.filter_order", "s.step",
        f"clean + {total('s.later', 'removed')} as kept",
        "cells[s.cell].removed as removed",
        f"{total('s.chain', 'newly')} as redundant",
        "cells[s.alone].removed as unique_fails",
        "cells[s.cell].good as good_lost",
        "cells[s.cell].toxic as toxic_lost",
        "shares[s.at] as shapley",
    )
