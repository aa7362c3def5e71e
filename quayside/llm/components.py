"""Connected components of a link table, as joins and aggregates only.

Large-star and small-star rounds (Kiveris et al., 2014) alternate until the
links stop changing; they are then stars around the smallest node. A node's
minimum is a grouped minimum (combined before the shuffle) joined back to its
links, so a hub with many links is an ordinary skewed join, never one task's list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.store import written


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def _round(links: DataFrame, large: bool) -> DataFrame:
    if large:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    joined = both.join(low, both.a == low.n)
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select(F.col("n").alias("a"), F.col("m").alias("b"))
        )
    return out.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``: root is the smallest node reachable.
    Empty links give an empty result; loops and repeated links do no harm."""
    links = written(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    state = _state(links)
    while state[0]:
        links = written(_round(_round(links, True), False), "links")
        now = _state(links)
        if now == state:
            break
        state = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
