"""Warehouse load: de-duplication and an insert-only merge without MERGE.

The reference appends each load to a staging table, then either copies it
(first run) or runs ``MERGE ... WHEN NOT MATCHED THEN INSERT``. Parquet
has no MERGE; the insert-only merge is an anti join plus an append, which
is idempotent: re-running a load after a crash inserts nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_by_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per non-null ``key``: the first by ``order`` (a null order value
    comes last, so a copy whose time did not parse never wins), ties broken by
    the remaining columns, so the choice is deterministic across re-runs.
    Rows with a null key are kept as they are (they match nothing).

    A ``groupBy`` with ``min(struct)`` rather than a ``row_number`` window:
    ``min`` combines map-side, so a key that holds a third of all rows is
    reduced to one candidate per map task before the shuffle, where a
    window would sort every one of its rows in a single task.
    """
    order = list(order)
    rest = [c for c in df.columns if c != key and c not in order]
    ranked = [F.isnull(c).alias(f"_null_{c}") for c in order] + [F.col(c) for c in order + rest]
    keyed = df.filter(F.col(key).isNotNull())
    first = keyed.groupBy(key).agg(F.min(F.struct(*ranked)).alias("_first"))
    kept = first.select(key, *[F.col(f"_first.{c}").alias(c) for c in order + rest]).select(*df.columns)
    return kept.unionByName(df.filter(F.col(key).isNull()))


def insert_if_absent(target: DataFrame | None, source: DataFrame, key: str) -> DataFrame:
    """Rows of ``source`` whose ``key`` does not occur in ``target``: what a
    ``WHEN NOT MATCHED THEN INSERT`` merge appends. No target = first load =
    every source row. Null keys match nothing and are inserted; duplicates
    inside ``source`` all survive (call :func:`dedupe_by_key` first). The key
    alone decides, whatever else a returning row says.

    The target is the big, growing table. A plain anti join would shuffle
    every target key on every load (Spark cannot broadcast the left side of
    an anti join). Instead the target's key column alone is semi-joined to
    the load's keys, which Spark broadcasts when their measured size allows,
    leaving only the keys that already exist; the load is then anti-joined
    to that small set. When a load is as large as the target, both joins
    fall back to sort-merge joins picked by AQE.
    """
    if target is None:
        return source
    return source.join(existing_keys(target, source, key), key, "left_anti")


def existing_keys(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The keys of ``target`` that ``source`` brings again."""
    load_keys = source.select(key).filter(F.col(key).isNotNull())
    return target.select(key).join(load_keys, key, "left_semi")


def load_guard(source: DataFrame) -> bool:
    """True when there is something to load. ``isEmpty`` stops at the first
    row found; an empty or missing lake is a no-op, never an error."""
    return not source.isEmpty()
