"""Column expressions shared by the marts and the queries.

Every helper returns a built-in Catalyst expression (no Python UDFs), so it
stays inside whole-stage code generation and partial aggregation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def latest_non_null(value: str, *order: str) -> Column:
    """A deterministic ``any_value``: the value of the latest row by
    ``order`` among rows where it is not null.

    ``max_by`` ignores rows whose ordering key is null, so masking the key
    skips null values. It is a declarative aggregate: it combines map-side,
    which keeps a customer holding a third of all rows from landing in one
    task as raw rows.
    """
    key = F.when(F.col(value).isNotNull(), F.struct(*[F.col(c) for c in order]))
    return F.max_by(F.col(value), key)


def avg_money(value: Column) -> Column:
    """Average of a decimal money column, exact and rounded half-up to 9
    decimals (the warehouse NUMERIC average). ``avg`` on a decimal would
    keep only ``scale + 4`` digits; dividing the exact sum by the count as
    ``decimal(38,9)`` rounds once, at the 9th decimal."""
    return ratio_money(F.sum(value), F.count(value))


def ratio_money(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as ``decimal(38,9)``; null on a zero or
    null denominator."""
    return F.try_divide(numerator.cast("decimal(38,9)"), denominator)


def rate_pct(numerator: Column, denominator: Column) -> Column:
    """``round(safe_divide(n, d) * 100, 2)``; null when ``d`` is 0."""
    return F.round(F.try_divide(numerator, denominator) * 100, 2)


def segment(spend: Column, vip: float, regular: float) -> Column:
    return (
        F.when(spend >= vip, F.lit("VIP"))
        .when(spend >= regular, F.lit("Regular"))
        .otherwise(F.lit("Casual"))
    )


def is_true(predicate: Column) -> Column:
    """Three-valued predicate to boolean: null counts as false."""
    return F.coalesce(predicate, F.lit(False))


def day_floor(as_of: dt.date, days: int) -> Column:
    """Lower bound of an "N-day" window: ``as_of - days`` (no upper bound).

    Computed on the driver so the comparison is against a literal, which
    folds, reaches the Parquet scan as a pushed filter and prunes
    ``transaction_date`` partitions of written marts.
    """
    return F.lit(as_of - dt.timedelta(days=days))
