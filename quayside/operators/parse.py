"""Row-level stream operators: encode, parse, classify, split, dead-letter.

All are pure ``DataFrame -> DataFrame`` projections and filters, so the
same code runs on a static frame (tests, replays) and on a streaming frame
inside ``foreachBatch``. Nothing here shuffles.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.schema import (
    EVENT_FIELDS,
    EVENT_SCHEMA,
    REASON_INVALID_AMOUNT,
    REASON_MISSING_ID,
    TIME_PARTS,
)

# An ordered rule list: the first rule whose predicate holds names the
# dead-letter reason. Predicates are functions of the parsed columns.
Rule = tuple[str, Callable[[], Column]]

DEFAULT_RULES: list[Rule] = [
    (REASON_MISSING_ID, lambda: F.col("transaction_id").isNull()),
    # NaN is not <= 0 in Spark's ordering, so a NaN amount is valid here and
    # staging's range test drops it later.
    (REASON_INVALID_AMOUNT, lambda: F.col("amount").isNull() | (F.col("amount") <= 0)),
]


def encode_events(events: DataFrame, key: str = "customer_id", order_by: str | None = None) -> DataFrame:
    """Producer encoding: ``(key, value)`` with value = the event as JSON.

    Null fields are written out as ``null`` (as a JSON encoder does). The
    bus keeps one key's messages in one partition, in order. ``order_by``
    reproduces that before a write to the bus: rows are hash-partitioned on
    the key and sorted by ``order_by`` within each task. Per-key order puts
    a hot key in one task, as it puts it in one bus partition, so it is
    opt-in; without it the encoding is a map-only projection.
    """
    payload = F.to_json(F.struct(*[F.col(c) for c in EVENT_FIELDS]), {"ignoreNullFields": "false"})
    cols = [F.col(key).cast("string").alias("key"), payload.alias("value")]
    if order_by is None:
        return events.select(*cols)
    ordered = events.select(*cols, F.col(order_by).alias("_order"))
    return ordered.repartition("key").sortWithinPartitions("key", "_order").drop("_order")


def classify(rules: Sequence[Rule] = DEFAULT_RULES) -> Column:
    """The dead-letter reason of a parsed row, or null when it is valid."""
    out: Column = F.lit(None).cast("string")
    for reason, predicate in reversed(list(rules)):
        out = F.when(predicate(), F.lit(reason)).otherwise(out)
    return out


def parse_transactions(
    raw: DataFrame,
    value_col: str = "value",
    rules: Sequence[Rule] = DEFAULT_RULES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse message values against the fixed event schema.

    Output: ``raw_value``, the 15 event fields, ``event_timestamp``,
    ``year, month, day, hour`` and ``dlq_reason``, then any ``keep``
    columns of the input carried through (e.g. bus offsets or send time).
    Malformed JSON yields all-null fields (hence ``missing_transaction_id``);
    an unparsable time yields null time parts but does not by itself
    dead-letter the row.

    Each value is parsed once, however many filters and columns are taken
    from the result: the fields come out of a generator of one row a message,
    which the optimizer does not copy predicates or projections through. (As
    plain aliases over one ``from_json`` column, every predicate on a field
    carries its own copy of the parse below the projection.)
    """
    text = F.col(value_col).cast("string")
    message = raw.select(text.alias("raw_value"), *[F.col(c) for c in keep])
    parsed = message.select("raw_value", F.inline(F.array(F.from_json("raw_value", EVENT_SCHEMA))), *keep)
    parsed = parsed.select("raw_value", *EVENT_FIELDS, F.try_to_timestamp(F.col("timestamp")).alias("event_timestamp"), *keep)
    ts = F.col("event_timestamp")
    parts = {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts), "dlq_reason": classify(rules)}
    return parsed.withColumns(parts).select("raw_value", *EVENT_FIELDS, *TIME_PARTS, "dlq_reason", *keep)


def split_valid_invalid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, invalid)``: valid rows lose ``raw_value`` and ``dlq_reason``."""
    valid = parsed.filter(F.col("dlq_reason").isNull()).drop("raw_value", "dlq_reason")
    invalid = parsed.filter(F.col("dlq_reason").isNotNull())
    return valid, invalid


def build_dlq_payload(invalid: DataFrame, now: dt.datetime | Column) -> DataFrame:
    """Dead-letter envelope: one column ``value`` = JSON of raw value, reason
    and error time. ``now`` is a parameter so replays write the same bytes.
    """
    error_ts = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    envelope = F.struct(
        F.col("raw_value"),
        F.col("dlq_reason").alias("error_reason"),
        error_ts.alias("error_timestamp"),
    )
    return invalid.select(F.to_json(envelope).alias("value"))


DLQ_SCHEMA = "raw_value string, error_reason string, error_timestamp timestamp"


def read_dlq_payload(dlq: DataFrame) -> DataFrame:
    """Inverse of :func:`build_dlq_payload` (for audits and tests)."""
    return dlq.select(F.from_json("value", DLQ_SCHEMA).alias("e")).select("e.*")
