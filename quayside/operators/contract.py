"""Event-contract checks as a DataFrame operator.

The reference documents its event contract as a JSON Schema (required
fields, no extra fields, patterns, enums, ranges, a constant, formats) and
checks generated events against it in unit tests; nothing applies it to
the stream. Here the same rules run over parsed messages as one
distributed pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside import schema as S

Violation = tuple[str, str, Callable[[], Column]]


def _outside(field: str, values: list[str]) -> Callable[[], Column]:
    return lambda: F.col(field).isNotNull() & ~F.col(field).isin(*values)


def _no_match(field: str, pattern: str) -> Callable[[], Column]:
    return lambda: F.col(field).isNotNull() & ~F.col(field).rlike(pattern)


def _shorter_than_one(field: str) -> Callable[[], Column]:
    return lambda: F.length(F.col(field)) < 1


def _extra_keys() -> Column:
    keys = F.json_object_keys(F.col("raw_value"))
    return F.size(F.filter(keys, lambda k: ~k.isin(*S.EVENT_FIELDS))) > 0


# (field, rule, predicate that holds when the row violates the rule)
RULES: list[Violation] = (
    [
        ("$", "type_object", lambda: F.json_object_keys(F.col("raw_value")).isNull()),
        ("$", "additional_properties", _extra_keys),
    ]
    + [(f, "required", (lambda f=f: F.col(f).isNull())) for f in S.EVENT_FIELDS]
    + [
        ("transaction_id", "pattern", _no_match("transaction_id", S.CONTRACT_TRANSACTION_ID_PATTERN)),
        ("customer_id", "pattern", _no_match("customer_id", S.CONTRACT_CUSTOMER_ID_PATTERN)),
        ("customer_name", "min_length", _shorter_than_one("customer_name")),
        ("customer_email", "format_email", _no_match("customer_email", S.EMAIL_PATTERN)),
        ("customer_country", "pattern", _no_match("customer_country", S.CONTRACT_COUNTRY_PATTERN)),
        ("amount", "exclusive_minimum", lambda: F.col("amount") <= S.CONTRACT_AMOUNT_EXCLUSIVE_MIN),
        ("amount", "maximum", lambda: F.col("amount") > S.CONTRACT_AMOUNT_MAX),
        ("currency", "const", lambda: F.col("currency") != S.CONTRACT_CURRENCY),
        ("status", "enum", _outside("status", S.STATUSES)),
        ("product_category", "enum", _outside("product_category", S.CONTRACT_CATEGORIES)),
        ("product_name", "min_length", _shorter_than_one("product_name")),
        ("quantity", "minimum", lambda: F.col("quantity") < S.CONTRACT_QUANTITY_MIN),
        ("quantity", "maximum", lambda: F.col("quantity") > S.CONTRACT_QUANTITY_MAX),
        ("timestamp", "format_date_time", _no_match("timestamp", S.DATETIME_PATTERN)),
        ("ip_address", "format_ipv4", _no_match("ip_address", S.IPV4_PATTERN)),
        ("device_type", "enum", _outside("device_type", S.CONTRACT_DEVICES)),
        ("payment_method", "enum", _outside("payment_method", S.CONTRACT_PAYMENT_METHODS)),
    ]
)


def contract_violations(parsed: DataFrame, rules: list[Violation] = RULES) -> DataFrame:
    """``(field, rule, violations)``: rows breaking each rule, every rule
    listed (zero included). One global aggregate of ``count_if`` columns:
    each map task emits a single partial row, nothing else is shuffled.

    ``parsed`` is the output of ``parse_transactions`` (needs ``raw_value``
    for the object-level rules). A field of the wrong JSON type parses to
    null and is reported as ``required``.
    """
    counts = parsed.agg(*[F.count_if(pred()).alias(f"r{i}") for i, (_, _, pred) in enumerate(rules)])
    pairs = F.array(
        *[
            F.struct(F.lit(field).alias("field"), F.lit(rule).alias("rule"), F.col(f"r{i}").alias("violations"))
            for i, (field, rule, _) in enumerate(rules)
        ]
    )
    return counts.select(F.explode(pairs).alias("v")).select("v.*")


def contract_violation_rows(parsed: DataFrame, rules: list[Violation] = RULES) -> DataFrame:
    """Row-level report ``(transaction_id, raw_value, field, rule)``: one
    output row per broken rule; a map-only ``explode``, no shuffle."""
    hits = F.array(
        *[F.when(pred(), F.struct(F.lit(field).alias("field"), F.lit(rule).alias("rule"))) for field, rule, pred in rules]
    )
    return parsed.select(
        "transaction_id", "raw_value", F.explode(F.filter(hits, lambda x: x.isNotNull())).alias("v")
    ).select("transaction_id", "raw_value", "v.field", "v.rule")
