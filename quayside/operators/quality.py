"""Declared data-quality assertions and the report that gates each layer.

Failure counts follow the usual declarative-test semantics:

* ``not_null``: rows where the column is null;
* ``unique``: non-null values that occur more than once (one per value);
* ``accepted_values``: distinct non-null values outside the list.

Work per table: all ``not_null`` and ``accepted_values`` checks of a table
share one global aggregate (one scan, partial-aggregated, a handful of rows
shuffled); each ``unique`` check is one ``groupBy(column).count()``, whose
map-side combine turns a hot value into one row per map task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.schema import SEGMENTS, STATUSES

REPORT_SCHEMA = "table string, test string, column string, failures bigint"


@dataclass(frozen=True)
class Check:
    table: str
    test: str  # not_null | unique | accepted_values
    column: str
    values: tuple[str, ...] = ()


# The 19 declared assertions, by layer.
SUITE: list[Check] = [
    Check("stg_transactions", "unique", "transaction_id"),
    Check("stg_transactions", "not_null", "transaction_id"),
    Check("stg_transactions", "not_null", "customer_id"),
    Check("stg_transactions", "not_null", "amount"),
    Check("stg_transactions", "accepted_values", "status", tuple(STATUSES)),
    Check("stg_transactions", "not_null", "transaction_date"),
    Check("dim_customers", "unique", "customer_id"),
    Check("dim_customers", "not_null", "customer_id"),
    Check("dim_customers", "not_null", "total_spend"),
    Check("dim_customers", "accepted_values", "customer_segment", tuple(SEGMENTS)),
    Check("fct_transactions", "unique", "transaction_id"),
    Check("fct_transactions", "not_null", "transaction_id"),
    Check("fct_transactions", "not_null", "amount"),
    Check("fct_transactions", "not_null", "customer_id"),
    Check("fct_daily_revenue", "not_null", "transaction_date"),
    Check("fct_daily_revenue", "not_null", "product_category"),
    Check("fct_daily_revenue", "not_null", "total_revenue"),
    Check("fct_daily_revenue", "not_null", "order_count"),
    Check("fct_daily_revenue", "not_null", "failure_rate_pct"),
]


def _label(check: Check) -> F.Column:
    return F.struct(
        F.lit(check.table).alias("table"), F.lit(check.test).alias("test"), F.lit(check.column).alias("column")
    )


def _single_pass(df: DataFrame, checks: list[Check]) -> DataFrame:
    """not_null and accepted_values checks of one table in one aggregate."""
    measures = []
    for i, c in enumerate(checks):
        col = F.col(c.column)
        if c.test == "not_null":
            m = F.count_if(col.isNull())
        else:
            m = F.count_distinct(F.when(~col.isin(*c.values), col))
        measures.append(m.cast("bigint").alias(f"m{i}"))
    row = df.agg(*measures)
    pairs = F.array(
        *[F.struct(_label(c).alias("k"), F.col(f"m{i}").alias("failures")) for i, c in enumerate(checks)]
    )
    return row.select(F.explode(pairs).alias("p")).select("p.k.*", "p.failures")


def _unique(df: DataFrame, check: Check) -> DataFrame:
    dupes = (
        df.select(check.column)
        .filter(F.col(check.column).isNotNull())
        .groupBy(check.column)
        .count()
        .filter(F.col("count") > 1)
    )
    return dupes.agg(F.count(F.lit(1)).alias("failures")).select(_label(check).alias("k"), "failures").select(
        "k.*", "failures"
    )


def with_reasons(df: DataFrame, table: str, suite: list[Check] = SUITE) -> DataFrame:
    """``df`` with ``reasons``: the not_null and accepted_values checks of ``table`` that each row fails, as
    ``test:column``. Empty for a good row. (Uniqueness is no property of a row.)"""
    fails = []
    for c in (c for c in suite if c.table == table and c.test in ("not_null", "accepted_values")):
        col = F.col(c.column)
        # a null is accepted, as in the report
        bad = col.isNull() if c.test == "not_null" else F.coalesce(~col.isin(*c.values), F.lit(False))
        fails.append(F.when(bad, F.lit(f"{c.test}:{c.column}")))
    return df.withColumn("reasons", F.array_compact(F.array(*fails)))


def dq_report(tables: dict[str, DataFrame], suite: list[Check] = SUITE) -> DataFrame:
    """One row per assertion: ``table, test, column, failures``.

    Checks whose table is not in ``tables`` are skipped, so a gate can run
    one layer at a time.
    """
    parts: list[DataFrame] = []
    for name, df in tables.items():
        checks = [c for c in suite if c.table == name]
        single = [c for c in checks if c.test in ("not_null", "accepted_values")]
        if single:
            parts.append(_single_pass(df, single))
        parts.extend(_unique(df, c) for c in checks if c.test == "unique")
    if not parts:
        spark = SparkSession.getActiveSession()
        return spark.createDataFrame([], REPORT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def increment_report(new: DataFrame, existing: DataFrame | None, table: str, suite: list[Check] = SUITE) -> DataFrame:
    """The report of ``table`` as if run over ``existing`` plus ``new``, when
    ``existing`` passed every check of ``table`` (an append-only table that
    is only ever appended to after this report passes, so by induction).

    not_null and accepted_values over the new rows only; unique = values
    repeated within the new rows plus new values already present in
    ``existing``. The latter is a semi-join of the existing key column to
    the new keys (broadcast when small): a map-only scan of one column, not
    the shuffle of every key a table-wide ``groupBy`` needs.
    """
    checks = [c for c in suite if c.table == table]
    parts: list[DataFrame] = []
    single = [c for c in checks if c.test in ("not_null", "accepted_values")]
    if single:
        parts.append(_single_pass(new, single))
    for c in (c for c in checks if c.test == "unique"):
        keys = new.select(c.column).filter(F.col(c.column).isNotNull())
        dupes = keys.groupBy(c.column).count().filter(F.col("count") > 1).select(c.column)
        if existing is not None:
            dupes = dupes.unionByName(existing.select(c.column).join(keys, c.column, "left_semi"))
        parts.append(
            dupes.distinct().agg(F.count(F.lit(1)).alias("failures")).select(_label(c).alias("k"), "failures").select(
                "k.*", "failures"
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def with_implied(report: DataFrame, source: str, target: str, suite: list[Check] = SUITE) -> DataFrame:
    """Add the checks of ``target`` that are identical checks of ``source``
    on the same rows (same test, same column), relabelled, instead of
    running them again. The report (one row per check) is computed once.
    Raises if ``target`` has a check ``source`` lacks."""
    have = {(c.test, c.column) for c in suite if c.table == source}
    wanted = {(c.test, c.column) for c in suite if c.table == target}
    if wanted - have:
        raise ValueError(f"{target} checks not implied by {source}: {sorted(wanted - have)}")
    rows = [tuple(r) for r in report.select("table", "test", "column", "failures").collect()]
    rows += [(target, t, c, n) for (tb, t, c, n) in rows if tb == source and (t, c) in wanted]
    return report.sparkSession.createDataFrame(rows, REPORT_SCHEMA)


def raise_on_failures(report: DataFrame) -> None:
    failed = [
        (r["table"], r["test"], r["column"], r["failures"]) for r in report.filter(F.col("failures") > 0).collect()
    ]
    if failed:
        raise DataQualityError(failed)


class DataQualityError(RuntimeError):
    def __init__(self, failures: list[tuple[str, str, str, int]]):
        self.failures = failures
        lines = ", ".join(f"{t}.{c} {k}: {n}" for t, k, c, n in failures)
        super().__init__(f"data tests failed: {lines}")


def gate(tables: dict[str, DataFrame], suite: list[Check] = SUITE) -> list[tuple[str, str, str, int]]:
    """Run the checks of ``tables``; raise :class:`DataQualityError` when any
    fails. Only the failing rows of the (tiny) report reach the driver."""
    raise_on_failures(dq_report(tables, suite))
    return []
