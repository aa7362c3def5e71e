"""Day states of the staged rows, from which windowed queries are answered without reading those rows.

Each state is a function of one event day's staged rows alone, so a run recomputes the days its load touched and
replaces them; recomputing a whole day is idempotent. Windows are made of whole days, so a query only adds up the
days it reaches. A distinct count does not add up, but is only ever asked for by day, where it is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.operators.marts import with_amount_flag

#: Candidates kept of a day. Spark cuts a rank filter of up to 1,000 rows before its shuffle
#: (``spark.sql.optimizer.windowGroupLimitThreshold``), so a day of any size sends this many rows a task at most.
CANDIDATES = 1000

MEASURE_KEYS = ("transaction_date", "transaction_hour", "product_category", "status", "payment_method")
CANDIDATE_COLUMNS = (
    "transaction_id", "customer_id", "amount", "product_category", "device_type", "ip_address", "event_timestamp", "transaction_date",
)


def day_measures(stg: DataFrame) -> DataFrame:
    """Rows, rows with an amount, and the exact amount by hour, category, status and payment method:
    as many rows a day as those values have combinations, whatever the number of transactions. The partial
    aggregate runs map-side, so a hot day or category shuffles no more than any other."""
    return stg.groupBy(*MEASURE_KEYS).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("amount").alias("n_amounts"), F.sum("amount").alias("amount")
    )


def day_customers(groups: DataFrame) -> DataFrame:
    """Distinct customers of each day, from the dimension's (customer, day, category) groups."""
    return groups.groupBy("transaction_date").agg(F.count_distinct("customer_id").alias("unique_customers"))


def day_candidates(stg: DataFrame, kept: int = CANDIDATES) -> DataFrame:
    """The ``kept`` largest high-value rows of each day (ties: smaller id). The largest k high-value rows of any set of days are among
    them for every k up to ``kept``."""
    high = with_amount_flag(stg).filter("is_high_value").select(*CANDIDATE_COLUMNS)
    place = F.row_number().over(Window.partitionBy("transaction_date").orderBy(F.desc("amount"), F.asc("transaction_id")))
    return high.withColumn("place", place).filter(F.col("place") <= kept).drop("place")
