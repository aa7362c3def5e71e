"""Type-2 history of a dimension (``check`` strategy) without MERGE.

Rules: a new key opens a version; a key whose check columns changed (null
equals null) closes its open version at ``now`` and opens a new one; an
unchanged key is untouched; a key missing from the source stays open.
Version id = md5(key | valid_from).

Two forms with the same rows: :func:`snapshot_scd2` gives the whole new history; a log of opened
versions (:func:`opened_versions`, appended by each run) holds only what changed, and
:func:`history_of` reads it as the history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SCD_COLUMNS = ["scd_id", "valid_from", "valid_to"]


def _scd_id(key: Column, valid_from: Column) -> Column:
    return F.md5(F.concat_ws("|", key.cast("string"), F.date_format(valid_from, "yyyy-MM-dd HH:mm:ss.SSSSSS")))


def open_versions(source: DataFrame, key: str, now: dt.datetime) -> DataFrame:
    """First run: every source row becomes an open version."""
    now_c = F.lit(now).cast("timestamp")
    return source.select(
        "*",
        _scd_id(F.col(key), now_c).alias("scd_id"),
        now_c.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )


def _changes(history: DataFrame, source: DataFrame, key: str, check_cols: Sequence[str]) -> DataFrame:
    """Open versions full-outer-joined to the source, with a change type.

    The only shuffle: both sides hash-partitioned on the key, one row per
    key on each side, so no key can be hot. Closed versions never join.
    """
    h = history.filter(F.col("valid_to").isNull())
    h = h.select(*[F.col(c).alias(f"h_{c}") for c in h.columns], F.lit(True).alias("_in_h"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in source.columns], F.lit(True).alias("_in_s"))
    j = h.join(s, F.col(f"h_{key}") == F.col(f"s_{key}"), "full_outer")
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(f"h_{c}").eqNullSafe(F.col(f"s_{c}"))
    change = (
        F.when(F.col("_in_h").isNull(), F.lit("insert"))
        .when(F.col("_in_s").isNull(), F.lit("absent"))
        .when(same, F.lit("same"))
        .otherwise(F.lit("change"))
    )
    return j.withColumn("change_type", change)


def snapshot_changes(
    history: DataFrame | None, source: DataFrame, key: str, check_cols: Sequence[str]
) -> DataFrame:
    """``(key, change_type)`` per key: insert / change / same / absent."""
    if history is None:
        return source.select(key, F.lit("insert").alias("change_type"))
    j = _changes(history, source, key, check_cols)
    return j.select(F.coalesce(F.col(f"s_{key}"), F.col(f"h_{key}")).alias(key), "change_type")


def snapshot_scd2(
    history: DataFrame | None,
    source: DataFrame,
    key: str,
    check_cols: Sequence[str],
    now: dt.datetime,
) -> DataFrame:
    """The full new history: closed versions pass through untouched; each
    joined key emits its (possibly closed) open version and, when inserted or
    changed, a new open version, in one pass (array of at most two structs,
    exploded) rather than one join per outcome.

    ``now`` must be later than every earlier run's ``now``; it is a
    parameter so a replayed run produces the same rows.
    """
    if history is None:
        return open_versions(source, key, now)
    cols = source.columns
    hist_cols = cols + SCD_COLUMNS
    types = dict(source.dtypes)
    now_c = F.lit(now).cast("timestamp")
    closed = history.filter(F.col("valid_to").isNotNull()).select(*hist_cols)
    j = _changes(history.select(*hist_cols), source, key, check_cols)
    ct = F.col("change_type")
    old = F.when(
        F.col("_in_h").isNotNull(),
        F.struct(
            *[F.col(f"h_{c}").cast(types[c]).alias(c) for c in cols],
            F.col("h_scd_id").alias("scd_id"),
            F.col("h_valid_from").alias("valid_from"),
            F.when(ct == "change", now_c).otherwise(F.col("h_valid_to")).alias("valid_to"),
        ),
    )
    new = F.when(
        ct.isin("insert", "change"),
        F.struct(
            *[F.col(f"s_{c}").alias(c) for c in cols],
            _scd_id(F.col(f"s_{key}"), now_c).alias("scd_id"),
            now_c.alias("valid_from"),
            F.lit(None).cast("timestamp").alias("valid_to"),
        ),
    )
    rows = j.select(F.explode(F.filter(F.array(old, new), lambda x: x.isNotNull())).alias("v")).select("v.*")
    return closed.unionByName(rows)


def opened_versions(
    log: DataFrame | None, source: DataFrame, key: str, check_cols: Sequence[str], now: dt.datetime
) -> DataFrame:
    """What one run appends to the log: a version for each source row whose key is new or whose
    check columns differ from the key's latest version. A version closes when its key's next one
    opens, so a closing is no row of its own and nothing written before is touched.

    Of the log only the key, the check columns and ``valid_from`` are read; the latest version of a
    key is a ``max_by`` (combined map-side), and both sides meet hash-partitioned on the key.
    ``now`` must be later than every earlier run's; a null key matches nothing and opens a version.
    """
    if log is not None:
        seen = F.max_by(F.struct(*check_cols), "valid_from").alias("_seen")
        latest = log.groupBy(F.col(key).alias("_key")).agg(seen)
        same = F.lit(True)
        for c in check_cols:
            same = same & F.col(c).eqNullSafe(F.col(f"_seen.{c}"))
        joined = source.join(latest, F.col(key) == F.col("_key"), "left")
        source = joined.filter(F.col("_seen").isNull() | ~same).select(*source.columns)
    return open_versions(source, key, now).drop("valid_to")


def history_of(log: DataFrame, key: str) -> DataFrame:
    """The type-2 history that a log of opened versions stands for. A window holds one key's
    versions: one row a run at most, whatever the number of events behind them."""
    after = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    return log.withColumn("valid_to", F.when(F.col(key).isNotNull(), after))
