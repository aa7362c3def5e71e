"""Spark session helpers.

Library code never creates a session on its own; these helpers exist for
tests, the bench and command-line entry points. On a cluster the session
comes from ``spark-submit`` and only the checkpoint helper is used.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every run needs, whatever the cluster size.
BASE_CONF = {
    # All event times are UTC; dates and hours derived from them must not
    # depend on the host the task happens to run on.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, turn sort-merge joins into broadcast joins when the
    # measured (not estimated) side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The plans here state the filters they need; inferring more only
    # costs planning time.
    "spark.sql.constraintPropagation.enabled": "false",
    # No web server.
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "quayside",
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local-mode session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(BASE_CONF)
    conf.update(
        {
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.driver.memory": driver_memory,
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
        }
    )
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_base_conf(spark: SparkSession) -> None:
    """Apply the run-time SQL settings to an existing (cluster) session."""
    for key, value in BASE_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # a remote (Connect) session has no local context
        return None


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    The setting is read from the session. Only when it is unset in local
    mode (tests, a laptop) is a fallback used: the given folder, else a
    fresh scratch folder. With any other master an unset setting is an
    error: on a cluster it must point at shared storage, never at a
    machine-local folder.
    """
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir is unset: set it to shared storage; a machine-local "
                "folder cannot hold intermediates on a cluster"
            )
        configured = fallback or tempfile.mkdtemp(prefix="quayside-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for written intermediates."""
    return os.path.join(checkpoint_dir(spark), *parts)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    return a frame reading it back.

    Cuts the lineage (a lost executor recomputes from these files, not from
    the sources) and lets several branches of a plan share one computation.
    Unlike an eager ``checkpoint()`` the data is computed once, and the
    files are columnar, so later scans prune columns and push filters.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "materialized", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
