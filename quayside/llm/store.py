"""Shared folders, written intermediates and checked broadcasts for the operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from functools import wraps
from inspect import signature
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when its counted rows times its stated row width stay under this.
BROADCAST_BYTES = 32 << 20


def prepare(spark: SparkSession) -> None:
    """Let the Python workers of a local session import this package.

    With spark-submit the package comes by ``--py-files``; a notebook or a test
    session started elsewhere has it only on the driver's path.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a scratch folder only for a local session that has none."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    found = "file://" + tempfile.mkdtemp(prefix="quayside-llm-")
    spark.conf.set("spark.checkpoint.dir", found)
    return found


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written once into the shared folder: later branches and
    retried tasks read the files, and the lineage ends there."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shielded(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator that adds or replaces columns beside those of ``docs``, run with them under other names, so that none
    meets a name which the operator uses inside. ``key`` and ``text`` name columns of ``docs``."""

    @wraps(operator)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        given = signature(operator).bind(docs, *args, **kwargs)
        given.apply_defaults()
        names = {f"column_{i}": c for i, c in enumerate(docs.columns)}
        inside = {c: n for n, c in names.items()}
        for use in ("key", "text"):
            if use in given.arguments:
                given.arguments[use] = inside[given.arguments[use]]
        given.arguments["docs"] = docs.toDF(*names)
        out = operator(*given.args, **given.kwargs)
        added = [c for c in out.columns if c not in names]
        return out.select(*[F.col(c).alias(names[c]) for c in out.columns if c in names and names[c] not in added], *added)

    return run


def file_system(path: str):
    """(file system, path in it) for tasks that write or read raw files, alike on the driver and in tasks."""
    from pyarrow import fs

    if path.startswith("s3a://"):
        path = "s3://" + path.removeprefix("s3a://")
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    try:
        found, at = fs.FileSystem.from_uri(path)
    except (pa.ArrowInvalid, OSError, ImportError) as e:
        raise ValueError(f"{path}: raw files need a folder that pyarrow opens (file, hdfs, s3, gs); name one or set spark.checkpoint.dir to one") from e
    return found, at.rstrip("/")


def small_side(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if its count proves it small enough, else unchanged
    (Spark then joins by shuffle). Meant for a written table, whose count reads footers."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df
