"""Lake, dead-letter and mart storage: Parquet reads and replay-safe writes.

Delta and the Kafka connector are not on this classpath; formats are
parameters, so a deployment that has them passes ``"delta"`` / Kafka
options and the same code runs. Parquet paths are what the tests use.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quayside.schema import LAKE_PARTITIONS

MARKER = "leaves array<string>, n_rows long, batch_key string"
#: A marker older than the newest one by more is not looked for any more.
MARKER_AGE = "365d"
#: Tasks, hence files, over which a day's rows of one micro-batch are dealt at most.
DAY_SPREAD = 8
#: Folder name of a null partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def write_lake_batch(valid: DataFrame, path: str, batch_key: str, fmt: str = "parquet", spread: int = DAY_SPREAD) -> list[str]:
    """Append one micro-batch of valid rows to the lake, replay-safe; returns the leaves written.

    Rows are partitioned by event date and by ``batch_key`` (an id stable
    per checkpoint, e.g. ``<sink>-<batch id>``). With dynamic partition
    overwrite, writing the same batch again replaces exactly the leaves it
    wrote the first time, so a replayed batch after a failure changes no
    counts. Late events simply land in their own (older) date partition.

    The input is evaluated once. Rows are dealt to tasks by the hash of (day, id modulo ``spread``): no sampling pass
    as a range needs, a leaf of at most ``spread`` files, and a day that holds the whole batch
    still fills ``spread`` tasks. What was written is observed by the write itself.

    The leaves become visible one at a time. The batch's marker (its key, rows and leaves)
    is therefore written last: a reader that loads marked batches only never takes a part of a batch for the whole.
    """
    days = [c for c in LAKE_PARTITIONS if c != "batch_key"]
    leaf = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE))) for c in days])
    dealt = valid.repartition(*days, F.pmod(F.xxhash64("transaction_id"), F.lit(spread)))
    # behind the exchange, so a map task that runs again is not counted twice
    seen = Observation()
    keyed = dealt.withColumn("batch_key", F.lit(batch_key)).observe(
        seen, F.count(F.lit(1)).alias("n_rows"), F.array_join(F.collect_set(leaf), "\n").alias("leaves")
    )
    _write_leaves(keyed, path, fmt)
    found = observed(seen) or {"leaves": "", "n_rows": 0}
    leaves = sorted(filter(None, found["leaves"].split("\n")))
    _write_marker(valid.sparkSession, path, batch_key, leaves, found["n_rows"])
    return leaves


def observed(seen: Observation) -> dict | None:
    """What a finished write observed; None where adaptive planning found
    the rows empty and took the observation out of the plan with them."""
    try:
        return seen.get
    except Py4JJavaError:
        return None


def _write_marker(spark: SparkSession, path: str, batch_key: str, leaves: list[str], n_rows: int) -> None:
    row = spark.createDataFrame([(leaves, n_rows, batch_key)], MARKER).coalesce(1)
    row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_key").parquet(markers_path(path))


def _write_leaves(keyed: DataFrame, path: str, fmt: str) -> None:
    (
        keyed.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LAKE_PARTITIONS)
        .save(path)
    )


def markers_path(path: str) -> str:
    """Beside the leaves; the leading underscore hides it from reads of the lake."""
    return f"{path.rstrip('/')}/_complete"


class IncompleteBatch(RuntimeError):
    """A marked batch some of whose leaves are gone."""


def each_new_batch(spark: SparkSession, path: str, checkpoint: str, load: Callable[[list[str], list[str]], None]) -> None:
    """Call ``load(keys, leaf folders)`` for the batches marked complete since the last call that returned.

    The markers are a file stream with a checkpoint of its own, run until nothing is left: which markers are new is the
    checkpoint's knowledge, and a marker names its leaves, so neither the manifest nor the lake's day folders are listed or compared.
    A call that fails in ``load`` commits nothing; the next one gets the same batches again, so ``load`` must bear repetition.
    A batch whose leaves are not all there is not loaded; the others are, then :class:`IncompleteBatch` is
    raised and they come again until that batch is whole or published anew. The driver sees one row for each new batch.
    """
    if not existing(spark, [markers_path(path)]):
        return
    failed: list[Exception] = []

    def body(markers: DataFrame, _: int) -> None:
        try:
            found = sorted((r.batch_key, [f"{path.rstrip('/')}/{leaf}/batch_key={r.batch_key}" for leaf in r.leaves]) for r in markers.collect())
            whole = [(key, folders) for key, folders in found if len(existing(spark, folders)) == len(folders)]
            if whole:
                load([key for key, _ in whole], [f for _, folders in whole for f in folders])
            if len(whole) < len(found):
                raise IncompleteBatch(f"leaves are missing of {sorted({k for k, _ in found} - {k for k, _ in whole})}")
        except Exception as e:
            failed.append(e)
            raise

    stream = spark.readStream.schema(MARKER).option("maxFileAge", MARKER_AGE).parquet(markers_path(path))
    query = stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if failed:
            raise failed[0] from None
        raise


def write_dlq_batch(payload: DataFrame, batch_key: str, path: str | None = None, kafka: dict | None = None) -> None:
    """Write dead-letter envelopes: to a Kafka topic (``kafka`` options,
    e.g. bootstrap servers and topic) or replay-safe to Parquet by batch."""
    if kafka:
        w = payload.write.format("kafka")
        for k, v in kafka.items():
            w = w.option(k, v)
        w.save()
        return
    (
        payload.withColumn("batch_key", F.lit(batch_key))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_key")
        .parquet(path)
    )


def read_lake(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The raw warehouse rows: the lake read through its root (one
    distributed scan with partition discovery, not a file-by-file loop).

    Directory-only partition columns (year, month, day, batch key) are
    dropped: the raw table carries the event fields, ``event_timestamp``
    and ``hour``. Returns ``None`` when the lake does not exist yet.
    """
    try:
        df = spark.read.format(fmt).load(path)
    except AnalysisException:
        return None
    return df.drop(*[c for c in LAKE_PARTITIONS if c != "hour"])


def read_lake_batches(spark: SparkSession, path: str, folders: list[str], fmt: str = "parquet") -> DataFrame:
    """Only the given leaf folders of the lake, with partition columns
    still discovered from the paths (``basePath``)."""
    df = spark.read.format(fmt).option("basePath", path).load(folders)
    return df.drop(*[c for c in LAKE_PARTITIONS if c != "hour"])


def read_table_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    if not existing(spark, [path]):
        return None
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException:
        return None


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def complete_versions(spark: SparkSession, root: str) -> list[str]:
    """Version folders ``v=<id>`` under ``root`` that finished writing
    (have a ``_SUCCESS`` marker), oldest first. Listed through the Hadoop
    file system of the path, so it works on shared storage as locally."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")
            if fs.exists(marker):
                out.append(name.split("=", 1)[1])
    return sorted(out)


def version_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/v={version}"


def read_latest(spark: SparkSession, root: str, before: str | None = None) -> tuple[DataFrame | None, str | None]:
    """The newest complete version (strictly older than ``before`` if
    given). Readers never see a version that is still being written."""
    versions = [v for v in complete_versions(spark, root) if before is None or v < before]
    if not versions:
        return None, None
    return spark.read.parquet(version_path(root, versions[-1])), versions[-1]


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    out = []
    for path in paths:
        fs, p = _fs(spark, path)
        if fs.exists(p):
            out.append(path)
    return out


def write_mart(df: DataFrame, path: str, partition_by: str | None = None, cluster_by: Sequence[str] = ()) -> None:
    """Full refresh of a mart table into ``path`` (a new version folder:
    see :func:`version_path`; rewriting a folder being read would break
    its readers, so a refresh never overwrites the version in use).

    Partitioned marts are range-partitioned on (date, cluster columns)
    and sorted the same way inside each task: each task
    writes a few date directories and files carry tight min/max statistics on
    the cluster columns (the stand-in for clustering). A static overwrite drops dates that
    no longer exist.
    """
    w = df
    if partition_by:
        w = df.repartitionByRange(partition_by, *cluster_by).sortWithinPartitions(partition_by, *cluster_by)
    writer = w.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
