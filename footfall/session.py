"""Session construction and lineage-cut helpers."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this library assumes.  AQE re-plans joins at runtime
# (broadcast conversion of small shuffled sides, skew-join splitting, partition
# coalescing); the session time zone is pinned so dates never shift.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Let joins on (store, x) reuse a hash partitioning on store alone; the
    # store-keyed intermediates are laid out that way on purpose.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "footfall",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the library defaults.

    On a cluster pass ``master=None`` and let ``spark-submit`` decide; size
    ``shuffle_partitions`` so one shuffle partition is ~128-256 MB.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Rows of an Arrow batch where Spark's own default (10,000) would hold.
TEXT_BATCH_ROWS = 2000
_shipped: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would, once per application.

    The archive is made on the driver and served by Spark; Python tasks import it.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="footfall-")),
                        "footfall-package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    # rows of whole texts: a worker holds a batch at a time (a value of the user's own stays)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH_ROWS))
    _shipped[app] = path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint`` usable and return the directory.

    The directory the cluster names in ``spark.checkpoint.dir`` wins.  Only a
    local-mode session without that setting (tests) gets a private scratch
    directory; on a cluster a missing setting is an error, because a
    machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage "
                "(HDFS/S3/ABFS) before running iterative jobs")
        configured = tempfile.mkdtemp(prefix="footfall-ckpt-",
                                      dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: materialise ``df`` in the shared checkpoint dir.

    Used at loop boundaries (recursive forecast, ordinal numbering) so a lost
    executor re-reads the checkpoint instead of replaying the whole lineage.
    Under AQE the checkpointed frame reports no partitioning; when a later
    join should reuse a key layout, use ``materialize_bucketed`` instead.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint dir and read it back.

    A reliable lineage cut like ``cut_lineage``, but columnar and compressed: readers of a few
    columns of a wide frame read these alone.  ``rows_per_file`` bounds the rows of a file.
    """
    import uuid

    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    root = spark.sparkContext.getCheckpointDir().rstrip("/")
    path = f"{root}/frames/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def keep_methods_compiled(spark: SparkSession) -> None:
    """Generate no method above 8000 bytes, the most that HotSpot compiles: a longer one, as rows
    of 70 columns make it, is interpreted.  A value of the user's own stays."""
    if spark.conf.get(_METHOD_LIMIT) == "65535":
        spark.conf.set(_METHOD_LIMIT, "8000")


_WHOLE_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def keep_store_layout(spark: SparkSession) -> None:
    """Let joins on (store, x) use frames that lie by store, in a session of the user's own too:
    otherwise the wide panel is dealt out anew for each of its keys, and those copies stay on disk
    until the driver collects its garbage."""
    spark.conf.set(_WHOLE_KEYS, "false")


# Rows of the largest input table that one shuffle partition holds.
PARTITION_ROWS = 500_000
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_initial: dict[str, str] = {}       # what ``scale_partitions`` set, by application


def scale_partitions(spark: SparkSession, rows: int) -> None:
    """Let shuffles begin with a partition per ``PARTITION_ROWS`` of an input of ``rows``, where
    that is more than ``spark.sql.shuffle.partitions``; AQE merges those that stay small.

    A fixed number of partitions would let every task's share grow with the input.  A value of
    the user's own stays.
    """
    app = spark.sparkContext.applicationId
    now = spark.conf.get(_INITIAL, None)
    if now is not None and now != _initial.get(app):
        return
    wanted = -(-rows // PARTITION_ROWS)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(_INITIAL, str(wanted))
        _initial[app] = str(wanted)
    elif now is not None:
        spark.conf.unset(_INITIAL)
        del _initial[app]


# Rows of the largest input table behind one partition of a store-keyed frame.
FRAME_ROWS = 250_000


def frame_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions of a store-keyed frame made from ``rows`` input rows, at least one a core.

    Given to ``repartition`` it holds: AQE merges the partitions of its own shuffles by their
    compressed bytes, down to one a core, so that the rows of a task would grow with the input.
    """
    return max(spark.sparkContext.defaultParallelism, -(-rows // FRAME_ROWS))


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions that a shuffle begins with."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               int(spark.conf.get(_INITIAL, None) or 0))


# Tables written below, dropped with their files by ``drop_intermediates``.
_intermediate: dict[str, list[tuple[str, str]]] = {}


def materialize_bucketed(df: DataFrame, key: str, name: str, buckets: int | None = None,
                         partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as a table bucketed (and sorted) by ``key`` under the checkpoint dir.

    A reliable lineage cut that, unlike ``checkpoint``, keeps a known layout:
    reads report hash partitioning on ``key``, so joins and aggregates keyed
    on ``key`` between tables with the same bucket count need no shuffle.
    Rows are hash-partitioned by ``key`` first, so each task writes one file.
    The table belongs to the session's flow: ``drop_intermediates`` removes it.
    """
    import uuid

    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    root = spark.sparkContext.getCheckpointDir()
    n = buckets or shuffle_partitions(spark)
    table = f"footfall_{name}_{uuid.uuid4().hex[:12]}"
    path = f"{root.rstrip('/')}/tables/{table}"
    writer = df.repartition(n, key).write.bucketBy(n, key).sortBy(key)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.mode("overwrite").option("path", path).saveAsTable(table)
    _intermediate.setdefault(spark.sparkContext.applicationId, []).append((table, path))
    return spark.table(table)


def intermediates(spark: SparkSession) -> int:
    """Tables of ``materialize_bucketed`` that this application has now."""
    return len(_intermediate.get(spark.sparkContext.applicationId, []))


def drop_intermediates(spark: SparkSession, after: int = 0) -> int:
    """Drop the tables of ``materialize_bucketed`` in this application, files included, but
    the first ``after`` (an earlier value of ``intermediates``).

    Call it when the frames built on them are no longer needed.  Returns their number.
    """
    sc = spark.sparkContext
    mine = _intermediate.setdefault(sc.applicationId, [])
    gone = mine[after:]
    del mine[after:]
    for table, path in gone:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
    return len(gone)
