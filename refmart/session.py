"""Spark session and lineage helpers.

Everything in the library is a ``DataFrame -> DataFrame`` function; this module
only builds a session with sane defaults for the tests and the bench, and
offers the one lineage-cutting helper the pipelines use.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

# Settings that a session started here gets where the submitter set nothing.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "refmart", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """The active session as it is, or a new one with the library's defaults.

    What the submitter set (spark-submit's master and ``--conf``) always wins;
    ``master`` and ``shuffle_partitions`` are for scripts and tests that start
    Spark themselves.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    conf = dict(_DEFAULTS) | (extra or {})
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if os.environ.get("SPARK_DRIVER_MEMORY"):
        conf.setdefault("spark.driver.memory", os.environ["SPARK_DRIVER_MEMORY"])
    if master:
        conf["spark.master"] = master
    submitted = _submitted()
    builder = SparkSession.builder
    for k, v in {"spark.app.name": app, **conf}.items():
        if k not in submitted:
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _submitted() -> dict[str, str]:
    """The settings spark-submit passed to this driver (none when it was started plainly)."""
    if "PYSPARK_GATEWAY_PORT" not in os.environ:
        return {}
    SparkContext._ensure_initialized()
    return dict(SparkConf().getAll())


_SCRATCH: dict[int, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``. Only a
    local session (tests), where driver and executors are one machine, may go
    without: it gets a fresh scratch folder. On a cluster an unset folder is an
    error, as executors cannot read what others write to their own disks."""
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if configured and sc.getCheckpointDir():
        return configured
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        if id(spark) not in _SCRATCH:
            _SCRATCH[id(spark)] = tempfile.mkdtemp(prefix="refmart-ckpt-")
        configured = _SCRATCH[id(spark)]
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def session_key(spark: SparkSession) -> int:
    """An id for memoising per session (the JVM context when there is one)."""
    try:
        return id(spark.sparkContext._jsc)
    except Exception:  # noqa: BLE001
        return id(spark)


def cut_lineage(df: DataFrame, name: str = "stage", buckets: tuple[int, str] | None = None) -> DataFrame:
    """Cut the lineage by writing the frame as Parquet into the shared checkpoint
    folder and reading it back (survives executor loss, unlike a local
    checkpoint). One computation -- ``DataFrame.checkpoint`` would evaluate the
    plan twice (once to count, once to write) -- and the re-read table carries
    real size statistics for AQE's join planning. Zstandard takes less of the shared
    disk than the default codec. ``buckets`` (a number and a column) writes a table in
    buckets by that column, sorted by it: what groups by it later shuffles nothing."""
    import uuid
    base = ensure_checkpoint_dir(df.sparkSession)
    path = f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    out = df.write.mode("errorifexists").option("compression", "zstd")
    if buckets is None:
        out.parquet(path)
        return df.sparkSession.read.parquet(path)
    n, column = buckets
    table = path.rpartition("/")[2].replace("-", "_")
    out.format("parquet").option("path", path).bucketBy(n, column).sortBy(column).saveAsTable(table)
    return df.sparkSession.table(table)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its file system; errors other than absence are raised."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
