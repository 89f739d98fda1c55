"""Sinks (inventory SNK1-SNK4).

Every write is atomic at the level Spark offers: a full refresh lands in a new
version folder and only then is published by a new pointer file (readers never see
a half-written table, nor a moment without one); appends are idempotent per source file; a day is replaced with
dynamic partition overwrite.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CURRENT = "_current"     # folder of pointers: one small file per published version
MANIFEST = "_manifest"   # folder of manifests: what a version that is made of parts consists of (releases)


def publish(spark: SparkSession, base: str, version: str) -> None:
    """Make ``version`` current. Pointers are only ever added (a file appears whole or
    not at all) and the highest number counts, so readers always find one."""
    n = _pointers(spark, base)
    n = 0 if n is None else n[0] + 1
    spark.createDataFrame([(f"{n:012d} {version}",)], "v STRING").coalesce(1).write.mode("append").text(
        f"{base}/{CURRENT}")


def _pointers(spark: SparkSession, base: str) -> tuple[int, str] | None:
    from ..session import path_exists
    if not path_exists(spark, f"{base}/{CURRENT}"):
        return None
    top = spark.read.text(f"{base}/{CURRENT}").agg(F.max("value")).first()[0]
    return None if top is None else (int(top.split(" ", 1)[0]), top.split(" ", 1)[1])


def current_version(spark: SparkSession, base: str) -> str | None:
    """The published version, or None if there never was one. A pointer that cannot
    be read raises: it is not the same as an empty table."""
    top = _pointers(spark, base)
    return None if top is None else top[1]


def write_full_refresh(df: DataFrame, base: str, version: str | None = None) -> str:
    """SNK1: truncate + reload as write-new-version-then-publish: a failed load
    leaves the previous version current."""
    version = version or _dt.datetime.now(_dt.timezone.utc).strftime("v%Y%m%dT%H%M%S%f")
    path = f"{base}/{version}"
    df.write.mode("overwrite").parquet(path)
    publish(df.sparkSession, base, version)
    return path


def read_current(spark: SparkSession, base: str) -> DataFrame:
    """Read the version that a full refresh, or a load of some of a state's buckets, made current."""
    from ..session import path_exists
    version = current_version(spark, base)
    if version is None:
        raise FileNotFoundError(f"no version was published under {base}")
    if path_exists(spark, f"{base}/{MANIFEST}/{version}"):
        from .releases import read_state
        return read_state(spark, base, version)
    return spark.read.parquet(f"{base}/{version}")


def append_batch(df: DataFrame, path: str, file_col: str = "file_name") -> DataFrame:
    """SNK2: append-only load, idempotent per source file: files already loaded are
    skipped, so a retried load does not duplicate rows. Rows are stored by file
    (``load_file=...`` folders), so the check lists folders and reads no data. Returns the appended rows (lazy)."""
    spark = df.sparkSession
    from ..session import path_exists
    new = df
    if path_exists(spark, path):
        done = spark.read.parquet(path)
        if "load_file" in done.columns:
            names = done.select(F.substring("load_file", 3, 1 << 30).alias(file_col)).distinct()
            new = df.join(names, file_col, "left_anti")
    # the prefix keeps folder names text, whatever a file is called
    (new.withColumn("load_file", F.concat(F.lit("f:"), F.col(file_col))).write.mode("append").partitionBy("load_file").parquet(path))
    return new


def overwrite_partition(df: DataFrame, path: str, partition_col: str = "SnapshotDate") -> None:
    """SNK3: idempotent day reload -- only the partitions present in ``df`` are
    replaced (dynamic partition overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def keep_latest(fact_path: str, spark: SparkSession, out: str) -> None:
    """SNK4 / C11: materialise the latest snapshot (rows at the max date) as a full refresh."""
    from ..operators.facts import latest_snapshot
    write_full_refresh(latest_snapshot(spark.read.parquet(fact_path)), out)


def now_utc() -> F.Column:
    return F.current_timestamp()
