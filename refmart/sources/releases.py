"""Releases: tables made of parts that one manifest names (inventory C1, C15, STR1).

A table's part is a folder that is written once and never changed. A release is a
manifest of ``(table, part, path, info)`` rows, written whole, and made current by
one pointer file that is written last. Readers take every path from the manifest
that the newest pointer names, so they see either the old release or the new one, of
all tables together; a load that fails leaves its folders unnamed and the old
release as it was. A load that changes a few parts writes those and names the
others where they lie.

State buckets are such a table: rows lie in ``n`` parts by a hash of the key, and a
delta reads and writes only the buckets its keys fall in. A manifest has a row per
part: bounded by the number of buckets (or of days), not by the data.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .sinks import MANIFEST, current_version, publish

BUCKETS = 256           # parts of a bucketed state unless the first load says otherwise
_BUCKET = "state_bucket"
_ROWS = "table STRING, part STRING, path STRING, info STRING"


@dataclass
class Table:
    """A table of a release: its schema, its parts' folders (below the base), of buckets their number and key,
    of a dimension the largest surrogate key given."""
    schema: StructType
    parts: dict[str, str] = field(default_factory=dict)
    buckets: int | None = None
    keys: list[str] | None = None
    top: int | None = None


Release = dict[str, Table]


def publish_release(spark: SparkSession, base: str, version: str, release: Release) -> None:
    """Write the manifest, then the pointer that makes it current."""
    rows = []
    for name, t in release.items():
        info = json.dumps({"schema": t.schema.jsonValue(), "buckets": t.buckets, "keys": t.keys, "top": t.top})
        rows.append((name, None, None, info))
        rows += [(name, part, path, None) for part, path in t.parts.items()]
    spark.createDataFrame(rows, _ROWS).coalesce(1).write.mode("overwrite").parquet(f"{base}/{MANIFEST}/{version}")
    publish(spark, base, version)


def load_release(spark: SparkSession, base: str, version: str | None = None) -> Release:
    """The current release (or a named one); empty if none was ever published."""
    version = version or current_version(spark, base)
    if version is None:
        return {}
    rows = spark.read.schema(_ROWS).parquet(f"{base}/{MANIFEST}/{version}").collect()     # a row per part
    out: Release = {}
    for r in rows:
        if r.part is None:
            info = json.loads(r.info)
            out[r.table] = Table(StructType.fromJson(info["schema"]), {}, info["buckets"], info["keys"], info.get("top"))
    for r in rows:
        if r.part is not None:
            out[r.table].parts[r.part] = r.path
    return out


def read_parts(spark: SparkSession, base: str, table: Table, parts: list[str] | None = None) -> DataFrame:
    """The rows of a table, or of some of its parts. The schema is the manifest's: no file is opened for it."""
    paths = [f"{base}/{p}" for part, p in sorted(table.parts.items()) if parts is None or part in parts]
    if not paths:
        return spark.createDataFrame([], table.schema)
    return spark.read.schema(table.schema).parquet(*paths)


def read_released(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table of the current release."""
    release = load_release(spark, base)
    if name not in release:
        raise FileNotFoundError(f"no release under {base} holds {name}")
    return read_parts(spark, base, release[name])


# ----------------------------------------------------------------- state buckets
STATE = "state"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write_buckets(df: DataFrame, base: str, version: str, keys: list[str], buckets: int) -> dict[str, str]:
    """Write rows into their buckets' folders; the parts that got rows. A rebalance brings a bucket's rows
    together; adaptive execution splits a bucket that holds too many of them over several tasks and files."""
    rows = df.withColumn(_BUCKET, bucket_of(keys, buckets)).hint("rebalance", _BUCKET)
    path = f"{base}/{version}"
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(_BUCKET).parquet(path))
    schema = StructType([*df.schema.fields]).add(_BUCKET, "integer")
    # only the folders' names are read; at most one row per bucket
    got = df.sparkSession.read.schema(schema).parquet(path).select(_BUCKET).distinct().collect()
    return {str(r[0]): f"{version}/{_BUCKET}={r[0]}" for r in got}


def write_state(df: DataFrame, base: str, version: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """A whole state as buckets: the first load, or a full refresh."""
    table = Table(df.schema, _write_buckets(df, base, version, keys, buckets), buckets, list(keys))
    publish_release(df.sparkSession, base, version, {STATE: table})


def update_state(spark: SparkSession, base: str, version: str, changes: DataFrame,
                 apply: Callable[[DataFrame, DataFrame], DataFrame]) -> list[str]:
    """Apply ``changes`` to the buckets its keys fall in: only these are read and written, the release
    names the others where they lie. Returns the touched buckets. ``apply(state, changes)`` must leave
    rows of other keys as they are and return no row under a key that ``changes`` lacks but the state
    did not have. Rows of ``changes`` with a null key touch nothing."""
    table = load_release(spark, base)[STATE]
    if any(p.startswith(f"{version}/") for p in table.parts.values()):
        raise ValueError(f"the current release of {base} holds parts of version {version}")
    keyed = changes.dropna(subset=table.keys)
    touched = sorted(str(r[0]) for r in keyed.select(bucket_of(table.keys, table.buckets)).distinct().collect())
    parts = {b: p for b, p in table.parts.items() if b not in touched}
    if touched:
        new = apply(read_parts(spark, base, table, touched), keyed).select(*table.schema.names)
        parts |= _write_buckets(new, base, version, table.keys, table.buckets)
    publish_release(spark, base, version, {STATE: Table(table.schema, parts, table.buckets, table.keys)})
    return touched


def has_state(spark: SparkSession, base: str) -> bool:
    """Whether the current version under ``base`` is made of buckets."""
    from ..session import path_exists
    version = current_version(spark, base)
    return version is not None and path_exists(spark, f"{base}/{MANIFEST}/{version}")


def read_state(spark: SparkSession, base: str, version: str | None = None) -> DataFrame:
    return read_parts(spark, base, load_release(spark, base, version)[STATE])
