"""File-manifest operators (inventory SRC8, SRC9, SRC10, SET1).

A landed-file listing is itself a DataFrame (path, name, modification time --
``spark.read.format("binaryFile")`` or the ``_metadata`` column of any file
scan gives one), so choosing what to load is ordinary aggregation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# File-name shapes of the three feeds and their date parts.
FILE_DATE_PATTERNS = {
    "full": (r"^FULINS_[A-Z]_([0-9]{8})_", "yyyyMMdd"),
    "delta": (r"^DLTINS_([0-9]{8})_", "yyyyMMdd"),
    "lei": (r"^([0-9]{8}-[0-9]{4})-", "yyyyMMdd-HHmm"),
}


def file_date(name: Column, kind: str) -> Column:
    """SRC9: the date (or timestamp for ``lei``) embedded in a file name; NULL when
    the name does not have the kind's shape or the date is invalid."""
    pattern, fmt = FILE_DATE_PATTERNS[kind]
    raw = F.nullif(F.regexp_extract(name, pattern, 1), F.lit(""))
    ts = F.try_to_timestamp(raw, F.lit(fmt))
    return ts if kind == "lei" else F.to_date(ts)


def latest_partition(df: DataFrame, date_col: str, by: list[str] | None = None) -> DataFrame:
    """SRC8: rows of the latest date (per ``by`` group when given). Without groups
    the max is a scalar subquery -- a partition-pruning filter when ``date_col`` is
    a partition column."""
    if not by:
        return df.filter(F.col(date_col) == df.select(F.max(date_col)).scalar())
    mx = df.groupBy(*by).agg(F.max(date_col).alias("__mx"))
    return df.join(mx, by).filter(F.col(date_col) == F.col("__mx")).drop("__mx")


def incremental_plan(manifest: DataFrame, loaded: DataFrame, kind: str = "kind", day: str = "day") -> DataFrame:
    """SRC10: one row {last_full, last_delta, latest_full, latest_delta,
    full_to_get, delta_day, reference_date} from the available and the already
    loaded file manifests (``kind`` in {'full','delta'}, ``day`` a date).

    A full file is loaded when a newer one exists; only the newest delta day is
    loaded, and only when it is after the reference (last delta, else last full).
    """
    def mx(df: DataFrame, k: str) -> Column:
        return F.max(F.when(F.col(kind) == k, F.col(day)))

    avail = manifest.agg(mx(manifest, "full").alias("latest_full"), mx(manifest, "delta").alias("latest_delta"))
    done = loaded.agg(mx(loaded, "full").alias("last_full"), mx(loaded, "delta").alias("last_delta"))
    lf, ld = done.select("last_full").scalar(), done.select("last_delta").scalar()
    ref = F.coalesce(ld, lf)
    full_to_get = F.when(F.col("latest_full").isNotNull() & (lf.isNull() | (lf < F.col("latest_full"))),
                         F.col("latest_full"))
    delta_day = F.when(F.col("latest_delta").isNotNull() & (ref.isNull() | (F.col("latest_delta") > ref)),
                       F.col("latest_delta"))
    return avail.select(lf.alias("last_full"), ld.alias("last_delta"), "latest_full", "latest_delta",
                        full_to_get.alias("full_to_get"), delta_day.alias("delta_day"),
                        ref.alias("reference_date"))


def union_files(dfs: list[DataFrame]) -> DataFrame:
    """SET1: append many inputs (UNION ALL by name; missing columns NULL)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
