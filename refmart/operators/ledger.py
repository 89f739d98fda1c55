"""Load ledger (inventory C16, AGG15, FLT8, TOP4).

The ledger is an append-only table of load events. Counts come from the data
itself: ``observed_counts`` attaches Spark ``Observation`` metrics to the
frame being written, so read / rejected / inserted are counted in the same
pass that writes the data (no second scan, nothing collected row by row).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from .windows import recent

LEDGER_SCHEMA = StructType([
    StructField("process_name", StringType(), False),
    StructField("file_name", StringType(), True),
    StructField("status", StringType(), False),
    StructField("load_start_ts", TimestampType(), True),
    StructField("load_end_ts", TimestampType(), True),
    StructField("rows_read", LongType(), True),
    StructField("rows_inserted", LongType(), True),
    StructField("rows_rejected", LongType(), True),
    StructField("error_message", StringType(), True),
])


def observed_counts(df: DataFrame, rejected: Column, name: str = "ledger") -> tuple[DataFrame, Observation]:
    """Attach read / rejected counters to ``df``; read ``obs.get`` after the write."""
    obs = Observation(name)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows_read"),
                          F.sum(F.when(rejected, 1).otherwise(0)).alias("rows_rejected"))
    return observed, obs


def ledger_entry(spark: SparkSession, process: str, file_name: str | None, status: str,
                 start: _dt.datetime, end: _dt.datetime | None, read: int | None = None,
                 inserted: int | None = None, rejected: int | None = None, error: str | None = None) -> DataFrame:
    """C16: one ledger row (START / END / ERROR); failures keep their message."""
    return spark.createDataFrame([(process, file_name, status, start, end, read, inserted, rejected,
                                   error or None)], LEDGER_SCHEMA)


def ledger_from_counts(per_file: DataFrame, process: Column, file_name: Column, read: Column,
                       rejected: Column, start: Column, end: Column) -> DataFrame:
    """C16 in bulk: ledger rows from per-file counts computed by Spark
    (status END when something was inserted or nothing was read, else ERROR)."""
    inserted = read - rejected
    return per_file.select(
        process.alias("process_name"), file_name.alias("file_name"),
        F.when((inserted > 0) | (read == 0), F.lit("END")).otherwise(F.lit("ERROR")).alias("status"),
        start.alias("load_start_ts"), end.alias("load_end_ts"),
        read.cast("long").alias("rows_read"), inserted.cast("long").alias("rows_inserted"),
        rejected.cast("long").alias("rows_rejected"), F.lit(None).cast("string").alias("error_message"))


def recent_loads(ledger: DataFrame, hours: float, n: int, now: Column | None = None,
                 ts: str = "load_start_ts") -> DataFrame:
    """RPT19 / FLT8 / TOP4: the ``n`` most recent loads of the last ``hours`` hours.
    ``now`` defaults to the current timestamp; tests pass a fixed one."""
    from ..functions.predicates import since
    now = now if now is not None else F.current_timestamp()
    return recent(ledger.filter(since(ts, hours, now)), [F.col(ts).desc_nulls_last(), F.col("file_name").desc_nulls_last()], n)
