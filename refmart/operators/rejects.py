"""Good and rejected rows of a load (inventory C16).

Each row is judged once: the first rule it breaks is its reason. Good and rejected rows
leave in one write, as partitions of a batch folder that a retried load replaces, and the
counts per file are taken from what was stored (two columns), so read = inserted +
rejected holds by construction and every reject keeps its row and its reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REASON = "reject_reason"
STATUS = "load_status"      # partition folders: inserted, rejected
BATCH = "load_batch"

Rules = list[tuple[str, Column]]


def with_reason(df: DataFrame, rules: Rules) -> DataFrame:
    """``df`` with the first reason whose condition holds (an unknown condition does not hold)."""
    reason = F.lit(None).cast("string")
    for name, broken in reversed(rules):
        reason = F.when(F.coalesce(broken, F.lit(False)), F.lit(name)).otherwise(reason)
    return df.withColumn(REASON, reason)


def write_checked(df: DataFrame, rules: Rules, path: str, batch: str) -> None:
    """Store a batch's good and rejected rows; the same batch again replaces it."""
    judged = with_reason(df, rules).withColumn(
        STATUS, F.when(F.col(REASON).isNull(), "inserted").otherwise("rejected"))
    judged.write.mode("overwrite").partitionBy(STATUS).parquet(f"{path}/{BATCH}={batch}")


def stored(spark: SparkSession, path: str, batch: str | None = None) -> DataFrame:
    """All rows of all batches (or of one) with their status and reason."""
    df = spark.read.option("basePath", path).parquet(path)
    return df if batch is None else df.where(F.col(BATCH).cast("string") == batch)


def inserted(spark: SparkSession, path: str, batch: str | None = None) -> DataFrame:
    return stored(spark, path, batch).where(f"{STATUS} = 'inserted'").drop(STATUS, REASON, BATCH)


def rejected(spark: SparkSession, path: str, batch: str | None = None) -> DataFrame:
    return stored(spark, path, batch).where(f"{STATUS} = 'rejected'").drop(STATUS, BATCH)


def file_counts(rows: DataFrame, file_col: str) -> DataFrame:
    """(file, rows_read, rows_inserted, rows_rejected, reasons): per file, with the number of rows per
    reason as text (``reason: n``, by reason, comma-joined; null without rejects)."""
    per = rows.groupBy(F.col(file_col).alias("file"), REASON).agg(F.count(F.lit(1)).alias("n"))
    why = F.array_sort(F.collect_list(F.when(F.col(REASON).isNotNull(), F.concat(REASON, F.lit(": "), F.col("n").cast("string")))))
    return per.groupBy("file").agg(
        F.sum("n").alias("rows_read"), F.sum(F.when(F.col(REASON).isNull(), F.col("n")).otherwise(0)).alias("rows_inserted"),
        F.sum(F.when(F.col(REASON).isNotNull(), F.col("n")).otherwise(0)).alias("rows_rejected"),
        F.nullif(F.array_join(why, ", "), F.lit("")).alias("reasons"))
