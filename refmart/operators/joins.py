"""Join operators (inventory JOI1-JOI12).

All equi joins. Join strategy is left to Catalyst + AQE: a side whose *runtime*
size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` is broadcast,
anything larger is sort-merge joined, and AQE splits skewed partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import OrderSpec, dedup_latest


def left_join_latest(df: DataFrame, ref: DataFrame, on: list[str], order: list[OrderSpec],
                     ref_on: list[str] | None = None) -> DataFrame:
    """JOI1: left join each row to the *latest* version of its reference row
    (rank in the reference first -- ``rn = 1`` -- so the join never fans out)."""
    ref_on = ref_on or on
    latest = dedup_latest(ref, ref_on, order)
    if ref_on != on:
        for a, b in zip(ref_on, on):
            latest = latest.withColumnRenamed(a, b)
    return df.join(latest, on=on, how="left")


def update_from(tgt: DataFrame, src: DataFrame, on: list[str], sets: dict[str, Column | str],
                when: Column | None = None, flag: str | None = None) -> DataFrame:
    """JOI3: ``UPDATE t SET ... FROM t JOIN s ON ... WHERE cond`` as a rewrite.

    ``src`` must hold at most one row per ``on`` (dedup it first). ``sets`` maps a
    target column to a source expression over ``s.<col>``; ``when`` may refer to
    ``t.<col>`` and ``s.<col>``. Returns the whole target, updated.
    """
    t, s = tgt.alias("t"), src.withColumn("__m", F.lit(True)).alias("s")
    cond = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in on])
    joined = t.join(s, cond, "left")
    hit = F.coalesce(F.col("s.__m"), F.lit(False))
    if when is not None:
        hit = hit & F.coalesce(when, F.lit(False))
    out = []
    for c in tgt.columns:
        if c in sets:
            v = sets[c]
            v = F.col(f"s.{v}") if isinstance(v, str) else v
            out.append(F.when(hit, v).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}"))
    if flag:
        out.append(hit.alias(flag))
    return joined.select(*out)


def full_merge(sources: list[DataFrame], keys: list[str], priority_cols: list[str]) -> DataFrame:
    """JOI4: FULL OUTER merge of several sources on ``keys`` with a priority
    coalesce of attributes (first source first).

    Each source must hold at most one row per key. Written as union + one
    ``groupBy`` (map-side combined, one shuffle) instead of chained full joins,
    which would re-shuffle on the coalesced key after every join.
    """
    tagged = [s.withColumn("__prio", F.lit(i)) for i, s in enumerate(sources)]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    aggs = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("__prio"))).alias(c) for c in priority_cols]
    return u.groupBy(*keys).agg(*aggs)


def not_exists(df: DataFrame, other: DataFrame, on: list[str] | Column) -> DataFrame:
    """JOI5 / JOI6: anti join (``NOT EXISTS`` and ``LEFT JOIN ... IS NULL``)."""
    return df.join(other, on=on, how="left_anti")


def append_common(target_columns: list[str], src: DataFrame,
                  exclude: tuple[str, ...] = ()) -> DataFrame:
    """JOI11: project ``src`` onto the columns it shares with the target (in target
    order); fails when nothing is shared."""
    common = [c for c in target_columns if c in set(src.columns) and c not in exclude]
    if not common:
        raise ValueError("no common columns between source and target")
    return src.select(*common)
