"""Ranking operators (inventory WIN1-WIN7, TOP1-TOP5, FLT10).

``dedup_latest`` is the one shared "keep the first row per key" operator. It is
written as ``row_number() ... = 1`` so Catalyst plans a *partial*
``WindowGroupLimit`` before the shuffle: every map task already cuts each key to
one row, so a key holding a third of the data never reaches one reducer whole.

Top-N is ties-preserving (the report engine's TOPN keeps ties): the N-th best
measure value is found with ``orderBy().limit(N)`` (per-partition top-N, merged
-- bounded by N x partitions) and used as a scalar-subquery threshold. No
global window, no single-partition sort of the whole key set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OrderSpec = Column | str


def _order(o: OrderSpec) -> Column:
    """``"col"``, ``"col desc"``, ``"col asc nulls last"`` ... -> Column ordering.
    Defaults follow SQL: ASC puts NULLs first, DESC puts them last."""
    if isinstance(o, Column):
        return o
    name, _, direction = o.strip().partition(" ")
    col = F.col(name)
    return {
        "": col.asc_nulls_first(),
        "asc": col.asc_nulls_first(),
        "asc nulls first": col.asc_nulls_first(),
        "asc nulls last": col.asc_nulls_last(),
        "desc": col.desc_nulls_last(),
        "desc nulls last": col.desc_nulls_last(),
        "desc nulls first": col.desc_nulls_first(),
    }[" ".join(direction.lower().split())]


def dedup_latest(df: DataFrame, keys: list[str | Column], order: list[OrderSpec]) -> DataFrame:
    """WIN1-WIN6: keep one row per ``keys``, the first by ``order``.

    ``order`` items are Columns or strings like ``"ValidFromDate desc"``. Add a
    deterministic tie-break yourself (Q-4): equal order values pick arbitrarily.
    """
    w = Window.partitionBy(*keys).orderBy(*[_order(o) for o in order])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def top_in_group(df: DataFrame, group: list[str], measure: str, n: int = 1) -> DataFrame:
    """WIN7: rows whose ``measure`` ranks within the top ``n`` of their group, ties kept
    (``rank() <= n``)."""
    w = Window.partitionBy(*group).orderBy(F.col(measure).desc_nulls_last())
    return df.withColumn("__rk", F.rank().over(w)).filter(F.col("__rk") <= n).drop("__rk")


def nth_best(df: DataFrame, measure: str, n: int) -> Column:
    """Scalar subquery: the ``n``-th largest ``measure`` (or the smallest if fewer rows)."""
    return df.select(measure).filter(F.col(measure).isNotNull()) \
        .orderBy(F.col(measure).desc()).limit(n).select(F.min(measure)).scalar()


def top_rows(df: DataFrame, measure: str, n: int) -> DataFrame:
    """TOP1/TOP2 core: rows whose ``measure`` is at least the ``n``-th best (ties kept)."""
    return df.filter(F.col(measure) >= nth_best(df, measure, n))


def keep_top_keys(df: DataFrame, key: str | list[str], measure_df: DataFrame, measure: str, n: int) -> DataFrame:
    """TOP3 / FLT10 / JOI7: keep the rows of ``df`` whose key is among the top ``n``
    keys of ``measure_df`` (one row per key), ties kept -- a semi join."""
    keys = [key] if isinstance(key, str) else key
    top = top_rows(measure_df, measure, n).select(*keys)
    return df.join(top, on=keys, how="left_semi")


def recent(df: DataFrame, order: list[OrderSpec], n: int) -> DataFrame:
    """TOP4: first ``n`` rows by ``order`` (TakeOrderedAndProject: per-partition top-n)."""
    return df.orderBy(*[_order(o) for o in order]).limit(n)


def order_by(df: DataFrame, order: list[OrderSpec]) -> DataFrame:
    """TOP5: display order (range-partitioned global sort)."""
    return df.orderBy(*[_order(o) for o in order])
