"""Aggregations and report measures (inventory AGG1-AGG16, TOP1-TOP2).

Measures are aggregate *expressions* (so several go into one ``agg`` and share
one shuffle) or small frame functions. Blank-inclusive distinct counts follow
the report engine, which counts BLANK as one value (Q-9).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import top_rows


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def distinct_count(c, blank: bool = True) -> Column:
    """AGG5: distinct count; with ``blank=True`` NULL counts as one more value."""
    x = _c(c)
    n = F.count_distinct(x)
    if not blank:
        return n
    return n + F.max(F.when(x.isNull(), 1).otherwise(0))


def ratio(num: Column, den: Column) -> Column:
    """AGG6: division that is blank (NULL) when the denominator is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def missing_share(key, col, blank: bool = True) -> Column:
    """AGG7: share of distinct ``key`` whose ``col`` is NULL; 0 when none."""
    k = _c(key)
    bad = distinct_count(F.when(_c(col).isNull(), k), blank=False) + (
        F.max(F.when(_c(col).isNull() & k.isNull(), 1).otherwise(0)) if blank else F.lit(0))
    return F.coalesce(ratio(bad, distinct_count(k, blank)), F.lit(0.0))


def missing_shares_of(df: DataFrame, key: str, names: dict[str, str]) -> DataFrame:
    """AGG7 for several columns at once (one row): the rows are first reduced to one
    per ``key`` (a NULL key is one more) with a flag per column, so no distinct
    count has to expand them."""
    per_key = df.groupBy(key).agg(*[F.max(F.col(c).isNull()).alias(n) for c, n in names.items()])
    return per_key.agg(*[F.coalesce(ratio(F.sum(F.col(n).cast("long")), F.count(F.lit(1))), F.lit(0.0)).alias(n)
                         for n in names.values()])


def max_date(df: DataFrame, col: str, cond: Column | None = None) -> Column:
    """AGG1: scalar ``MAX(col)`` (optionally filtered) as a scalar subquery; NULL
    when nothing qualifies -- the caller's skip signal."""
    src = df if cond is None else df.filter(cond)
    return src.select(F.max(col)).scalar()


def row_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """AGG2: row counts before / after and their difference (one row)."""
    b = before.select(F.count(F.lit(1))).scalar()
    a = after.select(F.count(F.lit(1))).scalar()
    return before.sparkSession.range(1).select(b.alias("rows_before"), a.alias("rows_after"),
                                               (a - b).alias("rows_delta"))


def distinct_keys(df: DataFrame, col: str) -> DataFrame:
    """AGG3 / SET3: ``SELECT DISTINCT col`` of non-NULL values."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct()


def flag_ladder(df: DataFrame, key: str, text: Column, rules: list[tuple[list[str], str]],
                default: str, name: str) -> DataFrame:
    """AGG4: per ``key``, the first label whose LIKE-patterns match *any* row's
    ``text`` (``MAX(CASE WHEN ... THEN 1 ELSE 0 END)`` per rule, then a ladder)."""
    flags = [F.max(reduce(lambda a, b: a | b, [text.like(p) for p in pats]).cast("int")).alias(f"__f{i}")
             for i, (pats, _) in enumerate(rules)]
    g = df.groupBy(key).agg(*flags)
    expr = None
    for i, (_, label) in enumerate(rules):
        cond = F.col(f"__f{i}") == 1
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return g.select(key, expr.otherwise(F.lit(default)).alias(name))


def total_without(df: DataFrame, by: list[str], removed: list[str], key: str, name: str = "total",
                  measure: str = "listings", blank: bool = True) -> DataFrame:
    """AGG9: per group, distinct ``key`` count and the count of the group with the
    columns in ``removed`` taken out of it (``ALL(column)``: the other ones still filter)."""
    left = [c for c in by if c not in removed]
    groups = df.groupBy(*by).agg(distinct_count(key, blank).alias(measure)).alias("g")
    totals = df.groupBy(*left).agg(distinct_count(key, blank).alias(name)).alias("t")
    same = reduce(lambda a, b: a & b, [F.col(f"g.{c}").eqNullSafe(F.col(f"t.{c}")) for c in left])
    return groups.join(totals, same).select(*[f"g.{c}" for c in by], measure, name)


def share_of_total(df: DataFrame, by: list[str], key: str, name: str = "share",
                   measure: str = "listings", blank: bool = True) -> DataFrame:
    """AGG9: per group, distinct ``key`` count and its share of the grand total
    computed with the grouping removed (``ALL(dim)``): a scalar subquery."""
    total = df.select(distinct_count(key, blank).alias("t")).scalar()
    return df.groupBy(*by).agg(distinct_count(key, blank).alias(measure)) \
        .withColumn(name, ratio(F.col(measure), total))


def agg_by_group(df: DataFrame, by: str, key: str, name: str, blank: bool = True) -> DataFrame:
    """AGG10: pre-aggregate (e.g. issuer -> distinct instruments). Groups without
    rows are absent, like the report engine's summarise."""
    return df.groupBy(by).agg(distinct_count(key, blank).alias(name))


def top_share(per_key: DataFrame, measure: str, n: int, total: Column) -> Column:
    """TOP1 / TOP2: sum of the top-``n`` per-key measures (ties kept) over ``total``
    -- returned as a scalar."""
    top_sum = top_rows(per_key, measure, n).select(F.sum(measure)).scalar()
    return ratio(top_sum, total)


def matrix(df: DataFrame, rows: list[str], col: str, values: list[str], measure: Column) -> DataFrame:
    """AGG14: pivot with an explicit value list (no extra pass to find values)."""
    return df.groupBy(*rows).pivot(col, values).agg(measure)


def ledger_summary(ledger: DataFrame, by: list[str] | None = None) -> DataFrame:
    """AGG15: files / read / inserted / failed and success rate (inserted/read*100,
    0 when nothing was read)."""
    g = ledger.groupBy(*(by or []))
    out = g.agg(
        F.count_distinct("file_name").alias("total_files"),
        F.coalesce(F.sum("rows_read"), F.lit(0)).cast("long").alias("total_read"),
        F.coalesce(F.sum("rows_inserted"), F.lit(0)).cast("long").alias("total_inserted"),
        F.sum(F.when(F.col("status") == "ERROR", 1).otherwise(0)).cast("long").alias("failed_files"),
    )
    rate = F.when(F.col("total_read") > 0,
                  F.round(F.col("total_inserted").cast("double") / F.col("total_read") * 100.0, 2)) \
        .otherwise(F.lit(0.0))
    return out.withColumn("success_rate", rate)


def is_empty(*dfs: DataFrame) -> Column:
    """AGG16: true when the sum of the frames' row counts is 0 (scalar)."""
    counts = [d.select(F.count(F.lit(1)).alias("n")) for d in dfs]
    return reduce(lambda a, b: a.unionByName(b), counts).select(F.sum("n") == 0).scalar()
