"""Row predicates (inventory FLT1-FLT13).

All return a boolean ``Column`` (or a filtered frame) so Catalyst can push them
into the Parquet scan when they touch raw columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clean import KEY_DATE_SENTINEL, _col


def current_only(df: DataFrame, flag: str = "LatestRecordFlag") -> DataFrame:
    """FLT1: keep rows whose current-record flag is set."""
    return df.filter(F.col(flag) == F.lit(True))


def require_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    """FLT2: keys not NULL (dates already parsed by ``parse_date``)."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def in_family(code: str, letters: list[str], *or_conds: Column) -> Column:
    """FLT3: first letter of ``code`` in ``letters``, OR any extra condition.

    NULL-safe: a NULL code or condition counts as false, never as unknown.
    """
    c = F.col(code)
    cond = F.coalesce(c.isNotNull() & F.substring(c, 1, 1).isin(letters), F.lit(False))
    for extra in or_conds:
        cond = cond | F.coalesce(extra, F.lit(False))
    return cond


def matches_like(c, pattern: str) -> Column:
    """FLT4: SQL LIKE (``%`` any run, ``_`` one character)."""
    return _col(c).like(pattern)


def min_length(c, n: int) -> Column:
    """FLT5: LEN(x) >= n where LEN ignores trailing blanks."""
    return F.length(F.rtrim(_col(c))) >= n


def incomplete(cols: list[str]) -> Column:
    """FLT6: any of ``cols`` still NULL."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def _sentinel_for(dtype: str):
    if dtype.startswith("date") or dtype.startswith("timestamp"):
        return F.lit(KEY_DATE_SENTINEL).cast("date")
    if dtype in ("string",):
        return F.lit("")
    if dtype == "boolean":
        return F.lit(False)
    return F.lit(0)


def changed(a_prefix: str, b_prefix: str, cols: dict[str, str]) -> Column:
    """FLT7: NULL-safe change test with sentinels over ``cols`` ({name: type}).

    NULL and the sentinel compare equal ('' for text, 0 for numbers, 1900-01-01
    for dates, false for flags) -- deliberately *not* ``<=>``.
    """
    terms = []
    for name, dtype in cols.items():
        s = _sentinel_for(dtype)
        a = F.coalesce(F.col(f"{a_prefix}{name}"), s)
        b = F.coalesce(F.col(f"{b_prefix}{name}"), s)
        terms.append(a != b)
    return reduce(lambda x, y: x | y, terms)


def since(ts: str, hours: float, now: Column) -> Column:
    """FLT8: ``ts >= now - hours``."""
    return F.col(ts) >= now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(hours) * 3600.0))


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q-11 / Q-5 check: the key groups that occur more than once (empty when the
    key is unique). Reported, never dropped silently."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def require_isin(df: DataFrame, col: str = "ISIN") -> DataFrame:
    """FLT12: rows without an identifier are dropped."""
    return df.filter(F.col(col).isNotNull() & (F.trim(F.col(col)) != ""))


def drop_blank_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """FLT13: drop rows whose cells are all blank."""
    cols = cols or df.columns
    any_value = reduce(lambda a, b: a | b,
                       [F.coalesce(F.trim(F.col(f"`{c}`").cast("string")) != "", F.lit(False)) for c in cols])
    return df.filter(any_value)
