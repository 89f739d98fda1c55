"""Distinct counts over surrogate keys by mergeable bitmaps (inventory AGG5, AGG14).

Surrogate keys are dense, so the distinct keys of a group are a few bitmaps of 32768 bits:
one row per (group, key column, bucket). All key columns go through one partial
aggregation, no distinct count expands the rows, and the sets of days, venues or matrix
cells unite by ``bitmap_or_agg`` -- so totals are counts of the union, not sums. The blank
member (a NULL key) is bit 0, which no surrogate key uses.

Where the sets are many and thin (those of every venue), they are kept in words of 64 bits
(``word_sets``): these are hashed, not sorted, and unite by ``bit_or``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType


def distinct_sets(df: DataFrame, by: list[str], of: list[str]) -> DataFrame:
    """(by..., of, bucket, bits): the sets of the keys ``of`` per group; a table to store and merge."""
    return _keys(df, by, of).groupBy(*by, "of", F.bitmap_bucket_number("key").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bits"))


def _keys(df: DataFrame, by: list[str], of: list[str]) -> DataFrame:
    """(by..., of, key): a row per key column; the blank member is key 0."""
    keys = F.array(*[F.struct(F.lit(c).alias("of"), F.coalesce(F.col(c).cast("long"), F.lit(0)).alias("key")) for c in of])
    return df.select(*by, F.inline(keys))


def word_sets(df: DataFrame, by: list[str], of: list[str]) -> DataFrame:
    """``distinct_sets`` in words of 64 keys (bucket 0 holds the blank member, as there)."""
    return _keys(df, by, of).groupBy(*by, "of", (F.shiftright(F.col("key") - 1, 6) + 1).alias("bucket")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(pmod(key - 1, 64) as int))")).alias("bits"))


def united_sets(sets: DataFrame, on: str, groups: DataFrame, by: list[str]) -> DataFrame:
    """The word sets of ``on``'s values united into those of ``by``, its columns and those of ``groups``
    (a value may be in several groups, a few rows each: broadcast; one without any is blank). The sets
    are brought together by word before they meet their groups, so no copy of them is shuffled."""
    return sets.repartition("of", "bucket").join(F.broadcast(groups), on, "left") \
        .groupBy(*by, "of", "bucket").agg(F.bit_or("bits").alias("bits"))


def _united(sets: DataFrame) -> tuple[Column, Column]:
    """(the union of a group's bits, the number of keys in it) for bitmaps or words."""
    if sets.schema["bits"].dataType == LongType():
        return F.bit_or("bits"), F.bit_count("bits").cast("long")
    return F.bitmap_or_agg("bits"), F.bitmap_count("bits")


def set_counts(sets: DataFrame, by: list[str], names: dict[str, str], blank: bool = True) -> DataFrame:
    """AGG5 per group: of each key column its number of distinct keys (with ``blank``, a NULL is one
    more), as ``names`` calls it. ``by`` may be fewer columns than the sets have: they are merged."""
    if not blank:
        sets = sets.where("bucket > 0")
    union, count = _united(sets)
    whole = sets.groupBy(*by, "of", "bucket").agg(union.alias("bits"))
    return whole.groupBy(*by).agg(*[F.sum(F.when(F.col("of") == c, count)).alias(n)
                                    for c, n in names.items()])


def matrix_totals(sets: DataFrame, row: str, col: str, name: str, blank: bool = True) -> DataFrame:
    """AGG14 with totals: (row, col, row_total, col_total, name): the cells, the row and column totals
    and the grand total (flag 1 where the dimension is summed up), each a count of distinct keys.
    ``sets`` holds one key column."""
    if not blank:
        sets = sets.where("bucket > 0")
    # the grouping sets repeat bitmaps, not rows
    whole = sets.groupingSets([[row, col, "bucket"], [row, "bucket"], [col, "bucket"], ["bucket"]], row, col, "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.grouping(col).cast("int").alias("row_total"),
        F.grouping(row).cast("int").alias("col_total"))
    return whole.groupBy(row, col, "row_total", "col_total").agg(F.sum(F.bitmap_count("bits")).alias(name))
