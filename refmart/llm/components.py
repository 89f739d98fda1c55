"""Connected components of an edge table by alternating large-star and small-star
steps. Every step is a grouped minimum and a join; no links reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    # the rows of a hub join one row; AQE splits them when they are many
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where(
        "a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b): links between comparable values. Returns (a, b) with b the
    smallest value of a's component, for every linked value but the smallest.
    Each step's edges are written to the shared folder, which cuts the lineage."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "edges")
    state = _state(now)
    while True:
        now = written(_small_star(_large_star(now)), "edges")
        new = _state(now)
        if new == state:
            return now
        state = new
