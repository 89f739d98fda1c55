"""Dimension loads (inventory C3-C7, C13, JOI8, JOI9).

Parquet has no MERGE, so every load is a *rewrite*: the operator takes the
current dimension and the source as DataFrames and returns the new dimension.
The caller writes it to a new version path (or checkpoints it) and swaps.

Scale notes
* Each merge is one join on the business key (AQE broadcasts the side that is
  small at run time, otherwise sort-merge with skew splitting).
* Surrogate keys are dense and ordered by the business key without a global
  window: range-partition, number rows inside each partition, and add the
  running total of the partition sizes (a frame with one row per partition).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import changed


# --------------------------------------------------------------------- C13
def assign_keys(df: DataFrame, order_cols: list[str], sk: str, start: Column | int = 0) -> DataFrame:
    """C13: dense ascending integer keys ``start+1, start+2, ...`` in ``order_cols``
    order (``order_cols`` must be unique per row for a stable result).

    ``start`` may be a scalar subquery such as ``max(sk)`` of the existing table.

    The rows are range-partitioned by the key, numbered inside each partition and written
    once (a lineage cut) with the partition's number, so everything after reads the same
    stored rows -- a re-evaluation or a lost executor cannot change them. The running total
    of the partition sizes (one row per partition, broadcast) makes the keys global.
    No task ever holds more than one range. Writing happens when this is called.
    """
    from ..session import cut_lineage
    start_col = F.coalesce(start if isinstance(start, Column) else F.lit(start), F.lit(0)).cast("long")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    mid = F.monotonically_increasing_id()
    tagged = cut_lineage(ordered.withColumn("__mid", mid)
                         .withColumn("__pid", F.shiftright(F.col("__mid"), 33))
                         .withColumn("__local", F.col("__mid") - F.shiftleft(F.col("__pid"), 33) + 1)
                         .drop("__mid"), "keys")
    sizes = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: this window is over a few thousand rows at most.
    offsets = sizes.withColumn(
        "__off", F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                            F.lit(0))).select("__pid", "__off")
    out = tagged.join(F.broadcast(offsets), "__pid") \
        .withColumn(sk, start_col + F.col("__off") + F.col("__local"))
    return out.drop("__pid", "__local", "__off")


def _max_key(dim: DataFrame, sk: str) -> Column:
    return dim.select(F.coalesce(F.max(sk), F.lit(0)).cast("long")).scalar()


# --------------------------------------------------------------------- C6 / JOI8
def merge_new_keys(dim: DataFrame, src: DataFrame, key: str, sk: str, src_key: str | None = None) -> DataFrame:
    """C6 / JOI8: insert-only dimension. Distinct non-NULL source keys that the
    dimension lacks get new surrogate keys above the current maximum; existing
    rows are untouched. Returns the whole dimension (``key``, ``sk``, ...)."""
    src_key = src_key or key
    new = src.select(F.col(src_key).alias(key)).filter(F.col(key).isNotNull()).distinct() \
        .join(dim.select(key), key, "left_anti")
    new = assign_keys(new, [key], sk, _max_key(dim, sk))
    return dim.unionByName(new, allowMissingColumns=True)


# --------------------------------------------------------------------- C7 / JOI9
def upsert_dim(dim: DataFrame, src: DataFrame, key: str, sk: str, tracked: dict[str, str],
               status: str | None = "load_action") -> DataFrame:
    """C7 / JOI9: MERGE with a change predicate. New keys are inserted (new
    surrogate keys), matched keys whose tracked columns differ (FLT7 sentinels)
    take the source values -- NULLs included -- and the rest stay as they are.

    ``src`` must hold one row per key. One full outer join on the key.
    """
    cols = list(tracked)
    d = dim.select(key, sk, *cols).alias("d")
    s = src.select(key, *cols).withColumn("__s", F.lit(True)).alias("s")
    j = d.join(s, F.col(f"d.{key}") == F.col(f"s.{key}"), "full")
    in_d, in_s = F.col(f"d.{sk}").isNotNull(), F.coalesce(F.col("s.__s"), F.lit(False))
    diff = changed("d.", "s.", tracked)
    action = F.when(in_d & in_s & diff, F.lit("update")).when(in_d, F.lit("keep")).otherwise(F.lit("insert"))
    take_src = action.isin("update", "insert")
    merged = j.select(
        F.coalesce(F.col(f"d.{key}"), F.col(f"s.{key}")).alias(key),
        F.col(f"d.{sk}").alias(sk),
        *[F.when(take_src, F.col(f"s.{c}")).otherwise(F.col(f"d.{c}")).alias(c) for c in cols],
        action.alias("__action"),
    )
    # Written once: the kept rows and the rows needing keys both come from it,
    # so the full join is not evaluated twice.
    from ..session import cut_lineage
    merged = cut_lineage(merged, "upsert")
    old = merged.filter(F.col(sk).isNotNull())
    new = assign_keys(merged.filter(F.col(sk).isNull()).drop(sk), [key], sk, _max_key(dim, sk))
    out = old.unionByName(new)
    return out.withColumnRenamed("__action", status) if status else out.drop("__action")


# --------------------------------------------------------------------- C3
def scd2_by_current(dim: DataFrame, src: DataFrame, keys: list[str], tracked: dict[str, str], sk: str,
                    vf: str = "ValidFromDate", vt: str = "ValidToDate", cur: str = "IsCurrent",
                    top: int | None = None) -> DataFrame:
    """C3: type-2 load "close, then insert if no current row".

    * a current row whose tracked columns differ from the source is closed at
      ``source.ValidFrom - 1 day`` (``IsCurrent = false``);
    * every source row whose key has no current row *after* closing is inserted,
      ``IsCurrent = (ValidTo IS NULL)``.

    ``src`` holds one row per key. Historic (non-current) rows pass through
    without joining; the current rows and the source meet in one full join. A ``dim``
    of the current rows alone gives what becomes of them (``sources.history``); ``top``
    is then the largest key given so far.
    """
    cols = list(tracked)
    hist = dim.filter(~F.coalesce(F.col(cur), F.lit(False)))    # a NULL flag is not current
    d = dim.filter(F.col(cur)).alias("d")
    s = src.select(*keys, *cols, vf, vt).withColumn("__s", F.lit(True)).alias("s")
    cond = reduce(lambda a, b: a & b, [F.col(f"d.{k}") == F.col(f"s.{k}") for k in keys])
    j = d.join(s, cond, "full")
    in_d, in_s = F.col(f"d.{sk}").isNotNull(), F.coalesce(F.col("s.__s"), F.lit(False))
    close = in_d & in_s & changed("d.", "s.", tracked)
    key_cols = [F.coalesce(F.col(f"d.{k}"), F.col(f"s.{k}")).alias(k) for k in keys]
    dim_row = F.when(in_d, F.struct(
        F.col(f"d.{sk}").alias(sk), *[F.col(f"d.{c}").alias(c) for c in cols], F.col(f"d.{vf}").alias(vf),
        F.when(close, F.date_sub(F.col(f"s.{vf}"), 1)).otherwise(F.col(f"d.{vt}")).alias(vt),
        F.when(close, F.lit(False)).otherwise(F.col(f"d.{cur}")).alias(cur)))
    src_row = F.when(in_s & (~in_d | close), F.struct(
        F.lit(None).cast("long").alias(sk), *[F.col(f"s.{c}").alias(c) for c in cols], F.col(f"s.{vf}").alias(vf),
        F.col(f"s.{vt}").alias(vt), F.col(f"s.{vt}").isNull().alias(cur)))
    rows = j.select(*key_cols, F.inline(F.filter(F.array(dim_row, src_row), lambda x: x.isNotNull())))
    # Written once: kept rows and rows needing keys both come from it, so the
    # full join of the dimension with the source is not evaluated twice.
    from ..session import cut_lineage
    rows = cut_lineage(rows, "scd2")
    kept = rows.filter(F.col(sk).isNotNull())
    new = assign_keys(rows.filter(F.col(sk).isNull()).drop(sk), keys + [vf], sk,
                      _max_key(dim, sk) if top is None else F.lit(top))
    return hist.select(*kept.columns).unionByName(kept).unionByName(new.select(*kept.columns))


# --------------------------------------------------------------------- C4
def scd2_by_version(dim: DataFrame, src: DataFrame, keys: list[str], tracked: dict[str, str], sk: str,
                    vf: str = "ValidFromDate", vt: str = "ValidToDate", cur: str = "IsCurrent") -> DataFrame:
    """C4: type-2 load "close, then insert if the version is absent".

    ``src`` holds one row per (key, ValidFrom). A current row is closed at
    ``v - 1 day`` where ``v`` is the earliest source version whose tracked
    columns differ from it (the reference picks an arbitrary one). Source rows
    whose (key, ValidFrom) is not in the dimension are inserted,
    ``IsCurrent = (ValidTo IS NULL)`` -- so a key may end up with no current
    row or with several (Q-8, kept).

    No pairs are formed inside a key: the source is reduced to its two
    earliest *distinct* attribute tuples per key (partial WindowGroupLimit),
    which is all the close rule needs.
    """
    from ..functions.predicates import _sentinel_for
    cols = list(tracked)
    tup = F.struct(*[F.coalesce(F.col(c), _sentinel_for(t)).alias(c) for c, t in tracked.items()])
    per_tuple = src.groupBy(*keys, tup.alias("__t")).agg(F.min(vf).alias("__v"))
    w = Window.partitionBy(*keys).orderBy(F.col("__v").asc(), F.col("__t").asc())
    two = per_tuple.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= 2)
    summary = two.groupBy(*keys).agg(
        F.min_by(F.struct("__t", "__v"), F.col("__r")).alias("__first"),
        F.max_by(F.when(F.col("__r") == 2, F.struct("__t", "__v")), F.col("__r")).alias("__second"))
    d_tup = F.struct(*[F.coalesce(F.col(c), _sentinel_for(t)).alias(c) for c, t in tracked.items()])
    current = dim.filter(F.col(cur)).join(summary, keys, "left")
    first_t, first_v = F.col("__first.__t"), F.col("__first.__v")
    second_v = F.col("__second.__v")
    close_at = F.when(F.col("__first").isNull(), F.lit(None)) \
        .when(first_t != d_tup, F.date_sub(first_v, 1)) \
        .when(F.col("__second").isNotNull(), F.date_sub(second_v, 1))
    closed = current.withColumn("__close", close_at) \
        .withColumn(vt, F.coalesce(F.col("__close"), F.col(vt))) \
        .withColumn(cur, F.when(F.col("__close").isNotNull(), F.lit(False)).otherwise(F.col(cur))) \
        .select(*dim.columns)
    out = dim.filter(~F.coalesce(F.col(cur), F.lit(False))).unionByName(closed)
    ins = src.select(*keys, *cols, vf, vt).join(dim.select(*keys, vf), keys + [vf], "left_anti") \
        .withColumn(cur, F.col(vt).isNull())
    ins = assign_keys(ins, keys + [vf], sk, _max_key(dim, sk))
    # columns that other steps keep in the dimension (C5) start empty
    ins = ins.withColumns({f.name: F.lit(None).cast(f.dataType) for f in dim.schema if f.name not in ins.columns})
    return out.unionByName(ins.select(*dim.columns))


# --------------------------------------------------------------------- C5
def enrich(dim: DataFrame, upd: DataFrame, keys: list[str], fields: dict[str, str],
           flag: str | None = None) -> DataFrame:
    """C5: update ``fields`` of matching rows (on ``keys``) from ``upd`` when any of
    them changed (FLT7 sentinels); source NULLs overwrite. No versioning."""
    from .joins import update_from
    cond = changed("t.", "s.", fields)
    return update_from(dim, upd, keys, {c: c for c in fields}, when=cond, flag=flag)


def scd2_anomalies(dim: DataFrame, keys: list[str], cur: str = "IsCurrent") -> DataFrame:
    """Q-8 strict check: keys left with no current row or with several current
    rows (which the compatible C3/C4 loads can produce). Reported, not repaired."""
    n = F.sum(F.when(F.col(cur), 1).otherwise(0))
    return dim.groupBy(*keys).agg(n.alias("current_rows")).filter(F.col("current_rows") != 1)
