"""Type-2 dimensions whose history is left alone (inventory C3).

The current rows are one part of the table and are the only ones that a load reads and
writes; rows that it closes (or that arrive closed) leave for a history part of their
own, which is written once and never read by a load again. The manifest keeps the
largest surrogate key, so new keys need no look at the history either. Readers of the
whole dimension read all parts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .releases import Table, read_parts

CURRENT_PART = "current"
_PART = "dim_part"


def load_current(spark: SparkSession, base: str, folder: str, table: Table | None, empty: DataFrame, sk: str,
                 load: Callable[[DataFrame, int], DataFrame], cur: str = "IsCurrent") -> Table:
    """One load. ``load(current rows, largest key)`` gives what becomes of them and the new rows; ``folder``
    (new for each load) takes both kinds in one write. The table as it is then, to be named in a release:
    until that is published, readers see the old one. Without a ``table`` the load starts from ``empty``,
    which may hold rows of both kinds (a dimension that was stored whole)."""
    if table is None:
        first = empty.agg(F.max(sk)).first()[0] or 0
        rows = empty.filter(~F.coalesce(F.col(cur), F.lit(False)))
        out = load(empty.filter(F.col(cur)), first)
        out = rows.select(*out.columns).unionByName(out)
        parts, top, stem = {}, first, "history-0"
    else:
        parts = {name: path for name, path in table.parts.items() if name != CURRENT_PART}
        top, stem = table.top or 0, f"history-{len(parts)}"
        out = load(read_parts(spark, base, table, [CURRENT_PART]), top)
    marked = out.withColumn(_PART, F.when(F.col(cur), F.lit(CURRENT_PART)).otherwise(F.lit("history")))
    path = f"{base}/{folder}"
    marked.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(_PART).parquet(path)
    stored = spark.read.schema(StructType([*out.schema.fields]).add(_PART, "string")).parquet(path)
    for r in stored.groupBy(_PART).agg(F.max(sk).alias("top")).collect():       # two rows
        parts[CURRENT_PART if r[0] == CURRENT_PART else stem] = f"{folder}/{_PART}={r[0]}"
        top = max(top, r.top or 0)
    return Table(out.schema, parts, top=top)
