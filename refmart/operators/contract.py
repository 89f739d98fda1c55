"""Schema contract operators (inventory PRJ1, PRJ4, PRJ5, PRJ6, PRJ23).

These run at *plan time*: the frame's schema is known before any data moves,
so missing or unknown columns fail before a job starts. The data side is a
single projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DecimalType, StringType, StructType, TimestampNTZType,
                               TimestampType)

from ..functions.clean import blank_to_null, parse_date, parse_decimal


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


class ContractError(ValueError):
    pass


def project_mapping(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """PRJ1: rename + prune by an ordered (source, target) mapping; fail fast when
    a mapped source column is missing. Dotted source names are fine."""
    have = set(df.columns)
    missing = [s for s, _ in pairs if s not in have]
    if missing:
        raise ContractError(f"mapped source columns missing: {missing}")
    return df.select(*[_q(s).alias(t) for s, t in pairs])


def enforce_contract(df: DataFrame, target: StructType) -> DataFrame:
    """PRJ4: header contract against ``target``. Names match case-insensitively;
    a column unknown to the target fails; a missing NOT NULL column fails; a
    missing nullable column is added as NULL; output is in target order."""
    by_lower = {c.lower(): c for c in df.columns}
    known = {f.name.lower() for f in target.fields}
    unknown = [c for c in df.columns if c.lower() not in known]
    if unknown:
        raise ContractError(f"columns not in target: {unknown}")
    missing_required = [f.name for f in target.fields if f.name.lower() not in by_lower and not f.nullable]
    if missing_required:
        raise ContractError(f"required target columns missing: {missing_required}")
    out = []
    for f in target.fields:
        src = by_lower.get(f.name.lower())
        out.append(_q(src).alias(f.name) if src else F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)


def cast_to(df: DataFrame, target: StructType) -> DataFrame:
    """PRJ5: catalog-driven safe cast. Timestamps -> second precision or NULL,
    decimals -> decimal(p,s) or NULL, dates -> date or NULL, text cut to the
    width stored in the field metadata (``{"width": n}``); other types try_cast."""
    cols = []
    for f in target.fields:
        c = _q(f.name)
        t = f.dataType
        if isinstance(t, (TimestampType, TimestampNTZType)):
            v = F.date_trunc("second", F.try_to_timestamp(blank_to_null(c.cast("string")))).cast(t)
        elif isinstance(t, DecimalType):
            v = parse_decimal(blank_to_null(c.cast("string")), t.precision, t.scale)
        elif isinstance(t, DateType):
            v = parse_date(blank_to_null(c.cast("string")))
        elif isinstance(t, StringType):
            width = (f.metadata or {}).get("width")
            v = F.substring(c.cast("string"), 1, int(width)) if width else c.cast("string")
        else:
            v = c.try_cast(t)
        cols.append(v.alias(f.name))
    return df.select(*cols)


def with_lineage(df: DataFrame, script: str, launch_ts: Column, file_col: Column | None = None,
                 file_ts: Column | None = None, url: Column | None = None) -> DataFrame:
    """PRJ6: lineage columns -- script name, launch time, source file, file
    timestamp (else launch time) and url. ``file_col`` defaults to the scan's
    ``_metadata.file_name`` when the frame comes straight from a file source."""
    return df.withColumns({
        "ScriptName": F.lit(script),
        "LaunchTimestamp": launch_ts,
        "SourceFileName": file_col if file_col is not None else F.lit(None).cast("string"),
        "FileTimestamp": F.coalesce(file_ts, launch_ts) if file_ts is not None else launch_ts,
        "SourceUrl": url if url is not None else F.lit(None).cast("string"),
    })


def to_layout(df: DataFrame, columns: list[str], required: dict[str, Column] | None = None) -> DataFrame:
    """PRJ23: project any layout onto ``columns``; absent columns become NULL;
    ``required`` expressions always fill their column."""
    required = required or {}
    have = set(df.columns)
    out = []
    for c in columns:
        if c in required:
            out.append(required[c].alias(c))
        elif c in have:
            out.append(_q(c).cast("string").alias(c))
        else:
            out.append(F.lit(None).cast("string").alias(c))
    return df.select(*out)
