"""Snapshot fact, latest snapshot, calendar (inventory C10-C12, JOI2, WIN6).

``build_snapshot`` joins the current listing rows to the sub-type tables and
the six dimensions and keeps one row per (ISIN, venue). Instead of joining
everything and ranking the (possibly multiplied) result, every input is first
cut to one row per join key with the same deterministic order, so no join can
fan out inside a hot key.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import dedup_latest

KEYS = ["ISIN", "TradingVenueMIC"]

# Month and weekday names of the report culture (fr-FR).
MONTH_NAMES = ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre",
               "octobre", "novembre", "décembre"]
WEEKDAY_NAMES = ["lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi", "dimanche"]

FACT_COLUMNS = ["SnapshotDate", "ISIN", "TradingVenueMIC", "CurrencySK", "CFISK", "IssuerSK", "TradingVenueSK",
                "InstrumentSK", "InstrumentListingSK", "TotalIssuedNominalAmount", "NominalValuePerUnit",
                "FixedRate", "PriceMultiplier"]


def _current(df: DataFrame, flag: str) -> DataFrame:
    return df.filter(F.col(flag) == F.lit(True))


def build_snapshot(listing: DataFrame, debt: DataFrame, derivative: DataFrame, *, currency: DataFrame,
                   cfi: DataFrame, issuer: DataFrame, venue: DataFrame, instrument: DataFrame,
                   listing_dim: DataFrame, snapshot_date: Column | str | _dt.date) -> DataFrame:
    """C10: the daily snapshot fact for ``snapshot_date`` (a date, 'YYYY-MM-DD' or
    a Column; the caller passes "today" explicitly -- Q-10).

    Dimensions: currency(CurrencyCode, CurrencySK), cfi(CFI, CFISK),
    issuer(IssuerLEI, IssuerSK), venue(TradingVenueMIC, TradingVenueSK),
    instrument SCD2 (ISIN, InstrumentSK, IsCurrent) and listing SCD2
    (ISIN, TradingVenueMIC, InstrumentListingSK, IsCurrent).

    One row per (ISIN, venue). Where the reference picks arbitrarily among
    several candidates, the order is: highest instrument key, highest listing
    key, then lowest issuer / currency / classification key, then largest
    amounts -- NULLs last throughout.
    """
    if isinstance(snapshot_date, (str, _dt.date)):
        snap = F.lit(str(snapshot_date)).cast("date")
    else:
        snap = snapshot_date
    l = _current(listing, "LatestRecordFlag").filter(F.col("ISIN").isNotNull() & F.col("TradingVenueMIC").isNotNull())
    l = l.select(*KEYS, "NotionalCurrency", "CFI", "IssuerLEI") \
        .join(currency.select(F.col("CurrencyCode").alias("NotionalCurrency"), "CurrencySK"), "NotionalCurrency", "left") \
        .join(cfi.select("CFI", "CFISK"), "CFI", "left") \
        .join(issuer.select("IssuerLEI", "IssuerSK"), "IssuerLEI", "left")
    l = dedup_latest(l, KEYS, [F.col("IssuerSK").asc_nulls_last(), F.col("CurrencySK").asc_nulls_last(),
                               F.col("CFISK").asc_nulls_last()])
    d = dedup_latest(_current(debt, "LatestRecordFlag").select(*KEYS, "TotalIssuedNominalAmount",
                                                              "NominalValuePerUnit", "FixedRate"),
                     KEYS, [F.col("TotalIssuedNominalAmount").desc_nulls_last(),
                            F.col("NominalValuePerUnit").desc_nulls_last(), F.col("FixedRate").desc_nulls_last()])
    drv = _current(derivative, "LatestRecordFlag").groupBy(*KEYS).agg(F.max("PriceMultiplier").alias("PriceMultiplier"))
    di = instrument.filter(F.col("IsCurrent")).groupBy("ISIN").agg(F.max("InstrumentSK").alias("InstrumentSK"))
    dl = listing_dim.filter(F.col("IsCurrent")).groupBy(*KEYS) \
        .agg(F.max("InstrumentListingSK").alias("InstrumentListingSK"))
    # the joins on both keys follow each other: they share one shuffle of the listing
    fact = l.join(d, KEYS, "left").join(drv, KEYS, "left").join(dl, KEYS, "left") \
        .join(venue.select("TradingVenueMIC", "TradingVenueSK"), "TradingVenueMIC", "left") \
        .join(di, "ISIN", "left")
    return fact.select(
        snap.alias("SnapshotDate"), *KEYS, "CurrencySK", "CFISK", "IssuerSK", "TradingVenueSK", "InstrumentSK",
        "InstrumentListingSK",
        *[F.col(c).cast("decimal(38,10)").alias(c) for c in ["TotalIssuedNominalAmount", "NominalValuePerUnit",
                                                             "FixedRate", "PriceMultiplier"]],
    )


def latest_snapshot(fact: DataFrame) -> DataFrame:
    """C11 / SNK4: the rows of the most recent snapshot date (7 key columns);
    empty when the fact is empty. With the fact partitioned by SnapshotDate the
    scalar max becomes a partition-pruning filter."""
    mx = fact.select(F.max("SnapshotDate")).scalar()
    return fact.filter(F.col("SnapshotDate") == mx).select(
        "SnapshotDate", "CurrencySK", "CFISK", "IssuerSK", "TradingVenueSK", "InstrumentSK", "InstrumentListingSK")


def calendar(df: DataFrame, col: str) -> DataFrame:
    """C12: one row per day between the min and max non-NULL ``col`` (a date or
    timestamp; truncated to the day -- Q-13) with Year, Month, MonthName,
    Quarter ('Q1'..), YearMonth, Day, Weekday (Monday=1), WeekdayName.

    Days are generated per year (one task per year), not in one task."""
    d = F.to_date(F.col(col))
    bounds = df.select(F.min(d).alias("lo"), F.max(d).alias("hi")).filter(F.col("lo").isNotNull())
    years = bounds.select("lo", "hi", F.explode(F.sequence(F.year("lo"), F.year("hi"))).alias("y")) \
        .repartition("y")
    start = F.greatest(F.col("lo"), F.make_date(F.col("y"), F.lit(1), F.lit(1)))
    end = F.least(F.col("hi"), F.make_date(F.col("y"), F.lit(12), F.lit(31)))
    days = years.select(F.explode(F.sequence(start, end)).alias("Date"))
    month_names = F.array(*[F.lit(m) for m in MONTH_NAMES])
    day_names = F.array(*[F.lit(w) for w in WEEKDAY_NAMES])
    wd = F.weekday("Date") + 1
    return days.select(
        "Date", F.year("Date").alias("Year"), F.month("Date").alias("Month"),
        F.element_at(month_names, F.month("Date")).alias("MonthName"),
        F.concat(F.lit("Q"), F.quarter("Date").cast("string")).alias("Quarter"),
        F.date_format("Date", "yyyy-MM").alias("YearMonth"), F.dayofmonth("Date").alias("Day"),
        wd.alias("Weekday"), F.element_at(day_names, wd).alias("WeekdayName"),
    )
