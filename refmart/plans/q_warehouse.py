"""Registered queries for the warehouse operators (C1-C13, WIN1-WIN6, JOI1-JOI9)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.cdc import KEYS, apply_delta, prepare_delta
from ..operators.classify import classify, name_hints
from ..operators.dims import assign_keys, merge_new_keys, scd2_by_current, scd2_by_version, upsert_dim
from ..operators.facts import calendar, latest_snapshot
from ..operators.joins import left_join_latest
from ..operators.windows import dedup_latest
from ..session import cut_lineage
from . import fixtures as fx
from . import warehouse as wh
from .catalog import ORACLE, register
from .fixtures import sql_with


def _dbl(c: str):
    return F.col(c).cast("double").alias(c)


# ----------------------------------------------------------------- C2 / WIN1
LISTING_OUT = ["ISIN", "TradingVenueMIC", "IssuerLEI", "ValidFromDate", "ValidFromDate_PK", "CFI", "NotionalCurrency",
               "CommodityDerivativeInd", "IssuerReqAdmission", "AdmissionApprvlDate", "ReqForAdmissionDate",
               "FirstTradingDate", "TerminationDate", "CmdtyBaseProduct", "SourceFileName", "TechRcrdId"]


@register("c2_split_listing", sql_with(["typed"], f"SELECT {', '.join(LISTING_OUT)} FROM typed"))
def c2_split_listing(spark, d):
    """C2 + WIN1 + PRJ2/3/12/14/16/17: typed listing table (current rows, one per
    ISIN/issuer/venue, latest ValidFrom)."""
    return wh.staging(spark, d)["listing"].select(*LISTING_OUT)


@register("c2_split_debt", sql_with(["debt"], """SELECT ISIN, TradingVenueMIC, ValidFromDate,
  CAST(TotalIssuedNominalAmount AS DOUBLE) AS TotalIssuedNominalAmount, TotalIssuedNominalAmountCcy,
  CAST(NominalValuePerUnit AS DOUBLE) AS NominalValuePerUnit, CAST(FixedRate AS DOUBLE) AS FixedRate,
  DebtSeniority, MaturityDate FROM debt"""))
def c2_split_debt(spark, d):
    """C2 + PRJ13: debt sub-type (classification starting with D), amounts parsed."""
    t = wh.staging(spark, d)["debt"]
    return t.select("ISIN", "TradingVenueMIC", "ValidFromDate", _dbl("TotalIssuedNominalAmount"),
                    "TotalIssuedNominalAmountCcy", _dbl("NominalValuePerUnit"), _dbl("FixedRate"),
                    "DebtSeniority", "MaturityDate")


@register("c2_split_derivative", sql_with(["deriv"], """SELECT ISIN, TradingVenueMIC, ValidFromDate,
  CAST(PriceMultiplier AS DOUBLE) AS PriceMultiplier, OptionType, DeliveryType,
  CAST(StrikePrice AS DOUBLE) AS StrikePrice, ExpiryDate, CmdtyBaseProduct FROM deriv"""))
def c2_split_derivative(spark, d):
    """C2 + FLT3: derivative sub-type (F/O/S, commodity flag or base product)."""
    t = wh.staging(spark, d)["derivative"]
    return t.select("ISIN", "TradingVenueMIC", "ValidFromDate", _dbl("PriceMultiplier"), "OptionType",
                    "DeliveryType", _dbl("StrikePrice"), "ExpiryDate", "CmdtyBaseProduct")


# ----------------------------------------------------------------- C10 / C11
FACT_OUT = ["SnapshotDate", "ISIN", "TradingVenueMIC", "CurrencySK", "CFISK", "IssuerSK", "TradingVenueSK",
            "InstrumentSK", "InstrumentListingSK"]
FACT_AMT = ["TotalIssuedNominalAmount", "NominalValuePerUnit", "FixedRate", "PriceMultiplier"]


@register("c10_build_snapshot", sql_with(["fact"], f"""SELECT {', '.join(FACT_OUT)},
  {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in FACT_AMT)} FROM fact"""))
def c10_build_snapshot(spark, d):
    """C10 + JOI2 + WIN6 + C6 + C13: the daily snapshot fact."""
    f = wh.snapshot(spark, d)
    return f.select(*FACT_OUT, *[_dbl(c) for c in FACT_AMT])


@register("c11_latest_snapshot", sql_with(["fact"], """SELECT SnapshotDate, CurrencySK, CFISK, IssuerSK,
  TradingVenueSK, InstrumentSK, InstrumentListingSK FROM fact
  WHERE SnapshotDate = (SELECT max(SnapshotDate) FROM fact)"""))
def c11_latest_snapshot(spark, d):
    """C11 / SNK4: rows of the latest snapshot date."""
    return latest_snapshot(wh.mart(spark, d)["fact"])


# ----------------------------------------------------------------- C1 / WIN2
_SQL_D = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY ISIN, TradingVenueMIC, VF, ActionType
      ORDER BY TRY_CAST(TechRcrdId AS BIGINT) DESC NULLS LAST, TechRcrdId DESC NULLS LAST) rn
  FROM (SELECT *, CASE WHEN regexp_matches(substr(coalesce(ValidFromDate, HeaderReportingPeriodDate), 1, 10),
                   '^\\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\\s*$')
                 THEN TRY_CAST(trim(substr(coalesce(ValidFromDate, HeaderReportingPeriodDate), 1, 10)) AS DATE) END AS VF,
               CASE WHEN regexp_matches(substr(TerminationDate, 1, 10), '^\\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\\s*$')
                 THEN TRY_CAST(trim(substr(TerminationDate, 1, 10)) AS DATE) END AS TERM
        FROM delta WHERE ISIN IS NOT NULL AND TradingVenueMIC IS NOT NULL))
WHERE rn = 1 AND VF IS NOT NULL"""
fx.add_cte("delta_d", ["delta"], _SQL_D)


@register("win2_dedup_delta", sql_with(["delta_d"], """SELECT ISIN, TradingVenueMIC, VF, TERM, ActionType,
  TechRcrdId FROM delta_d"""))
def win2_dedup_delta(spark, d):
    """WIN2 + C1(a,b): delta rows with VF/TERM, one per (ISIN, venue, VF, action)."""
    return prepare_delta(fx.delta(spark, d)).select("ISIN", "TradingVenueMIC", "VF", "TERM", "ActionType",
                                                    "TechRcrdId")


@register("c1_apply_delta", sql_with(["cdc_state", "delta_d"], """
WITH instr AS (
  SELECT ISIN, TradingVenueMIC,
    coalesce(min(CASE WHEN ActionType = 'MOD' THEN VF END) - 1,
             min(CASE WHEN ActionType = 'TERM' THEN coalesce(TERM, VF) END),
             min(CASE WHEN ActionType = 'CANC' THEN VF END)) AS close_to
  FROM delta_d GROUP BY ISIN, TradingVenueMIC),
closed AS (
  SELECT s.ISIN, s.TradingVenueMIC, s.IssuerLEI, s.FullName, s.ValidFromDate,
    CASE WHEN s.ValidToDate IS NULL AND coalesce(s.LatestRecordFlag, FALSE) AND i.close_to IS NOT NULL
         THEN i.close_to ELSE s.ValidToDate END AS ValidToDate,
    CASE WHEN s.ValidToDate IS NULL AND coalesce(s.LatestRecordFlag, FALSE) AND i.close_to IS NOT NULL
         THEN FALSE ELSE s.LatestRecordFlag END AS LatestRecordFlag
  FROM cdc_state s LEFT JOIN instr i ON i.ISIN = s.ISIN AND i.TradingVenueMIC = s.TradingVenueMIC)
SELECT * FROM closed
UNION ALL
SELECT d.ISIN, d.TradingVenueMIC, d.IssuerLEI, d.FullName, d.VF AS ValidFromDate, CAST(NULL AS DATE), TRUE
FROM delta_d d WHERE d.ActionType IN ('NEW', 'MOD')
  AND NOT EXISTS (SELECT 1 FROM cdc_state s WHERE s.ISIN = d.ISIN AND s.TradingVenueMIC = d.TradingVenueMIC
                  AND s.ValidFromDate = d.VF)"""))
def c1_apply_delta(spark, d):
    """C1: the whole customer-based state after applying all event-based deltas."""
    return apply_delta(fx.cdc_state(spark, d), fx.delta(spark, d))


@register("c1_apply_delta_by_week", sql_with(["cdc_state", "delta_d"], """
WITH days AS (SELECT DISTINCT VF, date_diff('week', DATE '2000-01-03', VF) AS n FROM delta_d),
instr AS (
  SELECT ISIN, TradingVenueMIC, n,
    coalesce(min(CASE WHEN ActionType = 'MOD' THEN VF END) - 1,
             min(CASE WHEN ActionType = 'TERM' THEN coalesce(TERM, VF) END),
             min(CASE WHEN ActionType = 'CANC' THEN VF END)) AS close_to
  FROM delta_d JOIN days USING (VF) GROUP BY ISIN, TradingVenueMIC, n),
versions AS (
  SELECT ISIN, TradingVenueMIC, IssuerLEI, FullName, ValidFromDate, ValidToDate, LatestRecordFlag, 0 AS born FROM cdc_state
  UNION ALL
  SELECT d.ISIN, d.TradingVenueMIC, d.IssuerLEI, d.FullName, d.VF, CAST(NULL AS DATE), TRUE, n
  FROM delta_d d JOIN days USING (VF) WHERE d.ActionType IN ('NEW', 'MOD')
    AND NOT EXISTS (SELECT 1 FROM cdc_state s WHERE s.ISIN = d.ISIN AND s.TradingVenueMIC = d.TradingVenueMIC
                    AND s.ValidFromDate = d.VF)),
closed AS (
  SELECT r.*, (SELECT min_by(i.close_to, i.n) FROM instr i WHERE i.ISIN = r.ISIN AND i.TradingVenueMIC = r.TradingVenueMIC
               AND i.n > r.born AND i.close_to IS NOT NULL) AS close_to FROM versions r)
SELECT ISIN, TradingVenueMIC, IssuerLEI, FullName, ValidFromDate,
  CASE WHEN ValidToDate IS NULL AND coalesce(LatestRecordFlag, FALSE) AND close_to IS NOT NULL THEN close_to
       ELSE ValidToDate END AS ValidToDate,
  CASE WHEN ValidToDate IS NULL AND coalesce(LatestRecordFlag, FALSE) AND close_to IS NOT NULL THEN FALSE
       ELSE LatestRecordFlag END AS LatestRecordFlag
FROM closed"""))
def c1_apply_delta_by_week(spark, d):
    """C1: the deltas applied week after week to a state in buckets by key; each load reads and writes only the
    buckets its keys fall in. The weeks are those of the events' month, at any scale."""
    from ..session import ensure_checkpoint_dir
    from ..sources.releases import read_state, update_state, write_state
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/state-{uuid.uuid4().hex}"
    write_state(fx.cdc_state(spark, d), base, "v0", KEYS, 16)
    week = F.date_trunc("week", F.to_date("HeaderReportingPeriodDate"))
    delta = fx.delta(spark, d).withColumn("week", week)
    for n, r in enumerate(delta.select("week").distinct().orderBy("week").collect(), 1):
        update_state(spark, base, f"v{n}", delta.filter(F.col("week") == r.week).drop("week"), apply_delta)
    return read_state(spark, base)


# ----------------------------------------------------------------- helpers for SQL change tests
def _sql_changed(a: str, b: str, tracked: dict[str, str]) -> str:
    terms = []
    for c, t in tracked.items():
        s = "DATE '1900-01-01'" if t in ("date", "timestamp") else ("''" if t == "string" else "0")
        if t == "timestamp":
            terms.append(f"coalesce({a}.{c}, TIMESTAMP '1900-01-01') <> coalesce({b}.{c}, TIMESTAMP '1900-01-01')")
        else:
            terms.append(f"coalesce({a}.{c}, {s}) <> coalesce({b}.{c}, {s})")
    return "(" + " OR ".join(terms) + ")"


# ----------------------------------------------------------------- C3
_LT = fx.LISTING_TRACKED
_LCOLS = list(_LT)


@register("c3_scd2_by_current", sql_with(["lst_dim", "lst_new"], f"""
WITH j AS (
  SELECT d.InstrumentListingSK AS sk, d.ISIN AS d_isin, d.TradingVenueMIC AS d_mic,
    {', '.join(f'd.{c} AS d_{c}' for c in _LCOLS)}, d.ValidFromDate AS d_vf, d.ValidToDate AS d_vt, d.IsCurrent AS d_cur,
    s.ISIN AS s_isin, s.TradingVenueMIC AS s_mic,
    {', '.join(f's.{c} AS s_{c}' for c in _LCOLS)}, s.ValidFromDate AS s_vf, s.ValidToDate AS s_vt,
    (d.ISIN IS NOT NULL AND s.ISIN IS NOT NULL AND {_sql_changed('d', 's', _LT)}) AS chg
  FROM (SELECT * FROM lst_dim WHERE IsCurrent) d
  FULL JOIN lst_new s ON d.ISIN = s.ISIN AND d.TradingVenueMIC = s.TradingVenueMIC)
SELECT ISIN, TradingVenueMIC, {', '.join(_LCOLS)}, ValidFromDate, ValidToDate, IsCurrent, InstrumentListingSK
FROM lst_dim WHERE NOT IsCurrent
UNION ALL
SELECT d_isin, d_mic, {', '.join(f'd_{c}' for c in _LCOLS)}, d_vf,
  CASE WHEN chg THEN s_vf - 1 ELSE d_vt END, CASE WHEN chg THEN FALSE ELSE d_cur END, sk
FROM j WHERE sk IS NOT NULL
UNION ALL
SELECT s_isin, s_mic, {', '.join(f's_{c}' for c in _LCOLS)}, s_vf, s_vt, s_vt IS NULL,
  (SELECT coalesce(max(InstrumentListingSK), 0) FROM lst_dim) + row_number() OVER (ORDER BY s_isin, s_mic, s_vf)
FROM j WHERE s_isin IS NOT NULL AND (sk IS NULL OR chg)"""))
def c3_scd2_by_current(spark, d):
    """C3 + FLT7 + C13: listing type-2 load (close changed current rows, insert
    where no current row remains)."""
    dim, new = fx.listing_pair(spark, d)
    out = scd2_by_current(dim, new, ["ISIN", "TradingVenueMIC"], _LT, "InstrumentListingSK")
    return out.select("ISIN", "TradingVenueMIC", *_LCOLS, "ValidFromDate", "ValidToDate", "IsCurrent",
                      "InstrumentListingSK")


def c3_scd2_history(spark, d):
    """C3 with the history left alone: the dimension as a current part and history parts, the load over the
    current part only, all parts read back."""
    from ..session import ensure_checkpoint_dir
    from ..sources.history import load_current
    from ..sources.releases import read_parts
    dim, new = fx.listing_pair(spark, d)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/listing-{uuid.uuid4().hex}"
    keep = load_current(spark, base, "v0", None, dim, "InstrumentListingSK", lambda rows, top: rows)
    table = load_current(spark, base, "v1", keep, dim, "InstrumentListingSK", lambda rows, top: scd2_by_current(
        rows, new, ["ISIN", "TradingVenueMIC"], _LT, "InstrumentListingSK", top=top))
    return read_parts(spark, base, table).select("ISIN", "TradingVenueMIC", *_LCOLS, "ValidFromDate", "ValidToDate",
                                                 "IsCurrent", "InstrumentListingSK")


register("c3_scd2_history", ORACLE["c3_scd2_by_current"])(c3_scd2_history)


# ----------------------------------------------------------------- C4 / JOI5
_IT = fx.INSTRUMENT_TRACKED
_ICOLS = list(_IT)


@register("c4_scd2_by_version", sql_with(["ins_dim", "ins_new"], f"""
WITH chg AS (
  SELECT d.InstrumentSK, min(s.ValidFromDate) AS v
  FROM ins_dim d JOIN ins_new s ON s.ISIN = d.ISIN
  WHERE d.IsCurrent AND {_sql_changed('d', 's', _IT)}
  GROUP BY d.InstrumentSK)
SELECT d.ISIN, {', '.join(f'd.{c}' for c in _ICOLS)}, d.ValidFromDate,
  CASE WHEN c.v IS NOT NULL THEN c.v - 1 ELSE d.ValidToDate END AS ValidToDate,
  CASE WHEN c.v IS NOT NULL THEN FALSE ELSE d.IsCurrent END AS IsCurrent, d.InstrumentSK
FROM ins_dim d LEFT JOIN chg c ON c.InstrumentSK = d.InstrumentSK
UNION ALL
SELECT s.ISIN, {', '.join(f's.{c}' for c in _ICOLS)}, s.ValidFromDate, s.ValidToDate, s.ValidToDate IS NULL,
  (SELECT coalesce(max(InstrumentSK), 0) FROM ins_dim) + row_number() OVER (ORDER BY s.ISIN, s.ValidFromDate)
FROM ins_new s
WHERE NOT EXISTS (SELECT 1 FROM ins_dim d WHERE d.ISIN = s.ISIN AND d.ValidFromDate = s.ValidFromDate)"""))
def c4_scd2_by_version(spark, d):
    """C4 + FLT7 + JOI5 + C13: instrument type-2 load (insert absent versions)."""
    dim, new = fx.instrument_pair(spark, d)
    out = scd2_by_version(dim, new, ["ISIN"], _IT, "InstrumentSK")
    return out.select("ISIN", *_ICOLS, "ValidFromDate", "ValidToDate", "IsCurrent", "InstrumentSK")


@register("joi5_not_exists", sql_with(["ins_dim", "ins_new"], """SELECT s.ISIN, s.ValidFromDate FROM ins_new s
  WHERE NOT EXISTS (SELECT 1 FROM ins_dim d WHERE d.ISIN = s.ISIN AND d.ValidFromDate = s.ValidFromDate)"""))
def joi5_not_exists(spark, d):
    """JOI5/JOI6: versions absent from the dimension (anti join on key + date)."""
    from ..operators.joins import not_exists
    dim, new = fx.instrument_pair(spark, d)
    return not_exists(new.select("ISIN", "ValidFromDate"), dim.select("ISIN", "ValidFromDate"),
                      ["ISIN", "ValidFromDate"])


@register("win4_dedup_version", sql_with(["ins_new"], f"SELECT ISIN, ValidFromDate, {', '.join(_ICOLS)} FROM ins_new"))
def win4_dedup_version(spark, d):
    """WIN4: one row per (ISIN, ValidFrom), lowest venue first (record id breaks ties)."""
    _, new = fx.instrument_pair(spark, d)
    return new.select("ISIN", "ValidFromDate", *_ICOLS)


# ----------------------------------------------------------------- C5 / JOI4 / WIN5 / JOI3
_CMDTY, _DEBTF, _ENRICH = wh.COMMODITY_COLUMNS, wh.DEBT_COLUMNS, wh.ENRICHED


def _sql_per_version(src: str, cols: list[str], order: str) -> str:
    return f"""SELECT ISIN, ValidFromDate, {', '.join(cols)} FROM (
  SELECT * EXCLUDE (ISIN), substr(trim(ISIN), 1, 12) AS ISIN, row_number() OVER (
    PARTITION BY substr(trim(ISIN), 1, 12), ValidFromDate ORDER BY TradingVenueMIC ASC NULLS FIRST, {order}) rn
  FROM {src} WHERE ISIN IS NOT NULL AND LatestRecordFlag AND ValidFromDate IS NOT NULL) WHERE rn = 1"""


fx.add_cte("u_debt", ["debt"], _sql_per_version(
    "debt", _DEBTF, "TotalIssuedNominalAmount DESC NULLS LAST, NominalValuePerUnit DESC NULLS LAST, "
    "MaturityDate DESC NULLS LAST"))
fx.add_cte("u_der", ["deriv"], _sql_per_version(
    "(SELECT *, CAST(NULL AS VARCHAR) AS CmdtyFinalPriceType FROM deriv)", _CMDTY,
    ", ".join(f"{c} ASC NULLS LAST" for c in _CMDTY)))
fx.add_cte("u_lst", ["typed"], _sql_per_version(
    "(SELECT *, CAST(NULL AS VARCHAR) AS CmdtyFinalPriceType FROM typed)", _CMDTY, "IssuerLEI ASC NULLS LAST"))
fx.add_cte("u_merged", ["u_debt", "u_der", "u_lst"], f"""
SELECT coalesce(d.ISIN, r.ISIN, l.ISIN) AS ISIN, coalesce(d.ValidFromDate, r.ValidFromDate, l.ValidFromDate) AS ValidFromDate,
  {', '.join(f'coalesce(r.{c}, l.{c}) AS {c}' for c in _CMDTY)}, {', '.join(f'd.{c}' for c in _DEBTF)}
FROM u_debt d FULL JOIN u_der r ON r.ISIN = d.ISIN AND r.ValidFromDate = d.ValidFromDate
FULL JOIN u_lst l ON l.ISIN = coalesce(d.ISIN, r.ISIN) AND l.ValidFromDate = coalesce(d.ValidFromDate, r.ValidFromDate)""")


def _merged(spark, d):
    return wh.enrichment(wh.staged(spark, d))


_U_OUT = ["ISIN", "ValidFromDate", *_CMDTY, "TotalIssuedNominalAmountCcy", "MaturityDate", "NominalValuePerUnitCcy"]


@register("joi4_full_merge", sql_with(["u_merged"], f"""SELECT {', '.join(_U_OUT)},
  CAST(TotalIssuedNominalAmount AS DOUBLE) AS TotalIssuedNominalAmount,
  CAST(NominalValuePerUnit AS DOUBLE) AS NominalValuePerUnit FROM u_merged"""))
def joi4_full_merge(spark, d):
    """JOI4 + WIN5: 3-source outer merge on (ISIN, ValidFrom), derivative before
    listing for commodity fields, debt fields from the debt table."""
    return wh.merge_sources(spark, d).select(*_U_OUT, _dbl("TotalIssuedNominalAmount"), _dbl("NominalValuePerUnit"))


@register("win5_dedup_trimmed", sql_with(["u_lst"], f"SELECT ISIN, ValidFromDate, {', '.join(_CMDTY)} FROM u_lst"))
def win5_dedup_trimmed(spark, d):
    """WIN5: trimmed ISIN, one row per (ISIN, ValidFrom), lowest venue first."""
    return wh.enrichment_sources(wh.staging(spark, d))[2]


fx.add_cte("enrich_tgt", ["d_instrument"], f"""SELECT ISIN, ValidFromDate, InstrumentSK,
  {', '.join(f'CAST(NULL AS {"DECIMAL(38,10)" if t == "decimal" else ("DATE" if t == "date" else "VARCHAR")}) AS {c}' for c, t in _ENRICH.items())}
FROM d_instrument""")


@register("c5_enrich", sql_with(["enrich_tgt", "u_merged"], f"""
SELECT t.ISIN, t.ValidFromDate, t.InstrumentSK,
  {', '.join(f'CASE WHEN u.ISIN IS NOT NULL AND {_sql_changed("t", "u", _ENRICH)} THEN u.{c} ELSE t.{c} END AS {c}' for c in _CMDTY + ["TotalIssuedNominalAmountCcy", "MaturityDate", "NominalValuePerUnitCcy"])},
  CAST(CASE WHEN u.ISIN IS NOT NULL AND {_sql_changed("t", "u", _ENRICH)} THEN u.TotalIssuedNominalAmount ELSE t.TotalIssuedNominalAmount END AS DOUBLE) AS TotalIssuedNominalAmount,
  CAST(CASE WHEN u.ISIN IS NOT NULL AND {_sql_changed("t", "u", _ENRICH)} THEN u.NominalValuePerUnit ELSE t.NominalValuePerUnit END AS DOUBLE) AS NominalValuePerUnit,
  (u.ISIN IS NOT NULL AND {_sql_changed("t", "u", _ENRICH)}) AS updated
FROM enrich_tgt t LEFT JOIN u_merged u ON u.ISIN = t.ISIN AND u.ValidFromDate = t.ValidFromDate"""))
def c5_enrich(spark, d):
    """C5 + JOI3: enrichment update of the instrument dimension from the merged
    sub-type sources (no versioning; NULL overwrites)."""
    tgt = wh.dimensions(spark, d, "instrument")["instrument"].select("ISIN", "ValidFromDate", "InstrumentSK")
    out = wh.enriched(tgt, _merged(spark, d), flag="updated")
    return out.select("ISIN", "ValidFromDate", "InstrumentSK", *_CMDTY, "TotalIssuedNominalAmountCcy",
                      "MaturityDate", "NominalValuePerUnitCcy", _dbl("TotalIssuedNominalAmount"),
                      _dbl("NominalValuePerUnit"), "updated")


@register("c5_enrich_again", sql_with(["enrich_tgt", "u_merged"], f"""
SELECT t.ISIN, t.ValidFromDate, t.InstrumentSK, u.MaturityDate, false AS updated
FROM enrich_tgt t JOIN u_merged u ON u.ISIN = t.ISIN AND u.ValidFromDate = t.ValidFromDate"""))
def c5_enrich_again(spark, d):
    """C5 over a dimension that holds the values already: nothing changes."""
    tgt = wh.dimensions(spark, d, "instrument")["instrument"].select("ISIN", "ValidFromDate", "InstrumentSK")
    # written once: both loads and the last join read it
    merged = cut_lineage(_merged(spark, d), "merged")
    out = wh.enriched(wh.enriched(tgt, merged), merged, flag="updated")
    return out.join(merged.select("ISIN", "ValidFromDate"), ["ISIN", "ValidFromDate"], "left_semi").select(
        "ISIN", "ValidFromDate", "InstrumentSK", "MaturityDate", "updated")


# ----------------------------------------------------------------- C6 / JOI8 / C13 / AGG3
@register("c6_merge_new_keys", sql_with(["register", "typed"], """
WITH old AS (SELECT MIC AS TradingVenueMIC, row_number() OVER (ORDER BY MIC) AS TradingVenueSK FROM register)
SELECT * FROM old
UNION ALL
SELECT TradingVenueMIC, (SELECT coalesce(max(TradingVenueSK), 0) FROM old) + row_number() OVER (ORDER BY TradingVenueMIC)
FROM (SELECT DISTINCT TradingVenueMIC FROM typed WHERE TradingVenueMIC IS NOT NULL) s
WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.TradingVenueMIC = s.TradingVenueMIC)"""))
def c6_merge_new_keys(spark, d):
    """C6 + JOI8 + AGG3 + C13: insert-only venue dimension. The existing dimension
    is the venue register (keys in code order); the load adds every venue of
    the listing the register lacks, with keys above the current maximum."""
    reg = fx.venue_register(spark, d).select(F.col("MIC").alias("TradingVenueMIC"))
    old = assign_keys(reg, ["TradingVenueMIC"], "TradingVenueSK")
    return merge_new_keys(old, wh.staging(spark, d)["listing"], "TradingVenueMIC", "TradingVenueSK")


@register("c13_assign_keys", sql_with(["typed"], """SELECT ISIN, 1000 + row_number() OVER (ORDER BY ISIN) AS InstrumentKey
  FROM (SELECT DISTINCT ISIN FROM typed WHERE ISIN IS NOT NULL)"""))
def c13_assign_keys(spark, d):
    """C13: dense ascending keys above a start value, ordered by the business key,
    computed without a single-partition window."""
    isins = wh.staging(spark, d)["listing"].select("ISIN").filter(F.col("ISIN").isNotNull()).distinct()
    return assign_keys(isins, ["ISIN"], "InstrumentKey", 1000)


# ----------------------------------------------------------------- C7 / JOI9 / WIN3 / JOI1
_ISS = fx.ISSUER_TRACKED
_ISSC = list(_ISS)


@register("win3_dedup_entity", sql_with(["entities"], """SELECT LEI, LegalName, EntityStatus, LegalForm,
  InitialRegistrationDate, LastUpdateDate, RecordId FROM entities"""))
def win3_dedup_entity(spark, d):
    """WIN3: one golden-copy row per LEI (latest update, then registration, then record)."""
    ents = dedup_latest(fx.golden(spark, d), ["LEI"], fx.ENTITY_ORDER)
    return ents.select("LEI", "LegalName", "EntityStatus", "LegalForm", "InitialRegistrationDate",
                       "LastUpdateDate", "RecordId")


fx.add_cte("iss_src", ["typed", "entities"], f"""SELECT i.IssuerLEI, {', '.join(f'e.{c}' for c in _ISSC)}
  FROM (SELECT DISTINCT IssuerLEI FROM typed WHERE IssuerLEI IS NOT NULL) i LEFT JOIN entities e ON e.LEI = i.IssuerLEI""")


@register("joi1_left_join_latest", sql_with(["iss_src"], """SELECT IssuerLEI, LegalName, EntityStatus,
  LastUpdateDate FROM iss_src"""))
def joi1_left_join_latest(spark, d):
    """JOI1: each listed issuer left-joined to the latest version of its entity row."""
    from ..operators.joins import left_join_latest
    drv = wh.staging(spark, d)["listing"].select("IssuerLEI").filter(F.col("IssuerLEI").isNotNull()).distinct()
    ref = fx.golden(spark, d).withColumnRenamed("LEI", "IssuerLEI")
    return left_join_latest(drv, ref, ["IssuerLEI"], fx.ENTITY_ORDER) \
        .select("IssuerLEI", "LegalName", "EntityStatus", "LastUpdateDate")


def _old_issuers(spark, d):
    g = fx.golden(spark, d).filter(F.col("LastUpdateDate") < F.lit(fx.ENTITY_CUTOFF).cast("timestamp"))
    old = dedup_latest(g, ["LEI"], fx.ENTITY_ORDER).withColumnRenamed("LEI", "IssuerLEI")
    listed = wh.staged(spark, d)["listing"].select("IssuerLEI").distinct()
    old = old.join(listed, "IssuerLEI", "left_semi").select("IssuerLEI", *_ISSC)
    return assign_keys(old, ["IssuerLEI"], "IssuerSK")


@register("c7_upsert_dim", sql_with(["golden", "typed", "iss_src"], f"""
WITH old AS (
  SELECT IssuerLEI, {', '.join(_ISSC)}, row_number() OVER (ORDER BY IssuerLEI) AS IssuerSK FROM (
    SELECT LEI AS IssuerLEI, * EXCLUDE (LEI), row_number() OVER (PARTITION BY LEI ORDER BY LastUpdateDate DESC NULLS LAST,
      InitialRegistrationDate DESC NULLS LAST, RecordId DESC NULLS LAST) rn
    FROM golden WHERE LastUpdateDate < TIMESTAMP '{fx.ENTITY_CUTOFF}')
  WHERE rn = 1 AND IssuerLEI IN (SELECT IssuerLEI FROM typed)),
j AS (
  SELECT d.IssuerSK, coalesce(d.IssuerLEI, s.IssuerLEI) AS IssuerLEI,
    {', '.join(f'd.{c} AS d_{c}, s.{c} AS s_{c}' for c in _ISSC)},
    CASE WHEN d.IssuerSK IS NOT NULL AND s.IssuerLEI IS NOT NULL AND {_sql_changed('d', 's', _ISS)} THEN 'update'
         WHEN d.IssuerSK IS NOT NULL THEN 'keep' ELSE 'insert' END AS load_action
  FROM old d FULL JOIN iss_src s ON d.IssuerLEI = s.IssuerLEI)
SELECT IssuerLEI, coalesce(IssuerSK, (SELECT coalesce(max(IssuerSK), 0) FROM old)
    + row_number() OVER (PARTITION BY IssuerSK IS NULL ORDER BY IssuerLEI)) AS IssuerSK,
  {', '.join(f"CASE WHEN load_action IN ('update', 'insert') THEN s_{c} ELSE d_{c} END AS {c}" for c in _ISSC)},
  load_action
FROM j"""))
def c7_upsert_dim(spark, d):
    """C7 + JOI9 + WIN3 + JOI1: issuer dimension upsert from the entity golden copy
    (existing = entities known before the cut-off)."""
    src = wh.issuer_source(wh.staged(spark, d)["listing"], fx.entities(spark, d))
    out = upsert_dim(_old_issuers(spark, d), src, "IssuerLEI", "IssuerSK", _ISS)
    return out.select("IssuerLEI", "IssuerSK", *_ISSC, "load_action")


# ----------------------------------------------------------------- C8 / C9
_HINT_U = wh.FIXTURE_UNDERLYING_HINTS
_HINT_T = wh.FIXTURE_TYPE_HINTS


def _sql_ladder(rules, default):
    parts = []
    for pats, label in rules:
        cond = " OR ".join(f"upper(FullName) LIKE '{p}'" for p in pats)
        parts.append(f"WHEN max(CASE WHEN {cond} THEN 1 ELSE 0 END) = 1 THEN '{label}'")
    return "CASE " + " ".join(parts) + f" ELSE '{default}' END"


fx.add_cte("j_hints", ["typed"], f"""SELECT CFI, {_sql_ladder(_HINT_U, 'Unknown')} AS Hint_Underlying_Class,
  {_sql_ladder(_HINT_T, 'Unknown')} AS Hint_Derivative_Type
  FROM typed WHERE CFI LIKE 'J%' AND FullName IS NOT NULL GROUP BY CFI""")


@register("c9_name_hints", sql_with(["j_hints"], "SELECT * FROM j_hints"))
def c9_name_hints(spark, d):
    """C9 + AGG4 + FLT4: per J-code underlying/type hints from instrument names."""
    return name_hints(wh.staging(spark, d)["listing"], _HINT_U, _HINT_T)


def _sql_decode() -> str:
    from ..operators import classify as K
    def case(expr, mapping, default=None):
        whens = " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in mapping.items())
        return f"CASE {whens} " + (f"ELSE '{default}' " if default is not None else "") + "END"
    group_parts = []
    for letter, (sub, other) in K.GROUP_BY_LETTER.items():
        group_parts.append(f"WHEN cat = '{letter}' THEN {case('grp', sub, other)}")
    group_parts.append(f"WHEN cat = 'J' THEN {case(chr(99) + 'oalesce(Hint_Underlying_Class, ' + chr(39) + 'Unknown' + chr(39) + ')', K.J_GROUP, K.J_GROUP_OTHER)}")
    for letter, prefix in K.GROUP_PREFIX.items():
        group_parts.append(f"WHEN cat = '{letter}' THEN '{prefix}' || grp")
    und = [f"WHEN cat = 'H' THEN {case('grp', K.UNDERLYING_HYBRID, K.UNKNOWN)}",
           "WHEN cat = 'J' THEN coalesce(Hint_Underlying_Class, 'Unknown')"]
    und += [f"WHEN cat = '{k}' THEN '{v}'" for k, v in K.UNDERLYING_BY_CATEGORY.items()]
    der = ", ".join(f"'{x}'" for x in K.DERIVATIVE_LETTERS)
    rep = ", ".join(f"'{x}'" for x in K.REPORTABLE_LETTERS)
    return f"""SELECT CFI, CFISK, {case('cat', K.CATEGORY, K.UNKNOWN)} AS Category,
  CASE {' '.join(group_parts)} ELSE 'Unknown' END AS "Group",
  CASE WHEN cat = 'J' THEN {case("coalesce(Hint_Derivative_Type, 'Unknown')", K.J_TYPE, K.J_TYPE_OTHER)}
       WHEN a1 IS NULL OR a1 = '' THEN NULL WHEN a1 = 'X' THEN '{K.TYPE_NOT_APPLICABLE}'
       ELSE '{K.TYPE_PREFIX}' || a1 END AS "Type",
  CASE WHEN cat IN ({der}) THEN 1 ELSE 0 END AS Is_Derivative,
  CASE WHEN cat = 'O' THEN 1 WHEN cat = 'J' THEN CASE WHEN Hint_Derivative_Type = 'Option' THEN 1 ELSE 0 END ELSE 0 END AS Has_Strike,
  CASE WHEN cat IN ('O', 'H') THEN {case('a2', K.EXERCISE_STYLE)} END AS Exercise_Style,
  CASE {' '.join(und)} ELSE 'Unknown' END AS Underlying_Class,
  CASE WHEN cat IN ({rep}) THEN 1 ELSE 0 END AS ESMA_Reportable,
  {', '.join(f"nullif(substr(CFI, {i}, 1), '') AS CFI_{i}" for i in range(1, 7))}
FROM (SELECT k.CFI, k.CFISK, h.Hint_Underlying_Class, h.Hint_Derivative_Type,
        upper(substr(k.CFI, 1, 1)) AS cat, upper(substr(k.CFI, 2, 1)) AS grp,
        CASE WHEN length(rtrim(k.CFI)) >= 3 THEN upper(substr(k.CFI, 3, 1)) END AS a1,
        CASE WHEN length(rtrim(k.CFI)) >= 4 THEN upper(substr(k.CFI, 4, 1)) END AS a2
      FROM d_cfi_keys k LEFT JOIN j_hints h ON h.CFI = k.CFI)"""


fx.add_cte("d_cfi", ["d_cfi_keys", "j_hints"], _sql_decode())
_CFI_OUT = ["CFI", "CFISK", "Category", "Group", "Type", "Is_Derivative", "Has_Strike", "Exercise_Style",
            "Underlying_Class", "ESMA_Reportable"] + [f"CFI_{i}" for i in range(1, 7)]


@register("c8_classify", sql_with(["d_cfi"], "SELECT * FROM d_cfi"))
def c8_classify(spark, d):
    """C8 + PRJ25 + FLT5 + FLT6: classification dimension decoded from the code."""
    return wh.dimensions(spark, d, "cfi")["cfi"].select(*_CFI_OUT)


# ----------------------------------------------------------------- C12
@register("c12_calendar", sql_with(["entities"], """
SELECT CAST(dd AS DATE) AS "Date", CAST(year(dd) AS INTEGER) AS Year, CAST(month(dd) AS INTEGER) AS Month,
  ['janvier','février','mars','avril','mai','juin','juillet','août','septembre','octobre','novembre','décembre'][month(dd)] AS MonthName,
  'Q' || CAST(quarter(dd) AS VARCHAR) AS Quarter, strftime(dd, '%Y-%m') AS YearMonth, CAST(day(dd) AS INTEGER) AS Day,
  CAST(isodow(dd) AS INTEGER) AS Weekday,
  ['lundi','mardi','mercredi','jeudi','vendredi','samedi','dimanche'][isodow(dd)] AS WeekdayName
FROM (SELECT unnest(generate_series(min(InitialRegistrationDate), max(InitialRegistrationDate), INTERVAL 1 DAY)) AS dd
      FROM entities WHERE InitialRegistrationDate IS NOT NULL)"""))
def c12_calendar(spark, d):
    """C12: calendar dimension between the first and last registration date."""
    return calendar(fx.entities(spark, d), "InitialRegistrationDate")
