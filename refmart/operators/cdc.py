"""Staging operators: delta apply (C1) and sub-type split (C2).

The reference applies a daily delta with three ordered UPDATE ... FROM JOIN
statements and one INSERT ... WHERE NOT EXISTS. Here the delta is first
collapsed to *one close instruction per key* (a partial aggregate, so a hot
key is pre-reduced map-side), then the state meets it in a single left join;
inserts are found with a semi-join-reduced anti join, so the big state is
never the build side of anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import blank_to_null, coalesce_date, cut, parse_bool, parse_date, parse_decimal, parse_int
from ..functions.predicates import in_family, require_keys
from .windows import dedup_latest

KEYS = ["ISIN", "TradingVenueMIC"]
# Delta record kinds and the order in which their closes apply.
ACTION_NEW, ACTION_MOD, ACTION_TERM, ACTION_CANC = "NEW", "MOD", "TERM", "CANC"


def prepare_delta(delta: DataFrame) -> DataFrame:
    """C1 (a)+(b) / WIN2: add ``VF`` (date of the first 10 chars of ValidFrom,
    else of the header date) and ``TERM``; keep one row per
    (ISIN, venue, VF, action) -- highest numeric record id, then record id text."""
    d = require_keys(delta, ["ISIN", "TradingVenueMIC"])
    d = d.withColumn("VF", parse_date(F.coalesce(F.col("ValidFromDate").cast("string"),
                                                  F.col("HeaderReportingPeriodDate").cast("string")))) \
        .withColumn("TERM", parse_date(F.col("TerminationDate")))
    d = dedup_latest(d, ["ISIN", "TradingVenueMIC", "VF", "ActionType"],
                     [F.col("TechRcrdId").try_cast("long").desc_nulls_last(), F.col("TechRcrdId").desc_nulls_last()])
    return d.filter(F.col("VF").isNotNull())


def close_instructions(d: DataFrame) -> DataFrame:
    """One row per key: the ValidTo date to stamp on the open state row.

    MOD closes at VF-1, else TERM at coalesce(TerminationDate, VF), else CANC at
    VF ("first close wins"); among several deltas of one kind the earliest wins
    (Q-5). Expressed as conditional ``min`` -- a partial aggregate."""
    a = F.col("ActionType")
    g = d.groupBy(*KEYS).agg(
        F.min(F.when(a == ACTION_MOD, F.col("VF"))).alias("__mod"),
        F.min(F.when(a == ACTION_TERM, F.coalesce(F.col("TERM"), F.col("VF")))).alias("__term"),
        F.min(F.when(a == ACTION_CANC, F.col("VF"))).alias("__canc"),
    )
    close_to = F.coalesce(F.date_sub(F.col("__mod"), 1), F.col("__term"), F.col("__canc"))
    return g.select(*KEYS, close_to.alias("__close_to")).filter(F.col("__close_to").isNotNull())


def apply_delta(state: DataFrame, delta: DataFrame) -> DataFrame:
    """C1: apply a day's delta (NEW/MOD/TERM/CANC) to the versioned state.

    * open rows (ValidTo NULL and flag set) of keys with a close instruction get
      ValidTo = the instruction's date and flag = false;
    * NEW and MOD rows are appended open (ValidTo NULL, flag true) unless the
      state already has a row with the same key and the same ValidFrom date;
    * NEW closes nothing; TERM and CANC insert nothing.

    ``state`` has the wide columns with ValidFromDate/ValidToDate as dates and
    LatestRecordFlag boolean; the result has the same columns.
    """
    # The de-duplicated delta feeds three branches (closes, inserts, their keys):
    # write it once instead of repeating its shuffle and window three times.
    from ..session import cut_lineage
    d = cut_lineage(prepare_delta(delta), "delta")
    instr = close_instructions(d)
    is_open = F.col("ValidToDate").isNull() & F.coalesce(F.col("LatestRecordFlag"), F.lit(False))
    hit = is_open & F.col("__close_to").isNotNull()
    closed = state.join(instr, KEYS, "left").withColumns({
        "ValidToDate": F.when(hit, F.col("__close_to")).otherwise(F.col("ValidToDate")),
        "LatestRecordFlag": F.when(hit, F.lit(False)).otherwise(F.col("LatestRecordFlag")),
    }).select(*state.columns)
    candidates = d.filter(F.col("ActionType").isin(ACTION_NEW, ACTION_MOD))
    cand_keys = candidates.select(*KEYS, "VF").distinct()
    # Semi join first: the (small) candidate keys are the build side, the state is streamed.
    existing = state.select(*KEYS, F.col("ValidFromDate").cast("date").alias("VF")) \
        .join(cand_keys, KEYS + ["VF"], "left_semi")
    inserts = candidates.join(existing, KEYS + ["VF"], "left_anti") \
        .withColumn("ValidFromDate", F.col("VF")) \
        .withColumn("ValidToDate", F.lit(None).cast("date")) \
        .withColumn("LatestRecordFlag", F.lit(True))
    common = [c for c in state.columns if c in set(inserts.columns)]
    return closed.unionByName(inserts.select(*common), allowMissingColumns=True)


# ---------------------------------------------------------------- C2
LISTING_COLUMNS = [
    "ISIN", "TradingVenueMIC", "ValidFromDate", "ValidToDate", "LatestRecordFlag", "ValidFromDate_PK",
    "FullName", "ShortName", "CFI", "CommodityDerivativeInd", "NotionalCurrency", "IssuerLEI",
    "IssuerReqAdmission", "AdmissionApprvlDate", "ReqForAdmissionDate", "FirstTradingDate", "TerminationDate",
    "CmdtyBaseProduct", "CmdtySubProduct", "CmdtySubSubProduct", "CmdtyTransactionType", "CmdtyFinalPriceType",
    "HeaderReportingMarketId", "HeaderReportingNCA", "HeaderReportingPeriodDate", "SourceFileName", "TechRcrdId",
]
DEBT_COLUMNS = [
    "ISIN", "TradingVenueMIC", "ValidFromDate", "ValidToDate", "LatestRecordFlag", "ValidFromDate_PK",
    "TotalIssuedNominalAmount", "TotalIssuedNominalAmountCcy", "MaturityDate", "NominalValuePerUnit",
    "NominalValuePerUnitCcy", "FixedRate", "FloatRefRateISIN", "FloatRefRateIndex", "FloatTermUnit",
    "FloatTermValue", "FloatBasisPointSpread", "DebtSeniority",
]
DERIVATIVE_COLUMNS = [
    "ISIN", "TradingVenueMIC", "ValidFromDate", "ValidToDate", "LatestRecordFlag", "ValidFromDate_PK",
    "ExpiryDate", "PriceMultiplier", "UnderlyingISIN", "UnderlyingLEI", "UnderlyingIndexRef",
    "UnderlyingIndexTermUnit", "UnderlyingIndexTermValue", "OptionType", "OptionExerciseStyle", "DeliveryType",
    "StrikePrice", "StrikePriceCcy", "StrikeNoPriceCcy", "CmdtyBaseProduct", "CmdtySubProduct",
    "CmdtySubSubProduct", "CmdtyTransactionType", "CmdtyFinalPriceType",
]


def _s(name: str, width: int | None = None, trim: bool = True):
    c = blank_to_null(F.col(name), trim=trim)
    return cut(c, width) if width else c


def type_instruments(wide: DataFrame, isin_buckets: int | None = None) -> DataFrame:
    """C2 typing step: current rows, WIN1 dedup, every column parsed to its typed form
    (PRJ2/3, PRJ12-17). Missing optional columns read as NULL. Only the columns that the dedup
    reads are parsed after it: the others go through its shuffle in their small typed form.
    With ``isin_buckets`` the rows come hashed by the typed ISIN into that many partitions
    (all of one instrument in one), as a table bucketed by it is written."""
    present = set(wide.columns)
    missing = {}
    for c in ["HeaderReportingMarketId", "HeaderReportingNCA", "HeaderReportingPeriodDate", "SourceFileName",
              "TechRcrdId", "FullName", "ShortName", "CFI", "CommodityDerivativeInd", "NotionalCurrency",
              "IssuerLEI", "IssuerReqAdmission", "AdmissionApprvlDate", "ReqForAdmissionDate", "FirstTradingDate",
              "TerminationDate", "TotalIssuedNominalAmount", "TotalIssuedNominalAmountCcy", "MaturityDate",
              "NominalValuePerUnit", "NominalValuePerUnitCcy", "FixedRate", "FloatRefRateISIN",
              "FloatRefRateIndex", "FloatTermUnit", "FloatTermValue", "FloatBasisPointSpread", "DebtSeniority",
              "ExpiryDate", "PriceMultiplier", "UnderlyingISIN", "UnderlyingLEI", "UnderlyingIndexRef",
              "UnderlyingIndexTermUnit", "UnderlyingIndexTermValue", "OptionType", "OptionExerciseStyle",
              "DeliveryType", "StrikePrice", "StrikePriceCcy", "StrikeNoPriceCcy", "CmdtyBaseProduct",
              "CmdtySubProduct", "CmdtySubSubProduct", "CmdtyTransactionType", "CmdtyFinalPriceType"]:
        if c not in present:
            missing[c] = F.lit(None).cast("string")
    w = wide.withColumns(missing) if missing else wide
    cur = w.filter(F.col("LatestRecordFlag") == F.lit(True))
    after = {
        "ISIN": _s("ISIN", 12), "TradingVenueMIC": _s("TradingVenueMIC", 50),
        "ValidFromDate": F.col("ValidFromDate").cast("date"),
        "ValidFromDate_PK": coalesce_date(F.col("ValidFromDate").cast("date")),
        "IssuerLEI": _s("IssuerLEI", 50), "TechRcrdId": _s("TechRcrdId")}
    raw = ["ISIN", "IssuerLEI", "TradingVenueMIC", "ValidFromDate", "TechRcrdId"]
    typed = cur.select(
        *raw, F.col("ValidToDate").cast("date").alias("ValidToDate"), F.col("LatestRecordFlag"),
        _s("FullName", 400, trim=False).alias("FullName"), _s("ShortName", 200, trim=False).alias("ShortName"),
        _s("CFI", 6).alias("CFI"),
        parse_bool("CommodityDerivativeInd").alias("CommodityDerivativeInd"),
        _s("NotionalCurrency", 10).alias("NotionalCurrency"),
        parse_bool("IssuerReqAdmission").alias("IssuerReqAdmission"),
        parse_date(blank_to_null(F.col("AdmissionApprvlDate"), trim=False)).alias("AdmissionApprvlDate"),
        parse_date(blank_to_null(F.col("ReqForAdmissionDate"), trim=False)).alias("ReqForAdmissionDate"),
        parse_date(blank_to_null(F.col("FirstTradingDate"), trim=False)).alias("FirstTradingDate"),
        parse_date(blank_to_null(F.col("TerminationDate"), trim=False)).alias("TerminationDate"),
        *[_s(c, 50).alias(c) for c in ["CmdtyBaseProduct", "CmdtySubProduct", "CmdtySubSubProduct",
                                        "CmdtyTransactionType", "CmdtyFinalPriceType"]],
        _s("HeaderReportingMarketId", trim=False).alias("HeaderReportingMarketId"),
        _s("HeaderReportingNCA", trim=False).alias("HeaderReportingNCA"),
        parse_date(blank_to_null(F.col("HeaderReportingPeriodDate"), trim=False)).alias("HeaderReportingPeriodDate"),
        _s("SourceFileName", 260).alias("SourceFileName"),
        parse_decimal(blank_to_null(F.col("TotalIssuedNominalAmount"), trim=False)).alias("TotalIssuedNominalAmount"),
        _s("TotalIssuedNominalAmountCcy", 10).alias("TotalIssuedNominalAmountCcy"),
        parse_date(blank_to_null(F.col("MaturityDate"), trim=False)).alias("MaturityDate"),
        parse_decimal(blank_to_null(F.col("NominalValuePerUnit"), trim=False)).alias("NominalValuePerUnit"),
        _s("NominalValuePerUnitCcy", 10).alias("NominalValuePerUnitCcy"),
        parse_decimal(blank_to_null(F.col("FixedRate"), trim=False)).alias("FixedRate"),
        _s("FloatRefRateISIN", 12).alias("FloatRefRateISIN"),
        _s("FloatRefRateIndex", trim=False).alias("FloatRefRateIndex"),
        _s("FloatTermUnit", 10).alias("FloatTermUnit"),
        parse_int(blank_to_null(F.col("FloatTermValue"), trim=False)).alias("FloatTermValue"),
        parse_decimal(blank_to_null(F.col("FloatBasisPointSpread"), trim=False)).alias("FloatBasisPointSpread"),
        _s("DebtSeniority", 100, trim=False).alias("DebtSeniority"),
        parse_date(blank_to_null(F.col("ExpiryDate"), trim=False)).alias("ExpiryDate"),
        parse_decimal(blank_to_null(F.col("PriceMultiplier"), trim=False)).alias("PriceMultiplier"),
        _s("UnderlyingISIN", 12).alias("UnderlyingISIN"), _s("UnderlyingLEI", 50).alias("UnderlyingLEI"),
        _s("UnderlyingIndexRef", trim=False).alias("UnderlyingIndexRef"),
        _s("UnderlyingIndexTermUnit", 10).alias("UnderlyingIndexTermUnit"),
        parse_int(blank_to_null(F.col("UnderlyingIndexTermValue"), trim=False)).alias("UnderlyingIndexTermValue"),
        _s("OptionType", 50).alias("OptionType"), _s("OptionExerciseStyle", 50).alias("OptionExerciseStyle"),
        _s("DeliveryType", 50).alias("DeliveryType"),
        parse_decimal(blank_to_null(F.col("StrikePrice"), trim=False)).alias("StrikePrice"),
        _s("StrikePriceCcy", 10).alias("StrikePriceCcy"),
        parse_bool("StrikeNoPriceCcy").alias("StrikeNoPriceCcy"),
    )
    keys = ["ISIN", "IssuerLEI", "TradingVenueMIC"]
    if isin_buckets:
        # the typed ISIN follows from the raw one, so it does not change the groups
        typed = typed.withColumn("__isin", after["ISIN"]).repartition(isin_buckets, "__isin")
        keys, after["ISIN"] = ["__isin", *keys], F.col("__isin")
    typed = dedup_latest(typed, keys, [F.col("ValidFromDate").desc_nulls_last(), F.col("TechRcrdId").desc_nulls_last()])
    rest = [c for c in typed.columns if c not in raw and c != "__isin"]
    return typed.select(*[c.alias(n) for n, c in after.items()], *rest)


def split_instruments(wide: DataFrame) -> dict[str, DataFrame]:
    """C2: listing (all typed current rows), debt (CFI starting with D) and
    derivative (CFI starting with F/O/S, or commodity flag, or a base product).

    The three outputs share one typed frame; a pipeline should persist or
    write it once (``run_staging`` does) before deriving the three tables.
    """
    return split_typed(type_instruments(wide))


def split_typed(typed: DataFrame) -> dict[str, DataFrame]:
    """C2 second half: the three sub-type tables from the typed frame, each with those of its
    columns that the frame has."""
    def part(df: DataFrame, columns: list[str]) -> DataFrame:
        return df.select(*[c for c in columns if c in typed.columns])

    return {
        "listing": part(typed, LISTING_COLUMNS),
        "debt": part(typed.filter(in_family("CFI", ["D"])), DEBT_COLUMNS),
        "derivative": part(typed.filter(in_family("CFI", ["F", "O", "S"], F.col("CommodityDerivativeInd"),
                                                  F.col("CmdtyBaseProduct").isNotNull())), DERIVATIVE_COLUMNS),
    }
