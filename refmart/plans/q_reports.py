"""Registered report queries (RPT1-RPT19) and the measures they exercise."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.bitmaps import distinct_sets, matrix_totals, set_counts
from ..operators.facts import calendar
from ..operators.ledger import ledger_from_counts, recent_loads
from ..operators.measures import ledger_summary, matrix
from . import fixtures as fx
from . import q_warehouse  # noqa: F401  (registers the shared SQL stages first)
from . import reports as R
from . import warehouse as wh
from .catalog import register
from .fixtures import add_cte, sql_with

add_cte("star", ["fact", "d_venue", "register", "d_issuer", "d_cfi", "d_instrument"], """
SELECT f.*, v.TradingVenueMIC AS VenueMIC, r.MarketName, r.City, r.Country AS VenueCountry, r.Region AS VenueRegion,
  i.LegalAddress_Country AS IssuerCountry, i.LegalAddress_Region AS IssuerRegion, c.CFI AS CfiCode, c.Category,
  c.Underlying_Class, di.CFI AS InstrumentCFI
FROM fact f LEFT JOIN d_venue v ON v.TradingVenueSK = f.TradingVenueSK
LEFT JOIN register r ON r.MIC = v.TradingVenueMIC LEFT JOIN d_issuer i ON i.IssuerSK = f.IssuerSK
LEFT JOIN d_cfi c ON c.CFISK = f.CFISK LEFT JOIN d_instrument di ON di.InstrumentSK = f.InstrumentSK""")


def dc(x: str) -> str:
    """Blank-inclusive distinct count in SQL."""
    return f"(count(DISTINCT {x}) + max(CASE WHEN {x} IS NULL THEN 1 ELSE 0 END))"


def top_filter(table: str, measure: str, n: int) -> str:
    return f"{measure} >= (SELECT min({measure}) FROM (SELECT {measure} FROM {table} WHERE {measure} IS NOT NULL ORDER BY {measure} DESC LIMIT {n}))"


LST = dc("InstrumentListingSK")
DESC = "replace(coalesce(regexp_extract(Category, '\\(([^)]*)\\)', 1), ''), 'souvent OTC', 'hybride/structuré')"


def _star(spark, d, *columns):
    return wh.star(spark, d, *columns)


@register("rpt1_kpi_cards", sql_with(["star"], f"""
WITH pv AS (SELECT TradingVenueSK, {LST} AS x FROM star GROUP BY TradingVenueSK),
ai AS (SELECT IssuerSK, {dc('InstrumentSK')} AS cnt FROM star GROUP BY IssuerSK),
k AS (SELECT {dc('InstrumentSK')} AS instruments, {LST} AS listings, {dc('IssuerSK')} AS issuers,
        {dc('TradingVenueSK')} AS venues, min(SnapshotDate) AS lo, max(SnapshotDate) AS hi, count(*) AS n FROM star)
SELECT instruments, listings, issuers, venues,
  round(CAST(listings AS DOUBLE) / nullif(instruments, 0), 6) AS listings_per_instrument,
  round(CAST(instruments AS DOUBLE) / nullif(issuers, 0), 6) AS instruments_per_issuer,
  round(CAST(instruments AS DOUBLE) / nullif(venues, 0), 6) AS instruments_per_venue,
  round(CAST((SELECT sum(x) FROM pv WHERE {top_filter('pv', 'x', 10)}) AS DOUBLE) / nullif(listings, 0), 6) AS pct_top10_venues,
  round(CAST((SELECT sum(cnt) FROM ai WHERE {top_filter('ai', 'cnt', 10)}) AS DOUBLE)
        / nullif((SELECT sum(cnt) FROM ai), 0), 6) AS pct_top10_issuers,
  'Period: ' || strftime(lo, '%Y-%m-%d') || ' → ' || strftime(hi, '%Y-%m-%d') || ' | ' || format('{{:,}}', n) || ' records' AS overview_subtitle,
  'Snapshot: ' || strftime(hi, '%Y-%m-%d') AS trading_subtitle
FROM k"""))
def rpt1_kpi_cards(spark, d):
    """RPT1 (AGG5, AGG6, AGG10, TOP1, TOP2, PRJ29)."""
    return R.kpi_cards(_star(spark, d, "SnapshotDate", "VenueRows", *R.CARDS), F.coalesce(F.sum("VenueRows"), F.lit(0)))


@register("rpt2_listings_by_classification", sql_with(["star"], f"""
WITH pc AS (SELECT CfiCode, {LST} AS listings FROM star GROUP BY CfiCode),
ds AS (SELECT DISTINCT CfiCode, Category FROM star)
SELECT pc.CfiCode, {DESC.replace('Category', 'ds.Category')} AS cfi_desc, pc.listings
FROM pc LEFT JOIN ds ON ds.CfiCode IS NOT DISTINCT FROM pc.CfiCode WHERE {top_filter('pc', 'listings', 30)}"""))
def rpt2_listings_by_classification(spark, d):
    """RPT2 (TOP3, AGG5, PRJ26)."""
    return R.listings_by_classification(_star(spark, d, "CfiCode", "Category", "InstrumentListingSK"))


def _top_venue_sql(n: int, body: str) -> str:
    return f"""
WITH pv AS (SELECT TradingVenueSK, {LST} AS x FROM star GROUP BY TradingVenueSK),
s AS (SELECT * FROM star WHERE TradingVenueSK IN (SELECT TradingVenueSK FROM pv WHERE {top_filter('pv', 'x', n)}))
{body}"""


@register("rpt3_listings_by_city", sql_with(["star"], _top_venue_sql(
    7, f"SELECT City, {LST} AS listings FROM s GROUP BY City")))
def rpt3_listings_by_city(spark, d):
    """RPT3 (JOI12, TOP3, JOI7)."""
    return R.listings_by_city(_star(spark, d, "TradingVenueSK", "InstrumentListingSK"), wh.venues(spark, d, "City"))


@register("rpt4_listings_by_venue", sql_with(["star"], _top_venue_sql(
    6, f"SELECT VenueMIC, {LST} AS listings, min(MarketName) AS market_name FROM s GROUP BY VenueMIC")))
def rpt4_listings_by_venue(spark, d):
    """RPT4 (TOP3, AGG13)."""
    return R.listings_by_venue(_star(spark, d, "TradingVenueSK", "InstrumentListingSK", "VenueMIC"), wh.venues(spark, d, "MarketName"))


COUNTRY_SLICE = ["NATION_3", "NATION_7"]


@register("rpt5_country_cards", sql_with(["star"], f"""
WITH s AS (SELECT * FROM star WHERE VenueCountry IN ('NATION_3', 'NATION_7')),
pv AS (SELECT TradingVenueSK, {LST} AS x FROM s GROUP BY TradingVenueSK)
SELECT {dc('InstrumentSK')} AS instruments, {LST} AS listings, {dc('IssuerSK')} AS issuers,
  {dc('TradingVenueSK')} AS venues,
  round(CAST((SELECT sum(x) FROM pv WHERE {top_filter('pv', 'x', 1)}) AS DOUBLE) / nullif({LST}, 0), 6) AS pct_top1_venue
FROM s"""))
def rpt5_country_cards(spark, d):
    """RPT5 (FLT11, AGG5, TOP1)."""
    return R.country_cards(_star(spark, d, *R.CARDS), wh.venues(spark, d, "VenueCountry"), COUNTRY_SLICE)


@register("rpt6_venue_share", sql_with(["star"], f"""
WITH pv AS (SELECT TradingVenueSK, {LST} AS x FROM star GROUP BY TradingVenueSK),
g AS (SELECT TradingVenueSK, VenueMIC, MarketName, City, {LST} AS listings FROM star
      GROUP BY TradingVenueSK, VenueMIC, MarketName, City)
SELECT VenueMIC, MarketName, City, listings,
  round(CAST(listings AS DOUBLE) / nullif((SELECT {LST} FROM star), 0), 6) AS share
FROM g WHERE TradingVenueSK IN (SELECT TradingVenueSK FROM pv WHERE {top_filter('pv', 'x', 8)})"""))
def rpt6_venue_share(spark, d):
    """RPT6 (JOI12, AGG9, TOP3) -- the flagship query."""
    return R.venue_share(_star(spark, d, "TradingVenueSK", "InstrumentListingSK", "VenueMIC"), wh.venues(spark, d, "MarketName", "City"))


@register("rpt7_listings_by_venue_city", sql_with(["star"], _top_venue_sql(
    5, f"SELECT VenueMIC, City, {LST} AS listings FROM s GROUP BY VenueMIC, City")))
def rpt7_listings_by_venue_city(spark, d):
    """RPT7 (TOP3)."""
    return R.listings_by_venue_city(_star(spark, d, "TradingVenueSK", "InstrumentListingSK", "VenueMIC"), wh.venues(spark, d, "City"))


@register("rpt8_dominant_class_by_venue", sql_with(["star"], _top_venue_sql(5, f"""
, c AS (SELECT VenueMIC, Underlying_Class, {LST} AS listings FROM s GROUP BY VenueMIC, Underlying_Class)
SELECT VenueMIC, Underlying_Class, listings FROM (
  SELECT *, rank() OVER (PARTITION BY VenueMIC ORDER BY listings DESC NULLS LAST) rk FROM c) WHERE rk = 1""").replace(
    "\n\n,", ",")))
def rpt8_dominant_class_by_venue(spark, d):
    """RPT8 (WIN7, TOP3)."""
    return R.dominant_class_by_venue(_star(spark, d, "TradingVenueSK", "InstrumentListingSK", "VenueMIC", "Underlying_Class"))


@register("rpt9_issuers_by_country", sql_with(["star"], f"""
SELECT IssuerCountry, {dc('IssuerSK')} AS issuers FROM star GROUP BY IssuerCountry"""))
def rpt9_issuers_by_country(spark, d):
    """RPT9 (JOI12, AGG5)."""
    return R.issuers_by_country(_star(spark, d, "IssuerCountry", "IssuerSK"))


_REG = ", ".join(f"'{r}'" for r in R.REGIONS)


@register("rpt10_instruments_matrix", sql_with(["star"], f"""
WITH s AS (SELECT *, {DESC} AS cfi_desc FROM star WHERE IssuerRegion IN ({_REG})),
pc AS (SELECT IssuerCountry, {dc('InstrumentSK')} AS x FROM s GROUP BY IssuerCountry)
SELECT IssuerCountry, cfi_desc, {dc('InstrumentSK')} AS instruments FROM s
WHERE IssuerCountry IN (SELECT IssuerCountry FROM pc WHERE {top_filter('pc', 'x', 8)})
GROUP BY IssuerCountry, cfi_desc"""))
def rpt10_instruments_matrix(spark, d):
    """RPT10 (AGG14 long form, TOP3, FLT9 region list)."""
    return R.instruments_matrix(_star(spark, d, "IssuerRegion", "IssuerCountry", "Category", "InstrumentSK"))


@register("rpt11_region_cards", sql_with(["star"], f"""
SELECT {dc('InstrumentSK')} AS instruments, {dc('IssuerSK')} AS issuers FROM star WHERE IssuerRegion IN ('EUROPE')"""))
def rpt11_region_cards(spark, d):
    """RPT11 (AGG5, FLT11)."""
    return R.region_cards(_star(spark, d, "IssuerRegion", "InstrumentSK", "IssuerSK"), ["EUROPE"])


@register("rpt18_missing_shares", sql_with(["star"], ",\n".join(["SELECT " + ", ".join(
    f"round(coalesce(CAST(count(DISTINCT CASE WHEN {c} IS NULL THEN InstrumentListingSK END) + "
    f"max(CASE WHEN {c} IS NULL AND InstrumentListingSK IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / nullif({LST}, 0), 0.0), 6) AS {n}"
    for c, n in [("IssuerSK", "pct_without_issuer"), ("CFISK", "pct_without_cfi"),
                 ("CurrencySK", "pct_without_currency"), ("TradingVenueSK", "pct_without_venue")]) + " FROM star"])))
def rpt18_missing_shares(spark, d):
    """RPT18 (AGG7)."""
    return R.missing_shares(_star(spark, d, "InstrumentListingSK", "IssuerSK", "CFISK", "CurrencySK", "TradingVenueSK"))


# ----------------------------------------------------------------- entity reports
@register("rpt12_entities_by_country", sql_with(["entities"], f"""
WITH p AS (SELECT HeadquartersAddress_Country, count(DISTINCT LEI) AS nb_lei FROM entities GROUP BY 1)
SELECT * FROM p WHERE {top_filter('p', 'nb_lei', 8)}"""))
def rpt12_entities_by_country(spark, d):
    """RPT12 (AGG11, TOP3)."""
    return R.entities_by_country(fx.entities(spark, d))


_CAL = """(SELECT CAST(dd AS DATE) AS "Date", CAST(year(dd) AS INTEGER) AS Year, 'Q' || CAST(quarter(dd) AS VARCHAR) AS Quarter
  FROM (SELECT unnest(generate_series(min(InitialRegistrationDate), max(InitialRegistrationDate), INTERVAL 1 DAY)) AS dd
        FROM entities WHERE InitialRegistrationDate IS NOT NULL))"""


@register("rpt13_registrations_by_quarter", sql_with(["entities"], f"""
SELECT c.Year, c.Quarter, count(DISTINCT e.LEI) AS lei_created
FROM entities e JOIN {_CAL} c ON CAST(e.InitialRegistrationDate AS DATE) = c."Date"
WHERE e.InitialRegistrationDate IS NOT NULL GROUP BY c.Year, c.Quarter"""))
def rpt13_registrations_by_quarter(spark, d):
    """RPT13 (C12, AGG11)."""
    e = fx.entities(spark, d)
    return R.registrations_by_quarter(e, calendar(e, "InitialRegistrationDate"))


@register("rpt14_entities_by_status", sql_with(["entities"], """
SELECT EntityStatus, count(LEI) AS entities FROM entities GROUP BY EntityStatus"""))
def rpt14_entities_by_status(spark, d):
    """RPT14 (AGG12)."""
    return R.entities_by_status(fx.entities(spark, d))


@register("rpt15_entities_by_category", sql_with(["entities"], f"""
WITH p AS (SELECT EntityCategory, count(LEI) AS entities FROM entities GROUP BY EntityCategory)
SELECT * FROM p WHERE {top_filter('p', 'entities', 3)}"""))
def rpt15_entities_by_category(spark, d):
    """RPT15 (AGG12, TOP3)."""
    return R.entities_by_category(fx.entities(spark, d))


@register("rpt16_entities_by_legal_form", sql_with(["entities"], """
SELECT LegalForm, count(DISTINCT LEI) AS nb_lei FROM entities WHERE LegalForm IS NOT NULL
GROUP BY LegalForm HAVING count(DISTINCT LEI) > 10000"""))
def rpt16_entities_by_legal_form(spark, d):
    """RPT16 (AGG11, FLT9 with the report's threshold)."""
    return R.entities_by_legal_form(fx.entities(spark, d))


@register("rpt16_entities_by_legal_form_all", sql_with(["entities"], """
SELECT LegalForm, count(DISTINCT LEI) AS nb_lei FROM entities WHERE LegalForm IS NOT NULL
GROUP BY LegalForm HAVING count(DISTINCT LEI) > 1"""))
def rpt16_entities_by_legal_form_all(spark, d):
    """RPT16 with its threshold lowered to one entity (the default keeps no row of small tables)."""
    return R.entities_by_legal_form(fx.entities(spark, d), 1)


@register("rpt17_registrations_by_country_year", sql_with(["entities"], f"""
SELECT e.HeadquartersAddress_Country, c.Year, count(DISTINCT e.LEI) AS lei_created
FROM entities e JOIN {_CAL} c ON CAST(e.InitialRegistrationDate AS DATE) = c."Date"
WHERE e.InitialRegistrationDate IS NOT NULL AND c.Year > 2015
GROUP BY e.HeadquartersAddress_Country, c.Year HAVING count(DISTINCT e.LEI) > 600"""))
def rpt17_registrations_by_country_year(spark, d):
    """RPT17 (C12, AGG11, FLT9 with the report's thresholds)."""
    e = fx.entities(spark, d)
    return R.registrations_by_country_year(e, calendar(e, "InitialRegistrationDate"))


@register("rpt17_registrations_by_country_year_all", sql_with(["entities"], f"""
SELECT e.HeadquartersAddress_Country, c.Year, count(DISTINCT e.LEI) AS lei_created
FROM entities e JOIN {_CAL} c ON CAST(e.InitialRegistrationDate AS DATE) = c."Date"
WHERE e.InitialRegistrationDate IS NOT NULL AND c.Year > 1990
GROUP BY e.HeadquartersAddress_Country, c.Year HAVING count(DISTINCT e.LEI) > 1"""))
def rpt17_registrations_by_country_year_all(spark, d):
    """RPT17 with lowered thresholds (the defaults keep no row of small tables)."""
    e = fx.entities(spark, d)
    return R.registrations_by_country_year(e, calendar(e, "InitialRegistrationDate"), 1990, 1)


# ----------------------------------------------------------------- ledger (C16, AGG15, RPT19)
def event_ledger(spark, d):
    """C16 fixture: one ledger row per (day, event type) file of the events table."""
    e = fx.table(spark, d, "events")
    per = e.groupBy(F.to_date("ts").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("value") < 1.0, 1).otherwise(0)).alias("bad"),
        F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    return ledger_from_counts(
        per, F.concat(F.lit("load_"), F.col("event_type")),
        F.concat(F.lit("events_"), F.date_format("day", "yyyyMMdd"), F.lit("_"), F.col("event_type"), F.lit(".psv")),
        F.col("n"), F.col("bad"), F.col("t0"), F.col("t1"))


add_cte("ledger", [], """
SELECT 'load_' || event_type AS process_name,
  'events_' || strftime(day, '%Y%m%d') || '_' || event_type || '.psv' AS file_name,
  CASE WHEN n - bad > 0 OR n = 0 THEN 'END' ELSE 'ERROR' END AS status,
  t0 AS load_start_ts, t1 AS load_end_ts, n AS rows_read, CAST(n - bad AS BIGINT) AS rows_inserted,
  CAST(bad AS BIGINT) AS rows_rejected,
  CAST(NULL AS VARCHAR) AS error_message
FROM (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, sum(CASE WHEN value < 1.0 THEN 1 ELSE 0 END) AS bad,
        min(ts) AS t0, max(ts) AS t1 FROM events GROUP BY 1, 2)""")


@register("c16_ledger", sql_with(["ledger"], "SELECT * FROM ledger"))
def c16_ledger(spark, d):
    """C16: ledger rows (read / inserted / rejected per file) computed by Spark."""
    return event_ledger(spark, d)


@register("agg15_ledger_summary", sql_with(["ledger"], """
SELECT process_name, count(DISTINCT file_name) AS total_files, CAST(coalesce(sum(rows_read), 0) AS BIGINT) AS total_read,
  CAST(coalesce(sum(rows_inserted), 0) AS BIGINT) AS total_inserted,
  CAST(sum(CASE WHEN status = 'ERROR' THEN 1 ELSE 0 END) AS BIGINT) AS failed_files,
  CASE WHEN coalesce(sum(rows_read), 0) > 0
       THEN round(CAST(coalesce(sum(rows_inserted), 0) AS DOUBLE) / coalesce(sum(rows_read), 0) * 100.0, 2) ELSE 0.0 END AS success_rate
FROM ledger GROUP BY process_name"""))
def agg15_ledger_summary(spark, d):
    """AGG15: per process totals and success rate."""
    return ledger_summary(event_ledger(spark, d), ["process_name"])


@register("rpt19_recent_loads", sql_with(["ledger"], """
SELECT * FROM ledger WHERE load_start_ts >= (SELECT max(ts) FROM events) - INTERVAL 48 HOUR
ORDER BY load_start_ts DESC NULLS LAST, file_name DESC NULLS LAST LIMIT 10"""))
def rpt19_recent_loads(spark, d):
    """RPT19 (FLT8, TOP4): the 10 most recent loads in the 48 hours before the
    latest event (a fixed "now" so the result is reproducible)."""
    now = fx.table(spark, d, "events").select(F.max("ts")).scalar()
    return recent_loads(event_ledger(spark, d), 48, 10, now=now)


@register("agg14_matrix", sql_with(["star"], f"""
SELECT IssuerCountry, {', '.join(f"count(DISTINCT CASE WHEN substr(CfiCode, 1, 1) = '{x}' THEN InstrumentSK END) AS {x}" for x in 'EDCROFSHMJ')}
FROM star GROUP BY IssuerCountry"""))
def agg14_matrix(spark, d):
    """AGG14: pivot country x classification category letter -> distinct instruments
    (explicit value list, so no extra pass to discover the pivot values)."""
    s = _star(spark, d, "IssuerCountry", "CfiCode", "InstrumentSK").withColumn("cat", F.substring("CfiCode", 1, 1))
    letters = list("EDCROFSHMJ")
    m = matrix(s, ["IssuerCountry"], "cat", letters, F.count_distinct("InstrumentSK"))
    return m.select("IssuerCountry", *[F.coalesce(F.col(x), F.lit(0)).alias(x) for x in letters])


@register("agg14_matrix_totals", sql_with(["star"], f"""
WITH s AS (SELECT *, substr(CfiCode, 1, 1) AS cat FROM star)
SELECT IssuerCountry, cat, CAST(grouping(cat) AS INTEGER) AS row_total, CAST(grouping(IssuerCountry) AS INTEGER) AS col_total,
  {dc('InstrumentSK')} AS instruments
FROM s GROUP BY GROUPING SETS ((IssuerCountry, cat), (IssuerCountry), (cat), ())"""))
def agg14_matrix_totals(spark, d):
    """AGG14: distinct instruments per country x category letter with row, column and grand
    totals, all counted over united sets."""
    s = _star(spark, d, "IssuerCountry", "CfiCode", "InstrumentSK").withColumn("cat", F.substring("CfiCode", 1, 1))
    sets = distinct_sets(s, ["IssuerCountry", "cat"], ["InstrumentSK"])
    return matrix_totals(sets, "IssuerCountry", "cat", "instruments")


@register("agg5_cards_by_country", sql_with(["star"], f"""
SELECT VenueCountry, {dc('InstrumentSK')} AS instruments, {LST} AS listings, {dc('IssuerSK')} AS issuers,
  {dc('TradingVenueSK')} AS venues FROM star GROUP BY VenueCountry"""))
def agg5_cards_by_country(spark, d):
    """AGG5: the cards per venue country from the sets stored beside the snapshot (days united)."""
    return set_counts(wh.card_sets(spark, d), ["VenueCountry"], R.CARDS)


_JOI10 = [("fact", "ISIN"), ("venue", "TradingVenueMIC"), ("venue_info", "MIC"), ("venue_country", "CountryCode"),
          ("issuer", "IssuerLEI"), ("issuer_instruments", "CAST(IssuerSK AS VARCHAR)"), ("country", "CountryCode"),
          ("lei", "LEI"), ("currency", "CurrencyCode"), ("cfi", "CFI"), ("instrument", "ISIN")]


@register("joi10_filter_propagation", sql_with(["fact", "d_venue", "register", "d_issuer", "entities", "d_currency",
                                                "d_cfi_keys", "d_instrument"], """
WITH venue_info AS (SELECT * FROM register WHERE City IN ('CITY_3', 'CITY_7', 'CITY_11')),
venue AS (SELECT * FROM d_venue WHERE TradingVenueMIC IN (SELECT MIC FROM venue_info)),
venue_country AS (SELECT DISTINCT Country AS CountryCode FROM register WHERE Country IS NOT NULL),
issuer_instruments AS (
  SELECT * FROM (SELECT IssuerSK, count(DISTINCT InstrumentSK) AS cnt FROM fact GROUP BY IssuerSK) WHERE cnt >= 3),
issuer AS (SELECT * FROM d_issuer WHERE IssuerSK IN (SELECT IssuerSK FROM issuer_instruments WHERE IssuerSK IS NOT NULL)),
country AS (
  SELECT CountryCode FROM (SELECT LegalAddress_Country AS CountryCode FROM d_issuer
                           UNION SELECT HeadquartersAddress_Country FROM entities)
  WHERE CountryCode IN (SELECT LegalAddress_Country FROM issuer WHERE LegalAddress_Country IS NOT NULL)),
lei AS (SELECT * FROM entities WHERE HeadquartersAddress_Country IN (SELECT CountryCode FROM country)),
f AS (SELECT * FROM fact WHERE TradingVenueSK IN (SELECT TradingVenueSK FROM venue)
                           AND IssuerSK IN (SELECT IssuerSK FROM issuer))
""" + "UNION ALL\n".join(
    f"SELECT '{t}' AS tbl, count(*) AS n, count(DISTINCT {c}) AS n_keys, min({c}) AS lo, max({c}) AS hi FROM "
    f"{ {'fact': 'f', 'currency': 'd_currency', 'cfi': 'd_cfi_keys', 'instrument': 'd_instrument'}.get(t, t) }\n"
    for t, c in _JOI10)))
def joi10_filter_propagation(spark, d):
    """JOI10: a filter on the venue register (one-to-one, both ways) and one on the issuers' instrument
    counts (both ways, then through the countries to the entities): what each table keeps."""
    left = wh.report_model(spark, d).filtered({"venue_info": F.col("City").isin("CITY_3", "CITY_7", "CITY_11"),
                                               "issuer_instruments": F.col("cnt") >= 3})
    out = None
    for t, c in _JOI10:
        key = F.col("IssuerSK").cast("string") if c.startswith("CAST") else F.col(c)
        one = left[t].agg(F.lit(t).alias("tbl"), F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("n_keys"),
                          F.min(key).alias("lo"), F.max(key).alias("hi"))
        out = one if out is None else out.unionByName(one)
    return out
