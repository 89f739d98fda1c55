"""Report queries (inventory RPT1-RPT19) composed from the measure operators.

Each takes the star view (fact + dimensions along their paths) or the entity
table and returns a small result frame. Counts are distinct counts with the
report engine's blank-member rule; ratios are blank on a zero denominator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import between, overview_subtitle, trading_subtitle
from ..operators.bitmaps import distinct_sets, set_counts
from ..operators.measures import distinct_count, missing_shares_of, ratio, share_of_total, top_share
from ..operators.windows import keep_top_keys, top_in_group, top_rows

# --------------------------------------------------------------------------
# Fixed values taken from the report definition.
# --------------------------------------------------------------------------
REGIONS = ["AFRICA", "AMERICAS", "ASIA", "EUROPE", "MIDDLE EAST", "OCEANIA"]
DESC_REPLACE = ("souvent OTC", "hybride/structuré")
TOP_CLASSIFICATIONS = 30
TOP_VENUES_CITY, TOP_VENUES_BAR, TOP_VENUES_TABLE, TOP_VENUES_CITY_BAR, TOP_VENUES_CLASS = 7, 6, 8, 5, 5
TOP_ENTITY_COUNTRIES, TOP_ENTITY_CATEGORIES, TOP_MATRIX_COUNTRIES = 8, 3, 8
LEGAL_FORM_MIN = 10000
REGISTRATION_YEAR_AFTER, REGISTRATION_MIN = 2015, 600
# --------------------------------------------------------------------------


def _r6(c: Column) -> Column:
    return F.round(c, 6)


def listings() -> Column:
    return distinct_count("InstrumentListingSK")


def per_venue(star: DataFrame) -> DataFrame:
    return star.groupBy("TradingVenueSK").agg(listings().alias("x"))


CARDS = {"InstrumentSK": "instruments", "InstrumentListingSK": "listings", "IssuerSK": "issuers",
         "TradingVenueSK": "venues"}


def card_counts(star: DataFrame) -> DataFrame:
    """AGG5: the four distinct counts in one pass over the rows (one row)."""
    return set_counts(distinct_sets(star, [], list(CARDS)), [], CARDS)


def kpi_cards(star: DataFrame, records: Column | None = None) -> DataFrame:
    """RPT1: instruments, listings, issuers, venues, three ratios, top-10 venue
    and issuer shares and the subtitles -- one row. ``records``: the aggregate that
    counts the model's records, where a row of ``star`` stands for several."""
    agg_issuer = star.groupBy("IssuerSK").agg(distinct_count("InstrumentSK").alias("cnt"))
    top10_venues = top_share(per_venue(star), "x", 10, star.select(listings()).scalar())
    top10_issuers = top_share(agg_issuer, "cnt", 10, agg_issuer.select(F.sum("cnt")).scalar())
    k = card_counts(star).withColumns({
        "__lo": star.select(F.min("SnapshotDate")).scalar(), "__hi": star.select(F.max("SnapshotDate")).scalar(),
        "__n": star.select(F.count(F.lit(1)) if records is None else records).scalar()})
    return k.select(
        "instruments", "listings", "issuers", "venues",
        _r6(ratio(F.col("listings"), F.col("instruments"))).alias("listings_per_instrument"),
        _r6(ratio(F.col("instruments"), F.col("issuers"))).alias("instruments_per_issuer"),
        _r6(ratio(F.col("instruments"), F.col("venues"))).alias("instruments_per_venue"),
        _r6(top10_venues).alias("pct_top10_venues"), _r6(top10_issuers).alias("pct_top10_issuers"),
        overview_subtitle("__lo", "__hi", "__n").alias("overview_subtitle"),
        trading_subtitle("__hi").alias("trading_subtitle"))


def cfi_desc(c: str = "Category") -> Column:
    return F.replace(between(c), F.lit(DESC_REPLACE[0]), F.lit(DESC_REPLACE[1]))


def listings_by_classification(star: DataFrame, n: int = TOP_CLASSIFICATIONS) -> DataFrame:
    """RPT2: listings per classification code (with its description) for the top-n codes."""
    per_code = star.groupBy("CfiCode").agg(listings().alias("listings"))
    top = per_code.join(top_rows(per_code, "listings", n).select("CfiCode"), "CfiCode", "left_semi")
    desc = star.select("CfiCode", "Category").distinct()
    return top.join(desc, "CfiCode", "left").select("CfiCode", cfi_desc().alias("cfi_desc"), "listings")


def _top_venue_rows(star: DataFrame, n: int) -> DataFrame:
    return keep_top_keys(star, "TradingVenueSK", per_venue(star), "x", n)


def listings_by_city(star: DataFrame, venues: DataFrame, n: int = TOP_VENUES_CITY) -> DataFrame:
    """RPT3: listings per venue city, restricted to the top-n venues. ``venues``: the distinct
    cities of each venue key."""
    return _top_venue_rows(star, n).join(venues, "TradingVenueSK", "left").groupBy("City").agg(listings().alias("listings"))


def listings_by_venue(star: DataFrame, venues: DataFrame, n: int = TOP_VENUES_BAR) -> DataFrame:
    """RPT4 + AGG13: listings per venue (top-n) with the first market name (``venues``: those
    of each venue key) as tooltip."""
    first = venues.groupBy("TradingVenueSK").agg(F.min("MarketName").alias("MarketName"))
    return _top_venue_rows(star, n).join(first, "TradingVenueSK", "left").groupBy("VenueMIC").agg(
        listings().alias("listings"), F.min("MarketName").alias("market_name"))


def country_cards(star: DataFrame, venues: DataFrame, countries: list[str]) -> DataFrame:
    """RPT5 + FLT11 + TOP1: cards under a venue-country slicer: of the rows whose venue has one of
    the countries in ``venues`` (the countries of each venue key; the keys left are broadcast)."""
    s = star.join(F.broadcast(venues.filter(F.col("VenueCountry").isin(countries))), "TradingVenueSK", "left_semi")
    top1 = top_share(per_venue(s), "x", 1, s.select(listings()).scalar())
    return card_counts(s).withColumn("pct_top1_venue", _r6(top1))


def venue_share(star: DataFrame, venues: DataFrame, n: int = TOP_VENUES_TABLE) -> DataFrame:
    """RPT6 + AGG9 + TOP3: venue table (city, code, name, listings, share of all
    listings) for the top-n venues. ``venues``: the distinct names and cities of each venue
    key; all of a venue's rows have its listings. A venue key has one code, so the shares hold a
    row per venue, and the top ones are found among them."""
    shares = share_of_total(star, ["TradingVenueSK", "VenueMIC"], "InstrumentListingSK")
    return top_rows(shares, "listings", n).filter(F.col("TradingVenueSK").isNotNull()) \
        .join(venues, "TradingVenueSK", "left") \
        .select("VenueMIC", "MarketName", "City", "listings", _r6(F.col("share")).alias("share"))


def listings_by_venue_city(star: DataFrame, venues: DataFrame, n: int = TOP_VENUES_CITY_BAR) -> DataFrame:
    """RPT7: listings per (venue, city) for the top-n venues. ``venues``: as in RPT3."""
    return _top_venue_rows(star, n).join(venues, "TradingVenueSK", "left").groupBy("VenueMIC", "City") \
        .agg(listings().alias("listings"))


def dominant_class_by_venue(star: DataFrame, n: int = TOP_VENUES_CLASS) -> DataFrame:
    """RPT8 + WIN7: per top-n venue, listings of its dominant underlying class (ties kept)."""
    cells = _top_venue_rows(star, n).groupBy("VenueMIC", "Underlying_Class").agg(listings().alias("listings"))
    return top_in_group(cells, ["VenueMIC"], "listings", 1)


def issuers_by_country(star: DataFrame) -> DataFrame:
    """RPT9: distinct issuers per issuer country (blank country kept)."""
    return star.groupBy("IssuerCountry").agg(distinct_count("IssuerSK").alias("issuers"))


def instruments_matrix(star: DataFrame, regions: list[str] = REGIONS, n: int = TOP_MATRIX_COUNTRIES) -> DataFrame:
    """RPT10 + AGG14 (long form) + FLT9: instruments per issuer country x
    classification description, region filter, top-n countries."""
    s = star.filter(F.col("IssuerRegion").isin(regions)).withColumn("cfi_desc", cfi_desc())
    per_country = s.groupBy("IssuerCountry").agg(distinct_count("InstrumentSK").alias("x"))
    s = keep_top_keys(s, "IssuerCountry", per_country, "x", n)
    return s.groupBy("IssuerCountry", "cfi_desc").agg(distinct_count("InstrumentSK").alias("instruments"))


def region_cards(star: DataFrame, regions: list[str]) -> DataFrame:
    """RPT11: instruments and issuers under a region slicer."""
    s = star.filter(F.col("IssuerRegion").isin(regions))
    return s.agg(distinct_count("InstrumentSK").alias("instruments"), distinct_count("IssuerSK").alias("issuers"))


def missing_shares(star: DataFrame) -> DataFrame:
    """RPT18 + AGG7: share of listings without issuer / classification / currency / venue."""
    names = {"IssuerSK": "pct_without_issuer", "CFISK": "pct_without_cfi", "CurrencySK": "pct_without_currency",
             "TradingVenueSK": "pct_without_venue"}
    return missing_shares_of(star, "InstrumentListingSK", names).select(*[_r6(F.col(n)).alias(n) for n in names.values()])


# ----------------------------------------------------------------- entity reports
def nb_lei() -> Column:
    return F.count_distinct("LEI")


def entities_by_country(ents: DataFrame, n: int = TOP_ENTITY_COUNTRIES) -> DataFrame:
    """RPT12 + AGG11 + TOP3: entities per headquarters country, top-n."""
    per = ents.groupBy("HeadquartersAddress_Country").agg(nb_lei().alias("nb_lei"))
    return top_rows(per, "nb_lei", n)


def registrations_by_quarter(ents: DataFrame, cal: DataFrame) -> DataFrame:
    """RPT13 + C12 + AGG11: entities created per (year, quarter) of registration."""
    j = ents.filter(F.col("InitialRegistrationDate").isNotNull()) \
        .join(cal, F.to_date(F.col("InitialRegistrationDate")) == F.col("Date"))
    return j.groupBy("Year", "Quarter").agg(nb_lei().alias("lei_created"))


def entities_by_status(ents: DataFrame) -> DataFrame:
    """RPT14 + AGG12: non-null entity count per status."""
    return ents.groupBy("EntityStatus").agg(F.count("LEI").alias("entities"))


def entities_by_category(ents: DataFrame, n: int = TOP_ENTITY_CATEGORIES) -> DataFrame:
    """RPT15 + AGG12 + TOP3: non-null entity count per category, top-n."""
    per = ents.groupBy("EntityCategory").agg(F.count("LEI").alias("entities"))
    return top_rows(per, "entities", n)


def entities_by_legal_form(ents: DataFrame, minimum: int = LEGAL_FORM_MIN) -> DataFrame:
    """RPT16 + FLT9: legal forms (not null) with more than ``minimum`` entities."""
    per = ents.filter(F.col("LegalForm").isNotNull()).groupBy("LegalForm").agg(nb_lei().alias("nb_lei"))
    return per.filter(F.col("nb_lei") > minimum)


def registrations_by_country_year(ents: DataFrame, cal: DataFrame, after: int = REGISTRATION_YEAR_AFTER,
                                  minimum: int = REGISTRATION_MIN) -> DataFrame:
    """RPT17 + FLT9: registrations per (country, year) after ``after`` with more than
    ``minimum`` entities (a HAVING filter)."""
    j = ents.filter(F.col("InitialRegistrationDate").isNotNull()) \
        .join(cal.filter(F.col("Year") > after), F.to_date(F.col("InitialRegistrationDate")) == F.col("Date"))
    per = j.groupBy("HeadquartersAddress_Country", "Year").agg(nb_lei().alias("lei_created"))
    return per.filter(F.col("lei_created") > minimum)
