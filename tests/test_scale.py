"""Work that must not grow with copies: venues with many register rows, stages read more than once."""

import random
import tempfile
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from test_star import shared_codes  # noqa: F401  (tables of their own)


@pytest.fixture(scope="module")
def scratch():
    return tempfile.mkdtemp(prefix="refmart-scale-", dir="/tmp")


def test_sets_of_venues_unite_into_those_of_their_countries(spark):
    from refmart.operators.bitmaps import set_counts, united_sets, word_sets
    rng = random.Random(5)
    rows = [(rng.choice(["d1", "d2"]), rng.choice([1, 2, 3, 9, None]), rng.choice([None, rng.randint(1, 100_000)]),
             rng.choice([1, 64, 65, 128, 129, None])) for _ in range(2000)]
    places = [(1, "x"), (1, "y"), (2, "y"), (3, None)]      # venue 9 and the blank venue have no row
    df = spark.createDataFrame(rows, "day string, venue long, a long, b int").repartition(4)
    groups = spark.createDataFrame(places, "venue long, country string")
    sets = united_sets(word_sets(df, ["day", "venue"], ["a", "b"]), "venue", groups, ["day", "country"])
    want = defaultdict(lambda: (set(), set()))
    for d, v, a, b in rows:
        for c in [c for p, c in places if p == v] or [None]:
            want[c][0].add(a)
            want[c][1].add(b)
    for blank in (True, False):
        got = {r.country: (r.na, r.nb) for r in set_counts(sets, ["country"], {"a": "na", "b": "nb"}, blank).collect()}
        assert got == {c: tuple(len(s) if blank else len(s - {None}) for s in v) for c, v in want.items()}


def test_sets_are_shuffled_before_they_meet_their_groups(spark):
    """However many groups a value has, no exchange holds a copy of its sets per group."""
    from refmart.operators.bitmaps import united_sets, word_sets
    df = spark.createDataFrame([("d", 1, 2)], "day string, venue long, a long")
    groups = spark.createDataFrame([(1, "x")], "venue long, country string")
    plan = united_sets(word_sets(df, ["day", "venue"], ["a"]), "venue", groups, ["day", "country"])._jdf \
        .queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert "hashpartitioning(day" in plan and "hashpartitioning(country" not in plan.replace("day", "") \
        and plan.index("BroadcastHashJoin") < plan.index("hashpartitioning(of")


def test_reports_cut_the_rows_before_they_join_the_register(spark):
    """RPT3, RPT5, RPT7: a venue of many register rows copies only the rows of the venues shown, or none."""
    from refmart.plans import reports as R
    star = spark.createDataFrame([(sk, f"M{sk % 3}", sk % 3, sk, sk) for sk in range(30)],
                                 "InstrumentListingSK long, VenueMIC string, TradingVenueSK long, InstrumentSK long, IssuerSK long")
    many = spark.range(3).select(F.col("id").alias("TradingVenueSK"), F.explode(F.sequence(F.lit(1), F.lit(50))).alias("n"))
    cities = many.select("TradingVenueSK", F.concat(F.lit("c"), "n").alias("City")).where("n <= 40 or TradingVenueSK = 1")
    countries = many.select("TradingVenueSK", F.concat(F.lit("n"), "n").alias("VenueCountry"))
    by_city = {r.City: r.listings for r in R.listings_by_city(star, cities).collect()}
    assert by_city["c1"] == 30 and by_city["c50"] == 10 and len(by_city) == 50
    assert R.listings_by_venue_city(star, cities).count() == 40 + 50 + 40
    cards = R.country_cards(star, countries, ["n1", "n2"])
    assert tuple(cards.first()) == (30, 30, 30, 3, round(1.0, 6))      # ties: all three venues are the top one
    assert "LeftSemi" in cards._jdf.queryExecution().optimizedPlan().toString()


def test_merged_sources_are_written_once(spark, shared_codes):
    """C5 again: both loads and the last join read one written merge."""
    from __spark_entry__ import queries
    df = queries()["c5_enrich_again"](spark, shared_codes)
    assert "min_by(" not in df._jdf.queryExecution().optimizedPlan().toString().replace("minby(", "min_by(")
    assert df.count() > 0


def _full(n, end="</FinInstrmRptgRefDataRpt>"):
    return "<FinInstrmRptgRefDataRpt><RptHdr><RptgNtty><NtlCmptntAuthrty>FR</NtlCmptntAuthrty></RptgNtty></RptHdr>" + "".join(
        f"<RefData><FinInstrmGnlAttrbts><Id>XS{i:010d}</Id></FinInstrmGnlAttrbts><Issr>L{i}</Issr></RefData>" for i in range(n)) + end


def test_a_record_is_parsed_once(spark, tmp):
    """SRC1, SRC2: the filters on the key columns must not parse the record again."""
    from refmart.sources.xml import read_delta_xml, read_full_xml
    with open(f"{tmp}/a.xml", "w") as f:
        f.write(_full(3))
    for df in (read_full_xml(spark, f"{tmp}/a.xml"), read_delta_xml(spark, f"{tmp}/a.xml")):     # a record and a header
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_xml(") == 2
    assert read_full_xml(spark, f"{tmp}/a.xml").count() == 3


def test_compressed_xml_files(spark, tmp):
    """Header and records of a gzip file; one that ends within a record is refused."""
    import gzip
    from refmart.sources.xml import read_full_xml
    for name, text in [("a.xml.gz", _full(3)), ("b.xml.gz", _full(2)), ("cut.xml.gz", _full(2, "<RefData><Issr>x</Issr>"))]:
        with gzip.open(f"{tmp}/{name}", "wt") as f:
            f.write(text)
    rows = read_full_xml(spark, [f"{tmp}/a.xml.gz", f"{tmp}/b.xml.gz"]).collect()
    assert sorted((r.SourceFileName, r.ISIN[-1], r.IssuerLEI, r.HeaderReportingNCA) for r in rows) == [
        ("a.xml.gz", "0", "L0", "FR"), ("a.xml.gz", "1", "L1", "FR"), ("a.xml.gz", "2", "L2", "FR"),
        ("b.xml.gz", "0", "L0", "FR"), ("b.xml.gz", "1", "L1", "FR")]
    with pytest.raises(ValueError, match="cut.xml.gz ends within a record"):
        read_full_xml(spark, f"{tmp}/cut.xml.gz")


def test_staged_tables_hold_what_the_loads_read(spark, shared_codes):
    """JOI4, the star: the typed stage keeps the columns read after it, as small files."""
    from __spark_entry__ import queries
    from refmart.operators.cdc import type_instruments
    from refmart.plans import fixtures as fx, warehouse as wh
    typed = set(type_instruments(fx.wide(spark, shared_codes)).columns)
    for columns in (wh.MERGED_COLUMNS, wh.STAGED_COLUMNS):
        assert set(columns) < typed and not {"SourceFileName", "ExpiryDate", "StrikePrice"} & set(columns)
    files = queries()["joi4_full_merge"](spark, shared_codes).inputFiles()
    assert files and all("typed_merged" in f and f.endswith(".zstd.parquet") for f in files)
    merged, whole = wh.merge_sources(spark, shared_codes), wh.enrichment(wh.staging(spark, shared_codes))
    assert merged.count() == whole.count() > 0 and merged.exceptAll(whole.select(*merged.columns)).count() == 0


def test_numbered_rows_are_written_once(spark, monkeypatch):
    """C13: the rows go to the shared disk with their numbers, not before as well."""
    from refmart import session
    from refmart.operators.dims import assign_keys
    written, cut = [], session.cut_lineage
    monkeypatch.setattr(session, "cut_lineage", lambda df, name="stage": written.append(name) or cut(df, name))
    rows = assign_keys(spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")).distinct(), ["k"], "sk", 5)
    assert written == ["keys"]
    assert {r.k: r.sk for r in rows.collect()} == {k: k + 6 for k in range(1000)}


def test_listing_pair_comes_from_one_narrow_pass(spark, shared_codes):
    """C3: no joins with parts and customers, one written stage for both sides; parts that are there twice change nothing."""
    from refmart.plans import fixtures as fx
    plan = fx.wide_lines(spark, shared_codes)._jdf.queryExecution().optimizedPlan().toString()
    assert "p_partkey" not in plan and "c_custkey" not in plan
    dim, new = fx.listing_pair(spark, shared_codes)
    assert all("lst_sides" in f for f in new.inputFiles()) and not any("lst_sides" in f for f in dim.inputFiles())
    w = fx.wide(spark, shared_codes)
    for side, cond in ((dim, "ValidFromDate < '1999-01-01'"), (new, "ValidFromDate >= '1999-01-01'")):
        want = w.where(cond).groupBy("ISIN", "TradingVenueMIC").agg(F.max("ValidFromDate").alias("ValidFromDate"))
        got = side.select(*want.columns)
        assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_the_loads_do_not_shuffle_the_typed_stage(spark, shared_codes):
    """C2, the star: the typed stage lies in buckets by ISIN, so the loads that keep one row per ISIN and date or
    venue read it without a shuffle; it holds the rows that the typing gives without buckets."""
    from refmart.operators.cdc import type_instruments
    from refmart.plans import fixtures as fx, warehouse as wh
    listing = wh.staged(spark, shared_codes)["listing"]
    for source in (wh.instrument_source(listing), wh.listing_source(listing)):
        plan = source._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
    plain = type_instruments(fx.wide(spark, shared_codes))
    bucketed = type_instruments(fx.wide(spark, shared_codes), isin_buckets=3).select(*plain.columns)
    assert plain.count() > 0 and plain.exceptAll(bucketed).count() == 0 and bucketed.exceptAll(plain).count() == 0
    kept = listing.exceptAll(plain.select(*listing.columns))
    assert kept.count() == 0 and listing.count() == plain.count()


def test_typed_columns_are_parsed_before_the_shuffle(spark):
    """C2: the raw keys decide which row stays, also where they become equal by trimming."""
    from refmart.operators.cdc import type_instruments
    rows = spark.createDataFrame([(" A", "L", "M", "2024-01-01", "1", True, "1"), ("A", "L", "M", "2024-02-01", "1", True, "n/a"),
                                  ("A", "L", "M", "2024-02-01", "2", True, "0"), (None, "L", "M", None, "3", True, "1"),
                                  ("A", "L", "M", "2024-03-01", "9", False, "1")],
                                 "ISIN string, IssuerLEI string, TradingVenueMIC string, ValidFromDate string, TechRcrdId string, "
                                 "LatestRecordFlag boolean, CommodityDerivativeInd string").withColumn("ValidToDate", F.lit(None).cast("date"))
    for buckets in (None, 3):
        got = type_instruments(rows, buckets)
        assert sorted((r.ISIN or "", str(r.ValidFromDate), r.TechRcrdId, r.CommodityDerivativeInd) for r in got.collect()) == [
            ("", "None", "3", True), ("A", "2024-01-01", "1", True), ("A", "2024-02-01", "2", False)]
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Window") < plan.index("lower(")


def test_a_report_joins_the_paths_it_reads(spark, shared_codes):
    """The star is not written: a report's columns alone are read from the fact, and only the dimensions that bring one joined."""
    from __spark_entry__ import queries
    from refmart.plans import fixtures as fx, warehouse as wh
    whole = wh.star(spark, shared_codes)
    for columns in (["TradingVenueSK", "InstrumentListingSK"], ["IssuerCountry", "CfiCode", "InstrumentSK"],
                    ["InstrumentCFI", "VenueMIC", "VenueRows"]):
        some = wh.star(spark, shared_codes, *columns)
        assert some.count() > 0 and some.exceptAll(whole.select(*columns)).count() == 0 == whole.select(*columns).exceptAll(some).count()
    for name in ["agg10_agg_by_issuer", "rpt18_missing_shares"]:
        plan = queries()[name](spark, shared_codes)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "TotalIssuedNominalAmount" not in plan.split("Relation [")[0], name
    assert not any(k[2] == "star" for k in fx._STAGES)
