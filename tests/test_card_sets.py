"""AGG5 and JOI12 where venues share their register rows' countries, or have sets of their own."""

from test_star import shared_codes  # noqa: F401  (tables of their own)

import tempfile

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def scratch():
    return tempfile.mkdtemp(prefix="refmart-cards-", dir="/tmp")


def test_venues_of_the_same_countries_are_one_class(spark):
    from refmart.plans.warehouse import venue_classes
    places = {1: ["x", "y"], 2: ["y", "x"], 3: ["x"], 4: [None, "x"], 5: ["x", None], 6: [None], 7: [None], 8: ["x", "y"]}
    df = spark.createDataFrame([(v, c) for v, cs in places.items() for c in cs], "TradingVenueSK long, VenueCountry string")
    members, countries = venue_classes(df)
    of = {r.TradingVenueSK: r["__class"] for r in members.collect()}
    assert of == {1: 1, 2: 1, 8: 1, 3: 3, 4: 4, 5: 4, 6: 6, 7: 6}
    assert sorted(map(tuple, countries.collect()), key=str) == sorted([(1, "x"), (1, "y"), (3, "x"), (4, "x"), (4, None), (6, None)], key=str)


def test_sets_are_built_per_class_not_per_venue(spark, shared_codes, monkeypatch):
    """The fact's rows are counted into the sets of venue classes, of which there may be far fewer than venues."""
    from refmart.plans import warehouse as wh
    seen, real = [], wh.word_sets
    monkeypatch.setattr(wh, "word_sets", lambda df, by, of: seen.append((df, by)) or real(df, by, of))
    monkeypatch.setattr(wh, "_memo", lambda spark, d, name, build: build())
    real_star = wh.star(spark, shared_codes, "SnapshotDate", *["InstrumentSK", "InstrumentListingSK", "IssuerSK", "TradingVenueSK"])
    monkeypatch.setattr(wh, "star", lambda *a: real_star)
    same = spark.createDataFrame([(v, c) for v in range(1, 1000) for c in ("x", "y")], "TradingVenueSK long, VenueCountry string")
    monkeypatch.setattr(wh, "venues", lambda *a: same)
    sets = wh.card_sets(spark, shared_codes)
    (rows, by), = seen
    assert by == ["SnapshotDate", "__class"]
    assert rows.count() == real_star.count()        # a row meets one class at most
    known = rows.where("TradingVenueSK IS NOT NULL")
    assert [r[0] for r in known.select("__class").distinct().collect()] == [1] and known.select("TradingVenueSK").distinct().count() > 3
    assert {r[0] for r in sets.select("VenueCountry").distinct().collect()} == {"x", "y"} | ({None} if rows.where("TradingVenueSK IS NULL").count() else set())


def test_the_star_view_joins_the_paths_to_its_columns(spark, shared_codes):
    """JOI12 shows no column of the instrument: that dimension is not joined; the rows are those of the whole view."""
    from __spark_entry__ import queries
    from refmart.plans import warehouse as wh
    df = queries()["joi12_star_view"](spark, shared_codes)
    joins = [x for x in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join LeftOuter" in x]
    assert not any("(InstrumentSK#" in x for x in joins) and any("(IssuerSK#" in x for x in joins)
    whole = wh.star_view(spark, shared_codes).select(*df.columns)
    assert df.count() == whole.count() and df.exceptAll(whole).count() == 0


def test_amounts_of_the_feed_are_as_formatted(spark):
    """FX1: the texts of amounts and days are those of ``format_string`` and ``date_format``."""
    import math
    import random
    from refmart.plans.fixtures import _d, _fixed
    rng = random.Random(3)
    values = [None, 0.0, -0.0, 0.5, 1.5, 2.5, 0.005, 0.015, 1.005, 2.675, 0.125, 0.375, 1e-9, 1e14 + 0.3, 999999999999999.9, 1e15, 1e22, -1.005, -0.001,
              math.nan, math.inf, -math.inf, 0.994999, 0.995, 8.5] + [round(rng.uniform(0, 10 ** rng.randint(0, 9)), rng.randint(0, 6)) for _ in range(20000)] \
        + [rng.uniform(0, 10 ** rng.randint(0, 15)) for _ in range(20000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for n in (0, 2):
        assert df.where(_fixed(F.col("x"), n) != F.format_string(f"%.{n}f", "x")).collect() == []
        assert df.where(_fixed(F.col("x"), n).isNull()).count() == 0
    days = spark.sql("SELECT timestamp_ntz'1995-01-01 23:59:59' AS t UNION ALL SELECT NULL UNION ALL SELECT timestamp_ntz'2024-02-29 00:00:00'")
    for t in (F.col("t"), F.col("t").cast("timestamp"), F.col("t").cast("date")):
        assert days.where(~_d(t).eqNullSafe(F.date_format(t, "yyyy-MM-dd"))).count() == 0
