"""Filter propagation over relationships, and distinct counts by mergeable bitmaps."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from refmart.operators.bitmaps import distinct_sets, matrix_totals, set_counts
from refmart.operators.model import Model, Relationship


def _model(spark, both):
    def table(rows, ddl):
        return spark.createDataFrame(rows, ddl)
    tables = {
        "sales": table([(1, 1, 10), (2, 1, 20), (3, 2, 10), (4, None, 20), (5, 9, 10)], "id int, shop int, item int"),
        "shop": table([(1, "x"), (2, "y"), (3, "y"), (4, None)], "shop int, land string"),
        "land": table([("x",), ("y",), ("z",)], "land string"),
        "people": table([("p", "x"), ("q", "y"), ("r", "z")], "name string, land string"),
        "item": table([(10, "a"), (20, "b"), (30, "b")], "item int, kind string")}
    return Model(tables, [Relationship("sales", "shop", "shop", "shop"), Relationship("sales", "item", "item", "item"),
                          Relationship("shop", "land", "land", "land", both=both), Relationship("people", "land", "land", "land")])


def _keys(df, c):
    return sorted(r[0] for r in df.select(c).collect())


def test_filters_travel_from_key_to_rows_and_both_ways_where_allowed(spark):
    got = _model(spark, True).filtered({"shop": F.col("shop") == 1, "item": F.col("kind") == "b"})
    assert _keys(got["sales"], "id") == [2] and _keys(got["shop"], "shop") == [1] and _keys(got["land"], "land") == ["x"]
    assert _keys(got["people"], "name") == ["p"] and _keys(got["item"], "item") == [20, 30]
    one = _model(spark, False).filtered({"shop": F.col("shop") == 1})
    assert _keys(one["land"], "land") == ["x", "y", "z"] and len(_keys(one["people"], "name")) == 3
    assert _keys(one["sales"], "id") == [1, 2]
    down = _model(spark, False).filtered({"land": F.col("land") == "y"})
    assert _keys(down["shop"], "shop") == [2, 3] and _keys(down["sales"], "id") == [3] and _keys(down["people"], "name") == ["q"]
    none = _model(spark, True).filtered({"land": F.col("land") == "?"})
    assert all(none[t].count() == 0 for t in ("sales", "shop", "people", "land")) and none["item"].count() == 3
    every = _model(spark, True).filtered({})
    assert every["sales"].count() == 5


def test_facts_do_not_filter_keys(spark):
    got = _model(spark, True).filtered({"sales": F.col("id") == 1})
    assert got["shop"].count() == 4 and got["item"].count() == 3 and _keys(got["sales"], "id") == [1]


def test_ambiguous_paths_are_refused(spark):
    t = {n: spark.range(1).toDF("k") for n in "abc"}
    with pytest.raises(ValueError, match="more than one path"):
        Model(t, [Relationship("a", "k", "b", "k"), Relationship("b", "k", "c", "k"), Relationship("a", "k", "c", "k")])


def test_bitmap_counts_match_sets_and_merge(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["d1", "d2"]), rng.choice(["v", "w", None]), rng.choice([None, rng.randint(1, 100_000)]),
             rng.choice([1, 32768, 32769, 65536, None])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "day string, venue string, a long, b int").repartition(4)
    sets = distinct_sets(df, ["day", "venue"], ["a", "b"])
    for by in ([], ["venue"], ["day", "venue"]):
        want = defaultdict(lambda: (set(), set()))
        for d, v, a, b in rows:
            for x, s in zip((a, b), want[tuple({"day": d, "venue": v}[c] for c in by)]):
                s.add(x)
        for blank in (True, False):
            got = {tuple(r[c] for c in by): (r.na, r.nb) for r in set_counts(sets, by, {"a": "na", "b": "nb"}, blank).collect()}
            assert got == {k: tuple(len(s) if blank else len(s - {None}) for s in v) for k, v in want.items()}
    got = {(r.day, r.venue, r.row_total, r.col_total): r.n for r in matrix_totals(
        distinct_sets(df, ["day", "venue"], ["a"]), "day", "venue", "n").collect()}
    for d in ("d1", "d2", "all"):
        for v in ("v", "w", None, "all"):
            mine = {a for x, y, a, _ in rows if d in (x, "all") and v in (y, "all")}
            assert got[(None if d == "all" else d, None if v == "all" else v, int(v == "all"), int(d == "all"))] == len(mine)
    assert set_counts(distinct_sets(df.limit(0), [], ["a"]), [], {"a": "n"}).collect()[0].n is None


def test_cards_do_not_expand_the_rows(spark):
    from refmart.plans import reports
    star = spark.createDataFrame([(1, 2, 3, 4)], "InstrumentSK long, InstrumentListingSK long, IssuerSK long, TradingVenueSK long")
    plan = reports.card_counts(star)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "bitmap_construct_agg" in plan
