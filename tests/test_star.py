"""The report model where a venue has several register rows (supplier keys that share a code)."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import ROOT  # noqa: F401  (puts the repository on the path)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
REPORTS = ["rpt1_kpi_cards", "rpt2_listings_by_classification", "rpt3_listings_by_city", "rpt4_listings_by_venue",
           "rpt5_country_cards", "rpt6_venue_share", "rpt7_listings_by_venue_city", "rpt8_dominant_class_by_venue",
           "rpt9_issuers_by_country", "rpt10_instruments_matrix", "rpt11_region_cards", "rpt18_missing_shares",
           "agg5_cards_by_country", "agg8_total_nominal", "agg9_share_of_total", "agg9_total_without_code",
           "agg10_agg_by_issuer", "agg14_matrix", "agg14_matrix_totals", "joi12_star_view", "c10_build_snapshot"]


@pytest.fixture(scope="module")
def shared_codes(spark, scratch):
    """Small tables of their own: 'M' and the first three digits of the key are a venue's code, so 40 register
    rows share the codes of four venues; nulls in the keys of some lines and orders."""
    d = os.path.join(scratch, "shared_codes")
    os.makedirs(d)
    with duckdb.connect() as db:
        for name, sql in {
                "region": "SELECT CAST(i AS INTEGER) AS r_regionkey, ['AFRICA', 'EUROPE'][CAST(i + 1 AS INTEGER)] AS r_name FROM range(2) t(i)",
                "nation": "SELECT CAST(i AS INTEGER) AS n_nationkey, 'NATION_' || i AS n_name, CAST(i % 2 AS INTEGER) AS n_regionkey FROM range(9) t(i)",
                "customer": "SELECT i AS c_custkey, 'c' || i AS c_name, CAST(i % 10 AS INTEGER) AS c_nationkey, 1.5 AS c_acctbal, 'S' || i % 3 AS c_mktsegment FROM range(30) t(i)",
                "supplier": "SELECT CASE WHEN i < 6 THEN i ELSE 1000 + i % 10 + 1000 * (i // 10) END AS s_suppkey, 's' || i AS s_name, CAST(i % 9 AS INTEGER) AS s_nationkey, 1.5 AS s_acctbal FROM range(60) t(i)",
                "part": "SELECT i AS p_partkey, 'ring ' || i AS p_name, 'b' AS p_brand, 't' AS p_type, 1 AS p_size, CAST(9.5 + i AS DOUBLE) AS p_retailprice FROM range(40) t(i)",
                "orders": "SELECT i AS o_orderkey, CASE WHEN i % 11 > 0 THEN i % 33 END AS o_custkey, ['F', 'O', 'P'][CAST(i % 3 + 1 AS INTEGER)] AS o_orderstatus, 1.5 AS o_totalprice, TIMESTAMP '1998-03-01' + to_days(CAST(i AS INTEGER)) AS o_orderdate, '1-URGENT' AS o_orderpriority FROM range(200) t(i)",
                "lineitem": """SELECT i % 200 AS l_orderkey, CASE WHEN i % 13 > 0 THEN i * 7 % 40 END AS l_partkey,
                    CASE WHEN i % 17 = 0 THEN NULL WHEN i % 5 = 0 THEN i % 8 ELSE 1000 + 1000 * (i % 5) + i % 3 END AS l_suppkey, CAST(i // 200 + 1 AS INTEGER) AS l_linenumber,
                    CAST(1 + i % 50 AS DOUBLE) AS l_quantity, CAST(10.25 * i AS DOUBLE) AS l_extendedprice, CAST(0.05 AS DOUBLE) AS l_discount, CAST(i % 9 AS DOUBLE) / 100 AS l_tax, ['A', 'N', 'R'][CAST(i % 3 + 1 AS INTEGER)] AS l_returnflag,
                    CASE WHEN i % 4 > 0 THEN 'O' ELSE 'F' END AS l_linestatus, TIMESTAMP '1998-05-01' + to_days(CAST(i % 300 AS INTEGER)) AS l_shipdate FROM range(800) t(i)"""}.items():
            db.execute(f"COPY ({sql}) TO '{d}/{name}.parquet' (FORMAT parquet)")
    return d


def _rows(rows):
    return sorted(repr([round(float(v), 6) if isinstance(v, (int, float)) or type(v).__name__ == "Decimal" else v for v in r]) for r in rows)


@pytest.mark.parametrize("name", REPORTS)
def test_reports_over_venues_with_several_register_rows(spark, shared_codes, name):
    from __spark_entry__ import oracle_sql, queries
    df = queries()[name](spark, shared_codes)
    with duckdb.connect() as db:
        for t in TABLES:
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{shared_codes}/{t}.parquet'")
        want = db.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in df.columns)} FROM ({oracle_sql()[name]})").fetchall()
    assert want and _rows(df.collect()) == _rows(want)


def test_the_stored_star_has_one_row_per_fact_row(spark, shared_codes):
    from refmart.plans import warehouse as wh
    fact, star = wh.mart(spark, shared_codes)["fact"], wh.star(spark, shared_codes)
    assert star.count() == fact.count()
    assert wh.star_view(spark, shared_codes).count() == star.agg(F.sum("VenueRows")).first()[0] > 3 * fact.count()


def test_a_query_of_two_columns_writes_no_stage(spark, shared_codes):
    from __spark_entry__ import queries
    from refmart.plans import fixtures as fx
    for name in ["prj16_cut", "prj10_first_text", "flt4_matches_like", "prj14_parse_date", "set3_distinct_values"]:
        df = queries()[name](spark, shared_codes)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "l_extendedprice" not in plan.split("Relation [")[0], name
    assert not any(k[2] == "wide" for k in fx._STAGES)
