"""C14 / C15 end to end on the sf0.001 fixtures, plus PRJ6 lineage columns."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_with_lineage(spark):
    from refmart.operators.contract import with_lineage
    df = spark.createDataFrame([(1, None), (2, dt.datetime(2024, 1, 2))], "x INT, fts TIMESTAMP")
    launch = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp")
    out = with_lineage(df, "load_lei", launch, F.lit("lei2.csv"), F.col("fts"), F.lit("https://x")).collect()
    assert out[0].ScriptName == "load_lei" and out[0].SourceFileName == "lei2.csv"
    assert out[0].FileTimestamp == dt.datetime(2024, 1, 1) and out[1].FileTimestamp == dt.datetime(2024, 1, 2)


def test_pipelines(spark, tmp):
    from refmart.plans import fixtures as fx
    from refmart.plans.pipeline import run_mart, run_staging
    from refmart.plans.warehouse import FIXTURE_TYPE_HINTS, FIXTURE_UNDERLYING_HINTS
    from refmart.sources.sinks import read_current
    wide = fx.wide(spark, SF_SMALL)
    ledger = run_staging(spark, wide, None, tmp)
    counts = {r.file_name: r.rows_read for r in ledger.collect()}
    assert counts["listing"] == read_current(spark, tmp + "/listing").count() > 0
    ents = fx.entities(spark, SF_SMALL)
    m1 = run_mart(spark, tmp, ents, "2024-06-30", (FIXTURE_UNDERLYING_HINTS, FIXTURE_TYPE_HINTS)).first()
    fact1 = spark.read.parquet(tmp + "/fact")
    n1 = fact1.count()
    assert m1.rows_read == n1 > 0
    assert fact1.groupBy("SnapshotDate", "ISIN", "TradingVenueMIC").count().filter("count > 1").count() == 0
    # Re-running the same day is idempotent; a second day adds a partition; keys are stable.
    run_mart(spark, tmp, ents, "2024-06-30", (FIXTURE_UNDERLYING_HINTS, FIXTURE_TYPE_HINTS))
    run_mart(spark, tmp, ents, "2024-07-01", (FIXTURE_UNDERLYING_HINTS, FIXTURE_TYPE_HINTS))
    fact = spark.read.parquet(tmp + "/fact")
    assert fact.filter("SnapshotDate = DATE'2024-06-30'").count() == n1
    assert fact.filter("SnapshotDate = DATE'2024-07-01'").count() == n1
    day1 = fact.filter("SnapshotDate = DATE'2024-06-30'").drop("SnapshotDate")
    day2 = fact.filter("SnapshotDate = DATE'2024-07-01'").drop("SnapshotDate")
    assert day1.exceptAll(day2).count() == 0
    instrument = read_current(spark, tmp + "/instrument")       # enriched (C5), also after a second load
    assert instrument.filter("MaturityDate IS NOT NULL AND TotalIssuedNominalAmount IS NOT NULL").count() > 0
    latest = read_current(spark, tmp + "/fact_latest")
    assert latest.count() == n1 and latest.select(F.max("SnapshotDate")).first()[0] == dt.date(2024, 7, 1)


def test_staging_keeps_rejects_and_counts_before_and_after(spark, tmp):
    from refmart.operators.rejects import rejected
    from refmart.plans import fixtures as fx
    from refmart.plans.pipeline import run_staging
    from refmart.sources.sinks import read_current
    wide = fx.wide(spark, SF_SMALL)
    first = {(r.file_name, r.status): r.rows_read for r in run_staging(spark, wide, None, tmp).collect()}
    assert first["listing", "BEFORE"] == 0 and first["state", "AFTER"] == wide.count()
    good = fx.delta(spark, SF_SMALL)
    n = good.count()
    one = good.limit(1)
    bad = [one.withColumn("ISIN", F.lit(" ")), one.withColumn("ISIN", F.lit(None).cast("string")).withColumn(
        "TradingVenueMIC", F.lit(None).cast("string")), one.withColumn("TradingVenueMIC", F.lit("")),
        one.withColumn("ActionType", F.lit("ODD")), one.withColumn("ActionType", F.lit(None).cast("string"))]
    delta = good
    for b in bad:
        delta = delta.unionByName(b)
    delta = delta.withColumn("SourceFileName", F.when(F.col("ActionType") == "ODD", "odd.xml").otherwise("all.xml"))
    ledger = {(r.file_name, r.status): r for r in run_staging(spark, read_current(spark, tmp + "/state"), delta, tmp,
                                                               tmp + "/ledger").collect()}
    file = ledger["all.xml", "END"]
    assert (file.rows_read, file.rows_inserted, file.rows_rejected) == (n + 4, n + 1, 3)
    assert file.error_message == "no ISIN: 2, no venue: 1"
    odd = ledger["odd.xml", "ERROR"]
    assert (odd.rows_read, odd.rows_inserted, odd.rows_rejected, odd.error_message) == (1, 0, 1, "unknown action: 1")
    kept = rejected(spark, tmp + "/delta_load").groupBy("reject_reason").count().collect()
    assert {r.reject_reason: r["count"] for r in kept} == {"no ISIN": 2, "no venue": 1, "unknown action": 1}
    for t in ("state", "listing", "debt", "derivative"):
        assert ledger[t, "BEFORE"].rows_read == first[t, "AFTER"]
        assert ledger[t, "AFTER"].rows_read == read_current(spark, f"{tmp}/{t}").count()
    assert spark.read.parquet(tmp + "/ledger").count() == len(ledger)


def test_a_retried_batch_replaces_its_rows(spark, tmp):
    from refmart.operators.rejects import file_counts, inserted, rejected, stored, write_checked
    df = spark.createDataFrame([("f1", 1), ("f1", None), ("f2", -1), (None, 5)], "file_name STRING, x INT")
    rules = [("no x", F.col("x").isNull()), ("negative", F.col("x") < 0)]
    for _ in range(2):
        write_checked(df, rules, tmp + "/load", "b1")
    write_checked(df.where("x = 5"), rules, tmp + "/load", "b2")
    assert inserted(spark, tmp + "/load").count() == 3 and inserted(spark, tmp + "/load", "b1").count() == 2
    assert inserted(spark, tmp + "/load").columns == ["file_name", "x"]
    assert sorted(r.reject_reason for r in rejected(spark, tmp + "/load").collect()) == ["negative", "no x"]
    got = {r.file: tuple(r)[1:] for r in file_counts(stored(spark, tmp + "/load", "b1"), "file_name").collect()}
    assert got == {"f1": (2, 1, 1, "no x: 1"), "f2": (1, 0, 1, "negative: 1"), None: (1, 1, 0, None)}


def test_pipeline_errors_reach_the_ledger(spark, tmp):
    import pytest
    from refmart.plans.pipeline import run_mart
    with pytest.raises(Exception):
        run_mart(spark, tmp + "/nothing_here", None, "2024-06-30", ledger_path=tmp + "/ledger")
    row = spark.read.parquet(tmp + "/ledger").first()
    assert row.status == "ERROR" and row.process_name == "run_mart" and row.error_message
