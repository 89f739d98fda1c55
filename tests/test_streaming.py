"""Streaming entry points (STR1, STR2): exactly-once file streams."""

import os
import shutil

from pyspark.sql import functions as F

from conftest import DATA, SF_SMALL


def test_stream_delta_applies_each_batch_once(spark, tmp):
    from refmart.operators.cdc import apply_delta
    from refmart.plans import fixtures as fx
    from refmart.sources.sinks import read_current
    from refmart.streaming.stream import stream_delta
    delta = fx.delta(spark, SF_SMALL)
    src = tmp + "/delta_in"
    delta.write.parquet(src + "/day1")
    state = fx.cdc_state(spark, SF_SMALL)
    q = stream_delta(spark, src + "/*", tmp + "/state", tmp + "/ckpt", delta.schema, state)
    q.awaitTermination(120)
    got = read_current(spark, tmp + "/state")
    want = apply_delta(state, delta)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    q = stream_delta(spark, src + "/*", tmp + "/state", tmp + "/ckpt", delta.schema, state)  # restart: no new files
    q.awaitTermination(120)
    assert read_current(spark, tmp + "/state").count() == want.count()


def test_stream_quotes_appends_once(spark, tmp):
    from refmart.streaming.stream import stream_quotes
    src = tmp + "/quotes_in"
    shutil.copytree(os.path.join(DATA, "quotes"), src)
    q = stream_quotes(spark, src, tmp + "/quotes", tmp + "/ckpt")
    q.awaitTermination(120)
    q = stream_quotes(spark, src, tmp + "/quotes", tmp + "/ckpt")
    q.awaitTermination(120)
    out = spark.read.parquet(tmp + "/quotes")
    assert out.count() == 5 and out.select("file_name").distinct().count() == 3


def test_stream_delta_xml(spark, tmp):
    from refmart.operators.cdc import apply_delta
    from refmart.sources.sinks import read_current
    from refmart.sources.xml import read_delta_xml, read_full_xml
    from refmart.streaming.stream import stream_delta_xml
    full = read_full_xml(spark, os.path.join(DATA, "xml_full")) \
        .withColumn("ValidFromDate", F.to_date(F.col("HeaderReportingPeriodDate"))) \
        .withColumn("ValidToDate", F.lit(None).cast("date")).withColumn("LatestRecordFlag", F.lit(True))
    src = tmp + "/dltins"
    shutil.copytree(os.path.join(DATA, "xml_delta"), src)
    q = stream_delta_xml(spark, src, tmp + "/state", tmp + "/ckpt", full)
    q.awaitTermination(180)
    got = read_current(spark, tmp + "/state")
    batch = read_delta_xml(spark, src).withColumn("ValidFromDate", F.lit(None).cast("string"))
    want = apply_delta(full, batch)
    assert got.count() == want.count() == 8
    assert got.exceptAll(want).count() == 0
