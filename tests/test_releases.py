"""State buckets (C1, STR1) and the mart's releases (C15)."""

import glob

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL


def _small_delta(spark, state, n):
    """MOD rows for n keys, a NEW key, and a row without a venue."""
    some = state.filter("LatestRecordFlag").orderBy("ISIN", "TradingVenueMIC").limit(n)
    mod = some.select("ISIN", "TradingVenueMIC", "IssuerLEI", F.lit("changed").alias("FullName"), F.lit("MOD").alias("ActionType"))
    new = spark.createDataFrame([("XSNEW0000000", "M001", "L", "new", "NEW"), ("XSNEW0000001", None, "L", "new", "NEW")], mod.schema)
    return mod.unionByName(new).select("*", F.lit(None).cast("string").alias("ValidFromDate"),
                                       F.lit("2024-01-05").alias("HeaderReportingPeriodDate"),
                                       F.lit(None).cast("string").alias("TerminationDate"), F.lit("1").alias("TechRcrdId"))


def _files(base):
    return set(glob.glob(f"{base}/*/state_bucket=*/*.parquet"))


def test_a_small_delta_rewrites_few_buckets(spark, tmp):
    from refmart.operators.cdc import KEYS, apply_delta
    from refmart.plans import fixtures as fx
    from refmart.sources.releases import load_release, read_state, update_state, write_state
    from refmart.sources.sinks import read_current
    state = fx.cdc_state(spark, SF_SMALL)
    write_state(state, tmp, "v0", KEYS, 64)
    before, parts = _files(tmp), load_release(spark, tmp)["state"].parts
    assert len(parts) > 50 and read_state(spark, tmp).exceptAll(state).count() == 0
    delta = _small_delta(spark, state, 3)
    touched = update_state(spark, tmp, "v1", delta, apply_delta)
    new = _files(tmp) - before
    assert 1 <= len(touched) <= 4 and len(new) <= 2 * len(touched) and before <= _files(tmp)
    after = load_release(spark, tmp)["state"].parts
    assert {b for b in after if after[b] != parts.get(b)} == set(touched)
    got, want = read_current(spark, tmp), apply_delta(state, delta)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.columns == state.columns
    # a version that the release names is never written over; an older release stays readable
    with pytest.raises(ValueError):
        update_state(spark, tmp, "v1", delta, apply_delta)
    assert read_state(spark, tmp, "v0").exceptAll(state).count() == 0


def test_a_failed_load_leaves_the_state_and_can_be_retried(spark, tmp, monkeypatch):
    from refmart.operators.cdc import KEYS, apply_delta
    from refmart.plans import fixtures as fx
    from refmart.sources import releases
    state = fx.cdc_state(spark, SF_SMALL)
    releases.write_state(state, tmp, "v0", KEYS, 8)
    delta = _small_delta(spark, state, 5)
    with monkeypatch.context() as m:
        m.setattr(releases, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            releases.update_state(spark, tmp, "v1", delta, apply_delta)
    assert releases.read_state(spark, tmp).exceptAll(state).count() == 0      # nothing was published
    releases.update_state(spark, tmp, "v1", delta, apply_delta)
    assert releases.read_state(spark, tmp).exceptAll(apply_delta(state, delta)).count() == 0


def test_empty_states_and_deltas(spark, tmp):
    from refmart.operators.cdc import KEYS, apply_delta
    from refmart.plans import fixtures as fx
    from refmart.sources.releases import read_state, update_state, write_state
    state = fx.cdc_state(spark, SF_SMALL)
    write_state(state.limit(0), tmp, "v0", KEYS, 8)
    assert read_state(spark, tmp).count() == 0 and read_state(spark, tmp).schema == state.limit(0).schema
    delta = _small_delta(spark, state, 4)
    assert update_state(spark, tmp, "v1", delta.limit(0), apply_delta) == []
    update_state(spark, tmp, "v2", delta, apply_delta)
    assert read_state(spark, tmp).count() == 5
    update_state(spark, tmp, "v3", delta.filter("TradingVenueMIC IS NULL"), apply_delta)
    assert read_state(spark, tmp).count() == 5


def test_a_hot_key_is_split_over_files(spark, tmp):
    """A key with a third of all rows: its bucket is written by several tasks."""
    from refmart.sources.releases import read_state, write_state
    rows = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                       F.sha2(F.col("id").cast("string"), 512).alias("v"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        write_state(rows, tmp, "v0", ["k"], 8)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    sizes = {}
    for f in _files(tmp):
        sizes[f.split("/")[-2]] = sizes.get(f.split("/")[-2], 0) + 1
    assert len(sizes) == 8 and max(sizes.values()) > 2
    assert read_state(spark, tmp).count() == 300_000


def test_staging_goes_on_from_the_stored_state(spark, tmp):
    from refmart.operators.cdc import apply_delta
    from refmart.plans import fixtures as fx
    from refmart.plans.pipeline import run_staging
    from refmart.sources.sinks import read_current
    wide = fx.wide(spark, SF_SMALL)
    run_staging(spark, wide, None, tmp, buckets=32)
    before = _files(tmp + "/state")
    delta = _small_delta(spark, read_current(spark, tmp + "/state"), 2)
    run_staging(spark, None, delta, tmp)
    assert 1 <= len(_files(tmp + "/state") - before) <= 8
    got, want = read_current(spark, tmp + "/state"), apply_delta(wide, delta)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_the_mart_is_published_as_one(spark, tmp, monkeypatch):
    """A load that fails half way, after some dimensions were written, changes no table of the release."""
    from refmart.plans import fixtures as fx
    from refmart.plans import pipeline
    from refmart.sources.releases import load_release
    from refmart.sources.sinks import read_current
    wide = fx.wide(spark, SF_SMALL)
    half = wide.filter(F.crc32("ISIN") % 2 == 0)
    ents = fx.entities(spark, SF_SMALL)
    pipeline.run_staging(spark, half, None, tmp)
    pipeline.run_mart(spark, tmp, ents, "2024-06-30")
    names = ["cfi", "currency", "issuer", "venue", "instrument", "listing_dim", "fact", "fact_latest"]
    first = load_release(spark, tmp)
    assert sorted(first) == sorted(names)
    counts = {n: pipeline.read_mart(spark, tmp, n).count() for n in names}
    assert counts["fact"] == counts["fact_latest"] > 0
    pipeline.run_staging(spark, wide, None, tmp)
    with monkeypatch.context() as m:
        m.setattr(pipeline, "build_snapshot", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            pipeline.run_mart(spark, tmp, ents, "2024-07-01")
    assert {n: t.parts for n, t in load_release(spark, tmp).items()} == {n: t.parts for n, t in first.items()}
    assert read_current(spark, tmp + "/instrument").count() == counts["instrument"]
    pipeline.run_mart(spark, tmp, ents, "2024-07-01")
    fact = pipeline.read_mart(spark, tmp, "fact")
    assert {str(r.SnapshotDate) for r in fact.select("SnapshotDate").distinct().collect()} == {"2024-06-30", "2024-07-01"}
    assert fact.filter("SnapshotDate = DATE'2024-06-30'").count() == counts["fact"]
    latest = pipeline.read_mart(spark, tmp, "fact_latest")
    assert latest.exceptAll(read_current(spark, tmp + "/fact_latest")).count() == 0 and latest.count() > counts["fact"]
    # every key of the fact is in the release's dimensions, and the keys given first stay
    inst = pipeline.read_mart(spark, tmp, "instrument")
    assert fact.join(inst, "InstrumentSK", "left_anti").filter("InstrumentSK IS NOT NULL").count() == 0
    assert inst.count() > counts["instrument"]


def test_loads_leave_the_history_alone(spark, tmp):
    """Three loads by parts equal three loads of the whole dimension; no load reads or rewrites a closed row."""
    from refmart.operators.dims import scd2_by_current
    from refmart.sources.history import CURRENT_PART, load_current
    from refmart.sources.releases import read_parts
    src = "k STRING, v STRING, ValidFromDate DATE, ValidToDate DATE"
    whole = spark.createDataFrame([("a", "0", None, None, True, 1), ("b", "0", None, None, False, 2), ("c", "0", None, None, None, 3)],
                                  src + ", IsCurrent BOOLEAN, sk LONG")
    loads = [[("a", "1", "2024-01-02", None), ("d", "1", "2024-01-02", None), ("e", "1", "2024-01-02", "2024-01-09")],
             [("a", "1", "2024-02-02", None), ("d", "2", "2024-02-02", None), ("b", "2", "2024-02-02", None)],
             [], [("a", "3", "2024-03-02", None), ("e", "3", "2024-03-02", None)]]
    table, seen = None, {}
    for n, rows in enumerate(loads):
        s = spark.createDataFrame(rows, "k STRING, v STRING, f STRING, t STRING").selectExpr(
            "k", "v", "to_date(f) AS ValidFromDate", "to_date(t) AS ValidToDate")
        read = []

        def load(dim, top, s=s):
            read.append(dim.filter("NOT coalesce(IsCurrent, false)").count())
            return scd2_by_current(dim, s, ["k"], {"v": "string"}, "sk", top=top)

        table = load_current(spark, tmp, f"dim/v{n}", table, whole, "sk", load)
        whole = scd2_by_current(whole, s, ["k"], {"v": "string"}, "sk")
        got = read_parts(spark, tmp, table).select(*whole.columns)
        assert got.exceptAll(whole).count() == 0 and whole.exceptAll(got).count() == 0
        assert read == [0] and table.top == whole.agg(F.max("sk")).first()[0]
        assert read_parts(spark, tmp, table, [CURRENT_PART]).filter("NOT IsCurrent").count() == 0
        history = {p: table.parts[p] for p in table.parts if p != CURRENT_PART}
        assert all(history[p] == seen[p] for p in seen)
        seen = history
    assert len(seen) == 3       # the load without rows closed nothing
