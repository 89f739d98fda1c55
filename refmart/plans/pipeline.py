"""Stage and mart pipelines (inventory C14, C15, C16, SNK1, SNK3).

Each stage is written (or checkpointed) before the next reads it, so a lost
executor only recomputes the current stage, and every table is replaced by
write-then-swap. The wide state lies in buckets by key: a delta writes only those
it touches. The mart's tables are published together, by one manifest that is
written last. Row counts come from ``observe`` on the writes themselves.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import blank_to_null
from ..functions.predicates import min_length
from ..operators.cdc import KEYS, apply_delta, split_typed, type_instruments
from ..operators.classify import classify, name_hints
from ..operators.dims import merge_new_keys, scd2_by_current, scd2_by_version, upsert_dim
from ..operators.facts import build_snapshot, latest_snapshot
from ..operators.ledger import LEDGER_SCHEMA, observed_counts
from ..operators.rejects import Rules, file_counts, inserted, stored, write_checked
from ..sources.history import CURRENT_PART, load_current
from ..sources.releases import (BUCKETS, STATE, Table, has_state, load_release, publish_release, read_parts,
                                read_released, update_state, write_state)
from ..sources.sinks import (current_version, keep_latest, overwrite_partition, publish, read_current,
                             write_full_refresh)


def _ledger(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, LEDGER_SCHEMA)


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def logged(spark: SparkSession, process: str, ledger_path: str | None, body):
    """C16: run a pipeline step; append its ledger rows (END) or, on failure, an
    ERROR row with the message to the append-only ledger -- then re-raise, as
    the reference's TRY/CATCH does."""
    start = _now()
    try:
        rows = body()
    except Exception as e:  # noqa: BLE001
        if ledger_path:
            _ledger(spark, [(process, None, "ERROR", start, _now(), None, None, None, str(e))]) \
                .write.mode("append").parquet(ledger_path)
        raise
    if ledger_path:
        rows.write.mode("append").parquet(ledger_path)
    return rows


def run_staging(spark: SparkSession, state: DataFrame | None, delta: DataFrame | None, base: str,
                ledger_path: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """C14: apply the delta (if any) to the wide state, then rebuild the three
    sub-type tables. Without ``state`` the stored one is taken, and the delta reads
    and writes only the buckets its keys fall in; a given ``state`` replaces the
    stored one, in ``buckets`` parts. Returns the ledger rows: per file of the delta what was read,
    inserted and rejected, and per table the row counts before and after. With
    ``ledger_path`` the rows (or an ERROR row) are appended there."""
    return logged(spark, "run_staging", ledger_path, lambda: _run_staging(spark, state, delta, base, buckets))


def _run_staging(spark: SparkSession, state: DataFrame | None, delta: DataFrame | None, base: str,
                 buckets: int) -> DataFrame:
    start = _now()
    version = start.strftime("v%Y%m%dT%H%M%S%f")
    stored_state = state is None and has_state(spark, f"{base}/state")
    if state is None and not stored_state:
        state = read_current(spark, f"{base}/state")      # a state that was stored whole: split from now on
    tables = ["state", "listing", "debt", "derivative"]
    rows = [_counted(spark, base, t, "BEFORE", start) for t in tables]
    if delta is not None:
        # rows without the keys that the delta needs are kept aside, with the reason
        batch = start.strftime("%Y%m%dT%H%M%S%f")
        write_checked(delta, delta_rules(), f"{base}/delta_load", batch)
        file = "SourceFileName" if "SourceFileName" in delta.columns else "ActionType"
        counts = file_counts(stored(spark, f"{base}/delta_load", batch), file).orderBy("file").collect()   # a row per file
        rows += [("run_staging", c.file, "END" if c.rows_inserted or not c.rows_read else "ERROR", start, _now(),
                  c.rows_read, c.rows_inserted, c.rows_rejected, c.reasons) for c in counts]
        good = inserted(spark, f"{base}/delta_load", batch).select(*delta.columns)
        if stored_state:
            update_state(spark, f"{base}/state", version, good, apply_delta)
        else:
            state = apply_delta(state, good)
    if not stored_state:
        write_state(state, f"{base}/state", version, KEYS, buckets)
    state = read_current(spark, f"{base}/state")
    typed = type_instruments(state)
    for name, df in split_typed(typed).items():
        write_full_refresh(df, f"{base}/{name}")
    return _ledger(spark, rows + [_counted(spark, base, t, "AFTER", start) for t in tables])


def delta_rules() -> Rules:
    """What makes a delta row a reject."""
    return [("no ISIN", blank_to_null(F.col("ISIN")).isNull()),
            ("no venue", blank_to_null(F.col("TradingVenueMIC")).isNull()),
            ("unknown action", ~F.col("ActionType").isin("NEW", "MOD", "TERM", "CANC"))]


def _counted(spark: SparkSession, base: str, table: str, phase: str, start: _dt.datetime) -> tuple:
    """C14: a ledger row with a table's row count before or after the run (0 before its first load;
    the count reads file footers only)."""
    n = 0 if current_version(spark, f"{base}/{table}") is None else read_current(spark, f"{base}/{table}").count()
    return ("run_staging", table, phase, start, _now(), n, n if phase == "AFTER" else 0, 0, None)


def run_mart(spark: SparkSession, base: str, entities: DataFrame, snapshot_date: str,
             name_rules: tuple | None = None, ledger_path: str | None = None) -> DataFrame:
    """C15: dimensions in the fixed order (classification, currency, issuer,
    venue, instrument, listing), then the day's fact and the latest copy. All are
    written aside and published together: ``read_mart`` gives the tables of one
    release, the old one until the whole load is there; a load that fails leaves it
    as it was. Afterwards the plain folders (a version per dimension, ``fact`` by
    partition overwrite, ``fact_latest``) follow, for readers of single tables. Skipped (ledger SKIP row) when staging is empty (AGG16).
    With ``ledger_path`` the ledger rows (or an ERROR row) are appended there."""
    return logged(spark, "run_mart", ledger_path,
                  lambda: _run_mart(spark, base, entities, snapshot_date, name_rules))


def read_mart(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table (``cfi``, ``currency``, ``issuer``, ``venue``, ``instrument``, ``listing_dim``, ``fact``,
    ``fact_latest``) of the mart's current release."""
    return read_released(spark, base, name)


def _run_mart(spark: SparkSession, base: str, entities: DataFrame, snapshot_date: str,
              name_rules: tuple | None = None) -> DataFrame:
    from ..plans.warehouse import enriched, enrichment, instrument_source, issuer_source, listing_source
    start = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    listing = read_current(spark, f"{base}/listing")
    debt = read_current(spark, f"{base}/debt")
    deriv = read_current(spark, f"{base}/derivative")
    if listing.limit(1).count() == 0:
        return _ledger(spark, [("run_mart", None, "SKIP", start, start, 0, 0, 0, "staging empty")])

    version = start.strftime("v%Y%m%dT%H%M%S%f")
    release = load_release(spark, base)
    loaded = []

    def current(name: str, empty_like: DataFrame) -> DataFrame:
        if name in release:
            return read_parts(spark, base, release[name])
        if current_version(spark, f"{base}/{name}") is None:    # first load; read errors are raised
            return empty_like
        return read_current(spark, f"{base}/{name}")

    def save(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{base}/{name}/{version}")
        release[name] = Table(df.schema, {"all": f"{name}/{version}"})
        loaded.append(name)
        return read_parts(spark, base, release[name])

    empty_kv = lambda k, sk: spark.createDataFrame([], f"{k} STRING, {sk} BIGINT")
    cfi_src = listing.filter(F.col("CFI").isNotNull() & min_length("CFI", 2))
    cfi = merge_new_keys(current("cfi", empty_kv("CFI", "CFISK")).select("CFI", "CFISK"), cfi_src, "CFI", "CFISK")
    rules = name_rules or ()
    cfi = save("cfi", classify(cfi, name_hints(listing, *rules)))
    currency = save("currency", merge_new_keys(current("currency", empty_kv("CurrencyCode", "CurrencySK")), listing,
                                               "CurrencyCode", "CurrencySK", src_key="NotionalCurrency"))
    from ..plans.fixtures import INSTRUMENT_TRACKED, ISSUER_TRACKED, LISTING_TRACKED
    iss_src = issuer_source(listing, entities)
    iss_empty = spark.createDataFrame([], iss_src.schema).withColumn("IssuerSK", F.lit(None).cast("long"))
    issuer = save("issuer", upsert_dim(current("issuer", iss_empty), iss_src, "IssuerLEI", "IssuerSK",
                                       ISSUER_TRACKED, status=None))
    venue = save("venue", merge_new_keys(current("venue", empty_kv("TradingVenueMIC", "TradingVenueSK")), listing,
                                         "TradingVenueMIC", "TradingVenueSK"))
    ins_src = instrument_source(listing)
    ins_empty = spark.createDataFrame([], ins_src.schema).withColumn("InstrumentSK", F.lit(None).cast("long")) \
        .withColumn("IsCurrent", F.lit(None).cast("boolean"))
    instrument = scd2_by_version(current("instrument", ins_empty), ins_src, ["ISIN"], INSTRUMENT_TRACKED, "InstrumentSK")
    instrument = save("instrument", enriched(instrument, enrichment(
        {"debt": debt, "derivative": deriv, "listing": listing})))
    lst_src = listing_source(listing)
    lst_empty = spark.createDataFrame([], lst_src.schema).withColumn("InstrumentListingSK", F.lit(None).cast("long")) \
        .withColumn("IsCurrent", F.lit(None).cast("boolean"))
    # only current rows are read and written; what was closed by earlier loads stays where it is
    release["listing_dim"] = load_current(
        spark, base, f"listing_dim/{version}", release.get("listing_dim"),
        lst_empty if "listing_dim" in release else current("listing_dim", lst_empty), "InstrumentListingSK",
        lambda dim, top: scd2_by_current(dim, lst_src, ["ISIN", "TradingVenueMIC"], LISTING_TRACKED,
                                         "InstrumentListingSK", top=top))
    listing_dim = read_parts(spark, base, release["listing_dim"], [CURRENT_PART])
    fact = build_snapshot(listing, debt, deriv, currency=currency, cfi=cfi, issuer=issuer, venue=venue,
                          instrument=instrument, listing_dim=listing_dim, snapshot_date=snapshot_date)
    # every row of the snapshot is stored: what has no key was kept aside in staging
    observed, obs = observed_counts(fact, F.col("ISIN").isNull() | F.col("TradingVenueMIC").isNull(), "fact")
    observed.write.mode("overwrite").parquet(f"{base}/fact_days/{version}")
    m = obs.get
    days = release["fact"].parts if "fact" in release else {}
    release["fact"] = Table(fact.schema, {**days, str(snapshot_date): f"fact_days/{version}"})
    last = max(release["fact"].parts)
    release["fact_latest"] = Table(latest_snapshot(fact).schema, {last: release["fact"].parts[last]})
    publish_release(spark, base, version, release)
    for name in loaded:
        publish(spark, f"{base}/{name}", version)
    part = release["listing_dim"]
    below = {k: p.removeprefix("listing_dim/") for k, p in part.parts.items()}
    publish_release(spark, f"{base}/listing_dim", version, {STATE: replace(part, parts=below)})
    day = read_parts(spark, base, release["fact"], [str(snapshot_date)])
    overwrite_partition(day, f"{base}/fact", "SnapshotDate")
    keep_latest(f"{base}/fact", spark, f"{base}/fact_latest")
    end = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return _ledger(spark, [("run_mart", "fact", "END", start, end, m.get("rows_read"),
                            m.get("rows_read") - m.get("rows_rejected"), m.get("rows_rejected"), None)])
