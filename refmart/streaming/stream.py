"""File streams (inventory STR1, STR2).

The reference loads a daily delta and scrapes quote pages in a timed loop.
Both become Structured Streaming file sources with ``foreachBatch``: each
micro-batch runs the same batch operator as the daily job, and the output
is keyed by batch id so a replayed batch (after a failure between the write
and the checkpoint commit) is skipped -- exactly-once end to end.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.cdc import KEYS, apply_delta
from ..sources.releases import BUCKETS, update_state, write_state
from ..sources.sinks import append_batch, current_version, read_current, write_full_refresh
from ..sources.text import read_quote_files


def apply_delta_batch(state_dir: str, initial_state: DataFrame | None = None, stream: str = "delta",
                      buckets: int | None = None):
    """``foreachBatch`` body for STR1: state + delta batch -> next state.

    With ``buckets`` the state lies in that many parts by a hash of its key, and a
    batch reads and writes only the parts its keys fall in; without, each batch
    writes a whole new version.

    A published version names the stream (its checkpoint) and batch it holds, so
    a batch replayed by the same stream is skipped, while a stream with a new
    checkpoint, whose batch ids start again, goes on from the current state."""
    run_of = hashlib.sha256(stream.encode()).hexdigest()[:16]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cur = current_version(spark, state_dir)     # None only if nothing was ever published
        if cur is not None:
            of, done = cur.split("-")[:2]
            if of == run_of and int(done) >= batch_id:
                return
        version = f"{run_of}-{batch_id:012d}"
        if buckets is None:
            state = read_current(spark, state_dir) if cur else initial_state
            write_full_refresh(apply_delta(state, batch), state_dir, version)
            return
        if cur is None:
            write_state(initial_state, state_dir, "initial-000000000000", KEYS, buckets)
        update_state(spark, state_dir, version, batch, apply_delta)
    return run


def stream_delta(spark: SparkSession, source_dir: str, state_dir: str, checkpoint: str, schema,
                 initial_state: DataFrame, fmt: str = "parquet", options: dict | None = None,
                 available_now: bool = True, buckets: int | None = BUCKETS) -> StreamingQuery:
    """STR1: delta files as a stream; C1 applied per micro-batch (exactly once).

    ``fmt`` may be ``xml`` (with ``rowTag``) or the Parquet/CSV hand-off."""
    reader = spark.readStream.format(fmt).schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    w = reader.load(source_dir).writeStream.foreachBatch(
        apply_delta_batch(state_dir, initial_state, checkpoint, buckets)) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 minutes")
    return w.start()


def stream_delta_xml(spark: SparkSession, source_dir: str, state_dir: str, checkpoint: str,
                     initial_state: DataFrame, max_files_per_trigger: int = 100,
                     available_now: bool = True, buckets: int | None = BUCKETS) -> StreamingQuery:
    """STR1 on the delta XML files themselves: records stream as text cut at their end
    tag; each micro-batch reads the header of just its own files (at most
    ``max_files_per_trigger`` paths) and then applies C1 exactly once."""
    from ..sources.xml import DELTA_SCHEMA, delta_records_to_wide, parsed_records, with_header
    pieces = (spark.readStream.option("lineSep", "</FinInstrm>").option("maxFilesPerTrigger", max_files_per_trigger)
              .text(source_dir))
    recs = parsed_records(pieces, "FinInstrm", DELTA_SCHEMA)
    apply = apply_delta_batch(state_dir, initial_state, checkpoint, buckets)

    def run(batch: DataFrame, batch_id: int) -> None:
        paths = [r[0] for r in batch.select("SourceFilePath").distinct().collect()]  # <= max_files_per_trigger
        if paths:
            wide = with_header(delta_records_to_wide(batch), paths, "FinInstrm")
            apply(wide.withColumn("ValidFromDate", F.lit(None).cast("string")), batch_id)

    w = recs.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 day")
    return w.start()


def stream_quotes(spark: SparkSession, source_dir: str, out: str, checkpoint: str, delimiter: str = "|",
                  available_now: bool = True, max_files_per_trigger: int = 1000) -> StreamingQuery:
    """STR2: quote files as they land -> the 26-column quote table, appended
    once per file (SNK2). The stream hands over paths; the batch reader (SRC5)
    reads the files."""
    listing = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
    files = (spark.readStream.format("binaryFile").schema(listing).option("pathGlobFilter", "*.{csv,txt,tsv,psv}")
             .option("maxFilesPerTrigger", max_files_per_trigger).load(source_dir).select("path"))

    def run(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r[0] for r in batch.collect())      # at most max_files_per_trigger
        if paths:
            append_batch(read_quote_files(spark, paths, delimiter), out, "file_name")

    w = files.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 minutes")
    return w.start()
