"""Benchmark decontamination (native DataFrame functions only).

The benchmark's normalised word windows form a broadcast hash set; every window
of the training texts is scanned against it map-side, so only hits are ever
shuffled. The join compares the windows themselves, not only their hashes, which
verifies each hit. Hit words are the union of the matching windows; documents or
just the hit spans can then be removed.

Windows: ``width`` consecutive words; an item of fewer words (but not none) is one
window of its own length.

Defined results: null and empty texts have no words and are never contaminated;
items without words match nothing; repeated rows (documents or items) each get
their own result, and a null doc_id is a key like any other; texts of any length are
scanned whole; an empty benchmark leaves everything clean, an empty table gives an
empty result; further columns are kept by ``remove`` and else ignored, whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_WORD_ANY_CASE, alnum_words, keyed, same_key

WIDTH = 10
# The window set is broadcast up to this many rows (about 100 bytes each);
# a larger benchmark is joined by shuffle instead, with the same result.
MAX_BROADCAST_WINDOWS = 2_000_000


def _window(words: Column, start: Column, width: int) -> Column:
    return F.array_join(F.slice(words, start + 1, F.lit(width)), " ")


def benchmark_windows(benchmark: DataFrame, width: int = WIDTH, id_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """(window, width, items): one row per distinct window, with the items that hold it."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), alnum_words(F.col(text_col)).alias("w"))
    items = items.withColumn("n", F.least(F.size("w"), F.lit(width))).where("n > 0")
    starts = F.sequence(F.lit(0), F.size("w") - F.col("n"))
    wins = items.select("item", F.col("n").alias("width"), F.explode(F.transform(
        starts, lambda i: F.array_join(F.slice(F.col("w"), i + 1, F.col("n")), " "))).alias("window"))
    return wins.groupBy("window", "width").agg(F.collect_set("item").alias("items"))


def hits(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k_id, k_hash, at, width, items): every place where a benchmark window stands."""
    lengths = sorted(r.width for r in windows.select("width").distinct().collect())  # at most WIDTH values
    small = windows.limit(MAX_BROADCAST_WINDOWS + 1).count() <= MAX_BROADCAST_WINDOWS
    d = keyed(docs, id_col, text_col)
    d = d.select("k_id", "k_hash", alnum_words(F.col("k_text")).alias("w"))

    def rolling(m: int) -> Column:
        starts = F.sequence(F.lit(0), F.size("w") - m)
        wins = F.transform(starts, lambda i: F.struct(i.alias("at"), _window(F.col("w"), i, m).alias("window")))
        return F.when(F.size("w") >= m, wins).otherwise(F.array().cast("array<struct<at:int,window:string>>"))

    parts = [rolling(m) for m in lengths]
    if not parts:
        parts = [F.array().cast("array<struct<at:int,window:string>>")]
    scanned = d.select("k_id", "k_hash", F.explode(F.concat(*parts)).alias("s")).select("k_id", "k_hash", "s.*")
    return scanned.join(F.broadcast(windows) if small else windows, "window").select(
        "k_id", "k_hash", "at", "width", "items")


def _union_size(spans: Column) -> Column:
    """Words covered by the sorted (at, width) spans."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(spans, zero, lambda a, x: F.struct(
        (a["n"] + F.greatest(F.lit(0).cast("long"), x["at"] + x["width"] - F.greatest(a["end"], x["at"].cast("long"))))
        .alias("n"),
        F.greatest(a["end"], (x["at"] + x["width"]).cast("long")).alias("end")))["n"]


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           width: int = WIDTH) -> DataFrame:
    """One row per input row: id, n_words, n_hit, n_items, items (sorted strings),
    spans (merged [start, end) word ranges that are hit), contaminated."""
    found = hits(docs, benchmark_windows(benchmark, width), id_col, text_col)
    # repeated rows find the same places, so sets of them change nothing
    found = found.groupBy("k_id", "k_hash").agg(
        F.sort_array(F.collect_set(F.struct("at", "width"))).alias("places"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    d = keyed(docs, id_col, text_col).select(
        "k_id", "k_hash", F.coalesce(F.regexp_count("k_text", F.lit(ALNUM_WORD_ANY_CASE)), F.lit(0)).alias("n_words"))
    out = d.join(found, same_key(d, found), "left").select(d["k_id"].alias(id_col), d["n_words"].cast("long"),
                                                           "places", "items")
    no_items = F.array().cast("array<string>")
    n_hit = F.coalesce(_union_size(F.col("places")), F.lit(0)).cast("long")
    return out.select(id_col, "n_words", n_hit.alias("n_hit"),
                      F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce("items", no_items).alias("items"), "places",
                      (n_hit > 0).alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", id_col: str = "doc_id",
           text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``documents``: the clean rows. ``spans``: every row, with the hit words (and
    what separates them) cut out of the text. All columns of ``docs`` are returned."""
    found = hits(docs, benchmark_windows(benchmark, width), id_col, text_col)
    key = F.struct(F.col(f"`{id_col}`").alias("i"), F.xxhash64(F.col(f"`{text_col}`")).alias("h"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("k_row"), key.alias("k_key"))
    if mode == "documents":
        bad = found.select(F.struct(F.col("k_id").alias("i"), F.col("k_hash").alias("h")).alias("b_key")).distinct()
        return row.join(bad, F.col("k_key").eqNullSafe(F.col("b_key")), "left_anti").select("k_row.*")
    if mode != "spans":
        raise ValueError(f"unknown mode {mode!r}")
    bad = found.groupBy(F.struct(F.col("k_id").alias("i"), F.col("k_hash").alias("h")).alias("b_key")).agg(
        F.sort_array(F.collect_set(F.struct("at", "width"))).alias("places"))
    joined = row.join(bad, F.col("k_key").eqNullSafe(F.col("b_key")), "left")
    # A text is gap0 word0 gap1 word1 ... gapN; word i goes with the gap before it.
    text = F.col(f"k_row.`{text_col}`")
    words = F.regexp_extract_all(text, F.lit(ALNUM_WORD_ANY_CASE), F.lit(0))
    gaps = F.split(text, ALNUM_WORD_ANY_CASE, -1)
    hit_at = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p["at"], p["at"] + p["width"] - 1))))
    flags = F.map_from_arrays(hit_at, F.transform(hit_at, lambda _: F.lit(True)))
    kept = F.concat(F.array_join(F.transform(words, lambda w, i: F.when(
        F.coalesce(F.element_at(flags, i), F.lit(False)), "").otherwise(F.concat(gaps[i], w))), ""),
        F.element_at(gaps, -1))
    new = F.when(F.col("places").isNull(), text).otherwise(kept)
    return joined.select(*[(new if c == text_col else F.col(f"k_row.`{c}`")).alias(c) for c in docs.columns])


def decontamination_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest the op7 query returns."""
    return report(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"), "contaminated")


