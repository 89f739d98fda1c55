"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes. Two fingerprints that differ in at
most ``max_bits`` (3) bits share at least 8 - 3 = 5 positional bytes, so the
guaranteed minimum tally is 5. The index posts every fingerprint under each of its
C(8, 5) = 56 sets of five positional bytes: exactly the pairs whose tally reaches
the minimum meet in a bucket, and no pair below it is ever formed. Each bucket is
verified by the bit distance.

Scale: copies collapse to one fingerprint before the index. A bucket fixes 40 of
the 64 bits, so it holds at most 2^24 distinct fingerprints whatever the corpus;
it is streamed in sorted order and emits a spanning forest of its links (at most
one edge per member), never all pairs. Components are joined up relationally.

Defined results: a null or empty text has fingerprint zero (linked like any
other); repeated rows share a fingerprint and hence a component; null ids join
the component of their fingerprint and never name it (a component of null ids
only has a null id); texts of any length are shingled whole; an empty table gives an
empty result; further columns are kept by ``keep_one`` and else ignored, whatever
their names.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BLOCK = 1 << 16      # shingles counted at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the word shingles of ``text``."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    h = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), BLOCK):
        ones += np.unpackbits(h[i:i + BLOCK].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h)).view("<i8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE, out: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of its text as column ``out`` (bigint)."""
    @F.pandas_udf("bigint")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.withColumn(out, simhash(F.col(f"`{text_col}`")))


def postings(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(slots, key, fp): every distinct fingerprint under each set of 8 - max_bits positional bytes."""
    masks = [sum(0xFF << (8 * p) for p in ps) for ps in combinations(range(8), 8 - max_bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(i).cast("byte").alias("slots"),
                              F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key"))
                     for i, m in enumerate(signed)])
    return fps.select("fp", F.explode(keys).alias("k")).select("k.slots", "k.key", "fp")


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among ``fps`` (distinct): breadth first, each
    member compared once with those not reached yet."""
    edges, rest = [], fps
    while len(rest) > 1:
        root, rest, front = rest[0], rest[1:], [rest[0]]
        while front and len(rest):
            near = np.bitwise_count(rest ^ front.pop()) <= max_bits
            if near.any():
                found = rest[near]
                rest = rest[~near]
                front.extend(found)
                edges.extend((int(f), int(root)) for f in found)
    return edges


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints within ``max_bits`` bits."""
    def scan(batches):
        held, held_key = [], None   # the current bucket, across batches

        def close():
            if held and sum(map(len, held)) > 1:
                return _forest(np.concatenate(held).view(np.uint64), max_bits)
            return []

        for batch in batches:
            slots = batch.column(0).to_numpy()
            key, fp = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            cut = np.flatnonzero((slots[1:] != slots[:-1]) | (key[1:] != key[:-1])) + 1
            starts, ends = np.r_[0, cut], np.r_[cut, len(fp)]
            out = []
            # the first run may continue the held bucket, the last may go on in the next batch
            first = (int(slots[0]), int(key[0])) if len(fp) else held_key
            if first != held_key:
                out += close()
                held, held_key = [], first
            if len(fp):
                held.append(fp[starts[0]:ends[0]])
            if len(starts) > 1:
                out += close()
                for s, e in zip(starts[1:-1], ends[1:-1], strict=True):
                    if e - s > 1:
                        out += _forest(fp[s:e].view(np.uint64), max_bits)
                held, held_key = [fp[starts[-1]:]], (int(slots[starts[-1]]), int(key[starts[-1]]))
            if out:
                ab = np.array(out, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], ["a", "b"])
        out = close()
        if out:
            ab = np.array(out, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], ["a", "b"])

    dealt = postings(fps, max_bits).repartition("slots", "key").sortWithinPartitions("slots", "key", "fp")
    return dealt.mapInArrow(scan, "a long, b long").distinct()


def classes(marked: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``marked`` has ``k_id`` and ``fp``. Returns (fp, component): the smallest id of the component."""
    fps = marked.groupBy("fp").agg(F.min("k_id").alias("low"))
    root = components(links(fps.select("fp"), max_bits))
    named = fps.join(root, fps["fp"] == root["a"], "left").select(
        "fp", "low", F.coalesce("b", "fp").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component"))
    return named.join(lowest, "root").select("fp", "component", "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fp, component): one row per input row."""
    small = docs.select(F.col(id_col).alias("k_id"), F.col(text_col).alias("k_text"))
    marked = written(fingerprints(small, "k_text", shingle).select("k_id", "fp"), "fingerprints")
    named = classes(marked, max_bits)
    return marked.join(named, "fp").select(F.col("k_id").alias(id_col), "fp", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` (all columns) with one row of each component: the one
    with the smallest id (then the smallest text hash)."""
    small = docs.select(F.col(f"`{id_col}`").alias("k_id"), F.col(f"`{text_col}`").alias("k_text"))
    marked = fingerprints(small, "k_text", shingle).select("k_id", F.xxhash64("k_text").alias("k_hash"), "fp")
    marked = written(marked, "fingerprints")
    named = classes(marked, max_bits)
    # the first row of each fingerprint, then of each component: both reduced before they move
    first = F.min(F.struct(F.col("k_id").isNull().alias("last"), "k_id", "k_hash")).alias("row")
    of_fp = marked.groupBy("fp").agg(first)
    chosen = of_fp.join(named, "fp").groupBy("root").agg(F.min("row").alias("row")).select("row.k_id", "row.k_hash")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("k_row"),
                      F.col(f"`{id_col}`").alias("r_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("r_hash"))
    row = row.join(chosen, row["r_id"].eqNullSafe(chosen["k_id"]) & (row["r_hash"] == chosen["k_hash"]), "left_semi")
    # a row that is repeated as a whole still has to stay once
    once = F.row_number().over(Window.partitionBy("r_id", "r_hash").orderBy(F.lit(0)))
    return row.withColumn("n", once).where("n = 1").select("k_row.*")


def simhash_query(docs: DataFrame) -> DataFrame:
    """The digest the op8 query returns."""
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                        F.col("component").alias("component_id"))
