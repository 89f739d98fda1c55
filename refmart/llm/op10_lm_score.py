"""Stupid-backoff language-model scores, computed relationally.

The corpus is cut into chunks of documents. Each chunk explodes its texts into
n-grams of every order, pre-aggregates them, and sends (n-gram hash, count) rows to
hash ranges; each range sums them into its part of the n-gram count table and joins
the totals back to the chunk's n-grams, which then score every word, summed per
document. An n-gram goes once per chunk, however often it occurs, so a frequent one
makes no hot key; a range holds a bounded share of the hashes.

A word's score, after the longest seen context: count(n-gram) / count(context), or
for each order dropped ``ALPHA`` times the shorter context's score; an order above
one is seen if its count is at least ``CUTOFF`` (a rarer n-gram is counted, but
does not score), a single word always: its count over all words. Counts cover all rows.

Words are runs of ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered; n-grams do not cross
rows. Rows travel packed (sorted hashes as byte planes of their differences), as
the exploded rows would be several times the input.

Defined results: a null, empty or blank text has no words, score 0 and a null mean;
repeated rows count and score each; null ids are kept; texts of any length are
counted and scored whole; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .packed import CHUNK_BYTES, bounds, chunks, mix, planes, steps, unpack, unplanes

ORDER = 2
ALPHA = 0.4
CUTOFF = 2
RANGE_BYTES = 6 << 20      # text per hash range, about


# --- n-grams of a chunk ------------------------------------------------------

class Grams:
    """The n-grams of a chunk: per order the sorted distinct hashes, the count of
    each, and for each word the place of the n-gram that ends there (-1: none)."""

    def __init__(self, texts: list[bytes], order: int):
        words, self.sizes = [], np.zeros(len(texts), np.int64)
        known: dict[bytes, int] = {}
        for i, t in enumerate(texts):
            own = t.lower().split()
            self.sizes[i] = len(own)
            for w in own:
                h = known.get(w)
                if h is None:
                    h = known[w] = xxhash.xxh64_intdigest(w, 42)
                words.append(h)
        word = np.array(words, np.uint64)
        place = np.arange(len(word)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.hashes, self.counts, self.at = [], [], []
        gram = mix(word + np.uint64(1))
        for n in range(1, order + 1):
            if n > 1:      # the n-gram that ends at i: the one of n - 1 words that ends at i - 1, and word i
                longer = np.zeros_like(gram)
                longer[1:] = mix(gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + word[1:] + np.uint64(n))
                gram = longer
            valid = place >= n - 1
            distinct, inverse, count = np.unique(gram[valid], return_inverse=True, return_counts=True)
            at = np.full(len(word), -1, np.int64)
            at[valid] = inverse
            self.hashes.append(distinct)
            self.counts.append(count.astype(np.uint32))
            self.at.append(at)


# --- Spark -------------------------------------------------------------------

def exploded(packed: DataFrame, order: int, bits: int) -> DataFrame:
    """(range, chunk, n, hashes, counts): the distinct n-grams of every chunk, by hash range."""
    def explode(batches):
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob"), strict=True):
                grams = Grams(unpack(blob.as_py()), order)
                rows = []
                for n, (h, c) in enumerate(zip(grams.hashes, grams.counts, strict=True), 1):
                    cut = bounds(h, bits)
                    rows += [(r, chunk, n, planes(steps(h[a:b])), planes(c[a:b]))
                             for r, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
                for a in range(0, len(rows), 256):
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                        zip(*rows[a:a + 256], strict=True), (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()),
                        strict=True)], ["range", "chunk", "n", "hashes", "counts"])

    return packed.select("chunk", "blob").mapInArrow(
        explode, "range int, chunk long, n int, hashes binary, counts binary")


def joined(requests: DataFrame) -> DataFrame:
    """(chunk, n, range, counts): the totals of a range's n-grams, joined back to each chunk's own."""
    def total(rows: pd.DataFrame) -> pd.DataFrame:
        hashes = [np.cumsum(unplanes(x, np.uint64), dtype=np.uint64) for x in rows["hashes"]]
        counts = np.concatenate([unplanes(x, np.uint32) for x in rows["counts"]])
        _, where = np.unique(np.concatenate(hashes), return_inverse=True)
        totals = np.bincount(where, counts).astype(np.uint64)[where]
        cuts = np.cumsum([len(h) for h in hashes])[:-1]
        return pd.DataFrame({"chunk": rows["chunk"], "n": rows["n"], "range": rows["range"],
                             "counts": [planes(x) for x in np.split(totals, cuts)]})

    return requests.groupBy("n", "range").applyInPandas(total, "chunk long, n int, range int, counts binary")


def score(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, cutoff: int = CUTOFF, id_col: str = "doc_id",
          text_col: str = "text", chunk_bytes: int = CHUNK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per input row: id, n_words, n_seen (words scored at the full order),
    score (sum of log10) and mean_score."""
    packed = chunks(docs, id_col, text_col, chunk_bytes)
    size = packed.agg(F.sum("bytes")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, size / range_bytes))))
    replies = joined(exploded(packed, order, bits))

    def finish(key, own: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for ids, no_id, blob in zip(own["ids"], own["no_id"], own["blob"], strict=True):
            grams = Grams(unpack(blob), order)
            total = []
            for n in range(1, order + 1):
                parts = got[got["n"] == n].sort_values("range")["counts"]
                total.append(np.concatenate([np.zeros(0), *(unplanes(x, np.uint64) for x in parts)]))
            # log-scores, without the division by all words, which is the same for all rows
            count = [np.where(at >= 0, t[at] if len(t) else 0, 0) for t, at in zip(total, grams.at, strict=True)]
            best = np.log10(np.maximum(count[0], 1))
            level = np.ones(len(best), np.int64)
            for n in range(2, order + 1):
                before = np.r_[np.ones(min(1, len(best))), count[n - 2][:-1]]   # the context ends one word earlier
                seen = count[n - 1] >= cutoff
                with np.errstate(divide="ignore"):
                    full = np.log10(count[n - 1]) - np.log10(np.maximum(before, 1))
                can = grams.at[n - 1] >= 0      # words at a row's start have no such context to drop
                best = np.where(seen, full, best + np.where(can, math.log10(alpha), 0.0))
                level = np.where(seen, n, level)
            row = np.repeat(np.arange(len(ids)), grams.sizes)
            rows.append(pd.DataFrame({
                "id": pd.arrays.IntegerArray(np.asarray(ids, np.int64), np.asarray(no_id, bool)), "n_words": grams.sizes,
                "n_seen": np.bincount(row, level == order, len(ids)).astype(np.int64),
                "n_single": np.bincount(row, level == 1, len(ids)).astype(np.int64),
                "raw": np.bincount(row, best, len(ids))}))
        out = "id n_words n_seen n_single raw".split()
        return pd.concat(rows) if rows else pd.DataFrame({c: [] for c in out})

    scored = packed.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(
        finish, "id long, n_words long, n_seen long, n_single long, raw double")
    scored = written(scored, "scores")
    words = scored.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("words")).first()["words"]
    s = F.col("raw") - F.col("n_single") * F.lit(math.log10(max(words, 1)))
    return scored.select(F.col("id").alias(id_col), "n_words", "n_seen", s.alias("score"),
                         F.when(F.col("n_words") > 0, s / F.col("n_words")).alias("mean_score"))


def lm_query(docs: DataFrame) -> DataFrame:
    """The digest the op10 query returns (rounded: sums of doubles depend on their order)."""
    return score(docs).select("doc_id", "n_words", "n_seen", F.round("score", 4).alias("score"),
                              F.round("mean_score", 4).alias("mean_score"))
