"""Source divergence audit over a minimal acyclic transducer vocabulary.

Terms are runs of letters; a language keeps the terms that at least ``MIN_DOCS`` of its
documents have. How far a source's term shares are from another source's, and which terms
stand out against the whole language, comes from exact integer arithmetic:

1. Document frequencies: each task counts the distinct terms of its documents, Spark adds
   them up per (lang, term).
2. Kept terms are range-sorted and numbered per language in UTF-8 byte order (ordinals). Of
   every ``PIECE`` ordinals a task builds a minimal acyclic transducer (``transducer.py``).
3. All texts are streamed through the transducers for recounting: a word's path ends in its
   ordinal or nowhere. The transducers are broadcast in blocks of at most ``BLOCK_BYTES``;
   each block is one pass over the texts (one for some ten million terms), so neither the
   driver nor a task ever holds more, however large the vocabulary.
4. Counts are added up per (lang, source, ordinal) by Spark. A block of ordinals then
   compares all its sources as a matrix, the block being narrower the more sources there
   are; blocks emit partial sums per pair and their ten best terms per source. Ties between
   terms go by ordinal, which is UTF-8 order.

Defined results: null text, lang and source are ''; every (lang, source) group that occurs
counts, also one without terms; a language with one source has no pairs, one without kept
terms has pairs of value 0; rows that repeat a doc_id or a text count each time; a null
doc_id matters not; texts and terms of any length are read whole; an empty table gives an
empty result; further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .transducer import LOWER, Transducer, terms_of

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
PIECE = 1 << 17                # terms of a transducer
BLOCK_BYTES = 64 << 20         # of transducers broadcast at once
HELD_TERMS = 200_000           # distinct terms a task holds before it passes their counts on
HELD_COUNTS = 1 << 21          # (source, ordinal) counts likewise
SLICE_BYTES = 4 << 20          # text walked at once
CELLS = 1 << 21                # of a block's matrix: sources times ordinals


def _documents(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in (
        (lang_col, "lang"), (source_col, "source"), (text_col, "text"))])


# --- vocabulary ----------------------------------------------------------------

def _document_frequencies(batches):
    held: dict[str, Counter] = {}
    known = 0

    def flush():
        langs = [lang for lang, c in held.items() for _ in c]
        out = pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array([t.decode() for c in held.values() for t in c], pa.string()),
             pa.array([n for c in held.values() for n in c.values()], pa.int64())], ["lang", "term", "n"])
        held.clear()
        return out

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counter = held.setdefault(lang, Counter())
            before = len(counter)
            counter.update(set(terms_of(text.as_buffer().to_pybytes())))
            known += len(counter) - before
            if known > HELD_TERMS:
                yield flush()
                known = 0
    if held:
        yield flush()


def vocabulary(d: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, ord): the kept terms, numbered from 0 per language in UTF-8 order."""
    kept = d.select("lang", "text").mapInArrow(_document_frequencies, "lang string, term string, n long").groupBy(
        "lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)
    # numbers that rise with (lang, term), from the place of a row in its range
    ranged = written(kept.select("lang", "term").repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
                     .withColumn("at", F.monotonically_increasing_id())
                     .withColumn("part", F.spark_partition_id()), "ranged_terms")
    parts = ranged.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low"))
    ahead = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("lang", "part", "low", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    return written(ranged.join(parts, ["lang", "part"]).select(
        "lang", "term", (F.col("base") + F.col("at") - F.col("low")).alias("ord")), "terms")


def transducers(terms: DataFrame, piece: int = PIECE) -> DataFrame:
    """(lang, piece, bytes, blob): a transducer for every ``piece`` ordinals of a language."""
    def build(key, rows: pd.DataFrame) -> pd.DataFrame:
        t = Transducer([x.encode() for x in rows.sort_values("ord")["term"]])
        return pd.DataFrame({"lang": [key[0]], "piece": [key[1]], "bytes": [t.bytes], "blob": [t.dump()]})

    pieces = terms.withColumn("piece", F.expr(f"ord div {piece}"))
    return written(pieces.groupBy("lang", "piece").applyInPandas(
        build, "lang string, piece long, bytes long, blob binary"), "transducers")


# --- recounting ------------------------------------------------------------------

def _recount(batches, tables, piece: int):
    """(lang, source, ord, n) of the texts, from transducers (lang, piece, blob)."""
    loaded: dict[str, list] = {}
    for lang, number, blob in tables.value:
        loaded.setdefault(lang, []).append((number * piece, Transducer.load(blob)))
    sources: dict[str, dict[str, int]] = {}
    waiting: dict[str, list] = {}           # lang: its texts and their sources, to be walked together
    bytes_waiting: Counter = Counter()
    held: dict[str, list] = {}              # lang: (source << 32 | ordinal, count) arrays
    count = 0

    def take(lang):
        nonlocal count
        texts, owner = zip(*waiting.pop(lang), strict=True)
        bytes_waiting[lang] = 0
        text = np.frombuffer(b" ".join(texts).translate(LOWER), np.uint8)
        firsts = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
        edge = np.flatnonzero(np.diff(np.r_[False, text != 32, False]))
        start, length = edge[::2], edge[1::2] - edge[::2]
        who = np.array(owner, np.int64)[np.searchsorted(firsts, start, side="right") - 1] << 32
        for base, t in loaded[lang]:
            word, ordinal = t.walk(text, start, length)
            key, n = np.unique(who[word] + (ordinal.astype(np.int64) + base), return_counts=True)
            held.setdefault(lang, []).append((key, n))
            count += len(key)

    def merge():
        nonlocal count
        count = 0
        for lang, parts in held.items():
            key, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            n = np.zeros(len(key), np.int64)
            np.add.at(n, inverse, np.concatenate([x for _, x in parts]))
            held[lang] = [(key, n)]
            count += len(key)

    def rows():
        for lang, ((key, n),) in held.items():
            names = pa.array(list(sources[lang]), pa.string())
            for a in range(0, len(key), 1 << 16):
                k = key[a:a + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(k), np.int64))),
                     names.take(pa.array(k >> 32)), pa.array(k & 0xFFFFFFFF), pa.array(n[a:a + (1 << 16)])],
                    ["lang", "source", "ord", "n"])
        held.clear()

    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2),
                                      strict=True):
            if lang not in loaded:
                continue
            known = sources.setdefault(lang, {})
            data = text.as_buffer().to_pybytes()
            waiting.setdefault(lang, []).append((data, known.setdefault(source, len(known))))
            bytes_waiting[lang] += len(data)
            if sum(bytes_waiting.values()) > SLICE_BYTES:
                for each in list(waiting):
                    take(each)
                if count > HELD_COUNTS:
                    merge()
                    if count > HELD_COUNTS // 2:
                        yield from rows()
                        count = 0
    for each in list(waiting):
        take(each)
    merge()
    yield from rows()


def blocks_of(sizes: list[tuple], most: int) -> list[list[tuple]]:
    """(lang, piece) lists of at most ``most`` bytes each (a single larger one stands alone)."""
    out, held = [], 0
    for lang, piece, size in sizes:
        if not out or held + size > most:
            out.append([])
            held = 0
        out[-1].append((lang, piece))
        held += size
    return out


def counts(d: DataFrame, machines: DataFrame, piece: int = PIECE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, source, ord, n): how often each kept term occurs in each group. ``machines``: ``transducers``."""
    spark = d.sparkSession
    schema = "lang string, source string, ord long, n long"
    out = spark.createDataFrame([], schema)
    sizes = [tuple(r) for r in machines.select("lang", "piece", "bytes").orderBy("lang", "piece").collect()]
    for block in blocks_of(sizes, block_bytes):
        low, high = block[0], block[-1]        # the blocks follow the order of (lang, piece)
        chosen = ((F.col("lang") > low[0]) | ((F.col("lang") == low[0]) & (F.col("piece") >= low[1]))) & (
            (F.col("lang") < high[0]) | ((F.col("lang") == high[0]) & (F.col("piece") <= high[1])))
        tables = spark.sparkContext.broadcast([tuple(r) for r in machines.where(chosen).select(
            "lang", "piece", "blob").collect()])
        found = d.mapInArrow(partial(_recount, tables=tables, piece=piece), schema)
        out = out.unionByName(written(found.groupBy("lang", "source", "ord").agg(F.sum("n").alias("n")), "counts"))
        tables.unpersist()
    return out


# --- comparison --------------------------------------------------------------------

def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / total), digit by digit so that nothing overflows."""
    total = np.asarray(total, np.int64)
    rest = count + 2
    out, rest = rest // total, rest % total
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _compare(key, cells: pd.DataFrame, info: pd.DataFrame, width: int) -> pd.DataFrame:
    """Of a block of ordinals: partial sums of all pairs, and the best terms of each source."""
    lang, number = key
    info = info.sort_values("source")
    names = info["source"].to_numpy()
    first = int(number) * width
    v = int(info["v"].iloc[0])
    m = np.zeros((len(names), min(width, v - first)), np.int64)
    m[pd.Index(names).get_indexer(cells["source"]), cells["ord"].to_numpy() - first] = cells["n"]
    p = shares(m, (info["total"].to_numpy() + 2 * v)[:, None])
    q = shares(m.sum(0), info["lang_total"].iloc[0] + 2 * v)
    out = []
    for s, name in enumerate(names):
        value = distance(p[s], p).sum(1)
        other = np.arange(len(names)) != s
        out.append(pd.DataFrame({"source": name, "item": names[other], "ord": -1, "value": value[other]}))
        over = np.flatnonzero((m[s] > 0) & (p[s] > q))
        value = distance(p[s][over], q[over])
        best = np.lexsort((over, -value))[:TOP_TERMS]
        out.append(pd.DataFrame({"source": name, "item": None, "ord": over[best] + first, "value": value[best]}))
    frame = pd.concat(out, ignore_index=True)
    frame.insert(0, "lang", lang)
    return frame


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, piece: int = PIECE, block_bytes: int = BLOCK_BYTES, cells: int = CELLS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` holds every other source of the
    language, part ``term`` the ``TOP_TERMS`` terms that stand out most."""
    d = _documents(docs, text_col, lang_col, source_col)
    terms = vocabulary(d, min_docs)
    found = counts(d, transducers(terms, piece), piece, block_bytes)
    groups = d.select("lang", "source").distinct()
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    kept = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    info = groups.join(totals, ["lang", "source"], "left").join(kept, "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"))
    per_lang = info.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.count(F.lit(1)).alias("n_sources"))
    info = written(info.join(per_lang, "lang"), "groups")
    most = info.agg(F.max("n_sources")).first()[0] or 1
    width = max(1, min(1 << 12, cells // most))
    grid = info.where("v > 0").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(v - 1) div {width}"))))
    part = found.withColumn("block", F.expr(f"ord div {width}")).groupBy("lang", "block").cogroup(
        grid.groupBy("lang", "block")).applyInPandas(
        lambda key, a, b: _compare(key, a, b, width), "lang string, source string, item string, ord long, value long")
    part = written(part, "compared")

    by_source = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    flat = info.where("v = 0")       # no kept terms: every pair is at distance 0
    zero = flat.select("lang", "source").join(flat.select("lang", F.col("source").alias("item")), "lang").where(
        "source <> item").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    pairs = part.where("ord < 0").groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).unionByName(zero)
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                         F.row_number().over(by_source).alias("rank"))
    by_ordinal = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ord")
    best = part.where("ord >= 0").withColumn("rank", F.row_number().over(by_ordinal)).where(F.col("rank") <= TOP_TERMS)
    best = best.join(terms, ["lang", "ord"]).select("lang", "source", F.lit("term").alias("part"),
                                                    F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(best)


def divergence_query(docs: DataFrame) -> DataFrame:
    """The op11 query: the audit of the documents table."""
    return audit(docs)
