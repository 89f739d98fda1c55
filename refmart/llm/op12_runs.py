"""Periodic runs in word sequences by internal pattern matching.

A run is a stretch of words with smallest period q, at least ``max(MIN_WORDS, 2 * q)``
words long, that cannot be extended. Many documents are worked on at once, as one array
of word numbers that are distinct per document, so nothing crosses a document:

1. Suffix array by prefix doubling. Round k names the words' stretches of length 2**k by
   the place of their first suffix; only stretches that occur again are sorted further.
   The names of all rounds answer "how far do two places agree" in both directions.
2. Dyadic blocks: stretches of 2**k words at every multiple of 2**(k-1). A run with period q
   from ``3 * 2**(k-1) - 1`` to ``3 * 2**k - 2`` (level 2: from 1) holds such a block whose
   next copy in the run is q words on. A block's occurrences are an interval of the suffix
   array; a wavelet tree over it answers "smallest occurrence from here on" (range
   successor), so each block is looked up in the window of its level's distances.
3. Occurrences closer than half a block form a progression whose end one comparison gives.
   A progression that holds the block itself lies in one run of that step, so only its step
   is a candidate period; each member of a later progression is one.
4. Each candidate (place, period) is extended both ways; long enough ones are runs, and of
   equal stretches the smallest period stays.

A level asks about its blocks that occur again within their document, at most
2 * words / 2**k of them, and a block meets a few progressions, so work and memory stay near
n log n for the words in hand.

Defined results: a null or empty text has no words and no runs; a null doc_id has no planted
repeat (``planted``) and is a key like any other; rows that repeat an id or a text are judged
one by one; texts of any length are read whole, a document longer than ``BATCH_WORDS`` is a
batch of its own (memory grows with the longest document, as the row itself does); an empty
table gives an empty result; further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 12
BATCH_WORDS = 1 << 17
LEVEL = 2              # the shortest blocks have 2**LEVEL words


# --- suffix array and names ----------------------------------------------------

class Names:
    """The suffix array of a sequence and, for every round k, equal numbers for equal stretches
    of 2**k words (of those that lie in the sequence). ``ids`` start at 0."""

    def __init__(self, ids: np.ndarray):
        n = self.n = len(ids)
        size = np.bincount(ids)
        start = np.cumsum(size) - size
        rank = start[ids]
        self.suffix = np.argsort(ids, kind="stable")
        self.rounds = [rank.astype(np.int32)]
        many = size[ids] > 1
        self.again = [many]       # per round: whether another suffix has the same name
        depth = 1
        # the suffixes with a name that is not theirs alone, in suffix order
        active = self.suffix[many[self.suffix]]
        while len(active):
            ahead = active + depth
            key = rank[active] * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
            order = np.argsort(key, kind="stable")
            key, active = key[order], active[order]
            new = np.r_[True, key[1:] != key[:-1]]
            group = np.r_[True, (key // (n + 1))[1:] != (key // (n + 1))[:-1]]
            at = np.arange(len(key))
            place = rank[active] + at - np.maximum.accumulate(np.where(group, at, 0))
            self.suffix[place] = active
            rank = rank.copy()
            rank[active] = np.maximum.accumulate(np.where(new, place, 0))
            alone = new & np.r_[new[1:], True]
            many = np.zeros(n, bool)
            many[active[~alone]] = True
            depth *= 2
            self.rounds.append(rank.astype(np.int32))
            self.again.append(many)
            active = active[~alone]

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words agree from a[i] and b[i] on (a < b)."""
        return self._agree(a, b, 1)

    def behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words agree before a[i] and b[i] (a < b)."""
        return self._agree(a, b, -1)

    def _agree(self, a, b, way):
        total = np.zeros(len(a), np.int64)
        a, b = a.copy(), b.copy()
        for k in range(len(self.rounds) - 1, -1, -1):
            width, name = 1 << k, self.rounds[k]
            low, high = (a, b + width) if way > 0 else (a - width, b)
            x, y = (a, b) if way > 0 else (a - width, b - width)
            # an unshared name of the last round is its suffix's own, so equal names mean equal words
            same = (low >= 0) & (high <= self.n)
            same[same] = name[x[same]] == name[y[same]]
            step = np.where(same, width, 0)
            total += step
            a += way * step
            b += way * step
        return total


class WaveletTree:
    """Range successor over an array of numbers below 2**bits (a wavelet matrix)."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.zeros, self.ones = bits, [], []
        for b in range(bits - 1, -1, -1):
            bit = (values >> b) & 1
            self.ones.append(np.r_[0, np.cumsum(bit)].astype(np.int32))
            self.zeros.append(len(values) - int(bit.sum()))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def below(self, low, high, value):
        """How many numbers of each [low, high) are smaller than value."""
        every, count = high - low, np.zeros(len(low), np.int64)
        for n, (zeros, ones) in enumerate(zip(self.zeros, self.ones, strict=True)):
            one = (value >> (self.bits - 1 - n)) & 1 == 1
            low1, high1 = ones[low], ones[high]
            count += np.where(one, (high - high1) - (low - low1), 0)
            low, high = np.where(one, zeros + low1, low - low1), np.where(one, zeros + high1, high - high1)
        return np.where(value >> self.bits > 0, every, count)

    def nth(self, low, high, rank):
        """The number of each [low, high) with ``rank`` smaller ones."""
        low, high, rank, out = low.copy(), high.copy(), rank.copy(), np.zeros(len(low), np.int64)
        for zeros, ones in zip(self.zeros, self.ones, strict=True):
            low1, high1 = ones[low], ones[high]
            few = (high - high1) - (low - low1)
            one = rank >= few
            rank -= np.where(one, few, 0)
            out = 2 * out + one
            low, high = np.where(one, zeros + low1, low - low1), np.where(one, zeros + high1, high - high1)
        return out

    def successor(self, low, high, value):
        """The smallest number of each [low, high) that is at least value; -1 for none."""
        rank = self.below(low, high, value)
        out = np.full(len(low), -1, np.int64)
        some = rank < high - low
        out[some] = self.nth(low[some], high[some], rank[some])
        return out


# --- runs ------------------------------------------------------------------------

def runs(ids: np.ndarray, longest: int | None = None, min_words: int = MIN_WORDS) -> np.ndarray:
    """The runs of a sequence of word numbers, rows (start, length, period) by start, then period.
    ``longest``: no stretch to look at has more words (the longest document's length)."""
    longest = len(ids) if longest is None else longest
    if longest < min_words:
        return np.zeros((0, 3), np.int64)
    names = Names(ids)
    found = [_candidates(names, k, longest) for k in range(LEVEL, len(names.rounds))
             if 3 * (1 << (k - 1)) - 1 <= longest // 2 or k == LEVEL]
    if not found or not sum(len(f[0]) for f in found):
        return np.zeros((0, 3), np.int64)
    at, period = (np.concatenate(x) for x in zip(*found, strict=True))
    end = at + period + names.ahead(at, at + period)
    start = at - names.behind(at, at + period)
    keep = end - start >= np.maximum(min_words, 2 * period)
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    out = np.stack([start, end - start, period], 1)[first]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _candidates(names: Names, k: int, longest: int):
    """(places, periods) that the blocks of level k propose."""
    width = 1 << k
    least, most = (1 if k == LEVEL else 3 * (width // 2) - 1), min(3 * width - 2, longest // 2)
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    block = np.arange(0, names.n - width + 1, width // 2)
    block = block[names.again[k][block]]
    if not len(block):
        return none
    # the occurrences of every block that occurs again, laid end to end: their part of the suffix array
    name = names.rounds[k]
    mine = names.again[k][names.suffix]
    part = names.suffix[mine]
    first = np.r_[0, np.cumsum(mine)]
    size = np.bincount(name[part], minlength=names.n)
    low = first[name[block]].astype(np.int64)
    high = low + size[name[block]]
    tree = WaveletTree(part, max(1, int(names.n - 1).bit_length()))

    places, periods = [], []

    def propose(x, d):
        fits = (d >= least) & (d <= most)
        places.append(x[fits])
        periods.append(d[fits])

    def progression(x, a, b):
        """Where two neighbouring occurrences overlap by half a block or more: the last member."""
        step = b - a
        close = step <= width // 2
        last = b.copy()
        reach = b[close] + names.ahead(a[close], b[close])
        last[close] = a[close] + (reach - width - a[close]) // step[close] * step[close]
        return close, last

    # the progression that holds the block itself
    x, nxt = block, tree.successor(low, high, block + 1)
    near = (nxt >= 0) & (nxt <= block + most)
    x, low, high, nxt = x[near], low[near], high[near], nxt[near]
    own, last = progression(x, x, nxt)
    propose(x[own], (nxt - x)[own])
    start = np.maximum(np.where(own, last + 1, nxt), x + least)
    before = np.full(len(x), -1, np.int64)      # the occurrence found just before, none at first
    while len(x):
        nxt = tree.successor(low, high, start)
        near = (nxt >= 0) & (nxt <= x + most)
        x, low, high, nxt, before = x[near], low[near], high[near], nxt[near], before[near]
        propose(x, nxt - x)
        start = nxt + 1
        pair = np.flatnonzero(before >= 0)
        if len(pair):
            close, last = progression(x[pair], before[pair], nxt[pair])
            p = pair[close]
            step, far = nxt[p] - before[p], np.minimum(last[close], x[p] + most)
            more = np.maximum(0, (far - nxt[p]) // step)
            each = np.repeat(np.arange(len(p)), more)
            nth = np.arange(len(each)) - np.repeat(np.cumsum(more) - more, more) + 1
            propose(x[p][each], nxt[p][each] + nth * step[each] - x[p][each])
            start[p] = last[close] + 1
        before = np.where(start == nxt + 1, nxt, -1)
    return (np.concatenate(places), np.concatenate(periods)) if places else none


# --- documents ---------------------------------------------------------------------

def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The contract's planted repeat: which original word stands at each place; None for as it is."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + np.arange(n - a) % p
    return order


def batch_runs(texts: list[list], orders: list) -> list[np.ndarray]:
    """Per document (its words, and which of them stands where): its runs, places from 0."""
    parts, lengths, base = [], [], 0
    for words, order in zip(texts, orders, strict=True):
        table = dict(zip(dict.fromkeys(words), itertools.count(base)))
        ids = np.fromiter(map(table.__getitem__, words), np.int64, len(words))
        parts.append(ids if order is None else ids[order])
        lengths.append(len(ids))
        base += len(table)
    if not base:
        return [np.zeros((0, 3), np.int64)] * len(texts)
    ids = np.concatenate(parts)
    _, ids = np.unique(ids, return_inverse=True) if any(o is not None for o in orders) else (None, ids)
    found = runs(ids, max(lengths))
    ends = np.cumsum(lengths)
    cut = np.searchsorted(found[:, 0], np.r_[0, ends])
    return [found[a:b] - [s, 0, 0] for a, b, s in zip(cut[:-1], cut[1:], ends - lengths, strict=True)]


def digest(doc_id, words: list, order, found: np.ndarray) -> tuple:
    """The result row of a document."""
    if order is not None:
        words = [words[i] for i in order.tolist()]
    if not len(found):
        return (doc_id, 0, None, None, None, None, hashlib.sha256(b"").hexdigest(),
                hashlib.sha256(b" ".join(words)).hexdigest(), [], len(words))
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, found[:, 0] + found[:, 2], 1)
    np.add.at(gone, found[:, 0] + found[:, 1], -1)
    keep = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
    rows = found.tolist()
    start, length, period = min(rows, key=lambda r: (-r[1], r[0], r[2]))
    text = "".join(f"{a},{b},{c}\n" for a, b, c in rows)
    return (doc_id, len(rows), start, length, period, 1000 * length // period, hashlib.sha256(text.encode()).hexdigest(),
            hashlib.sha256(b" ".join([words[i] for i in keep.tolist()])).hexdigest(),
            [{"start": a, "length": b, "period": c} for a, b, c in rows], len(keep))


SCHEMA = pa.schema([("id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()),
                    ("collapsed_sha256", pa.string()),
                    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                    ("n_kept", pa.int64())])
DDL = ("id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
       "collapsed_sha256 string, runs array<struct<start:long,length:long,period:long>>, n_kept long")


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """One row per document: its runs (all of them and the longest one), and digests of the runs and
    of the text without their repeated words. ``plant``: with the contract's planted repeats."""
    def work(batches):
        held, words_held = [], 0

        def flush():
            orders = [planted(i, len(w)) if plant else None for i, w in held]
            found = batch_runs([w for _, w in held], orders)
            rows = [digest(i, w, o, f) for (i, w), o, f in zip(held, orders, found, strict=True)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
                zip(*rows, strict=True), SCHEMA, strict=True)], schema=SCHEMA)

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = t.as_buffer().to_pybytes().split() if t.is_valid else []
                if held and words_held + len(words) > BATCH_WORDS:
                    yield flush()
                    words_held = 0
                held.append((i, words))
                words_held += len(words)
        if held:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    return rows.mapInArrow(work, DDL).withColumnRenamed("id", id_col)


def runs_query(docs: DataFrame) -> DataFrame:
    """The op12 query: the contract's columns over whole documents."""
    return detect(docs, plant=True).select("doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                                           "runs_sha256", "collapsed_sha256")
