"""Sampled SentencePiece segmentations: forward filtering, backward sampling.

A text's piece lattice falls apart at the start of every run of blanks and at line
feeds, because no piece of the vocabulary reaches over them. For each such unit the
forward pass sums the probability of reaching every position; the backward pass
then draws the last piece, the one before it, and so on, each in proportion to the
paths through it. The lattice of a unit is built once per worker (a bounded
memory); all occurrences of a batch are drawn together with numpy.

Draws are a hash of (seed, row key, unit number, step): the same row gives the same
segmentation on any executor, in any batch, after any retry. Decoding is lossless:
characters without a piece (and a literal U+2581, the vocabulary's blank) are spelt
as byte pieces, white space is never normalised, and the one blank put before the
text is taken off again.

Piece probabilities follow the vocabulary's merge ranks by a power law (Zipf),
sharpened by ``SHARPNESS``.

Defined results: a null text has null ids and decodes to null; an empty text has no
pieces and decodes to an empty text; a null key is one fixed key; repeated rows get
the same ids; very long texts are drawn in blocks of units; other columns are kept.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SEED = 1
SHARPNESS = 1.0
CACHE = 900_000      # lattice nodes that a worker remembers, about
SHORT = 40           # characters of a unit that shares its nodes
BLOCK = 200_000      # units drawn at once
TINY = 1e-200        # forward sums below this are scaled up

_UNITS = re.compile(r" *[^ \n]+|\n| +")


class Vocabulary:
    """Pieces by text (blanks as blanks), their probabilities and bytes."""

    def __init__(self, model: str = MODEL, sharpness: float = SHARPNESS):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        self.ids: dict[str, int] = {}
        self.byte = [0] * 256
        spelt: list[bytes] = []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[1:-1], 16)] = i
                spelt.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                spelt.append(b"")
            else:
                self.ids[piece.replace("▁", " ")] = i
                spelt.append(piece.replace("▁", " ").encode())
        crossing = [p for p in self.ids if "\n" in p or " " in p.lstrip(" ")]
        if crossing:
            raise ValueError(f"pieces reach over a unit's border: {crossing[:3]}")
        # ranks from the scores: a merge made earlier is a more frequent piece
        ranked = sorted(self.ids.items(), key=lambda x: -sp.get_score(x[1]))
        weight = {p: (r + 2.0) ** -sharpness for r, (p, _) in enumerate(ranked)}
        total = sum(weight.values())
        self.p = {p: (w / total, self.ids[p]) for p, w in weight.items()}
        # every end of a piece: (probability, id), or (0, -1) if it is none itself
        self.ends = {p[i:]: (0.0, -1) for p in self.p for i in range(1, len(p))} | self.p
        self.longest = max(map(len, self.ids))
        self.size = np.array([len(b) for b in spelt], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(spelt), np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids (as ``Sampler`` made them)."""
        size = self.size[ids]
        if not len(ids):
            return ""
        first = np.cumsum(size) - size
        where = np.repeat(self.at[ids] - first, size) + np.arange(size.sum())
        return self.bytes[where].tobytes().decode()[1:]


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sampler:
    """Lattices of units in flat arrays, and draws from them.

    A node is a beginning of a unit: its forward sum does not depend on what follows,
    so units share the nodes of common beginnings. Node k has the edges from
    ``first[k]`` on, likeliest first; ``cdf`` is the running share of each, ``source``
    the node it starts at (-1 at the unit's start), ``piece`` its id."""

    def __init__(self, vocabulary: Vocabulary, seed: int = SEED):
        self.v, self.seed = vocabulary, seed
        self._clear()

    def _clear(self):
        self.known: dict[str, int] = {}       # beginnings of short units
        self.forward, self.first = array("d"), array("i")
        self.cdf, self.source, self.piece = array("d"), array("i"), array("H")

    def _node(self, edges: list[tuple[float, int, int]]) -> int:
        """A new node for (weight, source, piece) edges; the forward sum is their sum."""
        edges.sort(reverse=True)
        total = 0.0
        for q, _, _ in edges:
            total += q
        self.forward.append(total)
        self.first.append(len(self.cdf))
        run = 0.0
        for q, s, i in edges:
            run += q
            self.cdf.append(run / total)
            self.source.append(s)
            self.piece.append(i)
        self.cdf[-1] = 2.0        # beyond every draw
        return len(self.first) - 1

    def _spell(self, ch: str, node: int, total: float) -> int:
        """The byte pieces of a character that has no piece."""
        for b in ch.encode():
            node = self._node([(total, node, self.v.byte[b])])
        return node

    def _edges(self, unit: str, e: int, node: list, total: list) -> list:
        """The edges into border e of ``unit``: every piece that ends there. ``node`` and
        ``total`` are lists that end with the borders before e."""
        ends, out, l = self.v.ends, [], 1
        while l <= e:
            got = ends.get(unit[e - l:e])
            if got is None:
                break
            if got[1] >= 0 and total[-l] is not None:
                out.append((total[-l] * got[0], node[-l], got[1]))
            l += 1
        return out

    def _short(self, unit: str) -> int:
        """Forward filtering of a short unit from its longest known beginning (written out:
        nearly all lattices are built here)."""
        known, forward, first = self.known, self.forward, self.first
        cdf, source, piece, ends = self.cdf, self.source, self.piece, self.v.ends.get
        n = len(unit)
        e = n - 1
        while e and unit[:e] not in known:
            e -= 1
        # the borders that a piece can still start from
        node, total = [-1], [1.0]
        for j in range(max(1, e + 1 - self.v.longest), e + 1):
            k = known[unit[:j]]
            node.append(k)
            total.append(forward[k])
        if e >= self.v.longest:
            del node[0], total[0]
        while e < n:
            e += 1
            edges, whole, l = [], 0.0, 1
            while l <= e:
                got = ends(unit[e - l:e])
                if got is None:
                    break
                q, i = got
                if i >= 0:
                    q *= total[-l]
                    whole += q
                    edges.append((q, node[-l], i))
                l += 1
            k = len(first)
            if len(edges) == 1:
                first.append(len(cdf))
                forward.append(whole)
                cdf.append(2.0)
                source.append(edges[0][1])
                piece.append(edges[0][2])
            elif edges:
                edges.sort(reverse=True)
                first.append(len(cdf))
                forward.append(whole)
                run = 0.0
                for q, s, i in edges:
                    run += q
                    cdf.append(run / whole)
                    source.append(s)
                    piece.append(i)
                cdf[-1] = 2.0
            else:
                k = self._spell(unit[e - 1], node[-1], total[-1])
                whole = total[-1]
            known[unit[:e]] = k
            node.append(k)
            total.append(whole)
        return node[-1]

    def _long(self, unit: str) -> int:
        """The same for a unit of any length, not shared: only the last borders are
        held, and their sums are scaled up together (only ratios matter)."""
        node, total, longest = [-1], [1.0], self.v.longest
        for e in range(1, len(unit) + 1):
            edges = self._edges(unit, e, node, total)
            k = self._node(edges) if edges else self._spell(unit[e - 1], node[-1], total[-1])
            node.append(k)
            total.append(self.forward[k])
            if len(node) > 4 * longest:
                del node[:-longest], total[:-longest]
            if total[-1] < TINY:
                total = [x / TINY for x in total[-longest:]]
                del node[:-longest]
        return node[-1]

    def draw(self, units: list[str], key: int) -> np.ndarray:
        """Backward sampling of the ids of consecutive units of one row, or block of it."""
        return self._draw([units], [key], [0])[0]

    def _draw(self, rows: list[list[str]], keys: list[int], starts: list[int]) -> list[np.ndarray]:
        """Ids per row; ``starts``: the number of each row's first unit here."""
        if len(self.known) > CACHE:
            self._clear()
        known, flat = self.known, []
        for units in rows:
            for u in units:
                k = known.get(u)
                if k is None:
                    k = self._short(u) if len(u) <= SHORT else self._long(u)
                flat.append(k)
        sizes = np.array([len(u) for u in rows])
        row = np.repeat(np.arange(len(rows)), sizes)
        number = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.array(starts)[row]
        salt = _mix(np.array(keys, np.int64).astype(np.uint64) + np.uint64(self.seed * 0x9E3779B97F4A7C15 % (1 << 64)))
        salt = _mix(salt[row] + number.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        first, cdf, source, piece = (np.frombuffer(x, t) for x, t in (
            (self.first, np.int32), (self.cdf, np.float64), (self.source, np.int32), (self.piece, np.uint16)))
        now, who = np.array(flat, np.int32), np.arange(len(flat), dtype=np.int32)
        steps = []
        while len(who):
            step = np.uint64((len(steps) + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
            u = (_mix(salt[who] + step) >> np.uint64(11)).astype(np.float64) / (1 << 53)
            edge = first[now]
            far = np.flatnonzero(cdf[edge] <= u)
            while len(far):        # to the next edges, for those that draw beyond the likeliest
                edge[far] += 1
                far = far[cdf[edge[far]] <= u[far]]
            steps.append((who, piece[edge]))
            now = source[edge]
            on = np.flatnonzero(now >= 0)
            now, who = now[on], who[on]
        count = np.zeros(len(flat), np.int64)
        for w, _ in steps:
            count[w] += 1
        last = np.cumsum(count) - 1
        out = np.empty(int(count.sum()), "<u2")
        for t, (w, ids) in enumerate(steps):
            out[last[w] - t] = ids
        del first, cdf, source, piece    # the arrays can grow again
        ends = np.cumsum(np.bincount(row, count, len(rows)).astype(np.int64)) if len(rows) else []
        return np.split(out, ends[:-1]) if len(rows) else []

    def encode(self, texts: list[str | None], keys: list[int]) -> list[bytes | None]:
        """Little-endian uint16 ids of every text."""
        out: list = [None if t is None else [] for t in texts]
        rows, owner, starts, held = [], [], [], 0

        def flush():
            for i, ids in zip(owner, self._draw(rows, [keys[i] for i in owner], starts), strict=True):
                out[i].append(ids.tobytes())
            rows.clear(), owner.clear(), starts.clear()

        for i, t in enumerate(texts):
            units = _UNITS.findall(" " + t) if t else []
            for a in range(0, len(units), BLOCK):
                part = units[a:a + BLOCK]
                rows.append(part)
                owner.append(i)
                starts.append(a)
                held += len(part)
                if held >= BLOCK:
                    flush()
                    held = 0
        if rows:
            flush()
        return [None if x is None else b"".join(x) for x in out]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "ids", seed: int = SEED,
           model: str = MODEL) -> DataFrame:
    """``docs`` with the sampled ids of each text as column ``out`` (binary, uint16, little-endian)."""
    held = {}

    @F.pandas_udf("binary")
    def sample(keys: pd.Series, texts: pd.Series) -> pd.Series:
        if "s" not in held:
            held["s"] = Sampler(Vocabulary(model), seed)
        return pd.Series(held["s"].encode([t if isinstance(t, str) else None for t in texts], keys.tolist()),
                         dtype=object)

    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-1 << 63).cast("long"))
    return docs.withColumn(out, sample.asNondeterministic()(key, F.col(f"`{text_col}`")))


def decode(rows: DataFrame, ids_col: str = "ids", out: str = "decoded", model: str = MODEL) -> DataFrame:
    """``rows`` with the text of the ids as column ``out``."""
    held = {}

    @F.pandas_udf("string")
    def spell(cells: pd.Series) -> pd.Series:
        if "v" not in held:
            held["v"] = Vocabulary(model)
        return pd.Series([None if c is None else held["v"].decode(np.frombuffer(c, "<u2")) for c in cells],
                         dtype=object)

    return rows.withColumn(out, spell(F.col(f"`{ids_col}`")))


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ids: str = "ids",
               lossless: str = "lossless", seed: int = SEED, model: str = MODEL) -> DataFrame:
    """``docs`` with the sampled ids and whether they decode to the text, in one pass over
    the rows (one Python worker a task, where ``decode`` after ``encode`` takes two)."""
    held = {}

    @F.pandas_udf("ids binary, lossless boolean")
    def both(keys: pd.Series, texts: pd.Series) -> pd.DataFrame:
        if "s" not in held:
            held["s"] = Sampler(Vocabulary(model), seed)
        s, plain = held["s"], [t if isinstance(t, str) else None for t in texts]
        cells = s.encode(plain, keys.tolist())
        return pd.DataFrame({"ids": cells, "lossless": [
            c is None or s.v.decode(np.frombuffer(c, "<u2")) == t for c, t in zip(cells, plain, strict=True)]})

    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-1 << 63).cast("long"))
    drawn = docs.select(*[F.col(f"`{c}`") for c in docs.columns],
                        both.asNondeterministic()(key, F.col(f"`{text_col}`")).alias("k_both"))
    return drawn.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("k_both.ids").alias(ids),
                        F.col("k_both.lossless").alias(lossless))


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """One row per input row: id, n_chars, n_pieces, ids_sha256, lossless (the ids decode to the text)."""
    small = docs.select(F.col(id_col).alias("k_id"), F.col(text_col).alias("k_text"))
    both = round_trip(small, "k_id", "k_text", "k_ids", "k_ok", seed)
    return both.select(F.col("k_id").alias(id_col), F.char_length("k_text").cast("long").alias("n_chars"),
                       (F.octet_length("k_ids") / 2).cast("long").alias("n_pieces"),
                       F.sha2("k_ids", 256).alias("ids_sha256"), F.col("k_ok").alias("lossless"))
