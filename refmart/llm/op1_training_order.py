"""Training-order materialisation of token-id sequences.

Texts are encoded by a public byte-level BPE and cut into sequences of ``LENGTH``
ids (an end-of-text id closes each document). Every possible sequence of a document
owns a number, ``((doc_id - lowest) * copies + copy) * most + its place``: known
without counting tokens first. A keyed Feistel permutation with cycle-walking maps the
numbers onto themselves; the result is the sequence's place in the training order, so
the order depends on the key, the range of the ids, the longest text and ``copies``.
Numbers of more than 62 bits (ids spread over all 64 bits) are kept as two halves.
Ranges of the permuted numbers are the shards: each goes to one task, is sorted and
written as records of one fixed stride, so a reader resumes at any record by a seek:
``read(from_slot=...)`` opens only the shards from that slot on.
Numbers that no sequence uses leave no hole in the files: the global slot of a
record is its shard's base (a running sum of the shards' record counts) plus its
row, and follows the permuted order.

A record: doc_id (int64), place (uint32), ids used (uint16), flags (uint16, 1: the
doc_id is null), LENGTH uint16 ids (padded with end-of-text), and one line feed,
which is the writer's separator. Everything is little-endian.

Defined results: a null or empty text is one sequence of the end-of-text id alone;
null ids share one number range behind the last id; an empty table writes no shard;
very long texts are encoded in pieces of bounded size; other columns are ignored.
Repeated rows are written once each. With ``copies`` of 1 rows that share an id (or
have none) share its numbers and stand next to one another. With more, as in the
query, such rows are permuted apart: ``copy`` is a hash of the text, and for a row that
a task has seen before, of the text, the task's partition and the repeat's count, so an
id or a row that a third of the table repeats fills no shard, and a task that runs
again deals the same records. Only the first of equal rows of each task share a number.
A task remembers a hash of 64 bits of each of its rows.
"""

from __future__ import annotations

import base64
import re
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_path

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LENGTH = 256                 # ids of a sequence
END = 50256                  # free in the vocabulary: end of text, and padding
SHARD_TEXT = 16 << 20        # bytes of text to a shard, about
ROUNDS = 6
CACHE = 400_000              # words whose ids a worker remembers
COPIES = 1 << 20             # numbers that rows of one id are dealt over, in the query
HEAD = "<qIHH"
STRIDE = struct.calcsize(HEAD) + 2 * LENGTH + 1

# Fixed value: how the vocabulary cuts a text before merging.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_BLANK_RUN = re.compile(r"\s ")


class _Known(dict):
    """The ids of words that follow ``lead``, looked up or encoded; at most ``most`` are remembered."""

    def __init__(self, encode, lead: str, most: int):
        super().__init__()
        self.encode, self.lead, self.most = encode, lead, most

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(self.lead + word)
        if len(word) < 64:
            if len(self) >= self.most:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Byte-level BPE with a bounded memory of words. Cutting before a lone blank
    between two other characters never changes the encoding, because the pattern
    always starts a new piece there."""

    def __init__(self, vocabulary: str = VOCABULARY):
        import tiktoken
        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("ids", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.first = _Known(self._ids, "", CACHE // 4)
        self.later = _Known(self._ids, " ", CACHE - CACHE // 4)

    def _ids(self, text: str) -> bytes:
        return np.array(self.bpe.encode_ordinary(text), dtype="<u2").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian uint16."""
        out, later = [], self.later.__getitem__
        for piece in self._pieces(text):
            words = piece.split(" ")
            out.append(self.first[words[0]])
            out.extend(map(later, words[1:]))
        return b"".join(out)

    @staticmethod
    def _pieces(text: str):
        """Stretches in which each blank is alone, and so can be cut at; a run of
        white space stays whole, with what follows it up to the next lone blank."""
        if not _BLANK_RUN.search(text) and not re.search(r" \s", text):
            yield text
            return
        at = 0
        for m in re.finditer(r"(?<=\S) (?=\S)", text):
            if m.start() > at or at == 0:
                yield _Whole(text[at:m.start()])
            at = m.start()
        yield _Whole(text[at:])


class _Whole(str):
    """A stretch that is encoded as it is."""

    def split(self, _):
        return [str(self)]


@dataclass(frozen=True)
class Order:
    """The numbering and its permutation."""
    lowest: int
    ids: int        # doc_id range
    most: int       # sequences that a document can have
    key: int
    copies: int = 1  # numbers of an id and place

    @property
    def size(self) -> int:
        return (self.ids + 1) * self.copies * self.most      # the last range is for null ids

    @property
    def half(self) -> int:
        """Bits of one side of the network; both together cover the domain."""
        return max(1, (max(self.size - 1, 1).bit_length() + 1) // 2)

    @property
    def shift(self) -> int:
        """Low bits that a permuted number has beyond a long."""
        return max(0, 2 * self.half - 62)

    def number(self, doc_id: int | None, place: int, copy: int = 0) -> int:
        return ((self.ids if doc_id is None else doc_id - self.lowest) * self.copies + copy) * self.most + place

    def halves(self, numbers) -> tuple[np.ndarray, np.ndarray]:
        """Keyed Feistel network on 2 * half bits, the two sides of each permuted number; values outside
        the domain walk on along their cycle until they are inside."""
        half, low = self.half, (1 << self.half) - 1
        if self.shift:
            a, b = (np.array([f(int(n)) for n in numbers], np.uint64) for f in (lambda n: n >> half, lambda n: n & low))
        else:
            n = np.asarray(numbers, np.int64).astype(np.uint64)
            a, b = n >> np.uint64(half), n & np.uint64(low)
        keys = [np.uint64((self.key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % (1 << 64)) for r in range(ROUNDS)]

        def once(a, b):
            for k in keys:
                f = (b ^ k) * np.uint64(0xBF58476D1CE4E5B9)
                f = (f ^ (f >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
                a, b = b, (a ^ (f >> np.uint64(32)) ^ (f << np.uint64(32) if half > 32 else np.uint64(0))) & np.uint64(low)
            return a, b

        end_a, end_b = (np.uint64(x) for x in divmod(self.size, 1 << half))
        a, b = once(a, b)
        while (far := (a > end_a) | ((a == end_a) & (b >= end_b))).any():
            a[far], b[far] = once(a[far], b[far])
        return a, b

    def split(self, numbers) -> tuple[np.ndarray, np.ndarray]:
        """The permuted numbers: their leading 62 bits, and the ``shift`` bits after them."""
        a, b = self.halves(numbers)
        top = (a << np.uint64(self.half - self.shift)) | (b >> np.uint64(self.shift))
        return top.astype(np.int64), (b & np.uint64((1 << self.shift) - 1)).astype(np.int64)

    def permute(self, numbers) -> np.ndarray:
        """The permuted numbers; Python's integers where they do not fit a long."""
        top, low = self.split(numbers)
        return (top.astype(object) << self.shift) | low.astype(object) if self.shift else top


def order(docs: DataFrame, key: int, id_col: str = "doc_id", text_col: str = "text",
          copies: int = 1) -> tuple[Order, int]:
    """The numbering of ``docs`` (a byte is at least one id) and their bytes of text: one aggregate."""
    size = F.coalesce(F.octet_length(text_col), F.lit(0))
    r = docs.agg(F.min(id_col).alias("lo"), F.max(id_col).alias("hi"), F.max(size).alias("top"),
                 F.sum(size.cast("long")).alias("bytes")).first()
    ids = 0 if r.lo is None else r.hi - r.lo + 1
    return Order(r.lo or 0, ids, (r.top or 0) // LENGTH + 1, key, copies), r.bytes or 0


def sequences(docs: DataFrame, plan: Order, shards: int, id_col: str = "doc_id", text_col: str = "text",
              vocabulary: str = VOCABULARY) -> DataFrame:
    """(shard, at, record): every sequence as a fixed-stride record, and its permuted number (and its
    ``low`` bits, where numbers are wider than a long)."""
    width = -(-(((plan.size - 1) >> plan.shift) + 1) // shards)
    names = ["shard", "at", "low", "record"] if plan.shift else ["shard", "at", "record"]

    def copy_of(i, text, seen, repeats):
        """Which of its id's copies a row is (see above); ``seen`` and ``repeats`` are the task's."""
        of_text = xxhash.xxh64_intdigest(text)
        row = xxhash.xxh64_intdigest(struct.pack("<qQ?", i or 0, of_text, i is None))
        if row not in seen:
            seen.add(row)
            return of_text % plan.copies
        repeats[row] = repeats.get(row, 0) + 1
        part = TaskContext.get().partitionId()
        return xxhash.xxh64_intdigest(struct.pack("<QIQ", of_text, part, repeats[row])) % plan.copies

    def encode(batches):
        enc, pad = Encoder(vocabulary), struct.pack("<H", END) * LENGTH
        seen, repeats = set(), {}
        for batch in batches:
            numbers, records = [], []

            def flush():
                at, low = plan.split(numbers)
                arrays = [pa.array((at // width).astype(np.int32)), pa.array(at), pa.array(low),
                          pa.array(records, pa.binary())]
                return pa.RecordBatch.from_arrays(arrays if plan.shift else arrays[:2] + arrays[3:], names)

            for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = enc.encode(t.as_py() or "") + pad[:2]
                copy = 0 if plan.copies == 1 else copy_of(i, t.as_buffer() or b"", seen, repeats)
                first = plan.number(i, 0, copy)
                for place, a in enumerate(range(0, len(ids), 2 * LENGTH)):
                    part = ids[a:a + 2 * LENGTH]
                    numbers.append(first + place)
                    records.append(struct.pack(HEAD, i or 0, place, len(part) // 2, int(i is None)) + part
                                   + pad[len(part):])
                    if len(records) == 8192:
                        yield flush()
                        numbers.clear()
                        records.clear()
            if records:
                yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    return rows.mapInArrow(encode, "shard int, at long, low long, record binary" if plan.shift
                           else "shard int, at long, record binary")


def write(docs: DataFrame, path: str, key: int = 1, id_col: str = "doc_id", text_col: str = "text",
          vocabulary: str = VOCABULARY, shard_text: int = SHARD_TEXT, copies: int = 1) -> None:
    """Write the shards (folders ``shard=N`` of one file) under ``path``."""
    plan, size = order(docs, key, id_col, text_col, copies)
    shards = max(1, -(-size // shard_text))
    dealt = sequences(docs, plan, shards, id_col, text_col, vocabulary).repartitionById(shards, F.col("shard"))
    # the text writer passes bytes through: a record and a line feed are one stride
    (dealt.sortWithinPartitions(*dealt.columns).select(F.col("record").cast("string").alias("value"), "shard")
     .write.partitionBy("shard").text(path))


def read(spark: SparkSession, path: str, with_ids: bool = False, from_slot: int = 0) -> DataFrame:
    """One row per record in the files: slot (global), shard, row, byte_offset, doc_id, place,
    n_ids, crc32 (of the used ids), and the ids if asked for. A run that stopped resumes with
    ``from_slot``: shards that end before it are not opened, records before it not parsed."""
    begin = (-1, 0)     # the first shard to read, and its first record

    def parse(batches):
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
                data = content.as_buffer()
                if data.size % STRIDE:
                    raise ValueError(f"shard {shard} is not a whole number of records")
                kind = np.dtype([("doc", "<i8"), ("place", "<u4"), ("n", "<u2"), ("flags", "<u2"),
                                 ("ids", "<u2", LENGTH), ("end", "u1")])
                start = begin[1] if shard == begin[0] else 0
                r = np.frombuffer(data, kind)[start:]
                crc = [zlib.crc32(x["ids"][:x["n"]].tobytes()) for x in r]
                arrays = [pa.array(np.full(len(r), shard, np.int32)), pa.array(np.arange(start, start + len(r), dtype=np.int64)),
                          pa.array(r["doc"].copy(), mask=r["flags"] == 1), pa.array(r["place"].astype(np.int64)),
                          pa.array(r["n"].astype(np.int64)), pa.array(crc, pa.int64())]
                names = ["shard", "row", "doc_id", "place", "n_ids", "crc32"]
                if with_ids:
                    arrays.append(pa.array([x["ids"][:x["n"]].astype(np.int32) for x in r], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    ddl = "shard int, row long, doc_id long, place long, n_ids long, crc32 long" + ", ids array<int>" * with_ids
    files = spark.read.format("binaryFile").load(path)
    if "shard" not in files.columns:     # nothing was written
        return spark.createDataFrame([], "slot long, byte_offset long, " + ddl)
    # one row per shard: the base of each is the sum of those before it
    sizes = files.select("shard", (F.col("length") / STRIDE).cast("long").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    if from_slot > 0:
        at = bases.join(sizes, "shard").where(F.col("base") + F.col("n") > from_slot)
        found = at.agg(F.min_by(F.struct("shard", "base"), "shard").alias("f")).first().f
        if found is None:       # every record lies before the slot
            return spark.createDataFrame([], "slot long, byte_offset long, " + ddl)
        begin = (found.shard, from_slot - found.base)
        files = files.where(F.col("shard") >= found.shard)
    rows = files.select("shard", "content").mapInArrow(parse, ddl)
    return rows.join(bases, "shard").withColumn("slot", F.col("base") + F.col("row")).withColumn(
        "byte_offset", F.col("row") * STRIDE).drop("base")


def training_order_query(docs: DataFrame, key: int = 1) -> DataFrame:
    """The digest the op1 query returns: the shards written, and read back."""
    path = shared_path(docs.sparkSession, "shards")
    write(docs, path, key, copies=COPIES)
    return read(docs.sparkSession, path).select("slot", "shard", "row", "byte_offset", "doc_id", "place", "n_ids",
                                                "crc32")
