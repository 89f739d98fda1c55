"""Chunks of documents, and integer arrays packed for the shuffle.

A chunk is a row that holds some thousand texts. Operators that compare small
pieces of all texts (n-grams, suffixes) send each piece once per chunk to a range
of the pieces' hashes, and get an answer back for the chunk: so a piece that
occurs everywhere makes no hot key, and a row of the shuffle is an array.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

CHUNK_BYTES = 8 << 20      # text of a chunk; a longer text is a chunk of its own


def planes(values: np.ndarray) -> bytes:
    """Integers as byte planes: the bytes that are mostly zero stand together."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def unplanes(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def steps(values: np.ndarray) -> np.ndarray:
    """Differences of sorted values, the first from zero."""
    return np.diff(values, prepend=np.zeros(1, values.dtype)) if len(values) else values


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pack(texts: list[bytes | None]) -> bytes:
    size = np.array([-1 if t is None else len(t) for t in texts], np.int64)
    return zstandard.compress(len(texts).to_bytes(8, "little") + size.tobytes() + b"".join(t or b"" for t in texts), 3)


def unpack(blob: bytes) -> list[bytes]:
    data = zstandard.decompress(blob)
    n = int.from_bytes(data[:8], "little")
    ends = np.cumsum(np.maximum(np.frombuffer(data, np.int64, n, 8), 0)) + 8 + 8 * n
    starts = np.r_[8 + 8 * n, ends[:-1]] if n else ends
    return [data[a:b] for a, b in zip(starts, ends, strict=True)]


def bounds(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where the hash ranges begin and end in sorted hashes."""
    if not bits:
        return np.array([0, len(hashes)])
    firsts = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.r_[0, np.searchsorted(hashes, firsts), len(hashes)]


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES,
           note=lambda texts: b"") -> DataFrame:
    """(chunk, ids, no_id, blob, bytes, note), written once: later steps agree on the chunks. A null
    id is 0 in ``ids`` and true in ``no_id`` (arrays with nulls would become floats in pandas).
    ``note``: what is worked out once from a chunk's texts and kept with them."""
    def cut(batches):
        part, n = TaskContext.get().partitionId(), 0
        ids, texts, held = [], [], 0

        def row():
            return pa.RecordBatch.from_arrays([
                pa.array([(part << 32) + n]), pa.array([[i or 0 for i in ids]], pa.list_(pa.int64())),
                pa.array([[i is None for i in ids]], pa.list_(pa.bool_())), pa.array([pack(texts)], pa.binary()),
                pa.array([held]), pa.array([note([t or b"" for t in texts])], pa.binary())],
                ["chunk", "ids", "no_id", "blob", "bytes", "note"])

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = t.as_buffer() if t.is_valid else None
                text = None if text is None else text.to_pybytes()
                if texts and held + len(text or b"") > chunk_bytes:
                    yield row()
                    n, ids, texts, held = n + 1, [], [], 0
                ids.append(i)
                texts.append(text)
                held += len(text or b"")
        if texts:
            yield row()

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    return written(rows.mapInArrow(cut, "chunk long, ids array<long>, no_id array<boolean>, blob binary, bytes long, note binary"),
                   "chunks")
