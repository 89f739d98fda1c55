"""Quoted CSV read by many tasks per file (inventory SRC4).

A quoted field may hold line ends, so where a record starts depends on the quotes before
it. A file is scanned as text lines in byte ranges (splits), in three steps:

1. the quotes of each split are counted (one row per split);
2. a running parity over a file's splits tells whether a split starts inside a field;
3. each split, knowing its start, joins its lines to records; pieces of records that cross
   a split's border are put together by file and order, all others stay where they are.

Quotes must stand around fields or doubled within them, as RFC 4180 has it; then a line
end is a record's end exactly where the number of quotes so far is even. Records are
parsed by ``from_csv``; line ends and quotes within fields are kept as they are.
"""

from __future__ import annotations

import csv

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

BOM = "﻿"
HEADER_LINES = 100       # the lines a header may spread over


def _lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))


def split_starts(lines: DataFrame) -> DataFrame:
    """(file, split, inside): whether a split starts within a quoted field."""
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "split").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("file", "split", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))


PIECES = "file string, split long, at int, opens boolean, head boolean, text string"


def _joined(whole: bool):
    """Lines (value, file, split, inside) -> the split's whole records, or its pieces of records that
    cross its borders: ``at`` 0 for the one that came in, 1 for the one that goes on (``opens``).
    ``head``: the file's first record."""
    def work(batches):
        # the split at hand, its open record's lines, whether that began here, and whether it is the file's first
        now, held, opened, head = None, [], False, False

        def rows(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out, strict=True), (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string()),
                strict=True)], ["file", "split", "at", "opens", "head", "text"])

        def rest():
            """What the split leaves open."""
            if held and not whole:
                yield rows([(*now, 1 if opened else 0, opened, head, "\n".join(held))])
            held.clear()

        for batch in batches:
            value, file, split = (batch.column(i) for i in range(3))
            key = np.array(split)
            names = file.dictionary_encode()
            which = np.array(names.indices)
            edge = np.flatnonzero((key[1:] != key[:-1]) | (which[1:] != which[:-1])) + 1
            for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(key)], strict=True):
                if b == a:
                    continue
                here = (names.dictionary[int(which[a])].as_py(), int(key[a]))
                start = here != now
                if start:
                    yield from rest()
                    now, opened, state = here, False, int(batch.column(3)[a].as_py())
                lines = value.slice(a, b - a)
                after = (state + np.cumsum(np.array(pc.count_substring(lines, '"'), np.int64))) % 2
                before = np.r_[state, after[:-1]]
                state = int(after[-1])
                single = (before == 0) & (after == 0)
                if whole and single.any():
                    done = lines.filter(pa.array(single))
                    heads = np.zeros(len(done), bool)
                    heads[0] = start and here[1] == 0 and single[0]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([here[0]] * len(done)), pa.array([here[1]] * len(done)),
                         pa.array(np.zeros(len(done), np.int32)), pa.array(np.ones(len(done), bool)), pa.array(heads), done],
                        ["file", "split", "at", "opens", "head", "text"])
                out = []
                for i in np.flatnonzero(~single).tolist():
                    if before[i] == 0:
                        opened, head = True, start and here[1] == 0 and i == 0
                    held.append(lines[i].as_py())
                    if after[i] == 0:
                        if opened == whole:
                            out.append((*here, 0, opened, head, "\n".join(held)))
                        held.clear()
                        opened = head = False
                if out:
                    yield rows(out)
        yield from rest()
    return work


def records(spark: SparkSession, path) -> DataFrame:
    """(file, head, text): the records of all files under ``path`` without line ends; ``head`` marks
    each file's first one.
    A file that ends within a field gives its rest as a record, as Spark's reader does."""
    lines = _lines(spark, path)
    # one row per split; the join keeps the lines' order, as its left side is streamed
    placed = lines.join(F.broadcast(split_starts(lines)), ["file", "split"]).select("value", "file", "split", "inside")
    whole = placed.mapInArrow(_joined(True), PIECES)
    order = Window.partitionBy("file").orderBy("split", "at")
    pieces = placed.mapInArrow(_joined(False), PIECES).withColumn("record", F.sum(F.col("opens").cast("int")).over(order))
    crossing = pieces.groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("split", "at", "text"))).alias("p"), F.bool_or("head").alias("head"))
    return whole.select("file", "head", "text").unionByName(
        crossing.select("file", "head", F.array_join("p.text", "\n").alias("text")))


def _header(spark: SparkSession, path) -> list[str]:
    """The column names in the header record of the first file that has lines."""
    first = spark.read.option("lineSep", "\n").text(path).head(HEADER_LINES)
    text, quotes = "", 0
    for n, row in enumerate(first):
        text += ("\n" if n else "") + row[0]
        quotes += row[0].count('"')
        if quotes % 2 == 0:
            break
    cells = next(csv.reader([text.removeprefix(BOM).rstrip("\r")]), [])
    names = [c or f"_c{i}" for i, c in enumerate(cells)]
    return [f"{c}{i}" if names.count(c) > 1 else c for i, c in enumerate(names)]


def read_quoted_csv(spark: SparkSession, path) -> DataFrame:
    """Files that start with a header record -> text columns named by it, null where a field is empty. Records with
    too few fields end in nulls, further fields are ignored. All files have the first one's columns."""
    names = _header(spark, path)
    if not names:
        return spark.createDataFrame([], StructType([]))
    schema = StructType([StructField(c, StringType()) for c in names])
    text = F.regexp_replace("text", "\r$", "")
    body = records(spark, path).where((text != "") & ~F.col("head"))
    return body.select(F.from_csv(text, _ddl(schema), {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}).alias("r")) \
        .select("r.*")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` STRING" for f in schema)
