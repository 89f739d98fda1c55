"""License scan by diagonal voting (native DataFrame functions only).

The hashes of all rolling word k-grams of every text are joined to the positions of the
same grams in the license templates (a fixed, broadcast table; short templates have grams of
``SHORT`` words, others of ``LONG``). A match votes for the diagonal ``text position -
template position``; votes are summed per diagonal, written once, and neighbouring diagonals
(a word added or dropped) are merged. Where enough words have votes, the document's words are
aligned with the template's: in order, at most ``MAX_EXTRA`` words between them, none of which
changes the license, and no word left out that names it. Of overlapping spans the best one
stays. Base phrases are templates that must match completely on one diagonal.

A text's words travel only with the first vote of a stretch of equal words on a diagonal, so
a whole license text costs a few copies of its words, not one for each of its grams.

Defined results: null and empty texts have no words, no labels and score 0; texts of any
length are read whole; repeated rows each get their own (equal) result and a null doc_id is a
key like any other; an empty table gives an empty result; further columns of the input are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keyed, same_key, split_alnum, written

SHORT, LONG = 2, 4   # words per gram; the shortest base phrase has two
LONG_TEMPLATE = 12   # words from which a template's grams are long
MERGE_DRIFT = 2      # diagonals this close may be one shifted copy
MIN_COVERAGE = 0.8   # of a template's words, for a span to count
MAX_EXTRA = 3        # words of a span that are not the template's

# Words that make another license of the same notice, and so may not stand between a
# template's words; like them, a word with a digit. A template's own ones (and those
# that name a license without changing it) may not be left out.
CHANGING = ("not", "nc", "nd", "sa", "lesser", "library", "affero", "mit", "apache", "gnu", "bsd", "mozilla",
            "eclipse", "cc", "cc0", "sharealike", "noncommercial", "noderivatives", "gpl", "lgpl", "agpl", "mpl", "isc",
            "only", "later", "clause", "boost", "zlib")
NAMING = (*CHANGING, "by", "general", "public", "domain", "attribution", "identifier", "provided", "bsl", "epl",
          "unlicense")

# Base phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# License notices (short standard forms) and the labels they stand for.
NOTICES = (
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("dedicated to the public domain under cc0 1 0 universal", "cc0-1.0"),
)

# Longer standard headers and texts, as published with the licenses.
HEADERS = (
    ("mit license copyright c", "mit"),
    ("the mit license mit", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
     "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
     "and this permission notice shall be included in all copies or substantial portions of the software", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
     "license you may obtain a copy of the license at http www apache org licenses license 2 0", "apache-2.0"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
     "distributed with this file you can obtain one at http mozilla org mpl 2 0", "mpl-2.0"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     "0bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
     "provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("boost software license version 1 0", "bsl-1.0"),
    ("eclipse public license v 2 0", "epl-2.0"),
    ("this software is provided as is without any express or implied warranty in no event will the authors be held liable "
     "for any damages arising from the use of this software", "zlib"),
)

# Names of which a rule makes notices: Creative Commons attributes, GNU families and versions, SPDX identifiers.
CC_ATTRIBUTES = (("attribution", "cc-by"), ("attribution sharealike", "cc-by-sa"),
                 ("attribution noncommercial", "cc-by-nc"), ("attribution noderivatives", "cc-by-nd"),
                 ("attribution noncommercial sharealike", "cc-by-nc-sa"),
                 ("attribution noncommercial noderivatives", "cc-by-nc-nd"))
GNU = (("", "gpl", ("2", "3")), ("lesser ", "lgpl", ("2 1", "3")), ("affero ", "agpl", ("3",)))
SPDX = ("MIT", "Apache-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later",
        "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0",
        "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "EPL-2.0", "CC0-1.0",
        "CC-BY-4.0", "CC-BY-SA-4.0", "BSL-1.0", "Unlicense", "Zlib", "0BSD")


def _by_rule():
    for version in ("3 0", "4 0"):
        for words, name in CC_ATTRIBUTES:
            yield f"creative commons {words} {version} international", f"{name}-{version.replace(' ', '.')}"
    for family, name, versions in GNU:
        for v in versions:
            yield (f"under the terms of the gnu {family}general public license as published by the free software foundation "
                   f"either version {v} of the license or at your option any later version",
                   f"{name}-{v.replace(' ', '.') if ' ' in v else v + '.0'}-or-later")
    for name in SPDX:
        yield f"spdx license identifier {name.lower().replace('-', ' ').replace('.', ' ')}", name.lower()


TEMPLATES = (*NOTICES, *HEADERS, *_by_rule())


def gram_words(size: int) -> int:
    """Words per gram of a template with ``size`` words."""
    return LONG if size >= LONG_TEMPLATE else SHORT


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda x: F.xxhash64(x))


def _rolled(hashes: Column, step: int) -> Column:
    """Hashes of two stretches that stand ``step`` words apart (past the end: of less than that).
    ``hashes`` should be a plain column, as it is named three times."""
    return F.zip_with(hashes, F.slice(hashes, F.lit(step + 1), F.size(hashes)), lambda a, b: F.xxhash64(a, b))


def template_grams(spark, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """(gram hash, k, template, label, at, size, base, words, slack): one row per template position
    that starts a gram; its size is fixed by the lists above."""
    rows = []
    for n, (text, label) in enumerate([*phrases, *templates]):
        words = text.split()
        if len(words) < SHORT:
            raise ValueError(f"a template needs at least {SHORT} words: {text!r}")
        rows.append((n, label, len(words), n < len(phrases), words, _slack(words), gram_words(len(words))))
    t = spark.createDataFrame(rows, "template int, label string, t_size int, base boolean, t_words array<string>, "
                                    "slack int, k int")
    t = t.withColumn("h", _hashes(F.col("t_words"))).withColumn("short", _rolled(F.col("h"), 1))
    t = t.withColumn("grams", F.when(F.col("k") == SHORT, F.col("short")).otherwise(_rolled(F.col("short"), SHORT)))
    return t.select("*", F.posexplode("grams").alias("t_at", "gram_hash")).where("t_at <= t_size - k").drop(
        "h", "short", "grams")


def _slack(words: list[str]) -> int:
    """How far a word of a span can be from any of its diagonals: words added or left out."""
    return MAX_EXTRA + int(len(words) * (1 - MIN_COVERAGE) + 1e-9)


def votes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES,
          templates=TEMPLATES) -> DataFrame:
    """(k_id, k_hash, template, label, t_size, base, k, at, t_at, diag, t_words, from, words): every
    k-gram of a text that stands in a template. Where a stretch of equal words begins, ``words`` are
    the text's words (from position ``from`` on) that a span on its diagonal can hold. Equal hashes
    are checked by their words."""
    w = F.col("w")
    d = keyed(docs, id_col, text_col).select("k_id", "k_hash", split_alnum(F.col("k_text")).alias("w"))
    d = d.select("*", _hashes(w).alias("h"))
    d = d.select("k_id", "k_hash", "w", _rolled(F.col("h"), 1).alias("short"))
    # all grams of a text in one array: the short ones, then the long ones, at their first words' places
    d = d.select("k_id", "k_hash", "w", F.size(w).alias("n"), F.concat("short", _rolled(F.col("short"), SHORT)).alias("all"))
    # outer: else a filter on the array's size is inferred, pushed down, and computes all of this again
    rolling = d.select("k_id", "k_hash", "w", "n", F.posexplode_outer("all").alias("place", "gram_hash"))
    g = template_grams(docs.sparkSession, phrases, templates)
    found = rolling.join(F.broadcast(g), "gram_hash").withColumn(
        "at", F.when(F.col("place") < F.col("n"), F.col("place")).otherwise(F.col("place") - F.col("n")))
    at, t_at = F.col("at"), F.col("t_at")
    found = found.where(F.slice(w, at + 1, F.col("k")) == F.slice("t_words", t_at + 1, F.col("k")))
    first = (at == 0) | (t_at == 0) | (F.get(w, at - 1) != F.get("t_words", t_at - 1))
    start = F.greatest(at - t_at - F.col("slack"), F.lit(0))
    near = F.slice(w, start + 1, F.col("t_size") + 2 * F.col("slack"))
    return found.select("k_id", "k_hash", "template", "label", "t_size", "base", "k", "at", "t_at", (at - t_at).alias("diag"),
                        F.when(~F.col("base"), F.col("t_words")).alias("t_words"), start.alias("from"),
                        F.when(first & ~F.col("base"), near).alias("words"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _changing(word: Column) -> Column:
    return word.isin(*CHANGING) | word.rlike("[0-9]")


def aligned(words: Column, t_words: Column) -> Column:
    """The best alignment of a template within ``words``: (matched, -extra, -end), the most
    words matched in order, then the fewest others between them, then the first.

    Cell ``e * (MAX_EXTRA + 1) + x`` of the state holds the most template words so far that
    an alignment matches which ends before word ``e`` and holds ``x`` other words."""
    width, never = MAX_EXTRA + 1, F.lit(-1_000_000)

    def table(plain: Column) -> Column:
        def matched(prev, t):
            needed = t.isin(*NAMING) | t.rlike("[0-9]")
            return F.transform(prev, lambda v, i: F.greatest(
                F.when(needed, never).otherwise(v),
                F.when((i >= width) & (F.get(words, F.floor(i / width).cast("int") - 1) == t),
                       F.get(prev, i - width) + 1).otherwise(never)))

        def widened(cells):
            def cell(v, i):
                ends, allowed = [v], F.lit(True)
                for k in range(1, width):     # k other words behind the last one matched
                    allowed = allowed & F.coalesce(F.get(plain, F.floor(i / width).cast("int") - k), F.lit(False))
                    ends.append(F.when((i % width >= k) & allowed, F.get(cells, i - k * (width + 1))).otherwise(never))
                return F.greatest(*ends)
            return F.transform(cells, cell)

        start = F.transform(F.sequence(F.lit(0), (F.size(words) + 1) * width - 1),
                            lambda i: F.when(i % width == 0, F.lit(0)).otherwise(never))
        return F.aggregate(t_words, start, lambda prev, t: _let(matched(prev, t), widened))

    cells = _let(F.transform(words, lambda x: ~_changing(x)), table)
    return F.array_max(F.transform(cells, lambda v, i: F.struct(
        v.alias("matched"), (-(i % width)).alias("extra"), (-F.floor(i / width).cast("int")).alias("end"))))


def lines(found: DataFrame) -> DataFrame:
    """One row per diagonal: the template positions that voted, and the words around it. Written
    once, as the spans are read from it twice."""
    key = ["k_id", "k_hash", "template", "label", "t_size", "base", "k"]
    return written(found.groupBy(*key, "diag").agg(
        F.collect_set("t_at").alias("votes"), F.min("at").alias("lo"), F.max("at").alias("hi"),
        F.first("from").alias("from"), F.first("words", ignorenulls=True).alias("words"),
        F.first("t_words").alias("t_words")), "license_votes")


def spans(voted: DataFrame) -> DataFrame:
    """Merged, verified spans: (k_id, k_hash, template, label, base, start, end, coverage)."""
    out = ["k_id", "k_hash", "template", "label", "base", "start", "end", "coverage"]
    # a base phrase stands on one diagonal, with all its grams
    base = voted.where(F.col("base") & (F.size("votes") == F.col("t_size") - F.col("k") + 1)).select(
        "k_id", "k_hash", "template", "label", "base", F.col("lo").alias("start"), (F.col("hi") + F.col("k")).alias("end"),
        F.lit(1.0).alias("coverage"))
    # neighbouring diagonals form one candidate
    key = ["k_id", "k_hash", "template", "label", "t_size", "base", "k"]
    w = Window.partitionBy(*key).orderBy("diag")
    step = F.col("diag") - F.lag("diag").over(w)
    new = F.when(step.isNull() | (step > MERGE_DRIFT), 1).otherwise(0)
    cand = voted.where(~F.col("base")).withColumn("new", new).withColumn(
        "group", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    cand = cand.groupBy(*key, "group").agg(
        F.array_distinct(F.flatten(F.collect_list("votes"))).alias("votes"),
        F.collect_list(F.struct("from", "words")).alias("texts"), F.first("t_words").alias("t_words"))
    # a gram at t_at votes for the template words t_at .. t_at + k - 1
    known = F.size(F.array_distinct(F.flatten(F.transform("votes", lambda v: F.sequence(v, v + F.col("k") - 1)))))
    # the words around every diagonal of a candidate are held against the template's
    near = cand.where(known / F.col("t_size") >= MIN_COVERAGE).withColumn(
        "t", F.explode("texts")).withColumn("best", aligned(F.col("t.words"), F.col("t_words")))
    best = F.col("best")
    near = near.withColumn("coverage", best["matched"] / F.col("t_size")).where(F.col("coverage") >= MIN_COVERAGE)
    near = near.withColumn("extra", -best["extra"]).withColumn("end", F.col("t.from") - best["end"]).withColumn(
        "start", F.col("end") - best["matched"] - F.col("extra"))
    return base.unionByName(best_spans(near.select(*out, "extra")).select(*out))


def best_spans(near: DataFrame) -> DataFrame:
    """Of spans that overlap, the best: most coverage, fewest other words, longest, first listed."""
    doc = ["k_id", "k_hash"]
    w = Window.partitionBy(*doc).orderBy("start", "end")
    reached = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    near = near.distinct().withColumn("new", (reached.isNull() | (F.col("start") >= reached)).cast("int")).withColumn(
        "cluster", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rank = F.struct((-F.col("coverage")).alias("worse"), "extra", (F.col("start") - F.col("end")).alias("short"),
                    "template", "start", "end", "label", "base", "coverage")
    spans = near.groupBy(*doc, "cluster").agg(F.sort_array(F.collect_list(rank)).alias("s"))
    kept = F.aggregate("s", F.slice("s", 1, 1), lambda got, s: F.when(
        F.exists(got, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])), got).otherwise(
        F.concat(got, F.array(s))))
    return spans.select(*doc, F.explode(kept).alias("s")).select(*doc, "s.*")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels,
    labels (distinct, sorted, comma-joined), score (the best coverage of a template)."""
    found = spans(lines(votes(docs, id_col, text_col, PHRASES, templates)))
    def labels(c):
        return F.array_join(F.sort_array(F.collect_set(c)), ",")
    base = F.col("base")
    found = found.groupBy("k_id", "k_hash").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        labels(F.when(base, F.col("label"))).alias("base_labels"),
        labels(F.col("label")).alias("labels"),
        F.max("coverage").cast("double").alias("score"))
    d = keyed(docs, id_col, text_col).select(
        "k_id", "k_hash", F.size(split_alnum(F.col("k_text"))).alias("n_words"))
    out = d.join(found, same_key(d, found), "left")
    return out.select(d["k_id"].alias(id_col), F.col("n_words").cast("long").alias("n_words"),
                      F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
                      F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                      F.coalesce("labels", F.lit("")).alias("labels"),
                      F.coalesce("score", F.lit(0.0)).alias("score"))
