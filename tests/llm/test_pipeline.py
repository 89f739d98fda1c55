"""The pipeline against a brute-force version on a small fixture."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from refmart.llm import common, op2_quality, op3_sentencepiece, op5_pii

from . import brute


def test_pipeline_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {r.doc_id for r in op2_quality.quality_query(docs).where("kept").collect()}
    comp = brute.simhash_components([(i, rows[i].text) for i in kept])
    kept = {c for _, c in comp.values()}

    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower_az(t))
    wins = {tuple(w[k:k + 10]) for w in (split(b.text) for b in bench) for k in range(max(1, len(w) - 9)) if w}
    sizes = {len(g) for g in wins}
    kept = {i for i in kept if not any(tuple(w[k:k + n]) in wins for w in [split(rows[i].text)] for n in sizes
                                       for k in range(len(w) - n + 1))}
    stages, df = {}, docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        df = stage(spark, df, "/root/testdata/sf0.001").cache()
        assert df.columns == docs.columns, name
        stages[name] = df
    clean = {r.doc_id: r for r in stages["PII"].collect()}
    assert set(clean) == kept
    for i, r in clean.items():
        assert r.n_chars == len(r.text)
        for kind, a, b in brute.pii(rows[i].text):
            assert rows[i].text[a:b] not in r.text and f"[{kind.upper()}]" in r.text
        if not re.search(r"[0-9@]", rows[i].text):
            assert r.text == rows[i].text
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in out} == kept and all(r.lossless for r in out)
    v = op3_sentencepiece.Vocabulary()
    for r in out:
        assert v.decode(np.frombuffer(r.piece_ids, "<u2")) == clean[r.doc_id].text


def test_pipeline_of_an_empty_table(spark, tmp_path):
    one = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one.withColumn("extra", F.lit(1)).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert op5_pii.train(one.limit(0)).shape == (len(op5_pii.FEATURES), 4)


def test_stages_with_odd_rows(spark):
    """Nulls in any column, empty and very long texts, repeated rows, null ids and clashing column names
    through every stage; each keeps the columns and whole clean rows."""
    import random
    rng = random.Random(11)
    names = ("k_id", "k_hash", "k_text", "q", "fail_bits", "n_words", "at", "spans", "fp", "root", "n", "row", "k_row")

    def prose(n):
        return " ".join("".join(rng.choice("abcdefghijklmno") for _ in range(rng.randint(3, 9))) for _ in range(n))

    clean = [(i, prose(120) + " end.") for i in range(1, 9)]
    mail = (20, prose(80) + " write to ann.lee@mail.example.org today " + prose(20))
    odd = [(30, None), (31, ""), (32, " \n "), (None, prose(110)), (33, prose(30_000))]
    rows = clean + [clean[0], (40, clean[1][1]), mail] + odd
    ddl = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in names)
    docs = spark.createDataFrame([(i, t, None, None, None if t is None else len(t), *[None] * len(names))
                                  for i, t in rows], ddl)
    want = {i for i, _ in clean} | {20, None, 33}       # 40 is a copy of 2; null, empty and blank texts are rejected
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, "/root/testdata/sf0.001"), "odd")
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and set(names) <= set(docs.columns)
        kept = docs.collect()
        assert {r.doc_id for r in kept} >= want
    assert sorted(r.doc_id or 0 for r in kept) == sorted(i or 0 for i in want)
    texts = dict(rows)
    for r in kept:
        assert r.n_chars == len(r.text)
        assert ("[EMAIL]" in r.text) == (r.doc_id == 20)
        if r.doc_id != 20:
            assert r.text == texts[r.doc_id]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").collect()
    assert len(out) == len(kept) and all(r.lossless and r.n_pieces > 0 for r in out)
